"""Blocks of rows that exchange what they hold: packed arrays, and shards dealt by hash.

A task gathers rows into blocks of bounded size, sends each shard the distinct keys of a block (once, however many rows
of the block hold them) and later gets an answer per key. So a key that a third of all rows hold is sent once per block,
and no step depends on how often a key occurs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.words import mix

#: Characters that are worked on at once; a longer text is worked on alone.
CHUNK_CHARS = 1 << 20


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob, byte plane by byte plane."""
    parts = [len(arrays).to_bytes(4, "little")]
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T if len(a) else np.zeros(0, np.uint8)
        parts += [a.dtype.str.encode().ljust(8), len(a).to_bytes(8, "little"), planes.tobytes()]
    raw = b"".join(parts)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    count, at, out = int.from_bytes(raw[:4], "little"), 4, []
    for _ in range(count):
        kind = np.dtype(raw[at : at + 8].decode().strip())
        n = int.from_bytes(raw[at + 8 : at + 16], "little")
        at += 16
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind) if n else np.zeros(0, kind))
        at += n * kind.itemsize
    return out


def scramble(keys: np.ndarray) -> np.ndarray:
    """A bijective hash of 64-bit keys."""
    return mix(keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each hash: equal ranges, so that hashes in order are in order of their shards."""
    return (((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


def slices(shard: np.ndarray) -> list[tuple[int, slice]]:
    """(shard, slice) of every shard in an ordered array."""
    if not len(shard):
        return []
    cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
    return [(int(shard[a]), slice(a, b)) for a, b in zip(cuts, [*cuts[1:], len(shard)])]


def shard_count(docs: DataFrame, text_bytes: int) -> int:
    """Shards for a table: one per ``text_bytes`` of text, the session's shuffle partitions at least."""
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(least, -(-total // text_bytes))


def chunks(batches, columns):
    """Lists of the columns' values, a bounded number of characters (or one long text) at a time. The text is last."""
    for batch in batches:
        values = [batch.column(c).to_pylist() for c in columns]
        begin = size = 0
        for i, text in enumerate(values[-1]):
            size += len(text or "") + 1
            if size >= CHUNK_CHARS or i + 1 == len(values[-1]):
                yield [v[begin : i + 1] for v in values]
                begin, size = i + 1, 0


def masked(values: list) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, whether each is missing) of a list with None."""
    missing = np.array([v is None for v in values], bool)
    return np.array([0 if v is None else v for v in values], np.int64), missing


def batch_of(schema: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], schema)
