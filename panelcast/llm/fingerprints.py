"""Document fingerprints that add up: a homomorphic multiset hash of paragraphs.

Every paragraph (a line that is not blank) is hashed to a wide vector; a document's fingerprint is the sum of the
vectors, lane by lane, modulo a power of two. So the order of paragraphs does not matter, and a paragraph is inserted
or deleted by adding or subtracting its vector, without the rest of the text.

The vector has two parts. LANES lanes modulo 2**64 are a cryptographic hash of the paragraph and decide equality.
SKETCH lanes modulo 2**32 are a signed count sketch of its word shingles; being sums as well, they estimate the cosine
of two documents' shingle counts, with an error of about 1 / sqrt(SKETCH), which is the likeness.

Defined cases: null texts count as empty; texts without paragraphs have the zero fingerprint, equal to each other
(likeness 1) and unlike all others (0); equal texts have equal fingerprints; repeated rows are documents of their own;
rows without id come first; a single row is its own next document; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.words import shingle_hashes, word_hashes

LANES, SKETCH, SHINGLE = 8, 256, 3
SIZE = LANES * 8 + SKETCH * 4
CHUNK_CHARS = 1 << 22
FIRST = -(1 << 63)


class Fingerprints:
    """Fingerprints of many texts: ``lanes`` (uint64) and ``sketch`` (uint32), a row each."""

    def __init__(self, lanes: np.ndarray, sketch: np.ndarray):
        self.lanes, self.sketch = lanes, sketch

    @classmethod
    def of(cls, texts: list[str | None]) -> Fingerprints:
        paragraphs, document = [], []
        for i, text in enumerate(texts):
            for line in (text or "").split("\n"):
                if line and not line.isspace():
                    paragraphs.append(line)
                    document.append(i)
        document = np.array(document, np.int64)
        lanes, sketch = np.zeros((len(texts), LANES), np.uint64), np.zeros((len(texts), SKETCH), np.uint32)
        if paragraphs:
            digests = b"".join(hashlib.blake2b(p.encode("utf-8", "replace"), digest_size=LANES * 8).digest() for p in paragraphs)
            begins = np.flatnonzero(np.append(True, document[1:] != document[:-1]))
            lanes[document[begins]] = np.add.reduceat(np.frombuffer(digests, "<u8").reshape(-1, LANES), begins, axis=0)
            words, owner = word_hashes(paragraphs)
            hashes, owner = shingle_hashes(words, owner, len(paragraphs), SHINGLE)
            cell = document[owner] * SKETCH + (hashes % np.uint64(SKETCH)).astype(np.int64)
            sign = np.where(hashes >> np.uint64(63), 1.0, -1.0)
            sums = np.bincount(cell, sign, len(texts) * SKETCH).astype(np.int64)
            sketch = (sums & 0xFFFFFFFF).astype(np.uint32).reshape(-1, SKETCH)
        return cls(lanes, sketch)

    def __len__(self) -> int:
        return len(self.lanes)

    def __getitem__(self, at) -> Fingerprints:
        return Fingerprints(self.lanes[at], self.sketch[at])

    def __add__(self, other: Fingerprints) -> Fingerprints:
        return Fingerprints(self.lanes + other.lanes, self.sketch + other.sketch)

    def __sub__(self, other: Fingerprints) -> Fingerprints:
        return Fingerprints(self.lanes - other.lanes, self.sketch - other.sketch)

    def encode(self) -> list[str]:
        return [base64.b64encode(a.astype("<u8").tobytes() + b.astype("<u4").tobytes()).decode() for a, b in zip(self.lanes, self.sketch)]

    @classmethod
    def decode(cls, strings: list[str]) -> Fingerprints:
        raw = np.frombuffer(b"".join(base64.b64decode(s) for s in strings), np.uint8).reshape(-1, SIZE)
        lanes = np.ascontiguousarray(raw[:, : LANES * 8]).view("<u8")
        return cls(lanes.astype(np.uint64), np.ascontiguousarray(raw[:, LANES * 8 :]).view("<u4").astype(np.uint32))

    def likeness(self, other: Fingerprints) -> np.ndarray:
        """Between 0 and 1, row by row; 1 for equal fingerprints."""
        a, b = self.sketch.view(np.int32).astype(np.float64), other.sketch.view(np.int32).astype(np.float64)
        norms = np.sqrt((a * a).sum(1) * (b * b).sum(1))
        cosine = np.divide((a * b).sum(1), norms, out=np.zeros(len(a)), where=norms > 0)
        equal = (self.lanes == other.lanes).all(1)
        return np.where(equal, 1.0, np.clip(cosine, 0.0, 1.0))


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` and the fingerprint of every whole text, as a string."""
    import pandas as pd

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(Fingerprints.of(list(texts)).encode(), dtype=object)

    return docs.withColumn(out, run(F.col(text)))


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def ordered_runs(docs: DataFrame) -> DataFrame:
    """``run, extra, doc_id, text``: the documents cut into runs by ascending id, each run closed by an extra row, the
    first document of the next run (after the last run: of the first). Rows of a run are together and in order.

    The driver learns the runs' bounds and first ids, two numbers per run; the texts are shuffled once.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = 8 * partitions
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST))
    ids = docs.select(key.alias("key"))
    points = ids.agg(F.percentile_approx("key", [i / runs for i in range(1, runs)], min(100 * runs, 1_000_000))).first()[0] or []
    bounds = np.unique(np.array(points, np.int64))

    def run_of(batches):
        for batch in batches:
            keys = batch.column("key").to_numpy()
            at = np.searchsorted(bounds, keys, side="right")
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("key")], ["run", "key"])

    firsts = ids.mapInArrow(run_of, "run long, key long").groupBy("run").agg(F.min("key").alias("key")).orderBy("run").collect()
    before = {r["key"]: firsts[i - 1]["run"] for i, r in enumerate(firsts)}

    def place(batches):
        names = ["run", "extra", "key", "doc_id", "text"]
        for batch in batches:
            keys = batch.column("key").to_numpy()
            at = np.searchsorted(bounds, keys, side="right")
            more = [i for i, k in enumerate(keys.tolist()) if k in before]
            rows = pa.array([*range(len(keys)), *more], pa.int64())
            run = pa.array([*at.tolist(), *[before[int(keys[i])] for i in more]], pa.int64())
            extra = pa.array([False] * len(keys) + [True] * len(more))
            yield pa.RecordBatch.from_arrays([run, extra, *[batch.column(c).take(rows) for c in names[2:]]], names)

    placed = docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    placed = placed.mapInArrow(place, "run long, extra boolean, key long, doc_id long, text string")
    return placed.repartition(partitions, "run").sortWithinPartitions("run", "extra", "key", "text")


def compare_with_next(docs: DataFrame) -> DataFrame:
    """A row per document: lengths, fingerprints of its text and of its edited text, and likenesses."""
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )

    def finish(rows):
        """``rows``: (id, text) of consecutive documents; all but the last are done."""
        texts = [t for _, t in rows]
        own = Fingerprints.of(texts)
        changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
        new, this, following = Fingerprints.of(changed), own[:-1], own[1:]
        columns = [
            pa.array([i for i, _ in rows[:-1]], pa.int64()),
            pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in changed]),
            pa.array(this.encode()),
            pa.array(new.encode()),
            pa.array(this.likeness(new)),
            pa.array(this.likeness(following)),
        ]
        return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in schema.split(", ")])

    def run(batches):
        rows, size, now, closed = [], 0, None, False
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("run", "extra", "doc_id", "text"))
            for of, extra, doc, text in zip(*columns):
                if of != now:
                    rows, size, now, closed = [], 0, of, False
                if closed:
                    continue
                rows.append((doc, text))
                size += len(text)
                if extra or size >= CHUNK_CHARS:
                    if len(rows) > 1:
                        yield finish(rows)
                    rows, size, closed = rows[-1:], len(text), extra

    return ordered_runs(docs).select("run", "extra", "doc_id", "text").mapInArrow(run, schema)


def query(spark, sf_dir):
    return compare_with_next(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
