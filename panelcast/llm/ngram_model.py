"""Interpolated modified Kneser-Ney model (Chen and Goodman 1998) of any order from two on, over word hashes.

Counting is two passes over the training texts. The first counts words; words that are too frequent for one shard
are known from it and n-grams whose last context word is one of them are salted by the word that follows, so a shard
holds about SHARD_TOKENS at most, whatever the words. The second counts n-grams of the highest order: a block of tokens
is sorted and summed in the task and leaves as one packed row per shard. Shards are summed and written to the shared
folder as sorted arrays of hashes with their counts. The distinct n-grams of an order leave their shard once more, without
their first word: summed again, they are the continuation counts of the order below, down to the words. Context sums of
all orders follow with one last, smaller shuffle.

Scoring maps the arrays into memory, shard by shard as they are needed, and finds the words of a chunk of texts by
binary search. The mapped pages belong to the files and not to the worker. If the shared folder is no mounted file
system, a worker copies the shards it needs to an unlinked temporary file first.

Words are 64-bit hashes; in n-grams all but the last context word are told apart by 40 bits of theirs. No n-gram is pruned. A text begins
with as many begin marks as the order needs; lower orders count the contexts before them as those of any other word.

Defined cases: null texts count as empty, which is the single token that ends each text; rows without id are trained
on; without training tokens every token has probability 1 under both models; repeated rows count each time.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.store import open_store, settle
from panelcast.llm.words import mix, word_hashes
from panelcast.staging import scratch_path

#: Order of the model; the README gives the figures of three.
ORDER = 2
#: Tokens of a block in a task and, about, of a shard; characters that are hashed at once.
BLOCK_TOKENS, SHARD_TOKENS, CHUNK_CHARS = 1 << 22, 1 << 21, 1 << 22
BEGIN, END = np.uint64(0x6265_6769_6E00_0001), np.uint64(0x656E_6400_0000_0001)
_LOW = np.uint64((1 << 40) - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _texts(batches):
    """Lists of texts, a bounded number of characters (or one long text) at a time."""
    for batch in batches:
        values = batch.column("text").to_pylist()
        begin = size = 0
        for i, text in enumerate(values):
            size += len(text or "") + 1
            if size >= CHUNK_CHARS or i + 1 == len(values):
                yield values[begin : i + 1]
                begin, size = i + 1, 0


def token_grams(texts, order: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(the order - 1 tokens before, farthest first; token; text index) for all tokens, the end of each text included.

    Of the tokens before, all but the last are 40 bits.
    """
    words, owner = word_hashes(texts)
    n = len(words) + len(texts)
    tokens, owners = np.full(n, END, np.uint64), np.zeros(n, np.int64)
    at = np.arange(len(words)) + owner
    tokens[at], owners[at] = words, owner
    ends = np.cumsum(np.bincount(owner, minlength=len(texts)) + 1) - 1
    owners[ends] = np.arange(len(texts))
    before = [tokens]
    for _ in range(order - 1):
        last = np.full(n, BEGIN, np.uint64)
        last[1:] = before[0][:-1]
        last[ends[:-1] + 1] = BEGIN
        before.insert(0, last)
    before = before[:-1]
    return [*[b & _LOW for b in before[:-1]], *before[-1:]], tokens, owners


def context_hash(before: list[np.ndarray]) -> np.ndarray:
    """One hash for the words of a context; that of one word is the word's."""
    out = before[0]
    for words in before[1:]:
        out = mix(out * _ODD + words)
    return out


def _summed(keys: np.ndarray, *counts: np.ndarray):
    """Sorted distinct keys with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
    return keys[begins], *[np.add.reduceat(c[order], begins) if len(begins) else c for c in counts]


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of the hash, so sorted hashes have sorted shards."""
    return (((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays in one piece, each from a multiple of 8 bytes on, so that a mapped file needs no copies."""
    head = np.array([len(arrays), *[x for a in arrays for x in (len(a), ord(a.dtype.char))]], np.int64)
    return head.tobytes() + b"".join(a.tobytes() + bytes(-a.nbytes % 8) for a in arrays)


def unpack(blob) -> list[np.ndarray]:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    head, at, out = np.frombuffer(blob, np.int64, 2 * n, 8), 8 + 16 * n, []
    for size, kind in head.reshape(-1, 2):
        out.append(np.frombuffer(blob, np.dtype(chr(kind)), int(size), at))
        at += out[-1].nbytes + -out[-1].nbytes % 8
    return out


ROW = "kind string, shard long, blob binary, path string, sums array<double>"
_NAMES = ["kind", "shard", "blob", "path", "sums"]
_TYPES = [pa.string(), pa.int64(), pa.binary(), pa.string(), pa.list_(pa.float64())]


def _rows(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(_NAMES)
    return pa.table([pa.array(c, t) for c, t in zip(columns, _TYPES)], _NAMES)


def narrowed(counts: np.ndarray) -> np.ndarray:
    """Counts in one, two or four bytes each where the largest fits; larger ones keep eight, none is clipped."""
    most = counts.max(initial=0)
    kinds = (k for k in (np.uint8, np.uint16, np.uint32) if most <= np.iinfo(k).max)
    return counts.astype(next(kinds, counts.dtype))


def cut(hashes: np.ndarray) -> list[np.ndarray]:
    """The 40 low bits of hashes as four bytes and one."""
    return [hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint8)]


def whole(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)


def _split(kind: str, keys: np.ndarray, shards: int, *values: np.ndarray) -> list[tuple]:
    """Packed rows of sorted keys and their values, one per shard that has any."""
    shard = shard_of(keys, shards)
    cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else []
    return [
        (kind, int(shard[b]), pack(keys[b:e], *[v[b:e] for v in values]), None, None) for b, e in zip(cuts, [*cuts[1:], len(keys)])
    ]


def _write(folder: str, *arrays: np.ndarray) -> str:
    """Write arrays one after the other as a file that ``mapped`` opens; a fresh name for each attempt."""
    uri = f"{folder}/{uuid.uuid4().hex}.arrays"
    store, path = open_store(uri)
    store.create_dir(folder if folder.startswith("/") else open_store(folder)[1], recursive=True)
    with store.open_output_stream(path) as out:
        out.write(pack(*arrays))
    return uri


def mapped(uri: str) -> list[np.ndarray]:
    """The arrays of a file, backed by its pages."""
    store, path = open_store(uri)
    if store.type_name == "local":
        return unpack(np.memmap(path, np.uint8, "r"))
    with tempfile.NamedTemporaryFile(delete=False) as local, store.open_input_stream(path) as source:
        while data := source.read(1 << 20):
            local.write(data)
    try:
        return unpack(np.memmap(local.name, np.uint8, "r"))
    finally:
        os.unlink(local.name)  # the mapping keeps the pages


# Counting


def count_words(train: DataFrame, shards: int, folder: str) -> DataFrame:
    """Files of (word hash, count) by shard; ``sums``: tokens, distinct tokens."""

    def block(parts):
        keys = np.concatenate(parts)
        keys, counts = _summed(keys, np.ones(len(keys), np.int64))
        return _rows(_split("word", keys, shards, counts.astype(np.uint32))).to_batches()

    def run(batches):
        parts, size = [], 0
        for texts in _texts(batches):
            parts.append(token_grams(texts, 1)[1])
            size += len(parts[-1])
            if size >= BLOCK_TOKENS:
                yield from block(parts)
                parts, size = [], 0
        if parts:
            yield from block(parts)

    def add(table: pa.Table) -> pa.Table:
        keys, counts = (np.concatenate(x) for x in zip(*[unpack(b.as_buffer()) for b in table.column("blob")]))
        keys, counts = _summed(keys, counts.astype(np.int64))
        shard = table.column("shard")[0].as_py()
        return _rows([("words", shard, None, _write(folder, keys, counts), [float(counts.sum()), float(len(keys))])])

    return train.mapInArrow(run, ROW).groupBy("shard").applyInArrow(add, ROW)


def frequent_words(files: DataFrame, above: int) -> DataFrame:
    """``word, count`` (the hash as a signed long) of the words that occur more than ``above`` times."""

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                keys, counts = mapped(path)
                often = counts > above
                yield pa.RecordBatch.from_arrays([pa.array(keys[often].view(np.int64)), pa.array(counts[often])], ["word", "count"])

    return files.select("path").mapInArrow(run, "word long, count long")


class Salts:
    """Spreads the n-grams after frequent words over several hashes, by the low bits of the word that follows."""

    def __init__(self, words: np.ndarray, parts: np.ndarray):
        order = np.argsort(words)
        self.words, self.parts = words[order], parts[order].astype(np.uint64)

    def apply(self, before: list[np.ndarray], low: np.ndarray) -> np.ndarray:
        """The context's hash, salted where its last word is frequent."""
        out = context_hash(before)
        if not len(self.words):
            return out
        at = np.minimum(np.searchsorted(self.words, before[-1]), len(self.words) - 1)
        hot = self.words[at] == before[-1]
        out = out.copy()
        out[hot] = mix(out[hot] + (low[hot] % self.parts[at[hot]] + np.uint64(1)) * _ODD)
        return out


def gram_key(context: np.ndarray, low: np.ndarray) -> np.ndarray:
    return mix(context * _ODD + low)


def summed_grams(before: list[np.ndarray], low: np.ndarray, salts: Salts, counts: np.ndarray | None = None):
    """(salted contexts, words before, last words, counts) of distinct n-grams, in order of the first and third."""
    salted = salts.apply(before, low)
    order = np.lexsort((low, salted))
    salted, low = salted[order], low[order]
    begins = np.flatnonzero(np.append(True, (salted[1:] != salted[:-1]) | (low[1:] != low[:-1])))
    if counts is None:
        counts = np.diff(np.append(begins, len(low)))
    else:
        counts = np.add.reduceat(counts[order], begins)
    order = order[begins]
    return salted[begins], [b[order] for b in before], low[begins], counts


def gram_rows(kind: str, salted: np.ndarray, before: list[np.ndarray], low: np.ndarray, counts: np.ndarray, shards: int):
    """Packed rows, one per shard: the words of each context once, then 40 bits and the count of each last word."""
    shard = shard_of(salted, shards)
    cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
    for b, e in zip(cuts, [*cuts[1:], len(salted)]):
        heads = np.flatnonzero(np.append(True, salted[b + 1 : e] != salted[b : e - 1]))
        runs = narrowed(np.diff(np.append(heads, e - b)))
        far = [a for x in before[:-1] for a in cut(x[b:e][heads])]
        blob = pack(*far, before[-1][b:e][heads], runs, *cut(low[b:e]), narrowed(counts[b:e]))
        yield kind, int(shard[b]), blob, None, None


def count_grams(train: DataFrame, order: int, shards: int, salts) -> DataFrame:
    """Rows of n-grams of the highest order, summed within blocks that shrink with the order."""
    limit = BLOCK_TOKENS // (order - 1)

    def block(befores, tokens):
        before, low = [np.concatenate(b) for b in zip(*befores)], np.concatenate(tokens) & _LOW
        return _rows(list(gram_rows(f"grams{order}", *summed_grams(before, low, salts.value), shards))).to_batches()

    def run(batches):
        befores, tokens, size = [], [], 0
        for texts in _texts(batches):
            before, words, _ = token_grams(texts, order)
            befores.append(before)
            tokens.append(words)
            size += len(words)
            if size >= limit:
                yield from block(befores, tokens)
                befores, tokens, size = [], [], 0
        if befores:
            yield from block(befores, tokens)

    return train.mapInArrow(run, ROW)


def file_grams(rows: DataFrame, order: int, shards: int, salts, folder: str) -> DataFrame:
    """Files of n-gram keys by shard (those that count once, the others, their counts), with the numbers of n-grams that
    count 1, 2, 3 and 4; partial context sums; rows of the distinct n-grams for the order below."""

    def add(table: pa.Table) -> pa.Table:
        parts = []
        for blob in table.column("blob"):
            *far, last, runs, low, high, counts = unpack(blob.as_buffer())
            words = [*[whole(a, b) for a, b in zip(far[::2], far[1::2])], last]
            parts.append((*[np.repeat(w, runs) for w in words], whole(low, high), counts.astype(np.int64)))
        *before, low, counts = (np.concatenate(x) for x in zip(*parts))
        del parts
        salted, before, low, counts = summed_grams(before, low, salts.value, counts)
        keys = gram_key(salted, low)
        at = np.argsort(keys)
        once = counts[at] == 1
        keys, more = keys[at], counts[at][~once]
        shard = table.column("shard")[0].as_py()
        seen = [float((counts == i).sum()) for i in (1, 2, 3, 4)]
        rows = [(f"filed{order}", shard, None, _write(folder, keys[once], keys[~once], narrowed(more)), seen)]
        sums = _summed(context_hash(before), counts, *[(counts == i).astype(np.int64) for i in (1, 2)], (counts > 2).astype(np.int64))
        rows += _split(f"context{order}", sums[0], shards, sums[1], *[narrowed(s) for s in sums[2:]])
        if order > 2:
            rows += gram_rows(f"grams{order - 1}", *summed_grams(before[1:], low, salts.value), shards)
        else:
            # Continuation counts are filed by the 40 bits, moved to the top so that shards are ranges again.
            words, types = _summed(low << np.uint64(24), np.ones(len(low), np.int64))
            rows += _split("continuation", words, shards, narrowed(types))
        return _rows(rows)

    return rows.groupBy("shard").applyInArrow(add, ROW)


def add_up(partial: DataFrame, folder: str) -> DataFrame:
    """Files of context sums and of continuation counts by shard; ``sums`` of the latter: words that continue 1, 2, 3,
    4 and more than 2 contexts, all bigram types."""

    def run(table: pa.Table) -> pa.Table:
        kind, shard = table.column("kind")[0].as_py(), table.column("shard")[0].as_py()
        parts = [np.concatenate(x) for x in zip(*[unpack(b.as_buffer()) for b in table.column("blob")])]
        keys, *values = _summed(parts[0], *[p.astype(np.int64) for p in parts[1:]])
        sums = None
        if kind == "continuation":
            c = values[0]
            sums = [float((c == i).sum()) for i in (1, 2, 3, 4)] + [float((c > 2).sum()), float(c.sum())]
        return _rows([(kind + "s", shard, None, _write(folder, keys, *values), sums)])

    return partial.groupBy("kind", "shard").applyInArrow(run, ROW)


# The model


def discounts(n1: float, n2: float, n3: float, n4: float) -> list[float]:
    """What is taken off counts of 1, 2 and more; the usual constants where the estimate does not exist."""
    if min(n1, n2, n3, n4) <= 0:
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    estimates = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return [min(max(d, 0.05 * k), float(k)) for k, d in enumerate(estimates, 1)]


@dataclass
class Model:
    """What scoring needs: the files by kind and shard, and a few sums."""

    order: int
    shards: int
    files: dict[str, dict[int, str]]
    tokens: int
    types: int
    gram_discounts: dict[int, list[float]]
    word_discounts: list[float]
    bigram_types: float
    word_backoff: float
    salts: Salts
    _open: dict = field(default_factory=dict)

    def __getstate__(self):
        return {**self.__dict__, "_open": {}}

    def arrays(self, kind: str, shard: int):
        key = kind, shard
        if key not in self._open:
            path = self.files[kind].get(shard)
            self._open[key] = mapped(path) if path else None
        return self._open[key]

    def look_up(self, kind: str, keys: np.ndarray, columns: int) -> list[np.ndarray]:
        """The columns of sorted keys, 0 where a key is absent."""
        out = [np.zeros(len(keys), np.int64) for _ in range(columns)]
        shard = shard_of(keys, self.shards)
        cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(keys) else []
        for b, e in zip(cuts, [*cuts[1:], len(keys)]):
            arrays = self.arrays(kind, int(shard[b]))
            if arrays is not None:
                at = np.minimum(np.searchsorted(arrays[0], keys[b:e]), len(arrays[0]) - 1)
                hit = arrays[0][at] == keys[b:e]
                for o, a in zip(out, arrays[1:]):
                    o[b:e][hit] = a[at[hit]]
        return out

    def gram_counts(self, before: list[np.ndarray], tokens: np.ndarray) -> np.ndarray:
        salted = self.salts.apply(before, tokens & _LOW)
        keys, shard = gram_key(salted, tokens & _LOW), shard_of(salted, self.shards)
        order = np.lexsort((keys, shard))
        keys, shard = keys[order], shard[order]
        counts = np.zeros(len(keys), np.int64)
        cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
        for b, e in zip(cuts, [*cuts[1:], len(keys)]):
            arrays = self.arrays(f"filed{len(before) + 1}", int(shard[b]))
            if arrays is None:
                continue
            once, more, count = arrays
            for have, value in ((once, None), (more, count)):
                if len(have):
                    at = np.minimum(np.searchsorted(have, keys[b:e]), len(have) - 1)
                    hit = have[at] == keys[b:e]
                    counts[b:e][hit] = 1 if value is None else value[at[hit]]
        out = np.empty_like(counts)
        out[order] = counts
        return out

    def score(self, texts) -> dict[str, np.ndarray]:
        """Per text: tokens, known tokens, log10 probability under the add-one unigram model and under this one."""
        before, tokens, owner = token_grams(texts, self.order)
        words, word = np.unique(tokens, return_inverse=True)
        (c,) = self.look_up("words", words, 1)
        high = (words & _LOW) << np.uint64(24)
        by_high = np.argsort(high)
        (found,) = self.look_up("continuations", high[by_high], 1)
        types = np.empty_like(found)
        types[by_high] = found
        uniform = 1.0 / (self.types + 1)
        taken = np.array([0.0, *self.word_discounts])[np.minimum(types, 3)]
        total = max(self.bigram_types, 1.0)
        lower = (types - taken) / total + self.word_backoff * uniform if self.bigram_types else np.full(len(words), uniform)

        p = lower[word]
        for order in range(2, self.order + 1):
            part, d = before[self.order - order :], self.gram_discounts[order]
            contexts, context = np.unique(context_hash(part), return_inverse=True)
            sums, n1, n2, n3 = self.look_up(f"context{order}s", contexts, 4)
            backoff = np.where(sums > 0, (d[0] * n1 + d[1] * n2 + d[2] * n3) / np.maximum(sums, 1), 1.0)
            counts = self.gram_counts(part, tokens)
            direct = (counts - np.array([0.0, *d])[np.minimum(counts, 3)]) / np.maximum(sums, 1)[context]
            p = np.where(counts > 0, direct, 0.0) + backoff[context] * p
        base = np.log10((c + 1) / (self.tokens + self.types + 1))[word]
        n = len(texts)
        return {
            "n_tokens": np.bincount(owner, minlength=n),
            "n_known": np.bincount(owner, (c > 0)[word], n).astype(np.int64),
            "base_score": np.bincount(owner, base, n),
            "score": np.bincount(owner, np.log10(p), n),
        }


def train(texts: DataFrame, order: int = ORDER) -> Model:
    """Learn from all rows of ``texts`` (text). The driver gets file names and sums per shard."""
    if order < 2:
        raise ValueError("order must be at least 2")
    spark = texts.sparkSession
    texts, folder = texts.select("text"), scratch_path(spark, "ngrams")
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(chars / 6 * (order - 1) / SHARD_TOKENS))
    words = settle(count_words(texts, shards, folder), "ngram-words")
    rows = words.collect()
    tokens, types = (int(sum(r["sums"][i] for r in rows)) for i in (0, 1))
    # At most tokens / SHARD_TOKENS words are that frequent.
    often = frequent_words(words.repartition(max(len(rows), 1)), SHARD_TOKENS).collect()
    hot = {int(np.int64(r["word"]).view(np.uint64)): math.ceil(r["count"] / SHARD_TOKENS) for r in often}
    if int(END) in hot:  # a text begins as often as one ends
        hot[int(BEGIN)] = hot[int(END)]
    salts = Salts(np.array(list(hot), np.uint64), np.array(list(hot.values()), np.int64))
    given, filed, partial = spark.sparkContext.broadcast(salts), [], []
    grams = count_grams(texts, order, shards, given)
    for n in range(order, 1, -1):
        table = settle(file_grams(grams, n, shards, given, folder), f"ngram-{n}")
        filed += table.where(F.col("kind") == f"filed{n}").select("kind", "shard", "path", "sums").collect()
        partial.append(table.where(F.col("kind").isin(f"context{n}", "continuation")))
        grams = table.where(F.col("kind") == f"grams{n - 1}")
    rest = settle(add_up(reduce(DataFrame.unionByName, partial), folder), "ngram-sums")
    files: dict[str, dict[int, str]] = {"words": {}, "continuations": {}}
    for n in range(2, order + 1):
        files |= {f"filed{n}": {}, f"context{n}s": {}}
    totals = {"continuations": np.zeros(6), **{f"filed{n}": np.zeros(4) for n in range(2, order + 1)}}
    for r in [*rows, *filed, *rest.select("kind", "shard", "path", "sums").collect()]:
        files[r["kind"]][r["shard"]] = r["path"]
        if r["kind"] in totals:
            totals[r["kind"]] += np.array(r["sums"])
    n1, n2, n3, n4, n3_more, bigram_types = totals["continuations"]
    word = discounts(n1, n2, n3, n4)
    backoff = (word[0] * n1 + word[1] * n2 + word[2] * n3_more) / bigram_types if bigram_types else 1.0
    of_grams = {n: discounts(*totals[f"filed{n}"]) for n in range(2, order + 1)}
    return Model(order, shards, files, tokens, types, of_grams, word, float(bigram_types), float(backoff), salts)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without ``text``, with ``n_tokens, n_known, base_score, score`` of every whole text."""
    given = docs.sparkSession.sparkContext.broadcast(model)
    added = {"n_tokens": pa.int64(), "n_known": pa.int64(), "base_score": pa.float64(), "score": pa.float64()}
    kept = [c for c in docs.columns if c != "text" and c not in added]
    schema = docs.select(*kept).schema
    for name, kind in (("n_tokens", "long"), ("n_known", "long"), ("base_score", "double"), ("score", "double")):
        schema = schema.add(name, kind)

    def run(batches):
        model = given.value
        for batch in batches:
            at = 0
            for texts in _texts([batch]):
                got = model.score(texts)
                arrays = [batch.column(c).slice(at, len(texts)) for c in kept]
                yield pa.RecordBatch.from_arrays([*arrays, *[pa.array(got[c], t) for c, t in added.items()]], [*kept, *added])
                at += len(texts)

    return docs.select(*kept, "text").mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """One seventh of the documents by checksum; rows without id are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    scored = score(docs.withColumn("held_out", held_out(F.col("doc_id"))), model)
    return scored.withColumn("train_tokens", F.lit(model.tokens).cast("long"))
