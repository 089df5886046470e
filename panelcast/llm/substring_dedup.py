"""Removal of long passages that a document with a smaller id holds too, by recompression.

1. **Names.** The words of a text are rewritten in rounds: a run of one symbol becomes one symbol, then pairs of
   neighbours do, where a coin of the left symbol shows heads and that of the right one tails. Names and coins are hashes
   of what they stand for, so all tasks name alike without a table, and equal stretches of words get equal symbols inside,
   whatever surrounds them; only at both ends a round may leave some out (the first symbol may belong to what stands
   before the window). A window of WINDOW words is known by its anchor: the first symbol of the highest round of which
   anything lies safely inside. Equal windows have equal anchors; an anchor serves many windows.
2. **Reveal** (first Spark round). Blocks of documents send each distinct anchor once to its shard, with the least and the
   largest document id that hold it. Anchors of one id alone are dropped, which ends most of the text.
3. **Verify** (second round). The texts that are left are fetched; the windows of shared anchors, as 128-bit hashes of
   their WINDOW words, are sent in the same way. A window goes if a smaller id than its own holds it.
4. The words that such windows cover are removed from the texts they are in.

A passage that a third of all documents hold is sent once per block. Texts are shuffled only where something is shared,
by a hash of id and text.

Defined cases: null, empty and blank texts have no words; texts of fewer words than a window stay whole; rows without id
stay whole and remove nothing; rows of one id never remove from each other, whatever their texts; repeated rows are
treated alike; ids may be negative; very long texts are one piece of a block; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.blocks import batch_of, chunks, pack, shard_count, shard_of, slices, unpack
from panelcast.llm.jaccard_join import key_filter, row_key
from panelcast.llm.store import settle
from panelcast.llm.words import mix

WINDOW = 50
#: Words of a block, windows of a block, bytes of text per shard, and bytes that are hashed at once.
BLOCK_WORDS, BLOCK_WINDOWS, SHARD_BYTES, SEGMENT = 1 << 20, 1 << 19, 16 << 20, 1 << 18
#: Rounds of names; every RUNS-th round is one of runs, the others of pairs.
ROUNDS, RUNS = 24, 6
STATE, REQUEST, ANSWER = 0, 1, 2
PACKED = "kind int, block long, shard long, blob binary"
COLUMNS = ["kind", "block", "shard", "blob"]
_ODD, _OTHER = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n - 1, 0), base, np.uint64)]), dtype=np.uint64)


_UP, _DOWN = _powers(_ODD, SEGMENT), _powers(pow(_ODD, -1, 1 << 64), SEGMENT)
_SIGNS = mix((np.arange(256) + 1).astype(np.uint64) * np.uint64(_OTHER))
_SIGNS[ord(" ")] = 0


class Words:
    """The words of some texts (bytes), one text after the other, as 64-bit hashes."""

    def __init__(self, texts: list[bytes | None]):
        # bytes are split at 09-0D and 20 and nowhere else
        self.plain = [b" ".join((t or b"").split()) for t in texts]
        self.n = np.array([p.count(b" ") + 1 if p else 0 for p in self.plain], np.int64)
        self.begin = np.cumsum(self.n) - self.n
        self.owner = np.repeat(np.arange(len(texts)), self.n)
        joined, at, out = b" ".join(p for p in self.plain if p) + b" ", 0, []
        while at < len(joined) and len(self.owner):
            end = joined.rfind(b" ", at, at + SEGMENT) + 1 or joined.find(b" ", at) + 1
            out.append(self._hash(np.frombuffer(joined, np.uint8, end - at, at)))
            at = end
        self.hashes = np.concatenate(out) if out else np.zeros(0, np.uint64)

    @staticmethod
    def _hash(part: np.ndarray) -> np.ndarray:
        n = len(part)
        up, down = (_UP, _DOWN) if n <= len(_UP) else (_powers(_ODD, n), _powers(pow(_ODD, -1, 1 << 64), n))
        first = np.append(0, np.flatnonzero(part == 32)[:-1] + 1)
        return mix(np.add.reduceat(_SIGNS[part] * up[:n], first) * down[first])

    def windows(self) -> np.ndarray:
        """Where the windows begin, in the words of all texts."""
        if len(self.owner) < WINDOW:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.owner[: 1 - WINDOW] == self.owner[WINDOW - 1 :])


def recompress(names: np.ndarray, owner: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(name, first word) of the anchor of each window that begins at one of ``starts``."""
    anchor, place = names[starts], starts.copy()
    begins, which = np.arange(len(names)), np.arange(len(starts))
    low, high = starts, starts + WINDOW - 1  # the first and the last symbol safely inside
    for round_ in range(ROUNDS):
        if not len(which):
            break
        same = owner[1:] == owner[:-1]
        if round_ % RUNS == 0:
            joins = same & (names[1:] == names[:-1])
        else:
            heads = mix(names + np.uint64(_ODD * (round_ + 1) % (1 << 64))) >> np.uint64(63) == 1
            joins = same & heads[:-1] & ~heads[1:]
        first = np.append(True, ~joins)[: len(names)]
        index = np.cumsum(first) - 1  # of the new symbol of each old one
        at = np.flatnonzero(first)
        size = np.diff(np.append(at, len(names)))
        if round_ % RUNS == 0:  # what continues a run outside is unknown: the runs at both ends are left out
            low, high = index[low] + 1, index[high] - 1
            new = np.where(size > 1, mix(names[at] * np.uint64(_OTHER) + size.astype(np.uint64)), names[at])
        else:
            low, high = low + ~heads[low], high - heads[high]
            low = np.append(index, at.size)[low]
            high = np.append(-1, index)[high + 1]
            second = names[np.minimum(at + 1, len(names) - 1)]
            new = np.where(size > 1, mix(names[at] * np.uint64(_ODD) + mix(second + np.uint64(_OTHER))), names[at])
        names, begins, owner = new, begins[at], owner[at]
        inside = low <= high
        low, high, which = low[inside], high[inside], which[inside]
        anchor[which], place[which] = names[low], begins[low]
    return anchor, place


def window_hashes(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the WINDOW words from each of ``starts``."""
    out = []
    for base, salt in ((_ODD, 0), (_OTHER, 0xD6E8FEB86659FD93)):
        values = mix(hashes + np.uint64(salt)) if salt else hashes
        sums = np.append(np.uint64(0), np.cumsum(values * _powers(base, len(hashes)), dtype=np.uint64))
        out.append(mix((sums[starts + WINDOW] - sums[starts]) * _powers(pow(base, -1, 1 << 64), len(hashes))[starts]))
    return out[0], out[1]


class Distinct:
    """The distinct (x, y) of a block, in order, numbered by first occurrence; ``number`` is that of every occurrence."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ids: np.ndarray):
        order = np.lexsort((y, x))
        new = np.ones(len(order), bool)
        new[1:] = (x[order][1:] != x[order][:-1]) | (y[order][1:] != y[order][:-1])
        at = np.flatnonzero(new)
        firsts = order[at]  # the sort is stable
        self.own = np.empty(len(at), np.int64)
        self.own[np.argsort(firsts)] = np.arange(len(at))
        self.number = np.empty(len(order), np.int64)
        self.number[order] = np.repeat(self.own, np.diff(np.append(at, len(order))))
        self.x, self.y = x[firsts], y[firsts]
        self.least = np.minimum.reduceat(ids[order], at) if len(at) else ids
        self.most = np.maximum.reduceat(ids[order], at) if len(at) else ids

    def requests(self, block: int, shards: int):
        for shard, part in slices(shard_of(self.x, shards)):
            blob = pack(self.x[part], self.y[part], self.least[part], self.most[part], self.own[part].astype(np.uint32))
            yield batch_of(COLUMNS, pa.array([REQUEST], pa.int32()), [block], [shard], [blob])


def _answers(packed: DataFrame, shared: bool) -> DataFrame:
    """The numbers that a block gets back: of what several ids hold (``shared``), or of what a smaller id holds elsewhere."""

    def run(table: pa.Table) -> pa.Table:
        blocks, shard = table.column("block").to_pylist(), table.column("shard")[0].as_py()
        asked = [unpack(b.as_py()) for b in table.column("blob")]
        x, y, least, most, own = (np.concatenate(c) for c in zip(*asked))
        order = np.lexsort((y, x))
        new = np.ones(len(order), bool)
        new[1:] = (x[order][1:] != x[order][:-1]) | (y[order][1:] != y[order][:-1])
        at, group = np.flatnonzero(new), np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        low, high = np.minimum.reduceat(least[order], at), np.maximum.reduceat(most[order], at)
        told = (low != high)[group] if shared else low[group] < least
        ends = np.cumsum([len(a[0]) for a in asked])
        parts = [pack(np.sort(own[a:b][told[a:b]])) for a, b in zip([0, *ends[:-1]], ends)]
        n = len(blocks)
        return pa.table([pa.array([ANSWER] * n, pa.int32()), pa.array(blocks), pa.array([shard] * n), pa.array(parts)], COLUMNS)

    return packed.where(F.col("kind") == REQUEST).groupBy("shard").applyInArrow(run, PACKED)


def _block_of(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
    """(the state of a block, all numbers of its answers)."""
    kinds = table.column("kind").to_pylist()
    blobs = [unpack(b.as_py()) for b in table.column("blob")]
    told = [b[0] for k, b in zip(kinds, blobs) if k == ANSWER]
    return blobs[kinds.index(STATE)], np.concatenate([np.zeros(0, np.uint32), *told])


def _lists(owner: np.ndarray, n: int, begins: np.ndarray, lengths: np.ndarray) -> list[pa.Array]:
    """Lists per document of spans that are in the order of their documents."""
    ends = pa.array(np.append(0, np.cumsum(np.bincount(owner, minlength=n))), pa.int32())
    return [pa.ListArray.from_arrays(ends, pa.array(v, pa.int32())) for v in (begins, lengths)]


def _spans(flags: np.ndarray, owner: np.ndarray, at: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, begin, length) of the flagged ranges at .. to, those that touch or overlap as one. Ranges are in order."""
    owner, at, to = owner[flags], at[flags], to[flags]
    new = np.ones(len(at), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (at[1:] > to[:-1])
    first = np.flatnonzero(new)
    ends = to[np.append(first[1:], len(to)) - 1] if len(first) else to
    return owner[first], at[first], ends - at[first]


SPANS = "doc_id long, key long, begins array<int>, lengths array<int>"


def _anchor_blocks(docs: DataFrame, shards: int) -> DataFrame:
    def flush(block, parts):
        ids, keys, many, lengths, names = (np.concatenate(c) for c in zip(*parts))
        distinct = Distinct(names, np.zeros(len(names), np.uint64), np.repeat(ids, many))
        blob = pack(ids, keys, many, lengths.astype(np.uint32), distinct.number.astype(np.uint32))
        yield batch_of(COLUMNS, pa.array([STATE], pa.int32()), [block], [-1], [blob])
        yield from distinct.requests(block, shards)

    def run(batches):
        from pyspark import TaskContext

        block, parts, size = TaskContext.get().partitionId() << 32, [], 0
        for ids, keys, texts in chunks(batches, ["doc_id", "key", "text"]):
            words = Words(texts)
            starts = words.windows()
            owner = words.owner[starts]
            names, places = recompress(words.hashes, words.owner, starts)
            new = np.ones(len(starts), bool)  # neighbours with one anchor are one range
            new[1:] = (owner[1:] != owner[:-1]) | (places[1:] != places[:-1]) | (names[1:] != names[:-1])
            at = np.flatnonzero(new)
            many = np.bincount(owner[at], minlength=len(ids))
            some = many > 0
            lengths = np.diff(np.append(at, len(starts)))
            parts.append((np.array(ids, np.int64)[some], np.array(keys, np.int64)[some], many[some], lengths, names[at]))
            size += len(words.owner)
            if size >= BLOCK_WORDS:
                yield from flush(block, parts)
                block, parts, size = block + 1, [], 0
        if parts:
            yield from flush(block, parts)

    return docs.where("doc_id IS NOT NULL").mapInArrow(run, PACKED)


def shared_spans(docs: DataFrame, shards: int) -> DataFrame:
    """Where in a document windows begin whose anchor another id holds too."""

    def finish(table: pa.Table) -> pa.Table:
        (ids, keys, many, lengths, numbers), told = _block_of(table)
        flags = np.zeros(int(numbers.max(initial=0)) + 1, bool)
        flags[told] = True
        owner, lengths = np.repeat(np.arange(len(ids)), many), lengths.astype(np.int64)
        ends = np.cumsum(lengths)
        base = np.append(0, ends)[np.cumsum(many) - many]
        to = ends - base[owner]
        owner, begins, sizes = _spans(flags[numbers], owner, to - lengths, to)
        some = np.bincount(owner, minlength=len(ids)) > 0
        number = np.cumsum(some) - 1
        return pa.table([ids[some], keys[some], *_lists(number[owner], int(some.sum()), begins, sizes)], ["doc_id", "key", "begins", "lengths"])

    packed = settle(_anchor_blocks(docs, shards), "repeats-anchors")
    rows = packed.where(F.col("kind") == STATE).unionByName(_answers(packed, shared=True))
    return rows.groupBy("block").applyInArrow(finish, SPANS)


def with_spans(docs: DataFrame, spans: DataFrame, how: str = "inner") -> DataFrame:
    """``docs`` with the spans of their id and text; only documents that may have some are shuffled."""
    some = spans.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "begins", "lengths")
    return docs.join(some, (F.col("key") == F.col("_key")) & (F.col("doc_id") == F.col("_id")), how).drop("_id", "_key")


def _window_blocks(docs: DataFrame, shards: int) -> DataFrame:
    def flush(block, parts):
        ids, keys, many, at, x, y = (np.concatenate(c) for c in zip(*parts))
        own = np.repeat(ids, many)
        distinct = Distinct(x, y, own)
        least = np.empty(len(distinct.own), np.int64)
        least[distinct.own] = distinct.least
        number = np.where(own > least[distinct.number], -1, distinct.number)  # -1: it goes, whatever others hold
        yield batch_of(COLUMNS, pa.array([STATE], pa.int32()), [block], [-1], [pack(ids, keys, many, at.astype(np.uint32), number)])
        yield from distinct.requests(block, shards)

    def run(batches):
        from pyspark import TaskContext

        block, parts, size = TaskContext.get().partitionId() << 32, [], 0
        for ids, keys, begins, lengths, texts in chunks(batches, ["doc_id", "key", "begins", "lengths", "text"]):
            words = Words(texts)
            flat = np.array([x for b in begins for x in b], np.int64)
            sizes = np.array([x for n in lengths for x in n], np.int64)
            owner = np.repeat(np.repeat(np.arange(len(ids)), [len(b) for b in begins]), sizes)
            at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(flat, sizes)
            x, y = window_hashes(words.hashes, words.begin[owner] + at)
            parts.append((np.array(ids, np.int64), np.array(keys, np.int64), np.bincount(owner, minlength=len(ids)), at, x, y))
            size += len(at)
            if size >= BLOCK_WINDOWS:
                yield from flush(block, parts)
                block, parts, size = block + 1, [], 0
        if parts:
            yield from flush(block, parts)

    return docs.select("doc_id", "key", "begins", "lengths", "text").mapInArrow(run, PACKED)


def _repeats(docs: DataFrame, shards: int) -> DataFrame:
    def finish(table: pa.Table) -> pa.Table:
        (ids, keys, many, at, number), told = _block_of(table)
        flags = np.zeros(int(number.max(initial=0)) + 2, bool)
        flags[told] = True
        flags[-1] = True
        at = at.astype(np.int64)
        owner, begins, sizes = _spans(flags[number], np.repeat(np.arange(len(ids)), many), at, at + WINDOW)
        some = np.bincount(owner, minlength=len(ids)) > 0
        place = np.cumsum(some) - 1
        return pa.table([ids[some], keys[some], *_lists(place[owner], int(some.sum()), begins, sizes)], ["doc_id", "key", "begins", "lengths"])

    first = settle(shared_spans(docs, shards), "repeats-shared").dropDuplicates(["doc_id", "key"])
    some = docs.where("doc_id IS NOT NULL").where(key_filter(first)("key"))
    packed = settle(_window_blocks(with_spans(some, first), shards), "repeats-windows")
    rows = packed.where(F.col("kind") == STATE).unionByName(_answers(packed, shared=False))
    return settle(rows.groupBy("block").applyInArrow(finish, SPANS).dropDuplicates(["doc_id", "key"]), "repeats-spans")


def _keyed(docs: DataFrame) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select("doc_id", "text", row_key())
    return docs.withColumn("text", F.col("text").cast("binary"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``key`` (hash of id and text), ``begins``, ``lengths``: the words of each text that go, in order."""
    return _repeats(_keyed(docs), shard_count(docs, SHARD_BYTES))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed`` and ``kept``, the words that stay joined by single blanks, of every row of ``docs``."""

    def run(batches):
        for batch in batches:
            begins, lengths = (batch.column(c).to_pylist() for c in ("begins", "lengths"))
            total, removed, kept = [], [], []
            for text, b, n in zip(batch.column("text"), begins, lengths):
                words = (text.as_py() or b"").split()
                stay, at = [], 0
                for i, size in zip(b or (), n or ()):
                    stay += words[at:i]
                    at = i + size
                stay += words[at:]
                total.append(len(words))
                removed.append(len(words) - len(stay))
                kept.append(b" ".join(stay))
            names = ["doc_id", "n_words", "n_removed", "kept"]
            yield batch_of(names, batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()))

    keyed = _keyed(docs)
    spans = _repeats(keyed, shard_count(docs, SHARD_BYTES))
    marked = F.coalesce(key_filter(spans)("key"), F.lit(False))
    none = F.lit(None).cast("array<int>")
    whole = keyed.where(~marked).withColumn("begins", none).withColumn("lengths", none)
    both = whole.unionByName(with_spans(keyed.where(marked), spans, "left")).select("doc_id", "text", "begins", "lengths")
    done = both.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept binary")
    return done.withColumn("kept", F.col("kept").cast("string"))


SQL = f"""
WITH listed AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), windows AS (
  SELECT r, doc_id, i, array_to_string(words[i : i + {WINDOW - 1}], ' ') AS w
  FROM (SELECT r, doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM listed)
), least AS (
  SELECT w, min(doc_id) AS m FROM windows GROUP BY w HAVING count(DISTINCT doc_id) > 1
), gone AS (
  SELECT DISTINCT r, unnest(range(i, i + {WINDOW})) AS i FROM windows JOIN least USING (w) WHERE m < doc_id
), holes AS (
  SELECT r, list(i) AS places FROM gone GROUP BY r
), kept AS (
  SELECT doc_id, len(words) AS n_words, coalesce(len(places), 0) AS n_removed,
    CASE WHEN places IS NULL THEN array_to_string(words, ' ')
      ELSE array_to_string(list_filter(words, lambda w, i: NOT list_contains(places, i)), ' ') END AS kept
  FROM listed LEFT JOIN holes USING (r)
)
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(kept) AS kept_sha256 FROM kept
"""


def query(spark, sf_dir):
    kept = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
