"""Near-duplicate documents by the Jaccard similarity of their word shingles.

A prefix-filtered self-join (Xiao et al. 2011), arranged so that no step emits all pairs of a group:

1. Shingle frequencies are counted over all documents into a table of fixed size; they order shingles rare first.
2. One pass gives every document its set size and a class (documents with equal sets are one class) and sends the
   prefix of each class to shards by hash. The prefix is longer than needed for one common shingle, so that two similar
   sets share a tenth of their size of it. A block of documents sends a shingle once, however many of its documents hold
   it; the others follow by a join that Spark can split.
3. A shard drops shingles of a single class; the classes that share one become members of that shingle's hub, its least
   class. So two similar classes always meet under some hub. Classes that share less of their prefix with all others
   together than a similar set would are left out: most documents that have only a passage in common end here.
4. The members of a hub are compared in units of bounded size. In a unit a class is probed against the prefix index;
   candidates pass the length, the positional and the suffix filter and are then verified once, by exact intersection.
   Classes that are already connected to the unit's main component need no probe of their own.
5. Hubs with more than one unit: classes that are still outside the component of the hub's least member, which is in
   all its units, are probed against the other units.
6. The links (a forest per unit) are closed to components.

Defined cases: texts without words (null, empty, blanks) have an empty set, are linked with nothing and are their own
component; texts of fewer words than a shingle are one shingle; repeated rows get a row each; rows that share an id and
differ in text are linked by their texts; rows without id belong to the component of their text; an empty table gives
an empty result. Sets are compared as sets of 64-bit hashes. Texts are fetched by a hash of id and text, never by id.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.components import components
from panelcast.llm.store import settle
from panelcast.llm.words import mix, shingle_hashes, word_hashes

SHINGLE, PERCENT = 5, 80
#: How much longer than necessary prefixes are, in percent of the set.
EXTRA = 10
#: Buckets of the frequency table (a power of two): 4 MB on each worker, whatever the size of the corpus.
FREQUENCY_BITS, SLICES, LANES = 20, 64, 256
#: Prefix entries per block and per shard, shingles per unit, characters that are hashed at once.
BLOCK_ENTRIES, SHARD_ENTRIES, UNIT_SHINGLES, CHUNK_CHARS = 1 << 20, 1 << 20, 1 << 19, 1 << 20
RANGES = 64
#: Bits of the filter of row keys (2 MB on each worker); with more keys than bits it lets more texts through.
FILTER_BITS = 24
HUB, MEMBER, OTHER, DOCUMENT = 0, 1, 2, 3


def _chunks(batches, columns):
    """Lists of the columns' values, a bounded number of characters (or one long text) at a time. Text is last."""
    for batch in batches:
        values = [batch.column(c).to_pylist() for c in columns]
        begin = size = 0
        for i, text in enumerate(values[-1]):
            size += len(text or "") + 1
            if size >= CHUNK_CHARS or i + 1 == len(values[-1]):
                yield [v[begin : i + 1] for v in values]
                begin, size = i + 1, 0


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - FREQUENCY_BITS)).astype(np.int64)


def shingle_frequencies(docs: DataFrame, shingle: int) -> np.ndarray:
    """How often the shingles of each hash bucket occur in all documents (capped at 32 bits)."""
    width = (1 << FREQUENCY_BITS) // SLICES

    def count(batches):
        from pyspark import TaskContext

        total = np.zeros(1 << FREQUENCY_BITS, np.int64)
        for (texts,) in _chunks(batches, ["text"]):
            words, owner = word_hashes(texts)
            hashes, _ = shingle_hashes(words, owner, len(texts), shingle)
            total += np.bincount(_slot(hashes), minlength=len(total))
        lane = TaskContext.get().partitionId() % LANES
        for i in range(SLICES):
            part = np.minimum(total[i * width : (i + 1) * width], 0xFFFFFFFF).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([lane]), pa.array([part.tobytes()])], ["slice", "lane", "counts"])

    def add(table):
        total = np.zeros(width, np.int64)
        for blob in table.column("counts"):
            total += np.frombuffer(blob.as_py(), np.uint32)
        part = np.minimum(total, 0xFFFFFFFF).astype(np.uint32).tobytes()
        return pa.table({"slice": table.column("slice")[:1], "lane": table.column("lane")[:1], "counts": pa.array([part])})

    schema = "slice long, lane long, counts binary"
    parts = docs.select("text").mapInArrow(count, schema)
    parts = parts.groupBy("slice", "lane").applyInArrow(add, schema).groupBy("slice").applyInArrow(add, schema)
    out = np.zeros(1 << FREQUENCY_BITS, np.uint32)
    for row in parts.collect():  # SLICES rows of fixed size
        out[row["slice"] * width : (row["slice"] + 1) * width] = np.frombuffer(row["counts"], np.uint32)
    return out


class Sets:
    """The shingle sets of some texts, one after the other, each in rare-first order."""

    def __init__(self, texts, frequency: np.ndarray, shingle: int, percent: int):
        words, owner = word_hashes(texts)
        hashes, owner = shingle_hashes(words, owner, len(texts), shingle)
        order = np.lexsort((hashes, frequency[_slot(hashes)], owner))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        self.hashes, self.owner = hashes[new], owner[new]
        self.n = np.bincount(self.owner, minlength=len(texts)).astype(np.int64)
        self.begin = np.cumsum(self.n) - self.n
        self.place = np.arange(len(self.hashes)) - self.begin[self.owner]
        # Sets of n elements that are similar enough share one of the first n - ceil(percent * n / 100) + 1 and, as both
        # prefixes cut the same order, at least max(1, extra) when these are extended by extra.
        self.prefix = np.minimum(self.n, self.n + (-percent * self.n) // 100 + (self.n > 0) + EXTRA * self.n // 100)
        self.in_prefix = self.place < self.prefix[self.owner]

    def classes(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of each set; equal sets have equal ones."""
        out, some = [], self.n > 0
        for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
            total = self.n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            if some.any():
                total[some] += np.add.reduceat(mix(self.hashes ^ np.uint64(salt)), self.begin[some])
            out.append(mix(total).view(np.int64))
        return out[0], out[1]

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.begin[i] : self.begin[i] + self.n[i]]


def _pack(*arrays: np.ndarray) -> bytes:
    return b"".join([len(arrays[0]).to_bytes(8, "little"), *[np.ascontiguousarray(a).tobytes() for a in arrays]])


def _unpack(blob: bytes, kinds: str) -> list[np.ndarray]:
    n, at, out = int.from_bytes(blob[:8], "little"), 8, []
    for kind in kinds:
        out.append(np.frombuffer(blob, np.dtype(kind), n, at))
        at += out[-1].nbytes
    return out


def _columns(kind: int, *values) -> pa.Table:
    """Rows of (kind, a, b, c, d); a may be a masked pair (values, is null)."""
    n = len(values[-1])
    arrays = [pa.array(np.full(n, kind, np.int32))]
    for i in range(4):
        if i >= len(values):
            arrays.append(pa.nulls(n, pa.int64()))
        elif isinstance(values[i], tuple):
            arrays.append(pa.array(values[i][0], pa.int64(), mask=values[i][1]))
        else:
            arrays.append(pa.array(values[i], pa.int64()))
    return pa.table(arrays, ["kind", "a", "b", "c", "d"])


def prefixes(docs: DataFrame, frequency, shards: int, shingle: int, percent: int) -> DataFrame:
    """Packed rows (shard, kind, blob): prefix entries by hash, entries that repeat in a block, and document rows."""

    def emit(shard, kind, blob):
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([kind], pa.int32()), pa.array([blob])], ["shard", "kind", "blob"])

    def flush(hashes, classes, spread):
        hashes, classes = np.concatenate(hashes), np.concatenate(classes)
        order = np.lexsort((classes, hashes))
        hashes, classes = hashes[order], classes[order]
        first = np.ones(len(hashes), bool)
        first[1:] = hashes[1:] != hashes[:-1]
        begins = np.flatnonzero(first)
        repeated = np.diff(np.append(begins, len(hashes))) > 1
        if (~first).any():
            yield emit(spread, OTHER, _pack(hashes[~first], classes[~first]))
        lead, lead_class = hashes[begins], classes[begins]
        shard = ((lead >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
        cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else []
        for begin, end in zip(cuts, [*cuts[1:], len(shard)]):
            part = slice(begin, end)
            yield emit(int(shard[begin]), MEMBER, _pack(lead[part], lead_class[part], repeated[part].astype(np.uint8)))

    def run(batches):
        from pyspark import TaskContext

        spread = TaskContext.get().partitionId()
        order, seen, hashes, classes, size = frequency.value, set(), [], [], 0
        for ids, keys, texts in _chunks(batches, ["doc_id", "key", "text"]):
            sets = Sets(texts, order, shingle, percent)
            one, _ = sets.classes()
            missing = np.array([i is None for i in ids])
            known = np.array([0 if i is None else i for i in ids], np.int64)
            spread += 1
            yield emit(spread % shards, DOCUMENT, _pack(known, missing.astype(np.uint8), sets.n, one, np.array(keys, np.int64)))
            fresh = np.array([c not in seen and not seen.add(c) for c in one.tolist()], bool)
            chosen = sets.in_prefix & fresh[sets.owner]
            hashes.append(sets.hashes[chosen])
            classes.append(one[sets.owner[chosen]])
            size += len(hashes[-1])
            if size >= BLOCK_ENTRIES:
                yield from flush(hashes, classes, spread % shards)
                seen, hashes, classes, size = set(), [], [], 0
        if hashes:
            yield from flush(hashes, classes, spread % shards)

    return docs.select("doc_id", "key", "text").mapInArrow(run, "shard long, kind int, blob binary")


def shared_entries(packed: DataFrame) -> DataFrame:
    """Rows (kind, a, b, c, d): HUB hash, hub | MEMBER hub, class | OTHER hash, class | DOCUMENT id, n, class, key."""

    def run(table: pa.Table) -> pa.Table:
        out, entries = [], []
        for kind, blob in zip(table.column("kind").to_pylist(), table.column("blob").to_pylist()):
            if kind == DOCUMENT:
                ids, missing, n, one, keys = _unpack(blob, ["<i8", "u1", "<i8", "<i8", "<i8"])
                out.append(_columns(DOCUMENT, (ids, missing.astype(bool)), n, one, keys))
            elif kind == OTHER:
                hashes, classes = _unpack(blob, ["<u8", "<i8"])
                out.append(_columns(OTHER, hashes.view(np.int64), classes))
            else:
                entries.append(_unpack(blob, ["<u8", "<i8", "u1"]))
        if entries:
            hashes, classes, repeated = (np.concatenate(x) for x in zip(*entries))
            order = np.lexsort((classes, hashes))
            hashes, classes, repeated = hashes[order], classes[order], repeated[order]
            new = np.ones(len(hashes), bool)
            new[1:] = hashes[1:] != hashes[:-1]
            group = np.cumsum(new) - 1
            hub = classes[new]
            flagged = np.bincount(group, repeated) > 0
            shared = flagged | (np.maximum.reduceat(classes, np.flatnonzero(new)) > hub)
            keep = shared[group]
            out.append(_columns(MEMBER, hub[group[keep]], classes[keep]))
            out.append(_columns(HUB, hashes[new][flagged].view(np.int64), hub[flagged]))
        return pa.concat_tables(out)

    return packed.groupBy("shard").applyInArrow(run, "kind int, a long, b long, c long, d long")


def unit_links(classes: np.ndarray, sets: Sets, probe: np.ndarray | None, percent: int) -> list[tuple[int, int]]:
    """Links between the sets of one unit that connect all that are similar (a forest).

    ``probe`` marks the sets to compare with the others; None compares all, but for those that are already connected
    to the first.
    """
    m = len(classes)
    parent = list(range(m))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    at = np.flatnonzero(sets.in_prefix)
    at = at[np.argsort(sets.hashes[at], kind="stable")]
    tokens, members, places = sets.hashes[at], sets.owner[at], sets.place[at]
    cell = sets.owner * RANGES + (sets.hashes & np.uint64(RANGES - 1)).astype(np.int64)
    ranges = np.bincount(cell, minlength=m * RANGES).reshape(m, RANGES)
    # Sets that share most of their prefix come first: the original of a group of copies connects the group.
    together = np.diff(np.append(np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1])), len(tokens))) if len(tokens) else []
    shares = np.bincount(members, np.repeat(together, together) > 1, m) if len(tokens) else np.zeros(m)
    order = np.argsort(-shares / np.maximum(sets.prefix, 1), kind="stable")
    links, main = [], int(order[0])
    for x in order if probe is None else order[probe[order]]:
        x = int(x)
        if probe is None and x != main and find(x) == find(main):
            continue
        mine = sets.of(x)
        head = mine[: sets.prefix[x]]
        low, high = np.searchsorted(tokens, head, "left"), np.searchsorted(tokens, head, "right")
        found = np.repeat(low - np.append(0, np.cumsum(high - low)[:-1]), high - low) + np.arange((high - low).sum())
        my_place = np.repeat(np.arange(len(head)), high - low)
        others, first = np.unique(members[found], return_index=True)  # the first hit is the rarest common shingle
        n, k = sets.n[others], sets.n[x]
        need = -((-percent * (n + k)) // (100 + percent))
        rest = 1 + np.minimum(k - my_place[first] - 1, n - places[found[first]] - 1)
        fit = (100 * np.minimum(n, k) >= percent * np.maximum(n, k)) & (rest >= need) & (others != x)
        others, need = others[fit], need[fit]
        fit = np.minimum(ranges[others], ranges[x]).sum(1) >= need
        others = np.array([o for o in others[fit] if find(int(o)) != find(x)], np.int64)
        if not len(others):
            continue
        lengths = sets.n[others]
        ends = np.cumsum(lengths)
        theirs = sets.hashes[np.repeat(sets.begin[others] - (ends - lengths), lengths) + np.arange(ends[-1])]
        ordered = np.sort(mine)
        hit = ordered[np.minimum(np.searchsorted(ordered, theirs), len(ordered) - 1)] == theirs
        common = np.add.reduceat(hit.astype(np.int64), ends - lengths)
        for o in others[100 * common >= percent * (lengths + k - common)]:
            a, b = find(x), find(int(o))
            if a != b:
                parent[a] = b
                links.append((int(classes[x]), int(classes[o])))
    return links


def row_key():
    """A hash of a row's id and text. Rows without id hash their text alone."""
    return F.xxhash64("doc_id", "text").alias("key")


def key_filter(keys: DataFrame):
    """A test that a column may hold one of the ``key`` of a table: a bitmap of fixed size, never wrong on a member."""

    def place(values: np.ndarray) -> np.ndarray:
        return (mix(values.astype(np.int64).view(np.uint64)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)

    def mark(batches):
        from pyspark import TaskContext

        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            bits[place(batch.column("key").to_numpy())] = True
        lane = TaskContext.get().partitionId() % LANES
        for i, part in enumerate(np.packbits(bits).reshape(SLICES, -1)):
            yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([lane]), pa.array([part.tobytes()])], ["slice", "lane", "bits"])

    def either(table: pa.Table) -> pa.Table:
        total = 0
        for blob in table.column("bits"):
            total = total | np.frombuffer(blob.as_py(), np.uint8)
        return pa.table({"slice": table.column("slice")[:1], "lane": table.column("lane")[:1], "bits": pa.array([total.tobytes()])})

    schema = "slice long, lane long, bits binary"
    parts = keys.select("key").mapInArrow(mark, schema)
    parts = parts.groupBy("slice", "lane").applyInArrow(either, schema).groupBy("slice").applyInArrow(either, schema)
    rows = sorted(parts.collect(), key=lambda r: r["slice"])  # SLICES rows of fixed size
    bitmap = b"".join(r["bits"] for r in rows) or bytes((1 << FILTER_BITS) // 8)
    given = keys.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def marked(values: pd.Series) -> pd.Series:
        bits = np.frombuffer(given.value, np.uint8)
        at = place(values.to_numpy())
        return pd.Series((bits[at >> 3] >> (7 - (at & 7))) & 1 == 1)

    return marked


def compare(docs: DataFrame, routes: DataFrame, first: DataFrame, frequency, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) of all units. ``routes``: class, hub, unit, probe (null: all); ``first``: class, key, rows.

    ``key`` is that of one text of the class, which ``rows`` rows hold.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("class")
        classes = np.array(table.column("class"), np.int64)
        texts, probe = table.column("text").to_pylist(), table.column("probe").to_pylist()
        sets = Sets(texts, frequency.value, shingle, percent)
        # Keys may collide: of the texts of a class, keep one whose set is the one that was asked for.
        right = np.flatnonzero(sets.classes()[0] == classes)
        _, one = np.unique(classes[right], return_index=True)
        keep = right[one]
        if len(keep) < len(classes):
            sets = Sets([texts[i] for i in keep], frequency.value, shingle, percent)
        probes = None if not len(keep) or probe[keep[0]] is None else np.array([probe[i] for i in keep], bool)
        links = unit_links(classes[keep], sets, probes, percent) if len(keep) > 1 else []
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    def fetch(part: DataFrame) -> DataFrame:
        some = docs.where(key_filter(part)("key"))  # before the texts are shuffled
        part = part.withColumnRenamed("key", "__key")
        return some.join(part, F.col("key") == F.col("__key")).select("class", "text", "units")

    wanted = routes.join(first, "class").groupBy("key", "class", "rows").agg(F.collect_set(F.struct("hub", "unit", "probe")).alias("units"))
    wanted = settle(wanted, "jaccard-wanted")
    texts, repeated = fetch(wanted.where("rows = 1")), wanted.where("rows > 1")
    if not repeated.isEmpty():
        texts = texts.unionByName(fetch(repeated).dropDuplicates(["class", "text"]))
    texts = texts.select("class", "text", F.explode("units").alias("u")).select("class", "text", "u.hub", "u.unit", "u.probe")
    return texts.groupBy("hub", "unit").applyInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    unit_shingles: int = UNIT_SHINGLES,
) -> DataFrame:
    """``doc_id, n_shingles, component_id``, ``class`` (equal sets), ``component`` and ``key`` for every row of ``docs``.

    ``component_id`` is the least id of the component; ``component`` (null without words) also tells those apart that
    have no id or share it. ``key`` is the hash of id and text.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select("doc_id", "text", row_key())
    counts = shingle_frequencies(docs, shingle)
    entries = int(counts.sum(dtype=np.int64)) * (100 - percent + EXTRA) // 100
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(entries / SHARD_ENTRIES))
    frequency = spark.sparkContext.broadcast(counts)
    rows = settle(shared_entries(prefixes(docs, frequency, shards, shingle, percent)), "jaccard-entries")
    per_doc = rows.where(F.col("kind") == DOCUMENT).select(
        F.col("a").alias("doc_id"), F.col("b").alias("n_shingles"), F.col("c").alias("class"), F.col("d").alias("key")
    )
    texts = per_doc.where("n_shingles > 0").groupBy("class", "key").agg(
        F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n"), F.count("key").alias("rows")
    )
    first = texts.groupBy("class").agg(
        F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.min_by("rows", "key").alias("rows"), F.min("key").alias("key")
    )
    hubs = rows.where(F.col("kind") == HUB).select(F.col("a").alias("hash"), F.col("b").alias("hub"))
    others = rows.where(F.col("kind") == OTHER).select(F.col("a").alias("hash"), F.col("b").alias("class"))
    members = rows.where(F.col("kind") == MEMBER).select(F.col("a").alias("hub"), F.col("b").alias("class"))
    shared = members.select("class").unionByName(others.select("class")).groupBy("class").agg(F.count(F.lit(1)).alias("shared"))
    enough = shared.join(first, "class").where(F.col("shared") >= F.greatest(F.lit(1), F.floor(F.col("n") * EXTRA / 100)))
    enough = settle(enough.select("class", "n", "key", "rows"), "jaccard-enough")
    members = members.unionByName(others.join(hubs, "hash").select("hub", "class")).distinct()

    sized = settle(members.join(enough.select("class", "n"), "class"), "jaccard-members")
    loads = sized.groupBy("hub").agg(
        F.ceil(F.sum("n") / unit_shingles).alias("units"), F.count("class").alias("size"), F.min("class").alias("lead")
    )
    loads = settle(loads.where("size > 1"), "jaccard-loads")
    members = settle(sized.join(loads, "hub").select("hub", "class", "units", "lead"), "jaccard-units")
    block = F.pmod(F.xxhash64("class"), F.col("units"))
    inside = members.where(F.col("lead") != F.col("class")).select("class", "hub", block.alias("unit"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("units") - 1))
    leads = members.where(F.col("lead") == F.col("class")).select("class", "hub", every.alias("unit"))
    routes = inside.unionByName(leads).withColumn("probe", F.lit(None).cast("boolean"))
    keys = enough.select("class", "key", "rows")
    links = settle(compare(docs, routes, keys, frequency, shingle, percent), "jaccard-links")

    large = members.where("units > 1")
    if not large.isEmpty():
        label = components(links)
        of = lambda c: label.select(F.col("node").alias(f"__{c}"), F.col("component").alias(f"{c}_component"))
        labelled = large.join(of("class"), F.col("class") == F.col("__class"), "left").join(of("lead"), F.col("lead") == F.col("__lead"), "left")
        inner = F.coalesce("class_component", "class") == F.coalesce("lead_component", "lead")
        labelled = settle(labelled.select("hub", "class", "units", block.alias("block"), (~inner).alias("outside")), "jaccard-outside")
        outside = labelled.where("outside")
        lines = outside.select("hub", F.col("block").alias("row")).distinct()
        probes = outside.select("class", "hub", "units", F.col("block").alias("row"), every.alias("column")).where(F.col("row") != F.col("column"))
        bases = labelled.join(lines, "hub").select("class", "hub", "units", "row", F.col("block").alias("column")).where(F.col("row") != F.col("column"))
        unit = (F.col("row") * F.col("units") + F.col("column")).alias("unit")
        second = probes.select("class", "hub", unit, F.lit(True).alias("probe")).unionByName(bases.select("class", "hub", unit, F.lit(False).alias("probe")))
        links = settle(links.unionByName(compare(docs, second, keys, frequency, shingle, percent)), "jaccard-links")

    label = components(links).select(F.col("node").alias("class"), F.col("component").alias("__component"))
    of_class = first.select("class", "doc_id").join(label, "class", "left").withColumn("__component", F.coalesce("__component", "class"))
    least = of_class.groupBy("__component").agg(F.min("doc_id").alias("component_id"))
    named = of_class.join(least, "__component").select(F.col("class").alias("__class"), "component_id", F.col("__component").alias("component"))
    alone = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    joined = per_doc.join(named, (F.col("class") == F.col("__class")) & (F.col("n_shingles") > 0), "left")
    return joined.select("doc_id", "n_shingles", alone.alias("component_id"), "class", "component", "key")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents with one row of each component, of the least id (none if no row has one); all without words stay.

    What is decided is narrow (id and key of a row); a bitmap of the decided keys parts the rows before any text moves,
    so only the rows in question meet the decisions and all others stay where they were read. Columns of any name stay.
    """
    found = settle(near_duplicates(docs, shingle, percent), "jaccard-components").where("n_shingles > 0")
    least = F.col("doc_id").eqNullSafe(F.col("component_id"))
    # Rows of the least id: mostly one of each component.
    several = found.where(least).groupBy("component").agg(F.min("key").alias("kept"), F.count("key").alias("rows"))
    several = settle(several.where("rows > 1").select(F.col("component").alias("several"), "kept", "rows"), "jaccard-several")
    beside = found.where(least).join(several, F.col("component") == F.col("several"))
    once = beside.where(F.col("key") == F.col("kept")).select("doc_id", "key", F.lit(True).alias("once"))
    gone = found.where(~least).unionByName(beside.where(F.col("key") != F.col("kept")).select(found.columns))
    gone = gone.select("doc_id", "key", F.lit(False).alias("once"))
    decided = once.unionByName(gone).distinct().select(F.col("doc_id").alias("id"), F.col("key").alias("decided"), "once")
    decided = settle(decided, "jaccard-decided")
    if decided.isEmpty():
        return docs
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.select("row", "doc_id", row_key())
    asked = key_filter(decided.select(F.col("decided").alias("key")))("key")
    met = rows.where(asked).join(decided, (F.col("key") == F.col("decided")) & F.col("doc_id").eqNullSafe(F.col("id")), "left")
    met = settle(met.where(F.coalesce("once", F.lit(True))).select("row", "key", "once"), "jaccard-met")
    kept = rows.where(~asked).select("row").unionByName(met.where("once is null").select("row"))
    return kept.unionByName(met.where("once").dropDuplicates(["key"]).select("row")).select("row.*")


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id")
