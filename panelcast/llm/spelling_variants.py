"""Spelling variants: words one edit apart, found by composing automata, and the form each variant is written in.

The words of all texts are counted (deduplicated in the task, then summed by Spark). The vocabulary's acceptor is composed
with a transducer of exactly one edit and with the acceptor again. An edit lies in one block of BLOCK places (in long words, a
BLOCKS-th of the word), so the two words agree before the block and behind it: that is a partition, the acceptor's state in which the block begins
and the rest both words still have to read. A word of m letters takes part with m letters (its partner has as many, or
one more) and with m - 1 (its partner has one less), once per block.

A partition's acceptors are minimised, so equal rests are one state. The composition walks the pairs of states reached by
the same letters, makes the edit where the words first differ (which makes the path of each pair unique), and then reads
on while both accept; what two states both accept is worked out once. Partitions are dealt to shards by hash. Their size
is bounded by the strings a block can hold, however large the vocabulary: its words share all letters but those of a block.

Only a count per word and its best partner leave a task. Chains of forms are followed by pointer doubling; as a form is
several times as frequent as its word, there are few rounds.

Defined cases: null and empty texts have no words; a row without id keeps its runs as they are (no id, no deletion);
repeated rows count again; ids may repeat; words of any length are taken; of equally frequent partners the least in code
point order is the form; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.blocks import batch_of, chunks
from panelcast.llm.store import settle

RUNS = re.compile("[A-Za-zÀ-ÿ]+")
#: Runs whose checksum this divides lose a letter; letters and occurrences of a word; how much more frequent a form is.
DELETED, LETTERS, OCCURRENCES, TIMES = 199, 6, 5, 5
#: Places of a block, blocks of a word at most, distinct words a task holds, and words of the vocabulary per shard.
BLOCK, BLOCKS, HELD, SHARD_WORDS = 3, 8, 1 << 19, 20_000


class Acceptor:
    """The minimal automaton of a sorted list of distinct strings.

    ``arcs[q]`` maps a letter to (state, strings accepted before): summed along a path they give the string's place.
    """

    def __init__(self, strings: list[str]):
        self.arcs: list[dict[str, tuple[int, int]]] = []
        self.final: list[bool] = []
        self.count: list[int] = []
        self._known: dict[tuple, int] = {}
        self.start = self._minimal(strings, 0)

    def _minimal(self, strings: list[str], at: int) -> int:
        """The state that accepts the rests of ``strings`` from place ``at``; blocks are short, so it does not go deep."""
        final = len(strings[0]) == at if strings else False
        before, arcs = int(final), {}
        for letter, some in groupby(strings[before:], key=lambda s: s[at]):
            some = list(some)
            arcs[letter] = (self._minimal(some, at + 1), before)
            before += len(some)
        same = (final, *((c, q) for c, (q, _) in arcs.items()))
        if same not in self._known:
            self._known[same] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
            self.count.append(before)
        return self._known[same]


class Composition:
    """Pairs of places (in the first acceptor's strings, in the second's) that one edit turns into each other."""

    def __init__(self, first: Acceptor, second: Acceptor):
        self.first, self.second = first, second
        self._common: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def common(self, p: int, q: int) -> list[tuple[int, int]]:
        """The strings that both states accept, by their places."""
        if self.first is self.second and p == q:
            return [(i, i) for i in range(self.first.count[p])]
        known = self._common.get((p, q))
        if known is None:
            known = [(0, 0)] if self.first.final[p] and self.second.final[q] else []
            known += self._read(p, q, None)
            self._common[p, q] = known
        return known

    def _read(self, p: int, q: int, but: str | None) -> list[tuple[int, int]]:
        """The common strings of two states that begin with any letter but one."""
        out, others = [], self.second.arcs[q]
        for letter, (r, x) in self.first.arcs[p].items():
            if letter != but and letter in others:
                s, y = others[letter]
                out += [(x + i, y + j) for i, j in self.common(r, s)]
        return out

    def replaced(self):
        """Pairs that differ in one letter, each once (of one acceptor with itself)."""
        states = [(self.first.start, 0)]
        while states:
            q, at = states.pop()
            arcs = list(self.first.arcs[q].values())
            for k, (r, x) in enumerate(arcs):
                states.append((r, at + x))
                for s, y in arcs[k + 1 :]:
                    for i, j in self.common(r, s):
                        yield at + x + i, at + y + j

    def inserted(self, at_end: bool):
        """Pairs of which the second has one letter more, each once: the letter comes where the two first differ.

        Behind the end of the first it counts only ``at_end``, that is when nothing follows.
        """
        states = [(self.first.start, 0, self.second.start, 0)]
        while states:
            p, at, q, there = states.pop()
            mine = self.first.arcs[p]
            for letter, (s, y) in self.second.arcs[q].items():
                if letter in mine:
                    r, x = mine[letter]
                    states.append((r, at + x, s, there + y))
                if at_end and self.first.final[p] and self.second.final[s]:
                    yield at, there + y
                for i, j in self._read(p, s, letter):
                    yield at + i, there + y + j


def one_edit_pairs(words: list[str]) -> list[tuple[str, str]]:
    """All pairs of the distinct ``words`` that are one edit apart, each once, partition by partition."""
    rows = [(m, b, w) for w in words for m, b in places(len(w), 1)]
    return list(partition_pairs(rows))


def width(m: int) -> int:
    """The places of a block."""
    return max(BLOCK, -(-m // BLOCKS))


def places(letters: int, least: int = LETTERS) -> list[tuple[int, int]]:
    """(m, first place of a block) of the partitions of a word."""
    return [(m, b) for m in (letters, letters - 1) if m >= least for b in range(0, m, width(m))]


def partition_pairs(rows):
    """Pairs of words one edit apart from (m, block, word) rows that hold all words of their partitions."""

    def key(row):
        m, b, word = row
        end = len(word) if b + width(m) >= m else b + width(m) + len(word) - m
        return m, b, word[:b], word[end:]

    for (m, b, _, rest), some in groupby(sorted((key(r), r[2]) for r in rows), key=lambda x: x[0]):
        words = [w for _, w in some]
        if len(words) == 1:
            continue
        short, long = [w for w in words if len(w) == m], [w for w in words if len(w) > m]
        if not short:
            continue
        if width(m) > 100:  # the automata read a block by recursion
            sys.setrecursionlimit(max(sys.getrecursionlimit(), 1000 + 4 * width(m)))
        inner = lambda some: [w[b : len(w) - len(rest)] for w in some]
        acceptor = Acceptor(inner(short))
        yield from ((short[i], short[j]) for i, j in Composition(acceptor, acceptor).replaced())
        if long:
            yield from ((short[i], long[j]) for i, j in Composition(acceptor, Acceptor(inner(long))).inserted(b + width(m) >= m))


def corpus_words(docs: DataFrame, letters: int = LETTERS, occurrences: int = OCCURRENCES) -> DataFrame:
    """(word, n) of the frequent words of all texts."""

    def run(batches):
        held: Counter[str] = Counter()

        def emit():
            return batch_of(["word", "n"], pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64()))

        for ids, texts in chunks(batches, ["doc_id", "text"]):
            for i, text in zip(ids, texts):
                start = zlib.crc32(f"{i}:".encode())
                # the lower case of bytes is that of A-Z
                for word, n in Counter(RUNS.findall((text or "").encode("utf-8", "replace").lower().decode())).items():
                    if i is not None:
                        h = zlib.crc32(word.encode(), start)
                        if h % DELETED == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                    if len(word) >= letters:
                        held[word] += n
            if len(held) >= HELD:
                yield emit()
                held.clear()
        yield emit()

    parts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


def nearest(words: DataFrame) -> DataFrame:
    """``words`` (word, n) with ``n_near``, and the most frequent near word with its count (``near``, ``near_n``)."""
    spark = words.sparkSession
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-words.count() // SHARD_WORDS))
    length = F.char_length("word")
    rows = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("m")).where(f"m >= {LETTERS}")
    rows = rows.withColumn("w", F.greatest(F.lit(BLOCK), F.ceil(F.col("m") / BLOCKS).cast("int")))
    rows = rows.select("word", "n", "m", "w", F.explode(F.sequence(F.lit(0), F.col("m") - 1, F.col("w"))).alias("b"))
    end = F.when(F.col("b") + F.col("w") >= F.col("m"), length).otherwise(F.col("b") + F.col("w") + length - F.col("m"))
    rest = F.expr("substring(word, e + 1)")
    shard = F.pmod(F.xxhash64("m", "b", F.expr("substring(word, 1, b)"), rest), F.lit(shards)).alias("shard")
    rows = rows.withColumn("e", end).select(shard, "m", "b", "word", "n")

    def run(table: pa.Table) -> pa.Table:
        words = table.column("word").to_pylist()
        often = dict(zip(words, table.column("n").to_pylist()))
        near: dict[str, list] = {}
        for pair in partition_pairs(zip(table.column("m").to_pylist(), table.column("b").to_pylist(), words)):
            for word, other in (pair, pair[::-1]):
                rank = (-often[other], other)
                one = near.get(word)
                if one is None:
                    near[word] = [1, rank]
                else:
                    one[0] += 1
                    if rank < one[1]:
                        one[1] = rank
        values = list(near.values())
        return pa.table(
            {
                "word": pa.array(list(near), pa.string()),
                "n": pa.nulls(len(near), pa.int64()),
                "n_near": pa.array([v[0] for v in values], pa.int64()),
                "near": pa.array([v[1][1] for v in values], pa.string()),
                "near_n": pa.array([-v[1][0] for v in values], pa.int64()),
            }
        )

    schema = "word string, n long, n_near long, near string, near_n long"
    found = rows.groupBy("shard").applyInArrow(run, schema)
    null = F.lit(None)
    every = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), null.cast("string").alias("near"), null.cast("long").alias("near_n"))
    rank = F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("a"), F.col("near").alias("b")))
    both = every.unionByName(found).groupBy("word")
    return both.agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min_by("near", rank).alias("near"), F.max("near_n").alias("near_n"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) for (word, form) links without cycles: the end of every word's chain, by pointer doubling."""
    ends = settle(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = ends.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        joined = ends.join(onward, F.col("root") == F.col("_at"), "left")
        joined = settle(joined.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "spelling-roots")
        ends = joined.drop("moved")
        if joined.where("moved").isEmpty():
            return ends


def spelling_variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every frequent word of ``docs`` (``doc_id``, ``text``)."""
    words = settle(corpus_words(docs), "spelling-words")
    near = settle(nearest(words), "spelling-near")
    is_form = F.col("near_n") >= TIMES * F.col("n")
    near = near.select("word", F.when(is_form, F.col("near")).alias("form"), "n", "n_near", F.when(is_form, F.col("near_n")).alias("form_n"))
    ends = roots(near.where("form IS NOT NULL")).withColumnRenamed("word", "_word")
    found = near.join(ends, F.col("word") == F.col("_word"), "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: The checksum of bytes, bit by bit; words joined by what is left when a letter is taken out.
SQL = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), lowered AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM runs
), distinct_runs AS (
  SELECT doc_id, run, count(*) AS n FROM lowered GROUP BY ALL
), bytes AS (
  SELECT *, hex(encode(doc_id || ':' || run)) AS x FROM distinct_runs
), checked AS (
  SELECT doc_id, run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(1, length(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda d, k: xor(d >> 1, 3988292384 * (d & 1)))
  )) AS h FROM bytes
), cut AS (
  SELECT n, CASE WHEN h % {DELETED} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
  FROM checked
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= {LETTERS} GROUP BY word HAVING sum(n) >= {OCCURRENCES}
), without AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM without a JOIN without b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT w.word, o.word, o.n FROM words w JOIN without o ON o.rest = w.word
  UNION SELECT o.word, w.word, w.n FROM words w JOIN without o ON o.rest = w.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= {TIMES} * w.n THEN b.other END AS form,
    CASE WHEN b.other_n >= {TIMES} * w.n THEN b.other_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), walk AS (
  SELECT word, word AS here, form AS onward FROM forms
  UNION ALL SELECT w.word, w.onward, f.form FROM walk w JOIN forms f ON f.word = w.onward
)
SELECT f.word, f.form, w.here AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN walk w ON w.word = f.word AND w.onward IS NULL
"""


def query(spark, sf_dir):
    return spelling_variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))
