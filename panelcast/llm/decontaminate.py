"""Finding benchmark passages in training documents.

DataFrame functions only. Every benchmark item is cut into windows of ``window`` normalised words; distinct windows
form a hash set that is broadcast when its counted size allows it. Each window is filed under its longest word. One
scan of the documents turns every text into its words; a word that files windows proposes them at its position, and
a proposal is a hit when the normalised document words equal the window. Only proposals leave the scan.

Defined cases: null and empty texts have no words and no hits; an item of fewer words than a window is one window, an
item without words none; null item ids count as the empty id; repeated rows give a row each; an empty benchmark hits
nothing; further columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.store import settle

WINDOW = 13
#: Largest number of windows that is broadcast (about 150 bytes each); beyond it the set is shuffled by hash.
MAX_BROADCAST_WINDOWS = 500_000
#: Normalised words consist of these after A-Z became a-z, so A-Z is allowed in the raw text.
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Ends the word list of each document; no word can contain it.
END = "\x00"


def raw_words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(RAW_WORD), F.lit(0))


def normalised(words: Column) -> Column:
    """Words joined by blanks, A-Z in lower case only."""
    return F.translate(F.array_join(words, " "), UPPER, LOWER)


def filed_under(word: Column) -> Column:
    """Hash that finds a word's windows. Full lower-casing merges more words than A-Z does, never fewer."""
    return F.xxhash64(F.lower(word))


def windows(benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(distinct windows: window_id, file, offset, length, phrase; window_id to item_id), both settled."""
    words = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), raw_words(F.col("text")).alias("words")
    )
    words = words.where(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))
    cut = words.withColumn("start", F.explode(starts)).withColumn("part", F.slice("words", F.col("start") + 1, window))
    longest = F.array_max(F.transform("part", lambda w, i: F.struct(F.length(w).alias("size"), (-i).alias("place"))))
    cut = cut.withColumn("offset", -longest["place"])
    filed = cut.select(
        "item_id",
        normalised(F.col("part")).alias("phrase"),
        filed_under(F.element_at("part", F.col("offset") + 1)).alias("file"),
        "offset",
        F.size("part").alias("length"),
    )
    # Equal phrases may differ in how their upper-case letters measure; keep one filing for each.
    listed = filed.groupBy("phrase").agg(
        F.min(F.struct("file", "offset", "length")).alias("how"), F.collect_set("item_id").alias("items")
    )
    listed = settle(listed.withColumn("window_id", F.xxhash64("phrase")), "benchmark-windows")
    index = listed.select("window_id", "how.file", "how.offset", "how.length", "phrase")
    return index, listed.select("window_id", F.explode("items").alias("item_id"))


def hits(docs: DataFrame, index: DataFrame, max_broadcast: int = MAX_BROADCAST_WINDOWS) -> DataFrame:
    """One row per distinct (doc_id, text): ``copies``, ``n_words`` and ``found``, the set of (start, length, window_id).

    ``docs`` has ``doc_id`` and ``text``. The list of a document is bounded by its own words.
    """
    spark = docs.sparkSession
    end = spark.range(1).select(
        F.lit(0).cast("long").alias("window_id"), filed_under(F.lit(END)).alias("file"), F.lit(0).alias("offset"),
        F.lit(0).alias("length"), F.lit("").alias("phrase"),
    )
    files = index.unionByName(end)
    if index.count() <= max_broadcast:
        files = F.broadcast(files)
    words = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.concat(raw_words(F.col("text")), F.array(F.lit(END))).alias("words"),
    )
    places = words.select("doc_id", "text_hash", "words", F.posexplode("words").alias("pos", "word"))
    proposed = places.join(files, filed_under(F.col("word")) == F.col("file"))
    start = F.col("pos") - F.col("offset")
    inside = (start >= 0) & (start + F.col("length") < F.size("words"))
    part = F.slice("words", F.greatest(start, F.lit(0)) + 1, F.col("length"))
    is_end = F.col("word") == END
    equal = F.when(is_end, F.col("length") == 0).otherwise(
        F.when((F.col("length") > 0) & inside, normalised(part) == F.col("phrase")).otherwise(False)
    )
    found = proposed.where(equal).select(
        "doc_id", "text_hash", F.when(is_end, F.col("pos")).alias("n_words"),
        F.when(~is_end, F.struct(start.alias("start"), F.col("length"), F.col("window_id"))).alias("hit"),
    )
    return found.groupBy("doc_id", "text_hash").agg(
        F.count("n_words").alias("copies"), F.max("n_words").alias("n_words"), F.collect_set("hit").alias("found")
    )


def merged_spans(found: Column) -> Column:
    """Disjoint spans (first word, words) that cover the hits."""
    ordered = F.array_sort(F.transform(found, lambda h: F.struct(h["start"].alias("first"), (h["start"] + h["length"]).alias("end"))))
    empty = F.array().cast("array<struct<first:int,end:int>>")

    def add(spans, hit):
        last = F.element_at(spans, -1)
        joined = F.concat(
            F.slice(spans, 1, F.size(spans) - 1),
            F.array(F.struct(last["first"].alias("first"), F.greatest(last["end"], hit["end"]).alias("end"))),
        )
        return F.when((F.size(spans) > 0) & (F.try_element_at(spans, F.lit(-1))["end"] >= hit["first"]), joined).otherwise(
            F.concat(spans, F.array(hit))
        )

    return F.aggregate(ordered, empty, add)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document row: ``doc_id, n_words, n_hit, spans, items, contaminated`` and the ``text_hash``."""
    index, members = windows(benchmark, window)
    per_doc = settle(hits(docs, index), "contamination-hits")
    by_doc = per_doc.where(F.size("found") > 0).select(
        "doc_id", "text_hash", F.explode(F.array_distinct(F.transform("found", lambda h: h["window_id"]))).alias("window_id")
    )
    items = (
        by_doc.join(members, "window_id")
        .groupBy(F.col("doc_id").alias("__d"), F.col("text_hash").alias("__h"))
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    spans = merged_spans(F.col("found"))
    counted = per_doc.withColumn("spans", F.when(F.size("found") > 0, spans).otherwise(F.array()))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["first"])
    out = (
        counted.join(items, F.col("doc_id").eqNullSafe(F.col("__d")) & F.col("text_hash").eqNullSafe(F.col("__h")), "left")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
        .withColumn("n_hit", n_hit)
    )
    return out.select(
        "doc_id",
        "text_hash",
        F.col("n_words").cast("long").alias("n_words"),
        "n_hit",
        "spans",
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without the contaminated ones, with their columns."""
    bad = contamination(docs, benchmark, window).where("contaminated")
    bad = settle(bad.select(F.col("doc_id").alias("__d"), F.col("text_hash").alias("__h")).distinct(), "contaminated")
    same = F.col("doc_id").eqNullSafe(F.col("__d")) & (F.xxhash64("text") == F.col("__h"))
    return docs.join(bad, same, "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with every hit passage cut out of ``text``, from its first word to its last."""
    hit = contamination(docs, benchmark, window).where("n_hit > 0")
    hit = hit.select(F.col("doc_id").alias("__d"), F.col("text_hash").alias("__h"), "spans").dropDuplicates(["__d", "__h"])
    hit = settle(hit, "contaminated-spans").withColumnRenamed("spans", "__spans")
    same = F.col("doc_id").eqNullSafe(F.col("__d")) & (F.xxhash64("text") == F.col("__h"))
    joined = docs.join(hit, same, "left")
    # The text splits into gap, word, gap, word, ..., gap; word i stands between gaps i and i + 1.
    gaps = F.split("text", RAW_WORD)
    words = raw_words(F.col("text"))
    cut = lambda i: F.exists("__spans", lambda s: (s["first"] <= i) & (i < s["end"]))
    inner = lambda i: F.exists("__spans", lambda s: (s["first"] < i) & (i < s["end"]))
    pieces = F.transform(
        gaps,
        lambda gap, i: F.concat(
            F.when(inner(i), F.lit("")).otherwise(gap),
            F.when(cut(i), F.lit("")).otherwise(F.coalesce(F.try_element_at(words, i + 1), F.lit(""))),
        ),
    )
    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(F.array_join(pieces, ""))
    return joined.withColumn("text", text).select(*docs.columns)


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return contamination(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


SQL = rf"""
WITH item AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id,
         regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
),
item_windows AS (
  SELECT DISTINCT item_id, w[s + 1 : s + least({WINDOW}, len(w))] AS win
  FROM (SELECT *, unnest(range(greatest(len(w) - {WINDOW}, 0) + 1)) AS s FROM item WHERE len(w) > 0)
),
doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
),
lens AS (SELECT DISTINCT len(win) AS n FROM item_windows),
doc_windows AS (
  SELECT r, s, n, w[s + 1 : s + n] AS win
  FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS s FROM doc, lens WHERE len(w) >= n)
),
found AS (SELECT r, s, n, item_id FROM doc_windows d JOIN item_windows i ON d.win = i.win),
places AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT r, s, n FROM found))
  GROUP BY r
),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN places USING (r) LEFT JOIN items USING (r)
"""
