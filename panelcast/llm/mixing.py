"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

DataFrame functions only. Sources share all words by weight. Blocks of ``block_words`` words are seats: they go to
sources by highest quotients ``target / (2k + 1)``, inside a source to groups of shards and inside a group to shards
in the same way. A shard is a line of documents in seeded order. Its quota buys whole passes over the line first and
then single blocks, spread over the line from a seeded offset.

No step sorts more than about the square root of a source's shards in one task, and a shard holds about
``shard_words`` words, so a source with a third of all rows is split like any other.

Defined cases: null and empty texts have size 0 and are never taken; null sources form one source, the last; an empty
table gives an empty result; repeated rows count as documents of their own; further columns are carried along (columns
named like an output column are replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.store import settle

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 32
SHARD_WORDS = 1 << 18
MAX_REPEATS = 3
OUTPUT = ("size", "source_size", "target", "passes", "spans", "taken")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sainte_lague(shares: DataFrame, group: list[str], weight: str, seats: str, order: list[str], out: str) -> DataFrame:
    """Add ``out``, the seats each row gets of its group's ``seats``, by highest quotients; ties go by ``order``.

    A row's seats differ from its exact share by at most ``weight * n / (2 * total) + 1``. Only the quotients in that
    range are listed: about five per row, whatever the number of seats.
    """
    all_rows = Window.partitionBy(*group)
    share = F.coalesce(F.try_divide(F.col(weight), F.sum(weight).over(all_rows)), F.lit(0.0))
    ranged = (
        shares.withColumn("__share", share)
        .withColumn("__n", F.count(F.lit(1)).over(all_rows))
        .withColumn("__guess", F.floor(F.col(seats) * F.col("__share") + 0.5))
        .withColumn("__reach", F.ceil(F.col("__share") * F.col("__n") / 2) + 1)
        .withColumn("__low", F.greatest(F.col("__guess") - F.col("__reach"), F.lit(0)))
        .withColumn("__rest", F.col(seats) - F.sum("__low").over(all_rows))
    )
    quotients = ranged.withColumn("__k", F.explode(F.sequence("__low", F.col("__guess") + F.col("__reach")))).withColumn(
        "__quotient", F.col(weight).cast("double") / (2 * F.col("__k") + 1)
    )
    by_quotient = Window.partitionBy(*group).orderBy(F.desc("__quotient"), *[F.asc_nulls_last(c) for c in order])
    won = ((F.row_number().over(by_quotient) <= F.col("__rest")) & (F.col("__quotient") > 0)).cast("long")
    counted = quotients.withColumn("__won", won).groupBy(*shares.columns, "__low").agg(F.sum("__won").alias("__won"))
    return counted.withColumn(out, F.col("__low") + F.col("__won")).drop("__low", "__won")


def cycle_weights(sources: DataFrame) -> DataFrame:
    """Weights 1, 2, 3, repeating, over the sources by code point, null last. One row per source."""
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    return sources.withColumn("weight", ((place - 1) % 3 + 1).cast("double"))


def targets(sources: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Add ``target``: all words shared by ``weight``, none above ``max_repeats`` times its source's size.

    Water filling in closed form. In order of cap / weight the full sources come first; the level of the others is
    what is left for each unit of their weight.
    """
    ordered = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    before = F.coalesce(F.sum("cap").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    everything = Window.partitionBy()
    levels = (
        sources.withColumn("cap", (max_repeats * F.col("source_size")).cast("double"))
        .withColumn("__total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("__place", F.row_number().over(ordered))
        .withColumn("__level", (F.col("__total") - before) / after)
    )
    open_level = F.min(F.when(F.col("__level") < F.col("cap") / F.col("weight"), F.struct("__place", "__level"))).over(everything)
    level = open_level["__level"]
    target = F.when(level.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), level * F.col("weight")))
    return levels.withColumn("target", target).drop("cap", "__total", "__place", "__level")


def seeded(text: Column) -> Column:
    """A long from the first 32 bits of an MD5."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _in_pass(x: Column, block_words: int) -> Column:
    """Words of the first ``x`` words of a shard's line that the last, partial pass takes."""
    block = F.floor(x / block_words)
    chosen = lambda b: F.floor((b * F.col("__blocks_left") + F.col("__offset")) / F.col("__blocks"))
    return block_words * chosen(block) + (x - block * block_words) * (chosen(block + 1) - chosen(block))


def plan_shards(sized: DataFrame, weights: DataFrame | None, seed: str, block_words: int, shard_words: int, max_repeats: int):
    """(sources, shards): targets and shard counts by source; passes, blocks and offset by shard."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    if weights is None:
        sources = cycle_weights(sources)
    else:
        w = weights.select(F.col("source").alias("__s"), F.col("weight").cast("double").alias("weight"))
        sources = sources.join(w, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    side = F.ceil(F.sqrt(F.ceil(F.greatest(F.col("source_size"), F.lit(1)) / shard_words)))
    sources = targets(sources, max_repeats).withColumn("__side", side)
    seats = sources.withColumn("__seats", F.floor(F.sum("target").over(Window.partitionBy()) / block_words + 0.5))
    sources = settle(sainte_lague(seats, [], "target", "__seats", ["source"], "__quota").drop("__seats"), "mix-sources")

    lines = _place(sized, sources, seed).groupBy("source", "__group", "__shard").agg(F.sum("size").alias("__words"))
    lines = settle(lines, "mix-lines")
    groups = lines.groupBy("source", "__group").agg(F.sum("__words").alias("__group_words"))
    quotas = sources.select(F.col("source").alias("__s"), "__quota")
    groups = groups.join(quotas, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    groups = sainte_lague(groups, ["source"], "__group_words", "__quota", ["__group"], "__group_quota")
    groups = groups.select(F.col("source").alias("__s"), F.col("__group").alias("__g"), "__group_quota")
    shards = lines.join(groups, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__group") == F.col("__g"))).drop("__s", "__g")
    shards = sainte_lague(shards, ["source", "__group"], "__words", "__group_quota", ["__shard"], "__quota")

    words, quota = F.col("__words"), F.col("__quota") * block_words
    passes = F.least(F.coalesce(F.floor(F.try_divide(quota, words)), F.lit(0)), F.lit(max_repeats))
    blocks = F.greatest(F.ceil(words / block_words), F.lit(1))
    left = F.floor((quota - F.col("passes") * words) / block_words + 0.5)
    offset = seeded(F.concat_ws(":", F.lit(seed), "source", F.col("__group").cast("string"), F.col("__shard").cast("string")))
    shards = (
        shards.withColumn("passes", passes)
        .withColumn("__blocks", blocks)
        .withColumn("__blocks_left", F.when(F.col("passes") < max_repeats, F.least(left, blocks)).otherwise(F.lit(0)))
        .withColumn("__offset", offset % F.col("__blocks"))
        .drop("__words", "__group_quota", "__quota")
    )
    return sources, settle(shards, "mix-shards")


def _place(sized: DataFrame, sources: DataFrame, seed: str) -> DataFrame:
    """Add source columns, ``_group``, ``_shard`` and the seeded order ``_order``."""
    table = sources.select(F.col("source").alias("__s"), "source_size", "target", "__side")
    placed = sized.join(table, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    order = F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")))
    spot = F.conv(F.substring("__order", 1, 8), 16, 10).cast("long")
    return (
        placed.withColumn("__order", order)
        .withColumn("__group", spot % F.col("__side"))
        .withColumn("__shard", F.floor(spot / F.col("__side")) % F.col("__side"))
    )


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    seed: str = "mix",
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """All documents with what the mix takes of them.

    ``docs`` has ``doc_id``, ``source`` and either ``size`` (words) or ``text``; ``weights`` has ``source`` and a
    positive ``weight``, one row per source (None: 1, 2, 3, repeating; sources without weight are left out). Adds
    ``size``, ``source_size``, ``target``, ``passes`` (whole copies), ``spans`` (first word and number of words of the
    pieces taken once more) and ``taken`` (words in all). The result depends on rows and seed only.
    """
    if "size" not in docs.columns or "text" in docs.columns:
        docs = docs.withColumn("size", word_count(F.col("text")))
    docs = docs.drop(*[c for c in OUTPUT if c != "size"])
    sources, shards = plan_shards(docs.select("doc_id", "source", "size"), weights, seed, block_words, shard_words, max_repeats)
    shard = shards.select(
        F.col("source").alias("__s"), F.col("__group").alias("__g"), F.col("__shard").alias("__h"),
        "passes", "__blocks", "__blocks_left", "__offset",
    )
    same = F.col("source").eqNullSafe(F.col("__s")) & (F.col("__group") == F.col("__g")) & (F.col("__shard") == F.col("__h"))
    line = Window.partitionBy("source", "__group", "__shard").orderBy("__order", F.asc_nulls_last("doc_id"), "size")
    end = F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    laid = _place(docs, sources, seed).withColumn("__end", end).withColumn("__start", F.col("__end") - F.col("size"))
    laid = laid.join(shard, same)
    once = _in_pass(F.col("__end"), block_words) - _in_pass(F.col("__start"), block_words)
    first, last = F.floor(F.col("__start") / block_words), F.floor((F.col("__end") - 1) / block_words)
    chosen = lambda b: F.floor((b * F.col("__blocks_left") + F.col("__offset")) / F.col("__blocks"))
    picked = F.filter(F.sequence(first, F.greatest(first, last)), lambda b: chosen(b + 1) > chosen(b))
    piece = lambda b: F.struct(
        (F.greatest(b * block_words, F.col("__start")) - F.col("__start")).alias("first"),
        (F.least((b + 1) * block_words, F.col("__end")) - F.greatest(b * block_words, F.col("__start"))).alias("words"),
    )
    spans = F.when(F.col("size") > 0, F.transform(picked, piece)).otherwise(F.array())
    return (
        laid.withColumn("spans", spans)
        .withColumn("taken", (F.col("passes") * F.col("size") + once).cast("long"))
        .select(*[c for c in docs.columns if c != "size"], *OUTPUT)
    )


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sized = settle(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    return mix(sized).select("doc_id", "size", "source_size", "target", "taken")


SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents
),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight,
         CAST({MAX_REPEATS} * source_size AS DOUBLE) AS cap FROM totals
),
levels AS (
  SELECT *, ((SELECT sum(source_size) FROM weighted)
             - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
         row_number() OVER o AS place
  FROM weighted WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)
),
filled AS (
  SELECT source, source_size, weight,
         least(cap, coalesce((SELECT arg_min(level, place) FROM levels WHERE level < cap / weight) * weight, cap)) AS target
  FROM levels
),
sided AS (
  SELECT *, CAST(ceil(sqrt(ceil(greatest(source_size, 1) / {SHARD_WORDS}.0))) AS BIGINT) AS side,
         CAST(floor(sum(target) OVER () / {BLOCK_WORDS} + 0.5) AS BIGINT) AS seats FROM filled
),
source_seats AS (
  SELECT source, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source NULLS LAST) AS place, seats
  FROM (SELECT *, unnest(range(CAST(ceil(target / {BLOCK_WORDS}) AS BIGINT) + 2)) AS k FROM sided WHERE target > 0)
),
source_quota AS (SELECT source, count(*) AS quota FROM source_seats WHERE place <= seats GROUP BY source),
spots AS (
  SELECT z.doc_id, z.source, z.size, s.source_size, s.target, s.side, md5('mix:' || z.doc_id) AS ord,
         CAST('0x' || substr(md5('mix:' || z.doc_id), 1, 8) AS BIGINT) AS spot
  FROM sized z JOIN sided s ON z.source IS NOT DISTINCT FROM s.source
),
placed AS (SELECT *, spot % side AS g, (spot // side) % side AS h FROM spots),
lines AS (SELECT source, g, h, CAST(sum(size) AS BIGINT) AS words FROM placed GROUP BY ALL),
group_words AS (SELECT source, g, sum(words) AS words FROM lines GROUP BY ALL),
group_seats AS (
  SELECT source, g, quota,
         row_number() OVER (PARTITION BY source ORDER BY CAST(words AS DOUBLE) / (2 * k + 1) DESC, g) AS place
  FROM (SELECT a.*, quota, unnest(range(quota + 1)) AS k
        FROM group_words a JOIN source_quota q ON a.source IS NOT DISTINCT FROM q.source) WHERE words > 0
),
group_quota AS (SELECT source, g, count(*) AS quota FROM group_seats WHERE place <= quota GROUP BY ALL),
shard_seats AS (
  SELECT source, g, h, quota,
         row_number() OVER (PARTITION BY source, g ORDER BY CAST(words AS DOUBLE) / (2 * k + 1) DESC, h) AS place
  FROM (SELECT a.*, quota, unnest(range(quota + 1)) AS k
        FROM lines a JOIN group_quota q ON a.source IS NOT DISTINCT FROM q.source AND a.g = q.g) WHERE words > 0
),
shard_quota AS (SELECT source, g, h, count(*) AS quota FROM shard_seats WHERE place <= quota GROUP BY ALL),
shards AS (
  SELECT l.source, l.g, l.h, words, coalesce(quota, 0) * {BLOCK_WORDS} AS q,
         greatest((words + {BLOCK_WORDS - 1}) // {BLOCK_WORDS}, 1) AS blocks,
         CASE WHEN words > 0 THEN least(coalesce(quota, 0) * {BLOCK_WORDS} // words, {MAX_REPEATS}) ELSE 0 END AS passes
  FROM lines l LEFT JOIN shard_quota s ON l.source IS NOT DISTINCT FROM s.source AND l.g = s.g AND l.h = s.h
),
ready AS (
  SELECT *, CASE WHEN passes < {MAX_REPEATS}
                 THEN least(CAST(floor((q - passes * words) / {BLOCK_WORDS}.0 + 0.5) AS BIGINT), blocks) ELSE 0 END AS picks,
         CAST('0x' || substr(md5(concat_ws(':', 'mix', source, g, h)), 1, 8) AS BIGINT) % blocks AS off
  FROM shards
),
laid AS (
  SELECT p.*, passes, picks, blocks, off,
         CAST(sum(size) OVER (PARTITION BY p.source, p.g, p.h ORDER BY ord, doc_id, size
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS fin
  FROM placed p JOIN ready r ON p.source IS NOT DISTINCT FROM r.source AND p.g = r.g AND p.h = r.h
)
SELECT doc_id, size, source_size, target,
       CAST(passes * size + list_sum(list_transform(range(fin - size, fin),
            lambda t: ((t // {BLOCK_WORDS} + 1) * picks + off) // blocks - ((t // {BLOCK_WORDS}) * picks + off) // blocks))
            AS BIGINT) AS taken
FROM (SELECT * FROM laid WHERE size > 0)
UNION ALL SELECT doc_id, size, source_size, target, 0 FROM laid WHERE size = 0
"""
