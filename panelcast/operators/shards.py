"""Splitting series into shards of about equal row counts.

Longest series first, each to the least loaded shard (ties to the lower number).
Series of one length are interchangeable, so the assignment needs only how many
series there are of each length: a histogram no longer than the calendar. The
plan for it is computed on the driver; series get their shard by an equi-join.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.operators.prepare import series_counts
from panelcast.staging import materialize

_BUCKETS = 3  # hex digits of the id hash that spread the series of one length


def length_plan(histogram: list[tuple[int, int]], n_shards: int) -> list[tuple[int, int, int, int]]:
    """(length, shard, first_rank, last_rank) for each run of equal picks.

    ``histogram`` lists (length, number of series). The picks among series of one
    length repeat in full rounds once the loads differ by less than that length,
    so whole rounds are taken at a time.
    """
    loads = [(0, i) for i in range(n_shards)]
    heapq.heapify(loads)
    plan: list[tuple[int, int, int, int]] = []
    for length, count in sorted(histogram, reverse=True):
        taken: dict[int, int] = {}
        left = count
        while left:
            low, high = loads[0][0], max(v for v, _ in loads)
            rounds = left // n_shards if high - low < length else 0
            if rounds:
                loads = [(v + rounds * length, i) for v, i in loads]
                heapq.heapify(loads)
                for _, i in loads:
                    taken[i] = taken.get(i, 0) + rounds
                left -= rounds * n_shards
                continue
            v, i = heapq.heappop(loads)
            heapq.heappush(loads, (v + length, i))
            taken[i] = taken.get(i, 0) + 1
            left -= 1
        start = 1
        for i in sorted(taken):
            plan.append((length, i, start, start + taken[i] - 1))
            start += taken[i]
    return plan


def rank_within_length(counts: DataFrame) -> DataFrame:
    """Number the series of each length from 1 without bringing them into one task.

    Series are spread over hash buckets, numbered inside their bucket and shifted
    by the sizes of the buckets before it.
    """
    keyed = counts.withColumn("bucket", F.substring(F.md5("unique_id"), 1, _BUCKETS))
    sizes = keyed.groupBy("n_obs", "bucket").agg(F.count("*").alias("size"))
    before = Window.partitionBy("n_obs").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "n_obs", "bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("n_obs", "bucket").orderBy("unique_id")
    return (
        keyed.withColumn("local", F.row_number().over(inside))
        .join(offsets, ["n_obs", "bucket"])
        .select("unique_id", "n_obs", (F.col("local") + F.col("offset")).alias("rank"))
    )


def balanced_shards(df: DataFrame, n_shards: int) -> DataFrame:
    """``unique_id, n_obs, shard``; shard numbers from 0, empty shards do not appear."""
    # One row per series, read several times below; the panel behind it is read once.
    counts = materialize(series_counts(df))
    histogram = counts.groupBy("n_obs").agg(F.count("*").alias("n")).collect()
    total = sum(r["n"] for r in histogram)
    n = max(1, min(n_shards, total))
    plan = df.sparkSession.createDataFrame(
        length_plan([(r["n_obs"], r["n"]) for r in histogram], n),
        "n_obs bigint, shard int, first_rank bigint, last_rank bigint",
    )
    by_length = plan.groupBy("n_obs").agg(
        F.array_sort(F.collect_list(F.struct("first_rank", "last_rank", "shard"))).alias("runs")
    )
    return (
        rank_within_length(counts)
        .join(by_length, "n_obs")
        .select(
            "unique_id",
            "n_obs",
            F.get(
                F.filter("runs", lambda r: (F.col("rank") >= r["first_rank"]) & (F.col("rank") <= r["last_rank"])),
                F.lit(0),
            )["shard"].alias("shard"),
        )
    )


def shard_loads(shards: DataFrame) -> DataFrame:
    return shards.groupBy("shard").agg(F.count("*").alias("series"), F.sum("n_obs").alias("rows"))
