"""Connected components of a link table, by star contraction (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.store import settle


def _star(links: DataFrame, small: bool) -> DataFrame:
    """Tie the neighbours of every node (only the smaller ones, or only the larger ones) to its least neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    side = both.where(F.col("b") < F.col("a")) if small else both
    least = side.groupBy(F.col("a").alias("_a")).agg(F.min("b").alias("_m"))
    least = least.withColumn("_m", F.least("_a", "_m"))
    rows = side if small else both.where(F.col("b") > F.col("a"))
    tied = rows.join(least, F.col("a") == F.col("_a")).select(F.col("b").alias("a"), F.col("_m").alias("b"))
    if small:
        tied = tied.unionByName(least.select(F.col("_a").alias("a"), F.col("_m").alias("b")))
    return tied.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: longs); the component is its least node.

    Each round is two joins on the links; the number of rounds grows with the logarithm of the longest chain. Only a
    count and a checksum reach the driver.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    seen = None
    while True:
        links = settle(_star(_star(links, small=False), small=True), "components")
        now = tuple(links.agg(F.count("a"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.sum(F.hash("b", "a").cast("long"))).first())
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
