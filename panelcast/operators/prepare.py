"""Cleaning, aggregation, history thresholds, hold-out and output shaping.

A raw table may hold any number of rows for one series, so operators that can
meet raw rows use partial aggregates, rank limits and joins, which a hot series
cannot stall. After ``aggregate_period`` a series has one row per period and its
length is bounded by the calendar; only then do windows over whole series run.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.calendar import floor_period, next_period
from panelcast.staging import materialize

KEYS = ["unique_id", "ds", "y"]


# -- checks ---------------------------------------------------------------------------------


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def require_non_empty(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(message)
    return df


# -- types and nulls ------------------------------------------------------------------------


def drop_null_keys(df: DataFrame) -> DataFrame:
    return df.dropna(subset=KEYS)


def null_if_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def coerce_types(df: DataFrame, freq: str = "D") -> DataFrame:
    """Text ids, dates (a bad date raises), numbers (bad text and NaN become NULL); incomplete rows go."""
    typed = df.withColumns(
        {
            "unique_id": F.col("unique_id").cast("string"),
            "ds": F.col("ds").cast("timestamp_ntz") if freq == "H" else F.to_date(F.col("ds")),
            "y": null_if_nan(F.col("y").try_cast("double")),
        }
    )
    return drop_null_keys(typed)


def filter_tenant(df: DataFrame, sys_id: str) -> DataFrame:
    return df.where(F.col("sys_id") == sys_id)


# -- aggregation ----------------------------------------------------------------------------


def aggregate_period(df: DataFrame, freq: str = "MS", keep: list[str] | None = None) -> DataFrame:
    """Sum ``y`` per series and period. Map-side partial sums make a hot series as cheap as any other."""
    keys = [*(keep or []), "unique_id"]
    period = floor_period(F.col("ds"), freq)
    return df.groupBy(*keys, period.alias("ds")).agg(F.sum("y").alias("y"))


def aggregate_same_ts(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(keep or []), "unique_id", "ds").agg(F.sum("y").alias("y"))


def assert_one_row_per_period(df: DataFrame) -> DataFrame:
    """Same panel, but a repeated (unique_id, ds) raises when the rows are computed."""
    message = F.concat(F.lit("more than one row for "), F.col("unique_id"), F.lit(" at "), F.col("ds").cast("string"))
    return (
        df.groupBy("unique_id", "ds")
        .agg(F.sum("y").alias("y"), F.count("*").alias("n"))
        .select("unique_id", "ds", F.when(F.col("n") > 1, F.raise_error(message)).otherwise(F.col("y")).alias("y"))
    )


def series_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("unique_id").agg(F.count("*").alias("n_obs"))


def count_series(df: DataFrame) -> DataFrame:
    return df.agg(F.count_distinct("unique_id").alias("series_count"))


# -- history thresholds ---------------------------------------------------------------------


def semi_join_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    return df.join(ids.select("unique_id"), "unique_id", "left_semi")


def anti_join_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    return df.join(ids.select("unique_id"), "unique_id", "left_anti")


def filter_series(df: DataFrame, min_exclusive: int, bounded: bool = True) -> DataFrame:
    """Keep series with more than ``min_exclusive`` rows.

    ``bounded`` says that the panel is aggregated: one count window, one pass.
    Otherwise counts are combined on the map side and joined back, so that a
    series with very many raw rows never meets in one task.
    """
    if bounded:
        n = F.count("*").over(Window.partitionBy("unique_id"))
        return df.withColumn("__n", n).where(F.col("__n") > min_exclusive).drop("__n")
    return semi_join_ids(df, series_counts(df).where(F.col("n_obs") > min_exclusive))


def flag_history(df: DataFrame, min_history: int) -> DataFrame:
    """One row per series: its length and whether it reaches ``min_history``."""
    return series_counts(df).withColumn("is_eligible", F.col("n_obs") >= min_history)


def take_ordered(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The first ``n`` rows in an order; rows that tie in it go by their other columns.

    Ranked in parallel for any ``n``: rows are range-partitioned, numbered inside each part and shifted by the sizes
    of the parts before it.
    """
    order = [*order, *[F.col(f"`{c}`").asc_nulls_last() for c in df.columns]]
    parts = materialize(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition: the only global window, over a table as long as the cluster is wide.
    offsets = (
        parts.groupBy("__part")
        .agg(F.count("*").alias("__size"))
        .select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    )
    inside = Window.partitionBy("__part").orderBy(*order)
    return (
        parts.withColumn("__local", F.row_number().over(inside))
        .join(offsets, "__part")
        .where(F.col("__local") + F.col("__offset") <= n)
        .select(*df.columns)
    )


def limit_series(df: DataFrame, n: int) -> DataFrame:
    """Rows of the first ``n`` series in id order; 0 keeps all."""
    if n <= 0:
        return df
    ids = df.select("unique_id").distinct()
    return semi_join_ids(df, take_ordered(ids, n, [F.col("unique_id").asc()]))


# -- hold-out -------------------------------------------------------------------------------


def _newest_first() -> Window:
    return Window.partitionBy("unique_id").orderBy(F.col("ds").desc())


def recency_rank(df: DataFrame) -> DataFrame:
    """Position from the newest row of the series, newest is 1. For aggregated panels."""
    return df.withColumn("rn", F.row_number().over(_newest_first()))


def series_position(df: DataFrame) -> DataFrame:
    """Position from the oldest row of the series, oldest is 1. For aggregated panels."""
    oldest_first = Window.partitionBy("unique_id").orderBy("ds")
    return df.withColumn("position", F.row_number().over(oldest_first))


def top_k_per_series(df: DataFrame, k: int) -> DataFrame:
    return recency_rank(df).where(F.col("rn") <= k)


def holdout_split(df: DataFrame, h: int, bounded: bool = True) -> DataFrame:
    """Mark the last ``h`` rows of every series; series with ``h`` rows or fewer are left out.

    ``bounded`` says that the panel is aggregated: one shuffle by series serves
    both the count and the rank. Otherwise only the newest ``h + 1`` rows of a
    series meet in one task (the rank limit runs before the shuffle) and the
    rest is an equi-join on the cut-off date.
    """
    if bounded:
        n = F.count("*").over(Window.partitionBy("unique_id"))
        ranked = recency_rank(df).withColumn("__n", n).where(F.col("__n") > h)
        return ranked.withColumn("is_valid", F.col("rn") <= h).drop("rn", "__n")
    # Rows of one date are told apart by all their columns; equal rows share a number and are counted.
    same = [c for c in df.columns if c not in ("unique_id", "ds")]
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in same]) if same else F.lit(0).cast("long")
    marked = df.withColumn("__tie", tie)
    newest = Window.partitionBy("unique_id").orderBy(F.col("ds").desc(), F.col("__tie").desc())
    last = (
        marked.select("unique_id", "ds", "__tie")
        .withColumn("rn", F.row_number().over(newest))
        .where(F.col("rn") <= h + 1)
        .groupBy("unique_id")
        .agg(
            F.count("*").alias("__n"),
            F.min(F.when(F.col("rn") <= h, F.struct("ds", "__tie"))).alias("__first"),
        )
        .where(F.col("__n") > h)
        .select("unique_id", "__first")
    )
    return (
        marked.join(last, "unique_id")
        .withColumn("is_valid", F.struct("ds", "__tie") >= F.col("__first"))
        .drop("__first", "__tie")
    )


def train_part(split: DataFrame) -> DataFrame:
    return split.where("NOT is_valid").drop("is_valid")


def valid_part(split: DataFrame) -> DataFrame:
    return split.where("is_valid").drop("is_valid")


def tail_rows(df: DataFrame, n: int) -> DataFrame:
    """The last ``n`` rows of the whole panel in (id, date) order, whatever series they belong to."""
    return take_ordered(df, n, [F.col("unique_id").desc(), F.col("ds").desc()])


# -- calendar -------------------------------------------------------------------------------


def future_dates(df: DataFrame, h: int, freq: str) -> DataFrame:
    """The ``h`` periods after the last row of each series."""
    return (
        df.groupBy("unique_id")
        .agg(F.max("ds").alias("last_ds"))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(h))))
        .select("unique_id", next_period(F.col("last_ds"), F.col("step"), freq).alias("ds"), "step")
    )


# -- output shape ---------------------------------------------------------------------------


def tag_run_columns(
    df: DataFrame,
    run_ts: dt.datetime,
    model_type: str | Column,
    source_table: str,
    forecast_freq: str,
    horizon: int,
    model_display_name: str | None = None,
    is_future: bool | None = None,
) -> DataFrame:
    """Add the columns that describe a run. The time stamp is an argument, so a repeated run agrees."""
    tags = {
        "run_ts": F.lit(run_ts).cast("timestamp"),
        "model_type": model_type if isinstance(model_type, Column) else F.lit(model_type),
        "source_table": F.lit(source_table),
        "forecast_freq": F.lit(forecast_freq),
        "horizon": F.lit(horizon).cast("bigint"),
    }
    if model_display_name is not None:
        tags["model_display_name"] = F.lit(model_display_name)
    if is_future is not None:
        tags["is_future"] = F.lit(is_future)
    return df.withColumns(tags)


def project_output(df: DataFrame, columns: list[str]) -> DataFrame:
    return require_columns(df, columns).select(*columns)


def drop_if_exists(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def sort_panel(df: DataFrame) -> DataFrame:
    """Rows of a series together and in date order inside partitions; no global order is needed."""
    return df.repartition("unique_id").sortWithinPartitions("unique_id", "ds")


def union_parts(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
