"""Panel readers. A panel is ``unique_id string, ds date, y double``, one row per period."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.functions.text import tenant_of
from panelcast.operators.prepare import drop_null_keys, filter_tenant, limit_series, require_columns, take_ordered

KEYS = ["unique_id", "ds", "y"]


def resolve(spark: SparkSession, table: DataFrame | str) -> DataFrame:
    """A DataFrame as is, a path by its ending (parquet by default), else a catalog table."""
    if isinstance(table, DataFrame):
        return table
    if table.endswith((".csv", ".csv/")):
        return spark.read.option("header", True).csv(table)
    if table.endswith((".json", ".json/")):
        return spark.read.json(table)
    if "/" in table or table.endswith(".parquet"):
        return spark.read.parquet(table)
    return spark.table(table)


def read_panel(spark: SparkSession, table: DataFrame | str, drop_nulls: bool = True) -> DataFrame:
    df = resolve(spark, table)
    require_columns(df, KEYS)
    df = df.select(*KEYS)
    return drop_null_keys(df) if drop_nulls else df


def read_panel_raw(spark: SparkSession, table: DataFrame | str) -> DataFrame:
    return read_panel(spark, table, drop_nulls=False)


def read_mapped_panel(
    spark: SparkSession,
    table: DataFrame | str,
    uid_col: str,
    date_col: str,
    target_col: str,
    uid_delimiter: str = "_",
    sys_id_value: str | None = None,
    max_series: int = 0,
    freq: str = "D",
) -> DataFrame:
    """Any table as ``unique_id, ds, y, sys_id``; rows with a NULL in a mapped column are left out.

    ``ds`` is a date, or a time stamp for hourly data.
    """
    df = resolve(spark, table)
    require_columns(df, [uid_col, date_col, target_col])
    panel = (
        df.dropna(subset=[uid_col, date_col, target_col])
        .select(
            F.col(uid_col).cast("string").alias("unique_id"),
            (F.col(date_col).cast("timestamp_ntz") if freq == "H" else F.to_date(F.col(date_col))).alias("ds"),
            F.col(target_col).cast("double").alias("y"),
        )
        .withColumn("sys_id", tenant_of(F.col("unique_id"), uid_delimiter))
    )
    if sys_id_value is not None:
        panel = filter_tenant(panel, sys_id_value)
    return limit_series(panel, max_series) if max_series else panel


def read_renamed_panel(spark: SparkSession, table: DataFrame | str, mapping: dict[str, str] | None = None) -> DataFrame:
    """Rename columns to the panel's names; ``mapping`` is source name -> panel name."""
    mapping = mapping or {"date": "ds", "target": "y"}
    df = resolve(spark, table)
    source = {new: old for old, new in mapping.items()}
    wanted = [source.get(name, name) for name in KEYS]
    require_columns(df, wanted)
    return df.select(*[F.col(old).alias(new) for old, new in zip(wanted, KEYS)])


def recent_rows(df: DataFrame, n: int = 1000) -> DataFrame:
    """The newest ``n`` rows of the whole table; rows of one date go by id, then by their other columns."""
    return take_ordered(df, n, [F.col("ds").desc(), F.col("unique_id").asc()])


def scoring_window(df: DataFrame, lags: list[int], horizon: int) -> DataFrame:
    """The last ``max(lags) + horizon`` rows of every series.

    The rank filter is pushed below the shuffle, so each map task sends at most
    that many rows per series however many a hot series has.
    """
    keep = (max(lags) if lags else 1) + horizon
    newest = Window.partitionBy("unique_id").orderBy(F.col("ds").desc())
    return (
        drop_null_keys(df)
        .withColumn("rn", F.row_number().over(newest))
        .where(F.col("rn") <= keep)
        .select(*df.columns)
    )


def champion_history(
    spark: SparkSession, table: DataFrame | str, n: int = 10, model_display_name: str | None = None
) -> DataFrame:
    """The newest ``n`` champions, of one display name if given; runs of one time stamp go by model type."""
    rows = resolve(spark, table)
    if model_display_name is not None:
        rows = rows.where(F.col("model_display_name") == model_display_name)
    ties = [F.col(c).asc_nulls_last() for c in ("champion_model_type", "champion_model_uri") if c in rows.columns]
    return rows.orderBy(F.col("run_ts").desc(), *ties).limit(n)


def table_row_count(spark: SparkSession, table: DataFrame | str) -> DataFrame:
    return resolve(spark, table).agg(F.count("*").alias("row_count"))


def parameterised_query(spark: SparkSession, sql: str, **parameters) -> DataFrame:
    """Run SQL with ``:name`` parameters; values are bound, never pasted into the text."""
    return spark.sql(sql, args=parameters)
