"""Result tables: parquet folders or catalog tables, CSV, JSON records and model folders."""

from __future__ import annotations

import datetime as dt
import threading
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast import schemas
from panelcast.functions.text import check_identifier
from panelcast.staging import materialize


def is_folder(table: str) -> bool:
    """A path; everything else names a catalog table."""
    return "/" in table


def existing_schema(spark: SparkSession, table: str, evolved: bool = False) -> T.StructType | None:
    """Schema of a table, from the catalog or from one file of the folder; None if there is no such table.

    ``evolved`` looks into all files of the folder.
    """
    try:
        folder = spark.read.option("mergeSchema", evolved)
        return (folder.parquet(table) if is_folder(table) else spark.table(table)).schema
    except AnalysisException:
        return None


_MODE_LOCK = threading.Lock()


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str):
    """Inserts into catalog tables know the mode from the session only, so jobs that share it replace one at a time."""
    key = "spark.sql.sources.partitionOverwriteMode"
    with _MODE_LOCK:
        before = spark.conf.get(key)
        spark.conf.set(key, mode)
        try:
            yield
        finally:
            spark.conf.set(key, before)


def write_table(
    df: DataFrame,
    table: str,
    mode: str = "append",
    evolve: bool = False,
    partition_by: list[str] | None = None,
) -> None:
    """Append to or replace a table, a folder or a catalog table.

    ``evolve`` lets an append to a folder bring new columns. With ``partition_by`` an
    overwrite replaces only the partitions present in ``df``: a job that stores
    its rows under its own run or tenant can be repeated without double rows. Rows of a partition are brought together
    first, and large partitions are split again, so that each gets few files.
    """
    spark = df.sparkSession
    present = None if evolve and is_folder(table) else existing_schema(spark, table)
    if mode == "append" and present is not None and set(df.columns) - set(present.names):
        # Only now are all footers read: an earlier append may have brought the columns.
        if extra := set(df.columns) - set(existing_schema(spark, table, evolved=True).names):
            raise ValueError(f"columns not in the table: {sorted(extra)}")
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if not is_folder(table) and present is not None:
        missing = [f for f in present.fields if f.name not in df.columns]
        df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in present.fields])
        if mode != "overwrite":
            df.write.insertInto(table)
            return
        with _overwrite_mode(spark, "dynamic" if partition_by else "static"):
            df.write.insertInto(table, overwrite=True)
        return
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic")
    if is_folder(table):
        writer.parquet(table)
    else:
        writer.format("parquet").saveAsTable(table)


def read_table(spark: SparkSession, table: str, evolved: bool = False) -> DataFrame:
    """Read a table. ``evolved`` opens the footers of all files to find the columns any append brought."""
    if not is_folder(table):
        return spark.table(table)
    return spark.read.option("mergeSchema", evolved).parquet(table)


def write_run(df: DataFrame, table: str, run_id: str) -> None:
    """Store a run's rows under its id (and tenant, where there is one); the same run again replaces them."""
    keys = ["run_id", *[c for c in ("sys_id",) if c in df.columns]]
    write_table(df.withColumn("run_id", F.lit(run_id)), table, "overwrite", partition_by=keys)


def target(output: str, name: str) -> str:
    """Where a job stores a result table: under a folder, or in a database of the catalog."""
    return f"{output.rstrip('/')}/{name}" if is_folder(output) else f"{output}.{name}"


def run_id_of(run_ts: dt.datetime, *names: str | None) -> str:
    """The id of a run that was given none: its time stamp and what it ran on."""
    return "-".join([run_ts.strftime("%Y%m%dT%H%M%S%f"), *[n for n in names if n]])


def split_valid(df: DataFrame, required: list[str]) -> DataFrame:
    """Mark rows that have a value in every required column."""
    ok = F.lit(True)
    for name in required:
        ok = ok & F.col(name).isNotNull()
    return df.withColumn("is_valid_row", ok)


def append_valid(
    df: DataFrame, path: str, required: list[str], rejects_path: str | None = None, raise_on_reject: bool = False
) -> tuple[int, int]:
    """Append the rows that fit, keep the others apart; returns (written, rejected).

    The rows are computed once and counted first: with ``raise_on_reject`` nothing is appended.
    """
    marked = materialize(split_valid(df, required))
    counts = marked.agg(
        F.count_if("is_valid_row").alias("written"), F.count_if(~F.col("is_valid_row")).alias("rejected")
    ).first()
    if counts["rejected"]:
        if rejects_path:
            write_table(marked.where("NOT is_valid_row").drop("is_valid_row"), rejects_path, evolve=True)
        if raise_on_reject:
            raise ValueError(f"{counts['rejected']} rows were rejected, none were written")
    write_table(marked.where("is_valid_row").drop("is_valid_row"), path)
    return counts["written"], counts["rejected"]


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_run_metadata(spark: SparkSession, record: dict, path: str) -> None:
    """One JSON record describing a training run."""
    names = [f.name for f in schemas.TRAINING_RESULT.fields]
    row = tuple(record.get(name) for name in names)
    write_json(spark.createDataFrame([row], schemas.TRAINING_RESULT).coalesce(1), path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def save_model(
    model: PipelineModel,
    base: str,
    display_name: str,
    model_type: str,
    fallback_base: str | None = None,
    run_id: str | None = None,
) -> str:
    """Store a fitted pipeline; when ``base`` cannot be written, ``fallback_base`` is used. Returns where it went.

    With ``run_id`` each run has its own folder, so a later run leaves the models that earlier rows name as they are.
    """
    uri = "/".join([base.rstrip("/"), display_name, model_type, *([run_id] if run_id else [])])
    try:
        model.write().overwrite().save(uri)
    except Exception:
        if fallback_base is None:
            raise
        return save_model(model, fallback_base, display_name, model_type, run_id=run_id)
    return uri


def load_champion_model(uri: str) -> PipelineModel:
    return PipelineModel.load(uri)


def ensure_tables(spark: SparkSession, database: str, tables: dict[str, T.StructType] | None = None) -> list[str]:
    """Create the database and its output tables where missing; running it again changes nothing."""
    check_identifier(database, "database")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for name, schema in (tables or schemas.OUTPUT_TABLES).items():
        check_identifier(name, "table")
        by_run = " PARTITIONED BY (run_id)" if "run_id" in schema.names else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({_ddl(schema)}) USING parquet{by_run}")
        names.append(f"{database}.{name}")
    return names


def _ddl(schema: T.StructType) -> str:
    return ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
    )


def create_or_replace_table_as(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def append_run_log(spark: SparkSession, summary: dict, path: str, created_at: dt.datetime) -> None:
    """One summary row per run; fields the log has not seen before become new columns."""
    known = {f.name: f.dataType for f in schemas.RUN_LOG.fields}
    row = {**summary, "created_at": created_at}
    fields = [T.StructField(k, known.get(k) or _infer(v), True) for k, v in row.items()]
    df = spark.createDataFrame([tuple(row.values())], T.StructType(fields))
    write_table(df.coalesce(1), path, evolve=True)


def _infer(value) -> T.DataType:
    if isinstance(value, bool):
        return T.BooleanType()
    if isinstance(value, int):
        return T.LongType()
    if isinstance(value, float):
        return T.DoubleType()
    return T.StringType()
