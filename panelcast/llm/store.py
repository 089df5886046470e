"""Tables and files that the operators keep in the shared folder of the session."""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelcast.staging import scratch_path


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    The lineage ends there, the rows survive the loss of executors, and the planner knows the table's true size,
    so that it broadcasts small tables by itself and shuffles large ones.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def open_store(uri: str):
    """(file system, path) of a URI in the shared folder, in a task or on the driver."""
    import re

    from pyarrow import fs

    uri = re.sub(r"^file:/+", "/", uri)
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)
