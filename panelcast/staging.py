"""Cutting lineage and sharing intermediate results between the stages of a job."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder of the session, or None when it names none."""
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's folder; pick a scratch folder only on a single-machine master."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = checkpoint_dir(spark)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="panelcast-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Compute once, keep the result in the shared folder, forget the lineage.

    Survives the loss of executors: the rows are in files, not in executor storage.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize_by(df: DataFrame, column: str) -> DataFrame:
    """The same, stored by the values of a column: a filter on it reads only the rows it keeps."""
    path = scratch_path(df.sparkSession, f"by-{column}")
    df.write.partitionBy(column).parquet(path)
    schema = [*[f for f in df.schema.fields if f.name != column], df.schema[column]]
    return df.sparkSession.read.schema(T.StructType(schema)).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for tables a query writes and reads back."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers of a session this package, wherever they run."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="panelcast-code-")  # read by Spark's file server until the driver ends
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, f"code-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for at, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    out.write(os.path.join(at, name), os.path.relpath(os.path.join(at, name), os.path.dirname(package)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)
