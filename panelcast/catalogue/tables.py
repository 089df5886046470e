"""Queries that write a table, read it back and show what arrived."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.catalogue.machine import H, split
from panelcast.catalogue.panels import DEMAND, SALES, SALES_RAW, demand, sales, sales_raw, split_sql, table
from panelcast.catalogue.registry import query
from panelcast.operators.features import FeatureSpec
from panelcast.operators.series import panel_rows
from panelcast.plans.recursive import predict_recursive
from panelcast.plans.training import fit_global, training_rows
from panelcast.sources import tables
from panelcast.staging import materialize, scratch_path


@query(
    "append_table",
    f"""
    WITH {DEMAND}
    SELECT batch, CAST(count(*) AS BIGINT) AS n, sum(y) AS total, CAST(count(note) AS BIGINT) AS notes
    FROM (SELECT 'first' AS batch, y, NULL AS note FROM demand UNION ALL SELECT 'second', y, 'x' FROM demand) GROUP BY batch
    """,
)
def append_table(spark, sf_dir):
    """Two appends, the second with a column the first did not have."""
    path = scratch_path(spark, "append")
    panel = materialize(demand(spark, sf_dir))
    tables.write_table(panel.withColumn("batch", F.lit("first")), path)
    tables.write_table(panel.withColumns({"batch": F.lit("second"), "note": F.lit("x")}), path, evolve=True)
    return (
        tables.read_table(spark, path, evolved=True)
        .groupBy("batch")
        .agg(F.count("*").alias("n"), F.sum("y").alias("total"), F.count("note").alias("notes"))
    )


@query(
    "overwrite_partitions",
    f"""
    WITH {SALES_RAW}
    SELECT sys_id, CASE WHEN sys_id = 'BUILDING' THEN 'second' ELSE 'first' END AS run, CAST(count(*) AS BIGINT) AS n
    FROM sales_raw GROUP BY sys_id
    """,
)
def overwrite_partitions(spark, sf_dir):
    """A tenant's second run replaces its own rows and no others."""
    path = scratch_path(spark, "overwrite")
    panel = sales_raw(spark, sf_dir)
    tables.write_table(panel.withColumn("run", F.lit("first")), path, "overwrite", partition_by=["sys_id"])
    again = panel.where(F.col("sys_id") == "BUILDING").withColumn("run", F.lit("second"))
    tables.write_table(again, path, "overwrite", partition_by=["sys_id"])
    return tables.read_table(spark, path).groupBy("sys_id", "run").agg(F.count("*").alias("n"))


@query("csv_round_trip", f"WITH {SALES} SELECT unique_id, ds, round(y, 2) AS y FROM sales")
def csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    tables.write_csv(sales(spark, sf_dir).withColumn("y", F.round("y", 2)), path)
    return spark.read.schema("unique_id string, ds date, y double").option("header", True).csv(path)


@query(
    "json_round_trip",
    """
    SELECT p_brand AS model_type, CAST(count(*) AS BIGINT) AS valid_rows, '[1,12]' AS lags FROM part GROUP BY p_brand
    """,
)
def json_round_trip(spark, sf_dir):
    path = scratch_path(spark, "json")
    rows = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("model_type")).agg(
        F.count("*").alias("valid_rows")
    )
    tables.write_json(rows.withColumn("lags", F.array(F.lit(1), F.lit(12))), path)
    back = spark.read.schema("model_type string, valid_rows bigint, lags array<int>").json(path)
    return back.withColumn("lags", F.to_json("lags"))


@query(
    "append_valid_rejects",
    """
    SELECT CASE WHEN event_id % 50 <> 0 THEN 'written' ELSE 'rejected' END AS kind, CAST(count(*) AS BIGINT) AS n
    FROM events GROUP BY 1
    """,
)
def append_valid_rejects(spark, sf_dir):
    """Rows without a required value go to their own table."""
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "bad")
    rows = table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 50 != 0, F.col("event_type")).alias("unique_id"), "value"
    )
    tables.append_valid(rows, good, ["unique_id"], rejects_path=bad)
    kept = tables.read_table(spark, good).withColumn("kind", F.lit("written"))
    left = tables.read_table(spark, bad).withColumn("kind", F.lit("rejected"))
    return kept.unionByName(left).groupBy("kind").agg(F.count("*").alias("n"))


@query(
    "model_round_trip",
    f"WITH {DEMAND}, {split_sql('demand', H)} SELECT unique_id, ds, true AS same FROM ahead",
)
def model_round_trip(spark, sf_dir):
    """A stored model gives the forecasts of the fitted one."""
    spec = FeatureSpec([1, 2])
    rows = split(spark, sf_dir)
    fitted = fit_global(training_rows(panel_rows(rows, "train_dates", "train"), spec), ["lr"], spec)
    uri = tables.save_model(fitted["lr"], scratch_path(spark, "models"), "demo", "lr")
    stored = {"lr": tables.load_champion_model(uri)}
    a, b = (predict_recursive(rows, m, H, "MS", spec, "train", "train_end") for m in (fitted, stored))
    both = a.join(b.withColumnRenamed("prediction", "stored"), ["unique_id", "ds", "model"])
    return both.select("unique_id", "ds", F.col("prediction").eqNullSafe(F.col("stored")).alias("same"))
