"""Whole jobs with linear models on one lag: their results have a closed form that SQL can state."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from panelcast.catalogue.panels import (
    DEMAND,
    SALES,
    demand_source,
    event_raw,
    sales,
    sales_source,
    split_sql,
    table,
)
from panelcast.catalogue.registry import query
from panelcast.operators import evaluate as ev
from panelcast.operators import prepare as pp
from panelcast.plans import jobs
from panelcast.plans.forecast import batch_forecast
from panelcast.sources import panel as src
from panelcast.sources import tables
from panelcast.staging import materialize, scratch_path

RUN_TS = dt.datetime(2024, 2, 1)
H = 3
# Ridge with the usual penalty is too close to lr here for a champion both sides agree on; ``ridge_forecast`` has it.
MODELS = ("lr", "naive")
LINEAR = jobs.GlobalConfig(freq="MS", horizon=H, lags=(1,), date_features=(), models=MODELS)

#: Pooled slopes of both linear models, their paths after the training end and the naive path.
FITS = """
pairs AS (SELECT y, lag(y) OVER (PARTITION BY unique_id ORDER BY ds) AS x FROM train),
sums AS (
  SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS vx, covar_pop(y, x) AS cxy FROM pairs WHERE x IS NOT NULL
),
fits AS (
  SELECT 'lr' AS model, cxy / vx AS b, mx, my FROM sums
  UNION ALL SELECT 'naive', 1.0, 0.0, 0.0
)"""


def paths_sql(start: str, h: int, name: str = "preds", fits: str = "fits") -> str:
    """Recursive forecasts from ``start`` (unique_id, ds, y: one row per series)."""
    return f"""
{name}_steps AS (
  SELECT model, unique_id, ds AS last_ds, CAST(y AS DOUBLE) AS y, b, mx, my, 0 AS k FROM {start} CROSS JOIN {fits}
  UNION ALL
  SELECT model, unique_id, last_ds, my + b * (y - mx), b, mx, my, k + 1 FROM {name}_steps WHERE k < {h}
),
{name} AS (
  SELECT model, unique_id, CAST(last_ds + to_months(CAST(k AS INTEGER)) AS DATE) AS ds, y AS prediction
  FROM {name}_steps WHERE k > 0
)"""


SCORED = f"""
RECURSIVE {SALES}, {split_sql("sales", H)}, {FITS},
train_last AS (SELECT unique_id, max(ds) AS ds, arg_max(y, ds) AS y FROM train GROUP BY unique_id),
{paths_sql("train_last", H)},
joined AS (
  SELECT v.unique_id, v.ds, v.y, p.model, p.prediction FROM valid v JOIN preds p ON p.unique_id = v.unique_id AND p.ds = v.ds
),
results AS (
  SELECT model, sqrt(avg((y - prediction) ** 2)) AS rmse, avg(abs(y - prediction)) AS mae,
         sum(abs(y - prediction)) / sum(abs(y)) AS wmape, count(*) AS valid_rows,
         list_position(['lr', 'naive'], model) AS ordinal
  FROM joined GROUP BY model
),
best AS (SELECT model FROM results ORDER BY wmape, ordinal LIMIT 1)"""


@query(
    "global_linear_job",
    f"""
    WITH {SCORED}
    SELECT model AS model_type, round(rmse, 2) AS rmse, round(mae, 2) AS mae, round(wmape, 6) AS wmape, valid_rows FROM results
    """,
)
def global_linear_job(spark, sf_dir):
    result = jobs.global_champion(sales(spark, sf_dir), LINEAR, "sales", RUN_TS)
    return result.results.select(
        "model_type", F.round("rmse", 2).alias("rmse"), F.round("mae", 2).alias("mae"), F.round("wmape", 6).alias("wmape"), "valid_rows"
    )


@query(
    "global_linear_champion",
    f"""
    WITH {SCORED}
    SELECT model AS champion_model_type, 'wmape' AS champion_metric_name, round(wmape, 6) AS champion_metric_value,
           (SELECT count(DISTINCT unique_id) FROM train) AS series_count, (SELECT count(*) FROM train) AS train_rows
    FROM results WHERE model = (SELECT model FROM best)
    """,
)
def global_linear_champion(spark, sf_dir):
    champion = jobs.global_champion(sales(spark, sf_dir), LINEAR, "sales", RUN_TS).champion
    return champion.select(
        "champion_model_type", "champion_metric_name", F.round("champion_metric_value", 6).alias("champion_metric_value"),
        "series_count", "train_rows",
    )


@query(
    "global_linear_predictions",
    f"""
    WITH {SCORED}
    SELECT unique_id, ds, round(y, 2) AS y, round(prediction, 2) AS prediction, model AS model_type,
           CAST({H} AS BIGINT) AS horizon FROM joined
    """,
)
def global_linear_predictions(spark, sf_dir):
    result = jobs.global_champion(sales(spark, sf_dir), LINEAR, "sales", RUN_TS)
    return result.predictions.select(
        "unique_id", "ds", F.round("y", 2).alias("y"), F.round("prediction", 2).alias("prediction"), "model_type", "horizon"
    )


@query(
    "multi_model_linear_job",
    f"""
    WITH {SCORED}
    SELECT unique_id, ds, round(max(y), 2) AS y,
           round(max(CASE WHEN model = 'lr' THEN prediction END), 2) AS lr,
           round(max(CASE WHEN model = 'naive' THEN prediction END), 2) AS naive,
           (SELECT model FROM best) AS best_model, CAST({H} AS BIGINT) AS horizon
    FROM joined GROUP BY unique_id, ds
    """,
)
def multi_model_linear_job(spark, sf_dir):
    wide, _ = jobs.run_multi_model_single_fit(spark, sales(spark, sf_dir), LINEAR, RUN_TS, "sales")
    return wide.select("unique_id", "ds", *[F.round(c, 2).alias(c) for c in ("y", *MODELS)], "best_model", "horizon")


@query(
    "training_fanout_linear",
    f"WITH {SCORED} SELECT model AS model_type, round(wmape, 6) AS wmape, valid_rows FROM results WHERE model = (SELECT model FROM best)",
)
def training_fanout_linear(spark, sf_dir):
    """Each model trained on its own, results collected, the best chosen."""
    panel = materialize(sales(spark, sf_dir))
    results = [jobs.train_one_model(panel, key, LINEAR, "sales", RUN_TS)[1] for key in MODELS]
    return jobs.select_champion(results, list(MODELS)).select("model_type", F.round("wmape", 6).alias("wmape"), "valid_rows")


@query(
    "batch_forecast_linear",
    f"""
    WITH {SCORED},
    newest AS (SELECT unique_id, max(ds) AS ds, arg_max(y, ds) AS y FROM sales GROUP BY unique_id),
    chosen AS (SELECT * FROM fits WHERE model = (SELECT model FROM best)),
    {paths_sql("newest", 6, "batch", "chosen")}
    SELECT unique_id, ds, round(prediction, 2) AS prediction, model AS model_type, true AS is_future FROM batch
    """,
)
def batch_forecast_linear(spark, sf_dir):
    """The champion of a global run forecasts from the newest rows of every series."""
    panel = materialize(sales(spark, sf_dir))
    result = jobs.global_champion(panel, LINEAR, "sales", RUN_TS)
    out = batch_forecast(panel, result.model_type, 6, "MS", LINEAR.features, RUN_TS, "sales", model=result.model)
    return out.select("unique_id", "ds", F.round("prediction", 2).alias("prediction"), "model_type", "is_future")


@query(
    "monthly_linear_job",
    f"""
    WITH RECURSIVE {DEMAND},
    train AS (SELECT *, count(*) OVER (PARTITION BY unique_id) AS n FROM demand QUALIFY n >= 24),
    {FITS},
    newest AS (SELECT unique_id, max(ds) AS ds, arg_max(y, ds) AS y FROM train GROUP BY unique_id),
    linear AS (SELECT * FROM fits WHERE model = 'lr'),
    {paths_sql("newest", 12, "preds", "linear")}
    SELECT unique_id, ds, round(prediction, 4) AS lr FROM preds
    """,
)
def monthly_linear_job(spark, sf_dir):
    mapping = {"product_id": "unique_id", "date": "ds", "quantity": "y"}
    out = jobs.run_monthly_ml(spark, demand_source(spark, sf_dir), mapping, ("lr",), lags=(1,))
    return out.withColumn("lr", F.round("lr", 4))


_SERIES_CHAMPIONS = f"""
RECURSIVE {SALES}, {split_sql("sales", 6)}, {FITS},
train_last AS (SELECT unique_id, max(ds) AS ds, arg_max(y, ds) AS y FROM train GROUP BY unique_id),
{paths_sql("train_last", 6)},
joined AS (
  SELECT v.unique_id, v.ds, v.y, p.model, p.prediction FROM valid v JOIN preds p ON p.unique_id = v.unique_id AND p.ds = v.ds
  WHERE p.model <> 'naive'
),
metrics AS (
  SELECT unique_id, model, sqrt(avg((y - prediction) ** 2)) AS rmse, avg(abs(y - prediction)) AS mae,
         sum(abs(y - prediction)) / greatest(sum(abs(y)), 1e-9) AS wmape FROM joined GROUP BY ALL
),
champions AS (
  SELECT unique_id, model FROM metrics
  QUALIFY row_number() OVER (PARTITION BY unique_id ORDER BY rmse, mae, wmape, model) = 1
)"""


@query(
    "series_linear_job",
    f"""
    WITH {_SERIES_CHAMPIONS},
    own_pairs AS (SELECT unique_id, y, lag(y) OVER (PARTITION BY unique_id ORDER BY ds) AS x FROM sales),
    own AS (
      SELECT unique_id, count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS vx, covar_pop(y, x) AS cxy
      FROM own_pairs WHERE x IS NOT NULL GROUP BY unique_id
    ),
    start AS (
      SELECT c.unique_id, c.model, max(s.ds) AS ds, arg_max(s.y, s.ds) AS y,
             any_value(cxy / vx) AS b, any_value(mx) AS mx, any_value(my) AS my
      FROM champions c JOIN sales s ON s.unique_id = c.unique_id JOIN own o ON o.unique_id = c.unique_id GROUP BY ALL
    ),
    steps AS (
      SELECT unique_id, model, ds, CAST(y AS DOUBLE) AS y, b, mx, my, 0 AS k FROM start
      UNION ALL SELECT unique_id, model, ds, my + b * (y - mx), b, mx, my, k + 1 FROM steps WHERE k < 6
    )
    SELECT split_part(unique_id, '_', 1) AS sys_id, unique_id, CAST(ds + to_months(CAST(k AS INTEGER)) AS DATE) AS ds,
           round(y, 1) AS forecast, model AS champion_model
    FROM steps WHERE k > 0
    """,
)
def series_linear_job(spark, sf_dir):
    """A pooled linear model audited per series and refitted on each series alone."""
    out = jobs.run_series_champion_ml(
        spark, sales(spark, sf_dir), "unique_id", "ds", "y", ["lr"], 6, 6, lags=(1,), date_features=()
    )
    return out["forecasts"].withColumn("forecast", F.round("forecast", 1))


# -- what jobs store ---------------------------------------------------------------------------


@query(
    "two_tenant_runs",
    f"""
    WITH {SALES}
    SELECT kind, split_part(unique_id, '_', 1) AS sys_id, count(DISTINCT unique_id) AS series
    FROM sales CROSS JOIN (SELECT unnest(['champions', 'forecasts']) AS kind)
    WHERE split_part(unique_id, '_', 1) IN ('BUILDING', 'MACHINERY') GROUP BY ALL
    """,
)
def two_tenant_runs(spark, sf_dir):
    """Two runs with default settings keep each other's rows, and the first one repeated adds none."""
    out = scratch_path(spark, "tenants")
    config = jobs.SeriesConfig(stats_models=("Naive",), ml_models=(), min_history=3, validation_horizon=1, fallback_unscored=True)
    for tenant in ("BUILDING", "MACHINERY", "BUILDING"):
        jobs.run_series_champion(
            spark, sales_source(spark, sf_dir), "product_id", "date", "sales", config, sys_id_value=tenant, output=out, run_ts=RUN_TS
        )
    parts = []
    for kind in ("champions", "forecasts"):
        stored = tables.read_table(spark, f"{out}/{kind}")
        parts.append(stored.groupBy(F.lit(kind).alias("kind"), "sys_id").agg(F.count_distinct("unique_id").alias("series")))
    return pp.union_parts(parts)


@query(
    "repeated_global_run",
    f"""
    WITH {SCORED}
    SELECT 'predictions' AS kind, model AS model_type, valid_rows AS n FROM results
    UNION ALL SELECT 'champion', model, 1 FROM best
    UNION ALL SELECT 'batch_forecasts', model, {H} * (SELECT count(DISTINCT unique_id) FROM sales) FROM best
    """,
)
def repeated_global_run(spark, sf_dir):
    """A global run on a table of texts, made twice: rows are coerced, stored once and forecast."""
    out = scratch_path(spark, "global-run")
    texts = sales(spark, sf_dir).select("unique_id", F.col("ds").cast("string").alias("ds"), F.col("y").cast("string").alias("y"))
    bad = texts.limit(1).select("unique_id", F.lit("2024-01-01").alias("ds"), F.lit("no number").alias("y"))
    panel = materialize(texts.unionByName(bad))
    for _ in range(2):
        jobs.run_global_champion(spark, panel, LINEAR, "sales", RUN_TS, out, batch=True)
    return pp.union_parts(
        [
            tables.read_table(spark, f"{out}/predictions").groupBy(F.lit("predictions").alias("kind"), "model_type").agg(F.count("*").alias("n")),
            tables.read_table(spark, f"{out}/champion")
            .groupBy(F.lit("champion").alias("kind"), F.col("champion_model_type").alias("model_type"))
            .agg(F.count("*").alias("n")),
            tables.read_table(spark, f"{out}/batch_forecasts")
            .groupBy(F.lit("batch_forecasts").alias("kind"), "model_type")
            .agg(F.count("*").alias("n")),
        ]
    )


@query(
    "hourly_series_job",
    """
    WITH hours AS (SELECT event_type AS unique_id, date_trunc('hour', ts) AS ds, sum(value) AS y FROM events GROUP BY 1, 2),
    newest AS (SELECT unique_id, max(ds) AS last_ds, arg_max(y, ds) AS y FROM hours GROUP BY unique_id)
    SELECT unique_id, CAST(last_ds + to_hours(CAST(k AS INTEGER)) AS TIMESTAMP) AS ds, round(y, 4) AS "Forecast"
    FROM newest CROSS JOIN (SELECT unnest(range(1, 7)) AS k)
    """,
)
def hourly_series_job(spark, sf_dir):
    """The per-series job on hours keeps them as hours."""
    config = jobs.SeriesConfig(
        freq="H", season_length=24, horizon=6, validation_horizon=6, stats_models=("Naive",), ml_models=(), fallback_unscored=True
    )
    rows = event_raw(spark, sf_dir, by_user=False)
    out = jobs.run_series_champion(spark, rows, "unique_id", "ds", "y", config)
    return out.forecasts.select("unique_id", "ds", F.round("Forecast", 4).alias("Forecast"))


# -- raw rows with repeated dates ----------------------------------------------------------------

_LINES = "lines AS (SELECT l_returnflag AS unique_id, CAST(l_shipdate AS DATE) AS ds, l_orderkey, l_quantity AS y FROM lineitem)"


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("unique_id"), F.to_date("l_shipdate").alias("ds"), "l_orderkey", "l_linenumber", F.col("l_quantity").alias("y")
    )


@query(
    "holdout_split_ties",
    f"""
    WITH {_LINES}, ranked AS (SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY ds DESC) AS rn FROM lines)
    SELECT unique_id, count(*) AS valid_rows, min(ds) AS first_valid FROM ranked WHERE rn <= 250 GROUP BY unique_id
    """,
)
def holdout_split_ties(spark, sf_dir):
    """Many rows share a date: the hold-out still has the asked number of rows."""
    valid = pp.valid_part(pp.holdout_split(_lines(spark, sf_dir), 250, bounded=False))
    return valid.groupBy("unique_id").agg(F.count("*").alias("valid_rows"), F.min("ds").alias("first_valid"))


@query(
    "recent_rows_ties",
    """
    SELECT unique_id, ds, l_orderkey, l_linenumber, y
    FROM (SELECT l_returnflag AS unique_id, CAST(l_shipdate AS DATE) AS ds, l_orderkey, l_linenumber, l_quantity AS y FROM lineitem)
    ORDER BY ds DESC, unique_id, l_orderkey, l_linenumber, y LIMIT 777
    """,
)
def recent_rows_ties(spark, sf_dir):
    return src.recent_rows(_lines(spark, sf_dir), 777)


@query(
    "sort_metrics",
    f"""
    WITH {SCORED}
    SELECT unique_id, model, round(sqrt(avg((y - prediction) ** 2)), 2) AS rmse FROM joined GROUP BY ALL
    ORDER BY unique_id, sqrt(avg((y - prediction) ** 2)), model LIMIT 100
    """,
)
def sort_metrics(spark, sf_dir):
    """The first hundred lines of the metric report."""
    result = jobs.global_champion(sales(spark, sf_dir), LINEAR, "sales", RUN_TS)
    metrics = ev.series_rmse(result.predictions.withColumnRenamed("model_type", "model"))
    return ev.sort_metrics(metrics).limit(100).withColumn("rmse", F.round("rmse", 2))
