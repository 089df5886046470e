"""Queries that run whole jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from panelcast.catalogue.evaluation import _CHAMPIONS, MODELS
from panelcast.catalogue.panels import (
    SALES,
    demand,
    demand_raw,
    demand_source,
    event_days,
    sales,
    sales_source,
)
from panelcast.catalogue.registry import query
from panelcast.operators.features import FeatureSpec
from panelcast.operators.prepare import aggregate_period
from panelcast.operators.series import hold_out, series_rows
from panelcast.plans import jobs
from panelcast.plans.forecast import batch_forecast, champion_paths
from panelcast.sources import tables
from panelcast.staging import materialize, scratch_path

RUN_TS = dt.datetime(2024, 2, 1)
NATIVE = jobs.SeriesConfig(stats_models=tuple(MODELS), ml_models=())


def flagship(spark, sf_dir):
    """Raw order lines to champion forecasts, one lazy plan with two shuffles after the fixture join."""
    panel = demand_raw(spark, sf_dir)
    series = hold_out(series_rows(aggregate_period(panel, "MS", ["sys_id"]), ["sys_id"]), NATIVE.validation_horizon)
    audited = jobs.audit_series(series, NATIVE)
    out = champion_paths(audited, MODELS, NATIVE.horizon, "MS", NATIVE.season_length, ["sys_id"])
    return out.where(F.col("Forecast").isNotNull()).withColumn("Forecast", F.round("Forecast", 4))


@query(
    "series_champion_job",
    f"""
    WITH {_CHAMPIONS}, chosen AS (
      SELECT unique_id, best_model_name FROM champions UNION ALL SELECT unique_id, 'Naive_Fallback' FROM short
    ),
    full_numbered AS (
      SELECT unique_id, ds, y, row_number() OVER (PARTITION BY unique_id ORDER BY ds) AS t FROM demand
    ),
    ends AS (
      SELECT unique_id, max(ds) AS last_ds, arg_max(y, ds) AS last_y, avg(y) AS mean_y, count(*) AS n
      FROM demand GROUP BY unique_id
    ),
    steps AS (SELECT unnest(range(1, 13)) AS k)
    SELECT split_part(c.unique_id, '_', 1) AS sys_id, c.unique_id,
           CAST(last_ds + to_months(CAST(k AS INTEGER)) AS DATE) AS ds,
           round(CASE best_model_name WHEN 'SeasonalNaive' THEN f.y WHEN 'ARCH(1)' THEN mean_y ELSE last_y END, 4)
             AS "Forecast",
           best_model_name AS "Best_model_name"
    FROM chosen c JOIN ends e ON e.unique_id = c.unique_id CROSS JOIN steps
    JOIN full_numbered f ON f.unique_id = c.unique_id AND f.t = greatest(n - 12 + (k - 1) % 12 + 1, 1)
    """,
)
def series_champion_job(spark, sf_dir):
    return flagship(spark, sf_dir)


@query(
    "series_champion_metrics",
    f"""
    WITH {_CHAMPIONS}
    SELECT s.unique_id, round(max(CASE WHEN model = 'SeasonalNaive' THEN s.rmse END), 4) AS "SeasonalNaive_RMSE",
           round(max(CASE WHEN model = 'Naive' THEN s.rmse END), 4) AS "Naive_RMSE",
           round(max(CASE WHEN model = 'ARCH(1)' THEN s.rmse END), 4) AS "ARCH_1__RMSE",
           max(best_model_name) AS "Best_model_name", round(max(c.rmse), 4) AS "Best_model_RMSE"
    FROM scores s JOIN champions c ON c.unique_id = s.unique_id WHERE s.rmse IS NOT NULL GROUP BY s.unique_id
    """,
)
def series_champion_metrics(spark, sf_dir):
    """The wide metric table of the job, read off the score arrays without a pivot."""
    audited = jobs.audit_series(series_rows(demand(spark, sf_dir)), NATIVE)
    out = jobs.metric_table(materialize(audited), MODELS)
    return out.withColumns({c: F.round(c, 4) for c in out.columns if c.endswith("RMSE")})


@query("series_champion_full_job")
def series_champion_full_job(spark, sf_dir):
    """All ten per-series models and both boosters, with the profile of the audit."""
    out = jobs.series_champion(demand_raw(spark, sf_dir), jobs.SeriesConfig()).forecasts
    return out.withColumn("Forecast", F.round("Forecast", 3))


@query("series_champion_tenant_job")
def series_champion_tenant_job(spark, sf_dir):
    """All per-series models on one tenant of a user-mapped table."""
    config = jobs.SeriesConfig(ml_models=())
    out = jobs.run_series_champion(
        spark, sales_source(spark, sf_dir), "product_id", "date", "sales", config, sys_id_value="BUILDING"
    )
    return out.forecasts.withColumn("Forecast", F.round("Forecast", 2))


@query("global_champion_job")
def global_champion_job(spark, sf_dir):
    config = jobs.GlobalConfig(freq="MS", horizon=3, models=("lgbm", "xgb", "rf", "et", "ridge"))
    result = jobs.global_champion(sales(spark, sf_dir), config, "sales", RUN_TS)
    return result.results.select(
        "model_type", F.round("rmse", 1).alias("rmse"), F.round("mae", 1).alias("mae"), F.round("wmape", 5).alias("wmape"), "valid_rows"
    )


@query("global_champion_predictions")
def global_champion_predictions(spark, sf_dir):
    config = jobs.GlobalConfig(freq="D", horizon=2, models=("ridge", "naive"))
    result = jobs.global_champion(event_days(spark, sf_dir), config, "events", RUN_TS)
    return result.predictions.select(
        "unique_id", "ds", F.round("y", 2).alias("y"), F.round("prediction", 3).alias("prediction"), "model_type", "horizon"
    )


@query("training_fanout")
def training_fanout(spark, sf_dir):
    """Each model trained on its own, results collected, the best chosen."""
    config = jobs.GlobalConfig(freq="MS", horizon=3, lags=(1, 2, 3))
    keys = ["ridge", "croston", "theta", "seasonal_naive"]
    panel = materialize(sales(spark, sf_dir))
    results = [jobs.train_one_model(panel, key, config, "sales", RUN_TS)[1] for key in keys]
    best = jobs.select_champion(results, keys)
    return best.select("model_type", F.round("wmape", 6).alias("wmape"), "valid_rows")


@query("series_champion_ml_job")
def series_champion_ml_job(spark, sf_dir):
    out = jobs.run_series_champion_ml(
        spark, demand_monthly_source(spark, sf_dir), "unique_id", "ds", "y", ["lr", "rf"], 6, 6, lags=(1, 2, 3), profile="fast"
    )
    return out["forecasts"].withColumn("forecast", F.round("forecast", 3))


def demand_monthly_source(spark, sf_dir):
    return demand(spark, sf_dir)


@query("monthly_ml_job")
def monthly_ml_job(spark, sf_dir):
    out = jobs.run_monthly_ml(
        spark, demand_source(spark, sf_dir), {"product_id": "unique_id", "date": "ds", "quantity": "y"}
    )
    return out.withColumns({m: F.round(m, 3) for m in ("xgb", "lgbm", "lr")})


@query("multi_model_single_fit_job")
def multi_model_single_fit_job(spark, sf_dir):
    config = jobs.GlobalConfig(freq="MS", horizon=3, models=("lgbm", "rf", "et"))
    wide, _ = jobs.run_multi_model_single_fit(spark, sales(spark, sf_dir), config, RUN_TS, "sales")
    return wide.select(
        "unique_id", "ds", *[F.round(c, 2).alias(c) for c in ("y", "lgbm", "rf", "et")], "best_model", "horizon"
    )


@query("batch_forecast_job")
def batch_forecast_job(spark, sf_dir):
    """The champion of a global run forecasts from the newest rows of every series."""
    config = jobs.GlobalConfig(freq="MS", horizon=3, models=("ridge", "lr"))
    panel = materialize(sales(spark, sf_dir))
    result = jobs.global_champion(panel, config, "sales", RUN_TS)
    out = batch_forecast(panel, result.model_type, 6, "MS", FeatureSpec([1, 2, 3], {}, ["dayofweek", "month"]), RUN_TS, "sales", model=result.model)
    return out.select("unique_id", "ds", F.round("prediction", 2).alias("prediction"), "model_type", "horizon", "is_future")




@query(
    "first_run_model_kept",
    f"""
    WITH {SALES}, ends AS (SELECT unique_id, max(ds) AS last_ds FROM sales GROUP BY unique_id),
    steps AS (SELECT unnest(range(1, 3)) AS k)
    SELECT unique_id, CAST(last_ds + to_months(CAST(k AS INTEGER)) AS DATE) AS ds, true AS same, 2 AS runs
    FROM ends CROSS JOIN steps
    """,
)
def first_run_model_kept(spark, sf_dir):
    """Two runs under one display name: the first champion's row still names a model that scores as it did."""
    out = scratch_path(spark, "two-runs")
    config = jobs.GlobalConfig(freq="MS", horizon=2, models=("lr",), lags=(1, 2, 3))
    panel = materialize(sales(spark, sf_dir))
    jobs.run_global_champion(spark, panel, config, "sales", RUN_TS, out, batch=True, run_id="first")
    changed = panel.withColumn("y", 7 - 3 * F.col("y"))
    jobs.run_global_champion(spark, changed, config, "sales", RUN_TS + dt.timedelta(days=1), out, run_id="second")
    champions = tables.read_table(spark, f"{out}/champion")
    uri = champions.where("run_id = 'first'").first()["champion_model_uri"]
    before = tables.read_table(spark, f"{out}/batch_forecasts").select("unique_id", "ds", F.col("prediction").alias("first"))
    again = batch_forecast(panel, "lr", 2, "MS", config.features, RUN_TS, "sales", model_uri=uri)
    both = again.join(before, ["unique_id", "ds"])
    runs = champions.select("champion_model_uri").distinct().count()
    return both.select(
        "unique_id", "ds", F.col("prediction").eqNullSafe(F.col("first")).alias("same"), F.lit(runs).alias("runs")
    )
