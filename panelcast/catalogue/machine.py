"""Queries of the global models, with their full profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.catalogue.panels import DEMAND, demand, split_sql
from panelcast.catalogue.registry import query
from panelcast.models.trees import HistogramTrees
from panelcast.operators.features import FeatureSpec, default_lag_transforms, series_features
from panelcast.operators.series import hold_out, panel_rows, series_rows
from panelcast.operators.shards import balanced_shards
from panelcast.plans.recursive import predict_recursive
from panelcast.plans.training import fit_global, fit_sharded, predict_sharded, training_rows_of
from panelcast.staging import materialize

H = 6


def split(spark, sf_dir, panel=demand):
    rows = hold_out(series_rows(panel(spark, sf_dir)), H).where(F.col("n") > H)
    return materialize(rows.withColumn("train_dates", F.slice("dates", 1, F.col("n") - H)))


def forecast(spark, sf_dir, models, spec, profile="fast"):
    rows = split(spark, sf_dir)
    fitted = fit_global(training_rows_of(rows, spec, "train_dates", "train"), models, spec, profile)
    out = predict_recursive(rows, fitted, H, "MS", spec, values="train", last_ds="train_end")
    return out.withColumn("prediction", F.round("prediction", 4))


def _one_lag_sql(slope: str) -> str:
    return f"""
    WITH RECURSIVE {DEMAND}, {split_sql("demand", H)},
    pairs AS (SELECT y, lag(y) OVER (PARTITION BY unique_id ORDER BY ds) AS x FROM train),
    m AS (
      SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS vx, covar_pop(y, x) AS cxy
      FROM pairs WHERE x IS NOT NULL
    ),
    fit AS (SELECT {slope} AS b, mx, my FROM m),
    path AS (
      SELECT unique_id, max(ds) AS last_ds, arg_max(y, ds) AS y, 0 AS k FROM train GROUP BY unique_id
      UNION ALL
      SELECT unique_id, last_ds, my + b * (y - mx), k + 1 FROM path CROSS JOIN fit WHERE k < {H}
    )
    SELECT unique_id, CAST(last_ds + to_months(CAST(k AS INTEGER)) AS DATE) AS ds, round(y, 4) AS prediction
    FROM path WHERE k > 0
    """


@query("ols_forecast", _one_lag_sql("cxy / vx"))
def ols_forecast(spark, sf_dir):
    return forecast(spark, sf_dir, ["lr"], FeatureSpec([1])).drop("model")


@query("ridge_forecast", _one_lag_sql("n * cxy / (n * vx + 1.0)"))
def ridge_forecast(spark, sf_dir):
    return forecast(spark, sf_dir, ["ridge"], FeatureSpec([1])).drop("model")


_SPEC = FeatureSpec([1, 2, 3], {1: [3]}, ["month", "quarter"])


#: Profile of each model's query: number of trees, depth, leaves and rates as in the jobs.
_FULL = {"lgbm": "panel", "xgb": "panel", "rf": "panel", "et": "panel", "gb": "parallel", "svr": "parallel"}
#: Forests, whose values are means of targets; models that take missing features.
_BOUNDED, _TAKES_MISSING = ("rf", "et"), ("lgbm", "xgb")


def _full_query(key):
    """A model with its full profile on all demand series: which get a value, and whether forests stay in the training range."""
    has = "a.n >= 1" if key in _TAKES_MISSING else "a.n >= 3"
    sql = f"""
    WITH {DEMAND}, {split_sql("demand", H)}
    SELECT a.unique_id, a.ds, {has} AS has_value, {has if key in _BOUNDED else "NULL"} AS in_range FROM ahead a
    """

    @query(f"{key}_forecast", sql)
    def run(spark, sf_dir):
        rows = split(spark, sf_dir)
        train = training_rows_of(rows, _SPEC, "train_dates", "train")
        fitted = fit_global(train, [key], _SPEC, _FULL[key])
        out = predict_recursive(rows, fitted, H, "MS", _SPEC, values="train", last_ds="train_end")
        low, high = train.agg(F.min("y"), F.max("y")).first() if key in _BOUNDED else (None, None)
        value = F.col("prediction")
        inside = value.isNotNull() & value.between(low or 0.0, high or 0.0) if key in _BOUNDED else F.lit(None).cast("boolean")
        return out.select("unique_id", "ds", (value.isNotNull() & ~F.isnan(value)).alias("has_value"), inside.alias("in_range"))

    return run


for _key in _FULL:
    _full_query(_key)


@query("tree_predictions")
def tree_predictions(spark, sf_dir):
    """What the four kinds of histogram trees, with full profiles, predict for all demand series."""
    rows = split(spark, sf_dir)
    train = materialize(training_rows_of(rows, _SPEC, "train_dates", "train"))
    fitted = {k: m for key in ("lgbm", "xgb", "gb", "et") for k, m in fit_global(train, [key], _SPEC, _FULL[key]).items()}
    out = predict_recursive(rows, fitted, H, "MS", _SPEC, values="train", last_ds="train_end")
    return out.withColumn("prediction", F.round("prediction", 4))


_STUMP = FeatureSpec([1], {}, ["month", "quarter"])


@query(
    "one_split_tree",
    f"""
    WITH {DEMAND}, {split_sql("demand", H)},
    rows AS (
      SELECT unique_id, ds, y, lag(y) OVER (PARTITION BY unique_id ORDER BY ds) AS lag1, month(ds) AS month, quarter(ds) AS quarter
      FROM train
    ),
    known AS (SELECT * FROM rows WHERE lag1 IS NOT NULL),
    long AS (
      SELECT 'lag1' AS f, lag1::DOUBLE AS x, y FROM known UNION ALL SELECT 'month', month, y FROM known UNION ALL SELECT 'quarter', quarter, y FROM known
    ),
    places AS (SELECT f, x, sum(y) AS s, count(*) AS c FROM long GROUP BY f, x),
    running AS (
      SELECT f, (x + lead(x) OVER w) / 2 AS t, sum(s) OVER w AS s, sum(c) OVER w AS c FROM places WINDOW w AS (PARTITION BY f ORDER BY x)
    ),
    total AS (SELECT sum(y) AS s, count(*) AS c FROM known),
    gains AS (
      SELECT f, t, (r.s - r.c * g.s / g.c) * (r.s - r.c * g.s / g.c) * (1.0 / r.c + 1.0 / (g.c - r.c)) AS gain
      FROM running r CROSS JOIN total g WHERE t IS NOT NULL
    ),
    best AS (SELECT arg_max(f, gain) AS f, arg_max(t, gain) AS t FROM gains),
    sides AS (
      SELECT k.unique_id, k.ds, k.y,
        CASE b.f WHEN 'lag1' THEN k.lag1 WHEN 'month' THEN k.month ELSE k.quarter END <= b.t AS side
      FROM known k CROSS JOIN best b
    )
    SELECT unique_id, ds, round(avg(y) OVER (PARTITION BY side), 6) AS prediction FROM sides
    """,
)
def one_split_tree(spark, sf_dir):
    """One tree of one split without shrinkage: the mean of the rows on each side of the best split of all features."""
    rows = split(spark, sf_dir)
    train = materialize(series_features(rows, _STUMP, "train_dates", "train"))
    p = {"trees": 1, "rate": 1.0, "leaves": 2, "leaf": 1, "seed": 0}
    scored = HistogramTrees(p, _STUMP.columns).fit(train).transform(train)
    return scored.select("unique_id", "ds", F.round("prediction", 6).alias("prediction"))


@query("ml_audit")
def ml_audit(spark, sf_dir):
    """The two boosters of the per-series audit, fitted on all series."""
    spec = FeatureSpec([1, 12], default_lag_transforms([1, 12]), ["month", "quarter", "year"])
    return forecast(spark, sf_dir, ["XGBoost", "LightGBM"], spec, "audit")


@query("ml_audit_sharded")
def ml_audit_sharded(spark, sf_dir):
    """A linear model per balanced shard of series."""
    spec = FeatureSpec([1, 2])
    rows = split(spark, sf_dir)
    train = panel_rows(rows, "train_dates", "train")
    shards = materialize(balanced_shards(train, 3))
    fitted = fit_sharded(training_rows_of(rows, spec, "train_dates", "train"), shards, ["lr"], spec)
    out = predict_sharded(rows, shards, fitted, H, "MS", spec, values="train", last_ds="train_end")
    return out.withColumn("prediction", F.round("prediction", 4))
