"""Joining predictions with actuals and scoring them.

Predictions are kept long: ``unique_id, ds, model, prediction``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions import metrics as m
from panelcast.functions.arrays import mean, total
from panelcast.functions.text import metric_column

PAIR = ["unique_id", "ds"]


# -- joins ----------------------------------------------------------------------------------


def join_actual_pred(valid: DataFrame, preds: DataFrame) -> DataFrame:
    """Rows both sides have; predicted dates a gappy series never reached drop out."""
    return valid.select(*PAIR, "y").join(preds, PAIR)


def join_pred_actual_left(preds: DataFrame, valid: DataFrame) -> DataFrame:
    """All predictions, with the actual value where it is known."""
    return preds.join(valid.select(*PAIR, "y"), PAIR, "left")


def align_outer(valid: DataFrame, preds: DataFrame) -> DataFrame:
    """Union of the dates of both sides; a one-sided date has a NULL on the other side."""
    return valid.select(*PAIR, "y").join(preds.select(*PAIR, "prediction"), PAIR, "full")


# -- shape ----------------------------------------------------------------------------------


def melt_models(wide: DataFrame, models: list[str], ids: list[str] | None = None) -> DataFrame:
    return wide.unpivot(ids or PAIR, models, "model", "prediction")


def metrics_wide(metrics: DataFrame, models: list[str], champions: DataFrame | None = None) -> DataFrame:
    """One row per scored series with one error column per model.

    The model list is explicit, so no extra job has to look for the pivot values.
    """
    wide = (
        metrics.where(F.col("rmse").isNotNull())
        .groupBy("unique_id")
        .pivot("model", models)
        .agg(F.first("rmse", ignorenulls=True))
    )
    wide = wide.select("unique_id", *[F.col(f"`{name}`").alias(metric_column(name)) for name in models])
    return wide if champions is None else join_metrics_champion(wide, champions)


def join_metrics_champion(wide: DataFrame, champions: DataFrame) -> DataFrame:
    best = champions.select(
        "unique_id",
        F.col("best_model_name").alias("Best_model_name"),
        F.col("rmse").alias("Best_model_RMSE"),
    )
    return wide.join(best, "unique_id", "left")


def sort_metrics(metrics: DataFrame, keys: tuple[str, ...] = ("unique_id", "rmse", "model")) -> DataFrame:
    """Metric rows in report order; a missing metric comes after every number."""
    return metrics.orderBy(*[F.col(k).asc_nulls_last() for k in keys])


# -- scores ---------------------------------------------------------------------------------


def global_metrics(joined: DataFrame, wmape: str = "fraction") -> DataFrame:
    """RMSE, MAE and WMAPE per model over all series in one aggregation."""
    y, p = F.col("y"), F.col("prediction")
    share = {"fraction": m.wmape, "percent": m.wmape_percent}[wmape]
    return joined.groupBy("model").agg(
        m.rmse(y, p).alias("rmse"),
        m.mae(y, p).alias("mae"),
        share(y, p).alias("wmape"),
        F.count("*").alias("n_rows"),
    )


def percent_wmape(aligned: DataFrame) -> DataFrame:
    y, p = F.col("y"), F.col("prediction")
    return aligned.agg(
        m.rmse(y, p).alias("rmse"), m.mae(y, p).alias("mae"), m.wmape_percent(y, p).alias("wmape")
    )


def _points(joined: DataFrame) -> DataFrame:
    """The scored points of each series and model in date order.

    Sums of doubles depend on the order of their terms in the last digits, which breaks ties between models and decides
    how a value is rounded. Adding by date gives what the SQL gives on one thread, in every run. A group is no longer
    than the hold-out.
    """
    order = [c for c in ("ds",) if c in joined.columns]
    point = F.struct(*order, F.col("y").cast("double").alias("y"), F.col("prediction").cast("double").alias("prediction"))
    return joined.groupBy("unique_id", "model").agg(F.array_sort(F.collect_list(point)).alias("points"))


def _known(values) -> Column:
    return F.filter(values, lambda v: v.isNotNull())


def _series_scores(floor: float) -> dict[str, Column]:
    errors = _known(F.transform("points", lambda p: p["y"] - p["prediction"]))
    sizes = F.transform(errors, F.abs)
    actual = _known(F.transform("points", lambda p: F.abs(p["y"])))
    return {
        "mae": mean(sizes),
        "rmse": F.sqrt(mean(F.transform(errors, lambda e: F.pow(e, F.lit(2.0))))),
        "wmape": F.when(F.size(errors) > 0, total(sizes)) / F.greatest(F.when(F.size(actual) > 0, total(actual)), F.lit(floor)),
        "n_validation_rows": F.size("points").cast("bigint"),
    }


def series_metrics(joined: DataFrame, floor: float = 1e-9) -> DataFrame:
    scores = _series_scores(floor)
    return _points(joined).select("unique_id", "model", *[value.alias(name) for name, value in scores.items()])


def series_rmse(joined: DataFrame) -> DataFrame:
    return _points(joined).select("unique_id", "model", _series_scores(1e-9)["rmse"].alias("rmse"))


def evaluate(valid: DataFrame, preds: DataFrame) -> DataFrame:
    """Per-series RMSE of every model on the dates present on both sides."""
    return series_rmse(join_actual_pred(valid, preds))


def multi_model_metrics(wide: DataFrame, models: list[str]) -> DataFrame:
    """Score the model columns of one wide frame; ``model_ordinal`` keeps the list order for ties."""
    scores = global_metrics(melt_models(wide, models, [*PAIR, "y"]))
    return scores.withColumn("model_ordinal", F.array_position(F.array(*[F.lit(k) for k in models]), F.col("model")))


def run_summary(panel: DataFrame, flags: DataFrame, **counted: DataFrame) -> DataFrame:
    """Counts of a run as one row; each count is its own small aggregate."""
    out = flags.agg(
        F.count("*").alias("series_count"),
        F.count_if("is_eligible").alias("eligible_ids_for_full_audit"),
        F.count_if(~F.col("is_eligible")).alias("fallback_ids"),
    )
    parts = {"panel_rows": panel, **{f"{name}_rows": df for name, df in counted.items()}}
    for name, df in parts.items():
        out = out.withColumn(name, _count(df))
    return out


def _count(df: DataFrame):
    return df.agg(F.count("*")).scalar()
