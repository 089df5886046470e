"""Choosing the best model for the whole panel or for each series.

NaN metrics are treated as missing and sort last. The tie rules differ and are
kept apart: list order for the panel and the three-metric rule, model name for
the RMSE rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.models.registry import FALLBACK_LABEL
from panelcast.operators.prepare import union_parts

ERROR_WMAPE = 999999.0


def model_ordinal(model: Column, models: list[str]) -> Column:
    """Position of a model in the requested list, from 1."""
    return F.array_position(F.array(*[F.lit(name) for name in models]), model)


def clean_metric(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def valid_results(results: DataFrame, metric: str) -> DataFrame:
    return results.where(clean_metric(F.col(metric)).isNotNull())


def select_global_champion(results: DataFrame, metric: str = "wmape") -> DataFrame:
    """The row with the smallest metric; ties go to the smaller ``model_ordinal``."""
    return (
        results.withColumn("__metric", clean_metric(F.col(metric)))
        .orderBy(F.col("__metric").asc_nulls_last(), F.col("model_ordinal"))
        .limit(1)
        .drop("__metric")
    )


def _ranked(keys: list[str], df: DataFrame) -> Column:
    """Comparable struct of the sort keys; a missing metric ranks after every number."""
    parts = []
    for name in keys:
        value = F.col(name)
        if dict(df.dtypes)[name] == "double":
            value = clean_metric(value)
            parts.append(value.isNull().alias(f"{name}_missing"))
        parts.append(value.alias(name))
    return F.struct(*parts)


def select_series_champion(metrics: DataFrame, order: tuple[str, ...] = ("rmse", "model")) -> DataFrame:
    """Best row of each series. ``min_by`` combines on the map side: no sort and no window."""
    rest = [c for c in metrics.columns if c != "unique_id"]
    best = F.min_by(F.struct(*rest), _ranked(list(order), metrics)).alias("best")
    return metrics.groupBy("unique_id").agg(best).select("unique_id", *[F.col(f"best.{c}").alias(c) for c in rest])


def series_champion_rmse(metrics: DataFrame) -> DataFrame:
    """``unique_id, best_model_name, rmse``; a series without any score keeps the first model name."""
    best = select_series_champion(metrics.select("unique_id", "model", "rmse"))
    return best.select(
        "unique_id", F.col("model").alias("best_model_name"), clean_metric(F.col("rmse")).alias("rmse")
    )


def series_champion_multi(metrics: DataFrame, models: list[str]) -> DataFrame:
    """Best by RMSE, then MAE, then WMAPE, then list order."""
    ordered = metrics.withColumn("model_ordinal", model_ordinal(F.col("model"), models))
    best = select_series_champion(ordered, ("rmse", "mae", "wmape", "model_ordinal"))
    return best.withColumnRenamed("model", "champion_model").drop("model_ordinal")


def add_naive_fallback(champions: DataFrame, fallback_ids: DataFrame) -> DataFrame:
    """Append the series whose history is too short for the audit."""
    short = fallback_ids.select(
        "unique_id",
        F.lit(FALLBACK_LABEL).alias("best_model_name"),
        F.lit(None).cast("double").alias("rmse"),
    )
    return union_parts([champions, short])


def lookup_champion(df: DataFrame, champions: DataFrame) -> DataFrame:
    """Attach each series' champion; series without one are left out."""
    return df.join(champions.select("unique_id", "best_model_name"), "unique_id")


def failed_model_sentinel(results: DataFrame) -> DataFrame:
    """A failed fit keeps its place in a WMAPE ranking, behind every real result."""
    failed = F.col("error").isNotNull()
    nothing = F.lit(None).cast("double")
    return results.withColumns(
        {
            "wmape": F.when(failed, F.lit(ERROR_WMAPE)).otherwise(F.col("wmape")),
            "rmse": F.when(failed, nothing).otherwise(F.col("rmse")),
            "mae": F.when(failed, nothing).otherwise(F.col("mae")),
        }
    )


def collect_training_results(parts: list[DataFrame], json_schema: str | None = None) -> DataFrame:
    """Results of separate training runs as one table; JSON text is parsed with ``json_schema``."""
    if json_schema is not None:
        parts = [p.select(F.from_json("value", json_schema).alias("r")).select("r.*") for p in parts]
    return union_parts(parts)


def flatten_batches(df: DataFrame, column: str) -> DataFrame:
    """Rows out of an array-of-structs column."""
    return df.select(F.explode(column).alias("row")).select("row.*")
