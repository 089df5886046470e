"""Fitting global models and forecasting with them."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.models.registry import get_model
from panelcast.operators.features import FeatureSpec, build_features, series_features
from panelcast.operators.prepare import union_parts
from panelcast.plans.recursive import predict_recursive
from panelcast.staging import materialize_by


def training_rows(panel: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Complete feature rows; the first rows of a series lack lags and are left out."""
    keep = [c for c in ("shard",) if c in panel.columns]
    return build_features(panel, spec, drop_incomplete=True).select("unique_id", *keep, "y", *spec.columns)


def training_rows_of(
    series: DataFrame, spec: FeatureSpec, dates: str = "dates", values: str = "values"
) -> DataFrame:
    """The same rows from the series layout, without a shuffle."""
    return series_features(series, spec, dates, values).select("unique_id", "y", *spec.columns)


def _fit_all(tasks: dict, parallelism: int) -> dict:
    """Fit several pipelines at once: boosting is a chain of short jobs that alone leave cores idle."""

    def run(task):
        name, profile, spec, rows = task
        return get_model(name, profile).build(spec.columns, rows).fit(rows)

    if not tasks:
        return {}
    session = next(iter(tasks.values()))[3].sparkSession
    threaded = inheritable_thread_target(session)(run)
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(tasks)))) as pool:
        fits = {key: pool.submit(threaded, task) for key, task in tasks.items()}
        return {key: fit.result() for key, fit in fits.items()}


def fit_global(
    rows: DataFrame, models: list[str], spec: FeatureSpec, profile: str = "library", parallelism: int = 4
) -> dict[str, PipelineModel]:
    """Fit each model on the feature rows of all series; rows are kept once for all models."""
    rows = rows.persist()
    try:
        return _fit_all({name: (name, profile, spec, rows) for name in models}, parallelism)
    finally:
        rows.unpersist()


def fit_sharded(
    rows: DataFrame,
    shards: DataFrame,
    models: list[str],
    spec: FeatureSpec,
    profile: str = "library",
    parallelism: int = 4,
) -> dict[int, dict[str, PipelineModel]]:
    """One model set per shard of series. The number of shards is small and chosen by the caller.

    The rows are written by shard, so that a fit reads its own shard only.
    """
    marked = materialize_by(rows.join(shards.select("unique_id", "shard"), "unique_id"), "shard")
    numbers = [r["shard"] for r in marked.select("shard").distinct().orderBy("shard").collect()]
    tasks = {(i, name): (name, profile, spec, marked.where(F.col("shard") == i)) for i in numbers for name in models}
    fits = _fit_all(tasks, parallelism)
    return {i: {name: fits[i, name] for name in models} for i in numbers}


def predict_sharded(
    series: DataFrame,
    shards: DataFrame,
    fitted: dict[int, dict[str, PipelineModel]],
    h: int,
    freq: str,
    spec: FeatureSpec,
    **columns: str,
) -> DataFrame:
    marked = materialize_by(series.join(shards.select("unique_id", "shard"), "unique_id"), "shard")
    return union_parts(
        [
            predict_recursive(marked.where(F.col("shard") == i), models, h, freq, spec, **columns)
            for i, models in fitted.items()
        ]
    )
