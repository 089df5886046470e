"""Forecasts after the champion is known."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.arrays import tail
from panelcast.functions.calendar import future_dates, next_period
from panelcast.functions.text import normalize_model_name
from panelcast.models.registry import FALLBACK_LABEL, forecast_path, get_model, linear_penalty, split_families
from panelcast.operators.features import FeatureSpec
from panelcast.operators.prepare import assert_one_row_per_period, tag_run_columns, union_parts
from panelcast.operators.series import forecast_rows, panel_rows, series_rows
from panelcast.plans.audit import grouped_forecast, native_forecast
from panelcast.plans.recursive import linear_path, predict_paths, predict_recursive
from panelcast.plans.training import fit_global, training_rows_of
from panelcast.sources.panel import recent_rows, scoring_window
from panelcast.sources.tables import load_champion_model

BATCH_COLUMNS = [
    "unique_id", "ds", "prediction", "run_ts", "model_type",
    "source_table", "forecast_freq", "horizon", "is_future",
]


def champion_paths(
    chosen: DataFrame, models: list[str], h: int, freq: str, season: int, keep: list[str] | None = None
) -> DataFrame:
    """Forecast each series with its own per-series champion on its full history.

    ``chosen`` is the series layout with ``best_model_name``. The CASE evaluates
    only the branch of the chosen model.
    """
    names = list(dict.fromkeys([*split_families(models)["native"], FALLBACK_LABEL]))
    label = normalize_model_name(F.col("best_model_name"))
    path = None
    for name in names:
        match = (F.col("best_model_name") == name) | (label == normalize_model_name(F.lit(name)))
        value = forecast_path(name, F.col("values"), h, season)
        path = F.when(match, value) if path is None else path.when(match, value)
    ahead = future_dates(F.element_at("dates", -1), h, freq)
    return chosen.select(
        "unique_id",
        *(keep or []),
        F.col("best_model_name").alias("Best_model_name"),
        F.explode_outer(F.arrays_zip(ahead.alias("ds"), path.alias("Forecast"))).alias("p"),
    ).select(
        "unique_id", *(keep or []), F.col("p.ds").alias("ds"), F.col("p.Forecast").alias("Forecast"), "Best_model_name"
    )


def refit_and_forecast(
    chosen: DataFrame,
    models: list[str],
    h: int,
    freq: str,
    season: int,
    spec: FeatureSpec | None = None,
    profile: str = "library",
    keep: list[str] | None = None,
) -> DataFrame:
    """Refit each series' champion on all its data and forecast ``h`` steps.

    Linear champions are refitted on the series alone, in closed form. Other global
    champions, and linear ones on histories that do not identify them, are refitted
    once on the history of all series and score the series that chose them. Only
    models some series chose are fitted.
    """
    # At most one name per model comes back; models no series chose are neither fitted nor planned.
    wanted = {r[0] for r in chosen.select("best_model_name").distinct().collect()}
    families = split_families([m for m in models if m in wanted], profile)
    pooled = [*families["global"], *families["grouped"]]
    is_pooled = F.col("best_model_name").isin(pooled) if pooled else F.lit(False)
    parts = [champion_paths(chosen.where(~is_pooled), families["native"], h, freq, season, keep)]
    if families["global"]:
        fitted = fit_global(training_rows_of(chosen, spec), families["global"], spec, profile)
        state = chosen.withColumn("last_ds", F.element_at("dates", -1))
        for name, model in fitted.items():
            mine, alpha = state.where(F.col("best_model_name") == name), linear_penalty(name, profile)
            if alpha is None:  # each written step repeats the columns
                mine = mine.select("unique_id", *(keep or []), "last_ds", tail(F.col("values"), spec.history).alias("values"))
            mine = predict_paths(mine, {"__pooled": model}, h, freq, spec)
            path = F.col("__pooled")
            if alpha is not None:
                ahead = future_dates(F.col("last_ds"), h, freq)
                path = F.coalesce(linear_path(spec, F.col("dates"), F.col("values"), ahead, h, alpha), path)
            out = forecast_rows(mine.withColumn("__path", path), {name: F.col("__path")}, h, freq, F.col("last_ds"), keep=keep)
            parts.append(_as_forecast(out, keep))
    for name in families["grouped"]:
        mine = panel_rows(chosen.where(F.col("best_model_name") == name))
        out = grouped_forecast(mine, name, h, freq, season).where("error IS NULL")
        parts.append(_as_forecast(out.join(chosen.select("unique_id", *(keep or [])), "unique_id"), keep))
    return union_parts(parts)


def _as_forecast(preds: DataFrame, keep: list[str] | None) -> DataFrame:
    return preds.select(
        "unique_id",
        *(keep or []),
        "ds",
        F.col("prediction").alias("Forecast"),
        F.col("model").alias("Best_model_name"),
    )


def drift_stub_forecast(
    df: DataFrame,
    h: int,
    freq: str = "D",
    rate: float = 0.01,
    compat: bool = False,
    run_date: dt.date | None = None,
    recent: int = 1000,
) -> DataFrame:
    """Last value grown by ``rate`` per step.

    ``compat`` keeps the older rule: only the newest ``recent`` rows of the table
    count, the base is the oldest of them per series, and dates are days from
    ``run_date`` whatever the frequency.
    """
    if compat:
        if run_date is None:
            raise ValueError("the compatible form needs run_date")
        base = recent_rows(df, recent).groupBy("unique_id").agg(F.min_by("y", "ds").alias("last_y"))
        ds = F.date_add(F.lit(run_date), F.col("step"))
    else:
        base = df.groupBy("unique_id").agg(F.max_by("y", "ds").alias("last_y"), F.max("ds").alias("last_ds"))
        ds = next_period(F.col("last_ds"), F.col("step"), freq)
    return base.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(h)))).select(
        "unique_id",
        ds.alias("ds"),
        (F.col("last_y") * (F.lit(1.0) + F.lit(rate) * F.col("step"))).alias("prediction"),
        F.lit(True).alias("is_future"),
    )


def batch_forecast(
    panel: DataFrame,
    model_type: str,
    h: int,
    freq: str,
    spec: FeatureSpec,
    run_ts: dt.datetime,
    source_table: str,
    season: int = 1,
    model=None,
    model_uri: str | None = None,
) -> DataFrame:
    """Forecast with a stored champion on the newest rows of every series.

    A global model reads only the rows its features need. A per-series model has
    no stored state: it is fitted again on the whole history.
    """
    if get_model(model_type).family == "native":
        preds = native_forecast(series_rows(assert_one_row_per_period(panel)), [model_type], h, freq, season)
    else:
        model = model or load_champion_model(model_uri)
        window = series_rows(scoring_window(panel.select("unique_id", "ds", "y"), list(range(1, spec.history + 1)), h))
        state = window.withColumn("last_ds", F.element_at("dates", -1))
        preds = predict_recursive(state, {model_type: model}, h, freq, spec)
    tagged = tag_run_columns(
        preds.drop("model"), run_ts, model_type, source_table, freq, h, is_future=True
    )
    return tagged.select(*BATCH_COLUMNS)
