"""Forecasts of the per-series models."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.models.registry import forecast_path, get_model, split_families
from panelcast.operators.prepare import assert_one_row_per_period, union_parts
from panelcast.operators.series import forecast_rows, series_rows


def native_forecast(
    series: DataFrame,
    models: list[str],
    h: int,
    freq: str,
    season: int,
    values: str = "values",
    last_ds: str | None = None,
    actual: tuple[str, str] | None = None,
) -> DataFrame:
    """``unique_id, ds, model, prediction`` for array models: a projection and one explode."""
    paths = {name: forecast_path(name, F.col(values), h, season) for name in models}
    last = F.element_at("dates", -1) if last_ds is None else F.col(last_ds)
    return forecast_rows(series, paths, h, freq, last, actual)


def variance_forecast(series: DataFrame, models: list[str], h: int, freq: str, values: str = "values") -> DataFrame:
    """``unique_id, ds, model, variance`` of the volatility models."""
    paths = {}
    for name in models:
        model = get_model(name)
        if model.variance is None:
            raise ValueError(f"{name} has no variance forecast")
        paths[name] = model.variance(F.col(values), h)
    out = forecast_rows(series, paths, h, freq, F.element_at("dates", -1))
    return out.withColumnRenamed("prediction", "variance")


def grouped_forecast(panel: DataFrame, model: str, h: int, freq: str, season: int) -> DataFrame:
    """User model on one series' pandas frame; a failure becomes a row with its message.

    The panel has one row per series and period, which bounds the frame by the calendar.
    """
    fn: Callable = get_model(model).build
    ds_type = panel.schema["ds"].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        uid = pdf["unique_id"].iloc[0]
        try:
            out = fn(pdf.sort_values("ds").reset_index(drop=True), h, freq, season)
            out = out.assign(unique_id=uid, model=model, error=None)
            out["ds"] = pd.to_datetime(out["ds"]).dt.date if ds_type == "date" else pd.to_datetime(out["ds"])
            return out[["unique_id", "ds", "model", "prediction", "error"]]
        except Exception as failure:  # one series must not fail the job
            return pd.DataFrame(
                [{"unique_id": uid, "ds": None, "model": model, "prediction": None, "error": repr(failure)}]
            )

    return (
        panel.select("unique_id", "ds", "y")
        .groupBy("unique_id")
        .applyInPandas(run, f"unique_id string, ds {ds_type}, model string, prediction double, error string")
    )


def stats_forecast(
    panel: DataFrame, models: list[str], h: int, freq: str, season: int, bounded: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Predictions of all per-series models and the (series, model) pairs that gave none.

    One row per series and period is enforced while grouping; ``bounded`` says that the panel comes from an
    aggregation that already made it so.
    """
    if not bounded:
        panel = assert_one_row_per_period(panel)
    groups = split_families(models)
    if groups["global"]:
        raise ValueError(f"not per-series models: {groups['global']}")
    preds, errors = [], []
    if groups["native"]:
        native = native_forecast(series_rows(panel), groups["native"], h, freq, season)
        preds.append(native)
        errors.append(
            native.groupBy("unique_id", "model")
            .agg(F.count("prediction").alias("n"))
            .where("n = 0")
            .select("unique_id", "model", F.lit("no forecast for this history").alias("error"))
        )
    for name in groups["grouped"]:
        out = grouped_forecast(panel, name, h, freq, season)
        preds.append(out.where("error IS NULL").drop("error"))
        errors.append(out.where("error IS NOT NULL").select("unique_id", "model", "error"))
    return union_parts(preds), union_parts(errors)
