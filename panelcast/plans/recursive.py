"""Multi-step forecasts of global models.

State is one row per series holding the trailing values the features need. A
step computes the features from that array, applies the model and appends its
prediction: h steps are h projections, without a shuffle.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.arrays import least_squares, let, mean, tail
from panelcast.functions.calendar import date_feature, next_period
from panelcast.operators.features import FeatureSpec, feature_at, rolling_name
from panelcast.operators.series import forecast_rows
from panelcast.staging import materialize

_STEPS_PER_PLAN = 16


def _step_features(spec: FeatureSpec, hist: Column, ds: Column) -> dict[str, Column]:
    size = F.size(hist)
    columns: dict[str, Column] = {f"lag{k}": F.get(hist, size - k) for k in spec.lags}
    for lag, sizes in spec.rolling.items():
        for w in sizes:
            window = F.slice(hist, F.greatest(size - lag - w + 2, F.lit(1)), w)
            columns[rolling_name(lag, w)] = F.when(size >= lag + w - 1, mean(window))
    columns.update({name: date_feature(name, ds) for name in spec.date_features})
    return columns


def linear_path(
    spec: FeatureSpec, dates: Column, values: Column, ahead: Column, h: int, alpha: float = 0.0
) -> Column:
    """``h`` steps of a linear model fitted on one series alone; NULL where its history does not identify the model."""
    n = F.size(values)
    index = F.when(n > spec.warm_up, F.sequence(F.lit(spec.warm_up), F.greatest(n - 1, F.lit(spec.warm_up))))
    names = spec.columns

    def column(name: str) -> Column:
        return F.transform(index, lambda i: feature_at(spec, values, dates, i)[name].cast("double"))

    target = F.transform(index, lambda i: F.get(values, i))
    coef = least_squares([column(name) for name in names], target, alpha)

    def run(b: Column) -> Column:
        def step(hist: Column, ds: Column) -> Column:
            features = _step_features(spec, hist, ds)
            value = F.get(b, F.lit(0))
            for k, name in enumerate(names, 1):
                value = value + F.get(b, F.lit(k)) * features[name]
            return F.concat(hist, F.array(value))

        return tail(F.aggregate(ahead, tail(values, spec.history), step), h)

    return F.when(n > spec.warm_up + len(names), let(coef, lambda b: F.when(~F.exists(b, lambda v: v.isNull()), run(b))))


def predict_paths(
    series: DataFrame,
    models: dict[str, PipelineModel],
    h: int,
    freq: str,
    spec: FeatureSpec,
    values: str = "values",
    last_ds: str = "last_ds",
) -> DataFrame:
    """Add one ``array<double>`` column of ``h`` predictions per model name.

    A series with too little history for the features gets NULL predictions, but from models that take missing features
    it gets values, as soon as it has any history.
    """
    complete = F.lit(True)
    for c in spec.columns:
        complete = complete & F.col(c).isNotNull()
    out, kept = series, list(series.columns)
    for name, model in models.items():
        state = f"__hist_{name}"
        takes = getattr(model.stages[-1], "accepts_missing", False)
        known = F.size(F.col(state)) > 0 if takes else complete
        value = F.when(known & ~F.isnan("prediction"), F.col("prediction"))
        out = out.withColumn(state, tail(F.col(values), spec.history))
        for k in range(1, h + 1):
            ds = next_period(F.col(last_ds), k, freq)
            scored = model.transform(out.withColumns(_step_features(spec, F.col(state), ds)))
            out = scored.select(*kept, F.concat(F.col(state), F.array(value)).alias(state))
            if k % (1 if getattr(model.stages[-1], "runs_in_workers", False) else _STEPS_PER_PLAN) == 0 and k < h:
                out = materialize(out)
        kept.append(name)
        out = out.withColumn(name, tail(F.col(state), h)).drop(state)
    return out


def predict_recursive(
    series: DataFrame,
    models: dict[str, PipelineModel],
    h: int,
    freq: str,
    spec: FeatureSpec,
    values: str = "values",
    last_ds: str = "last_ds",
    actual: tuple[str, str] | None = None,
) -> DataFrame:
    """``unique_id, ds, model, prediction`` for every model."""
    names = {name: f"__path_{i}" for i, name in enumerate(models)}
    # each written step repeats these columns: only what the features and the result need
    kept = dict.fromkeys(["unique_id", last_ds, *(actual or ())])
    state = series.select(*kept, tail(F.col(values), spec.history).alias("__values"))
    wide = predict_paths(
        state, {names[k]: v for k, v in models.items()}, h, freq, spec, values="__values", last_ds=last_ds
    )
    return forecast_rows(wide, {k: F.col(c) for k, c in names.items()}, h, freq, F.col(last_ds), actual)
