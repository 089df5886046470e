"""User-level jobs: read, prepare, train, score, choose, forecast, write."""

from __future__ import annotations

import datetime as dt
import logging
import time
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions.arrays import let
from panelcast.functions.calendar import check_freq, future_dates
from panelcast.functions.text import metric_column
from panelcast.models.registry import (
    AUDIT_LABELS,
    FALLBACK_LABEL,
    ML_LABELS,
    forecast_path,
    get_model,
    season_of,
    split_families,
)
from panelcast.operators import champion as ch
from panelcast.operators import evaluate as ev
from panelcast.operators import prepare as pp
from panelcast.operators.features import FeatureSpec, default_lag_transforms
from panelcast.operators.series import hold_out, in_few_parts, panel_rows, rmse_of, series_rows
from panelcast.operators.shards import balanced_shards
from panelcast.plans.audit import grouped_forecast, native_forecast
from panelcast.plans.forecast import batch_forecast, refit_and_forecast
from panelcast.plans.recursive import predict_paths, predict_recursive
from panelcast.plans.training import fit_global, fit_sharded, training_rows_of
from panelcast.sources import panel as src
from panelcast.sources import tables
from panelcast.staging import materialize, materialize_by

LOG = logging.getLogger(__name__)

NAIVE_MODELS = ["Naive", "SeasonalNaive"]


def now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


# -- per-series champion ----------------------------------------------------------------------


@dataclass(frozen=True)
class SeriesConfig:
    """Parameters of the per-series champion job."""

    freq: str = "MS"
    season_length: int = 12
    horizon: int = 12
    validation_horizon: int = 12
    min_history: int = 24
    max_series: int = 0
    ml_lags: tuple[int, ...] = (1, 12)
    ml_shards: int = 0
    stats_models: tuple[str, ...] = tuple(AUDIT_LABELS)
    ml_models: tuple[str, ...] = tuple(ML_LABELS)
    date_features: tuple[str, ...] = ("month", "quarter", "year")
    profile: str = "audit"
    fallback_unscored: bool = False

    def __post_init__(self):
        check_freq(self.freq)

    @property
    def features(self) -> FeatureSpec:
        lags = list(self.ml_lags)
        return FeatureSpec(lags, default_lag_transforms(lags), list(self.date_features))


def score_series(series: DataFrame, config: SeriesConfig, ml_paths: dict[str, str] | None = None) -> DataFrame:
    """Score all models of every series inside its row: adds ``scores``, an array of model and rmse.

    ``ml_paths`` maps a model label to the column with its validation forecast.
    A series without a date that both the hold-out and the calendar forecast
    have gets no scores.
    """
    h = config.validation_horizon
    split = series if "train" in series.columns else hold_out(series, h)

    # Arrow functions may not lie inside of array functions: the paths are bound next to the dates.
    paths = [forecast_path(n, F.col("train"), h, config.season_length) for n in config.stats_models]
    bound = F.struct(
        future_dates(F.col("train_end"), h, config.freq).alias("ahead"), *[p.alias(f"p{i}") for i, p in enumerate(paths)]
    )

    def entries(given):
        def score(name, path):
            error = rmse_of(F.col("valid_dates"), F.col("valid"), given["ahead"], path)
            return F.struct(F.lit(name).alias("model"), error.alias("rmse"))

        native = [score(n, given[f"p{i}"]) for i, n in enumerate(config.stats_models)]
        return F.array(*native, *[score(n, F.col(c)) for n, c in (ml_paths or {}).items()])

    audited = (F.col("n") >= config.min_history) & (F.col("n") > h)
    scores = let(bound, lambda given: F.when(F.arrays_overlap(F.col("valid_dates"), given["ahead"]), entries(given)))
    keys = [c for c in series.columns if c in ("unique_id", "sys_id", "dates", "values", "n")]
    return split.select(*keys, F.when(audited, scores).alias("scores"))


def name_champions(scored: DataFrame, config: SeriesConfig) -> DataFrame:
    """Add ``best_model_name`` and ``rmse``: least RMSE, ties by model name, naive for short histories."""
    ranked = F.transform(
        "scores",
        lambda s: F.struct(s["rmse"].isNull().alias("missing"), s["rmse"].alias("rmse"), s["model"].alias("model")),
    )
    is_fallback = F.col("n") < config.min_history
    if config.fallback_unscored:
        is_fallback = is_fallback | F.col("scores").isNull()
    return scored.withColumn("best", F.array_min(ranked)).select(
        *scored.columns,
        F.when(is_fallback, F.lit(FALLBACK_LABEL)).otherwise(F.col("best.model")).alias("best_model_name"),
        F.col("best.rmse").alias("rmse"),
    )


def audit_series(series: DataFrame, config: SeriesConfig, ml_paths: dict[str, str] | None = None) -> DataFrame:
    return name_champions(score_series(series, config, ml_paths), config)


def metric_rows(audited: DataFrame) -> DataFrame:
    """Long metrics: one row per scored series and model."""
    return (
        audited.select("unique_id", F.explode_outer("scores").alias("s"))
        .where(F.col("s").isNotNull())
        .select("unique_id", F.col("s.model").alias("model"), F.col("s.rmse").alias("rmse"))
    )


def metric_table(audited: DataFrame, models: list[str]) -> DataFrame:
    """Wide metrics straight from the score array: no pivot, no shuffle, no join."""
    keys = ["sys_id"] if "sys_id" in audited.columns else []
    by_model = F.map_from_entries(F.col("scores"))
    wide = audited.select(*keys, "unique_id", "best_model_name", "rmse", by_model.alias("by_model"))
    columns = [F.try_element_at("by_model", F.lit(m)).alias(metric_column(m)) for m in models]
    return wide.select(
        *keys,
        "unique_id",
        *columns,
        F.col("best_model_name").alias("Best_model_name"),
        F.col("rmse").alias("Best_model_RMSE"),
    ).where(F.coalesce(*[F.col(metric_column(m)) for m in models]).isNotNull())


def champion_rows(audited: DataFrame) -> DataFrame:
    keys = ["sys_id"] if "sys_id" in audited.columns else []
    return audited.select(*keys, "unique_id", "best_model_name", "rmse").where(F.col("best_model_name").isNotNull())


@dataclass
class SeriesChampionResult:
    series: DataFrame
    audited: DataFrame
    metrics: DataFrame
    champions: DataFrame
    forecasts: DataFrame
    shards_used: int
    seconds: dict = field(default_factory=dict)


def series_champion(panel: DataFrame, config: SeriesConfig, keep: list[str] | None = None) -> SeriesChampionResult:
    """Audit all models per series, choose the champions, refit and forecast.

    ``panel`` holds raw rows. The audited table, which all outputs come from, is
    kept in the checkpoint folder once.
    """
    keep = [c for c in (keep or ["sys_id"]) if c in panel.columns]
    models = [*config.stats_models, *config.ml_models]
    seconds = {}
    t0 = time.perf_counter()
    panel = pp.limit_series(panel, config.max_series)
    series = materialize(series_rows(pp.aggregate_period(panel, config.freq, keep), keep))
    seconds["data_read_seconds"] = round(time.perf_counter() - t0, 3)

    t0 = time.perf_counter()
    split = hold_out(series, config.validation_horizon)
    eligible = split.where((F.col("n") >= config.min_history) & (F.col("n") > config.validation_horizon))
    ml_paths, shards_used = {}, 0
    if config.ml_models and not eligible.isEmpty():
        split, ml_paths, shards_used = _ml_paths(split, eligible, config)
    seconds["ml_audit_seconds"] = round(time.perf_counter() - t0, 3)

    t0 = time.perf_counter()
    audited = name_champions(materialize(score_series(split, config, ml_paths)), config)
    seconds["stats_audit_seconds"] = round(time.perf_counter() - t0, 3)

    chosen = audited.where(F.col("best_model_name").isNotNull()).drop("scores", "rmse")
    forecasts = refit_and_forecast(
        chosen,
        models,
        config.horizon,
        config.freq,
        config.season_length,
        config.features if config.ml_models else None,
        config.profile,
        keep,
    )
    return SeriesChampionResult(
        series,
        audited,
        metric_table(audited, models),
        champion_rows(audited),
        forecasts.where(F.col("Forecast").isNotNull()),
        shards_used,
        seconds,
    )


def _ml_paths(split: DataFrame, eligible: DataFrame, config: SeriesConfig):
    """Validation forecasts of the global models as array columns next to each series."""
    spec, h = config.features, config.validation_horizon
    train = eligible.withColumn("train_dates", F.slice("dates", 1, F.greatest(F.col("n") - h, F.lit(0))))
    rows = training_rows_of(train, spec, "train_dates", "train")
    names = list(config.ml_models)
    columns = {name: f"path_{i}" for i, name in enumerate(names)}
    if config.ml_shards > 1:
        shards = materialize(balanced_shards(panel_rows(train, "train_dates", "train"), config.ml_shards))
        fitted = fit_sharded(rows, shards, names, spec, config.profile)
        marked = materialize_by(split.join(shards.select("unique_id", "shard"), "unique_id", "left"), "shard")
        parts = [marked.where(F.col("shard").isNull())]
        for number, models in fitted.items():
            parts.append(
                predict_paths(
                    marked.where(F.col("shard") == number),
                    {columns[k]: v for k, v in models.items()},
                    h,
                    config.freq,
                    spec,
                    values="train",
                    last_ds="train_end",
                )
            )
        return materialize(pp.union_parts(parts).drop("shard")), columns, len(fitted)
    fitted = fit_global(rows, names, spec, config.profile)
    out = predict_paths(
        eligible, {columns[k]: v for k, v in fitted.items()}, h, config.freq, spec, values="train", last_ds="train_end"
    )
    audited = (F.col("n") >= config.min_history) & (F.col("n") > h)
    return materialize(pp.union_parts([out, split.where(~audited)])), columns, 1


def run_series_champion(
    spark: SparkSession,
    table: DataFrame | str,
    uid_col: str,
    date_col: str,
    target_col: str,
    config: SeriesConfig = SeriesConfig(),
    uid_delimiter: str = "_",
    sys_id_value: str | None = None,
    output: str | None = None,
    run_id: str | None = None,
    run_ts: dt.datetime | None = None,
) -> SeriesChampionResult:
    """The whole job on a user-mapped table; with ``output`` the four result tables are written.

    Rows are stored by run and tenant. ``run_id`` defaults to the time stamp and the tenant, so a run never replaces
    another one's rows unless it is given the same id.
    """
    started = time.perf_counter()
    panel = src.read_mapped_panel(
        spark, table, uid_col, date_col, target_col, uid_delimiter, sys_id_value, freq=config.freq
    )
    pp.require_non_empty(panel, f"no rows to train on (tenant: {sys_id_value or 'all'})")
    result = series_champion(panel, config)
    if output:
        run_ts = run_ts or now()
        run_id = run_id or tables.run_id_of(run_ts, sys_id_value)
        t0 = time.perf_counter()
        for name, df in (("metrics", result.metrics), ("champions", result.champions), ("forecasts", result.forecasts)):
            tables.write_run(df.withColumn("created_at", F.lit(run_ts).cast("timestamp_ntz")), tables.target(output, name), run_id)
        result.seconds["write_seconds"] = round(time.perf_counter() - t0, 3)
        counts = result.audited.agg(
            F.count("*").alias("series_count"),
            F.count_if(F.col("n") >= config.min_history).alias("eligible_ids_for_full_audit"),
            F.count_if(F.col("n") < config.min_history).alias("fallback_ids"),
            F.count_if(F.col("best_model_name").isNull()).alias("unscored_ids"),
            F.count("best_model_name").alias("champion_rows"),
            F.count_if(F.exists(F.coalesce("scores", F.array()), lambda s: s["rmse"].isNotNull())).alias(
                "metrics_rows"
            ),
        ).first()
        summary = {
            "sys_id": sys_id_value or "*",
            "run_id": run_id,
            "max_series": config.max_series,
            **counts.asDict(),
            "forecast_rows": tables.read_table(spark, tables.target(output, "forecasts")).where(F.col("run_id") == run_id).count(),
            "ml_audit_shards_used": result.shards_used,
            "profile": config.profile,
            **result.seconds,
            "run_started_at": run_ts,
            "run_finished_at": run_ts + dt.timedelta(seconds=time.perf_counter() - started),
            "run_duration_seconds": round(time.perf_counter() - started, 3),
        }
        tables.append_run_log(spark, summary, tables.target(output, "run_logs"), run_ts)
    return result


# -- per-series champion over global models only ----------------------------------------------


def run_series_champion_ml(
    spark: SparkSession,
    table: DataFrame | str,
    uid_col: str,
    date_col: str,
    target_col: str,
    models: list[str],
    horizon: int,
    validation_horizon: int,
    freq: str = "MS",
    lags: tuple[int, ...] = (1, 2, 3, 6, 12),
    date_features: tuple[str, ...] = ("month", "quarter", "year"),
    uid_delimiter: str = "_",
    sys_id_value: str | None = None,
    profile: str = "series_ml",
    output: str | None = None,
    run_ts: dt.datetime | None = None,
    run_id: str | None = None,
) -> dict[str, DataFrame]:
    """Champion per series by RMSE, MAE, WMAPE among global models; series need more than two dates."""
    spec = FeatureSpec(list(lags), {}, list(date_features))
    raw = src.read_mapped_panel(spark, table, uid_col, date_col, target_col, uid_delimiter, sys_id_value, freq=freq)
    panel = pp.aggregate_same_ts(raw, ["sys_id"])
    series = materialize(series_rows(panel, ["sys_id"]).where(F.col("n") > 2))
    pp.require_non_empty(series, "every series has two dates or fewer")
    split = hold_out(series, validation_horizon).where(F.col("n") > validation_horizon)
    pp.require_non_empty(split, "no series is longer than the hold-out")
    train = split.withColumn("train_dates", F.slice("dates", 1, F.col("n") - validation_horizon))
    fitted = fit_global(training_rows_of(train, spec, "train_dates", "train"), models, spec, profile)
    joined = predict_recursive(
        split, fitted, validation_horizon, freq, spec, "train", "train_end", ("valid_dates", "valid")
    ).where(F.col("y").isNotNull())
    metrics = materialize(ev.series_metrics(joined))
    pp.require_non_empty(metrics, "no model could be scored on the hold-out")
    champions = ch.series_champion_multi(metrics, models)
    chosen = series.join(
        champions.select("unique_id", F.col("champion_model").alias("best_model_name")), "unique_id"
    )
    forecasts = refit_and_forecast(chosen, models, horizon, freq, 1, spec, profile, ["sys_id"]).select(
        "sys_id", "unique_id", "ds", F.col("Forecast").alias("forecast"), F.col("Best_model_name").alias("champion_model")
    )
    tenants = series.select("unique_id", "sys_id")
    out = {
        "metrics": metrics.join(tenants, "unique_id"),
        "champions": champions.join(tenants, "unique_id"),
        "forecasts": forecasts,
    }
    if output:
        run_ts = run_ts or now()
        run_id = run_id or tables.run_id_of(run_ts, sys_id_value)
        for name, df in out.items():
            tables.write_run(df.withColumn("created_at", F.lit(run_ts).cast("timestamp_ntz")), tables.target(output, name), run_id)
    return out


# -- one champion for the whole panel ----------------------------------------------------------


@dataclass(frozen=True)
class GlobalConfig:
    """Parameters of the panel-wide champion job."""

    freq: str = "D"
    horizon: int = 2
    lags: tuple[int, ...] = (1, 2, 3)
    date_features: tuple[str, ...] = ("dayofweek", "month")
    models: tuple[str, ...] = ("lgbm", "xgb", "rf", "et", "ridge")
    champion_metric: str = "wmape"
    profile: str = "panel"
    season_length: int | None = None
    model_display_name: str = "panel-forecast"
    wmape: str = "fraction"
    on_empty: str = "skip"

    @property
    def features(self) -> FeatureSpec:
        return FeatureSpec(list(self.lags), {}, list(self.date_features))

    def season(self, model: str) -> int:
        """The given season length, else that of the model's profile or of the frequency."""
        return self.season_length or season_of(model, self.profile, self.freq)


@dataclass
class GlobalSplit:
    """The panel of one run, prepared once for all models."""

    series: DataFrame
    train_rows: DataFrame
    valid: DataFrame


def prepare_global(panel: DataFrame, config: GlobalConfig) -> GlobalSplit:
    """Clean, require unique dates, drop series no longer than the horizon, hold out the last rows."""
    clean = pp.assert_one_row_per_period(pp.coerce_types(panel, config.freq))
    series = series_rows(clean).where(F.col("n") > config.horizon)
    split = materialize(
        hold_out(series, config.horizon).withColumn("train_dates", F.slice("dates", 1, F.col("n") - config.horizon))
    )
    pp.require_non_empty(split, "no series is longer than the horizon")
    split = in_few_parts(split, split.count())
    return GlobalSplit(
        split,
        panel_rows(split, "train_dates", "train"),
        panel_rows(split, "valid_dates", "valid"),
    )


def validation_forecast(
    split: GlobalSplit, names: list[str], config: GlobalConfig
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Hold-out forecasts next to the actual values, for any mix of models routed by family.

    Only dates that both sides have come back. Predictions and actuals lie in the
    same series row, so this join moves no data; user models are joined by key.
    """
    families = split_families(names, config.profile)
    h, freq, spec = config.horizon, config.freq, config.features
    where = {"values": "train", "last_ds": "train_end", "actual": ("valid_dates", "valid")}
    parts, fitted = [], {}
    if families["global"]:
        rows = training_rows_of(split.series, spec, "train_dates", "train")
        fitted = fit_global(rows, families["global"], spec, config.profile)
        parts.append(predict_recursive(split.series, fitted, h, freq, spec, **where))
    if families["native"]:
        parts.append(native_forecast(split.series, families["native"], h, freq, config.season, **where))
    for name in families["grouped"]:
        out = grouped_forecast(split.train_rows, name, h, freq, config.season(name))
        parts.append(ev.join_actual_pred(split.valid, out.where("error IS NULL").drop("error")))
    return pp.union_parts(parts).where(F.col("y").isNotNull()), fitted


def training_results(
    joined: DataFrame, config: GlobalConfig, source_table: str, prediction_table: str | None = None
) -> DataFrame:
    """One result row per model that had at least one comparable date."""
    return (
        ev.global_metrics(joined, config.wmape)
        .withColumnRenamed("model", "model_type")
        .withColumnRenamed("n_rows", "valid_rows")
        .withColumns(
            {
                "model_display_name": F.lit(config.model_display_name),
                "source_table": F.lit(source_table),
                "prediction_table": F.lit(prediction_table).cast("string"),
                "forecast_freq": F.lit(config.freq),
                "horizon": F.lit(config.horizon),
                "lags": F.lit(list(config.lags)) if config.lags else F.array().cast("array<int>"),
                "date_features": F.array(*[F.lit(f) for f in config.features.date_features]).cast("array<string>"),
                "model_ordinal": ch.model_ordinal(F.col("model_type"), list(config.models)),
                "error": F.lit(None).cast("string"),
            }
        )
    )


@dataclass
class GlobalChampionResult:
    predictions: DataFrame
    results: DataFrame
    champion: DataFrame
    model: PipelineModel | None
    model_type: str


def global_champion(panel: DataFrame, config: GlobalConfig, source_table: str, run_ts: dt.datetime):
    split = prepare_global(panel, config)
    joined, fitted = validation_forecast(split, list(config.models), config)
    joined = materialize(joined)
    results = materialize(training_results(joined, config, source_table))
    found = {r["model_type"] for r in results.select("model_type").collect()}
    missing = [m for m in config.models if m not in found]
    if missing and config.on_empty == "raise":
        raise ValueError(f"these models forecast none of the held-out dates: {', '.join(missing)}")
    pp.require_non_empty(results, "no model forecasts any of the held-out dates")
    counts = split.series.agg(F.count("*").alias("series"), F.sum(F.size("train")).alias("rows")).first()
    best = ch.select_global_champion(ch.valid_results(results, config.champion_metric), config.champion_metric)
    payload = results.agg(F.to_json(F.array_sort(F.collect_list(F.struct("model_ordinal", "model_type", "rmse", "mae", "wmape")))))
    champion = materialize(
        best.select(
            F.lit(run_ts).cast("timestamp").alias("run_ts"),
            F.col("model_type").alias("champion_model_type"),
            F.lit(config.champion_metric).alias("champion_metric_name"),
            F.col(config.champion_metric).alias("champion_metric_value"),
            "model_display_name",
            "source_table",
            "prediction_table",
            "forecast_freq",
            F.col("horizon").cast("bigint").alias("horizon"),
            F.to_json("lags").alias("lags"),
            F.to_json("date_features").alias("date_features"),
            F.lit(counts["series"]).cast("bigint").alias("series_count"),
            F.lit(counts["rows"]).cast("bigint").alias("train_rows"),
            "rmse",
            "mae",
            "wmape",
            payload.scalar().alias("all_results"),
        )
    )
    winner = champion.first()["champion_model_type"]
    predictions = pp.tag_run_columns(
        joined, run_ts, F.col("model"), source_table, config.freq, config.horizon, config.model_display_name
    ).drop("model")
    return GlobalChampionResult(predictions, results, champion, fitted.get(winner), winner)


def run_global_champion(
    spark: SparkSession,
    table: DataFrame | str,
    config: GlobalConfig = GlobalConfig(),
    source_table: str = "panel",
    run_ts: dt.datetime | None = None,
    output: str | None = None,
    batch: bool = False,
    run_id: str | None = None,
) -> GlobalChampionResult:
    """Train, score and choose; with ``output`` write predictions, champion, model and batch forecast.

    ``run_id`` defaults to the time stamp and the display name; a run that is repeated replaces its rows.
    """
    run_ts = run_ts or now()
    run_id = run_id or tables.run_id_of(run_ts, config.model_display_name)
    panel = pp.coerce_types(src.read_panel(spark, table), config.freq)
    pp.require_non_empty(panel, "the source table has no complete row")
    result = global_champion(panel, config, source_table, run_ts)
    if output:
        tables.write_run(result.predictions, tables.target(output, "predictions"), run_id)
        uri = None
        if result.model is not None:
            uri = tables.save_model(
                result.model, f"{output}/models", config.model_display_name, result.model_type, run_id=run_id
            )
        record = result.champion.first().asDict()
        tables.write_run_metadata(
            spark,
            {
                **record,
                "model_type": record["champion_model_type"],
                "lags": list(config.lags),
                "date_features": config.features.date_features,
                "horizon": config.horizon,
                "model_uri": uri,
            },
            f"{output}/metadata/{config.model_display_name}/{result.model_type}/run_id={run_id}",
        )
        champion = result.champion.withColumn("champion_model_uri", F.lit(uri).cast("string"))
        required = ["run_ts", "champion_model_type", "champion_metric_name"]
        if not tables.split_valid(champion, required).where("NOT is_valid_row").isEmpty():
            raise ValueError(f"the champion lacks one of {', '.join(required)}")
        tables.write_run(champion, tables.target(output, "champion"), run_id)
        if batch:
            forecasts = batch_forecast(
                panel,
                result.model_type,
                config.horizon,
                config.freq,
                config.features,
                run_ts,
                source_table,
                config.season,
                model=result.model,
            )
            tables.write_run(forecasts, tables.target(output, "batch_forecasts"), run_id)
    return result


def train_one_model(
    panel: DataFrame,
    key: str,
    config: GlobalConfig,
    source_table: str = "panel",
    run_ts: dt.datetime | None = None,
    output: str | None = None,
    run_id: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Train and score one model; returns (joined predictions, one result row).

    A failure gives a result row with the error text instead of an exception.
    """
    one = GlobalConfig(**{**config.__dict__, "models": (key,)})
    get_model(key, config.profile)
    run_ts = run_ts or now()
    spark = panel.sparkSession
    try:
        result = global_champion(panel, GlobalConfig(**{**one.__dict__, "on_empty": "raise"}), source_table, run_ts)
    except Exception as failure:  # the other models of a fan-out go on
        message = str(failure) or repr(failure)
        row = spark.createDataFrame(
            [(key, message, ch.ERROR_WMAPE)], "model_type string, error string, wmape double"
        )
        ds_type = "timestamp_ntz" if config.freq == "H" else "date"
        empty = spark.createDataFrame([], f"unique_id string, ds {ds_type}, y double, prediction double")
        return empty, row
    if output:
        run_id = run_id or tables.run_id_of(run_ts, config.model_display_name)
        tables.write_run(result.predictions, tables.target(output, "predictions"), f"{run_id}-{key}")
        tables.write_csv(result.predictions, f"{output}/evaluation/{key}/run_id={run_id}")
        if result.model is not None:
            tables.save_model(result.model, f"{output}/models", config.model_display_name, key, run_id=run_id)
    return result.predictions, result.results


def select_champion(
    parts: list[DataFrame], models: list[str], metric: str = "wmape"
) -> DataFrame:
    """Fan-in of separate training runs: collect the result rows, choose the best."""
    results = ch.collect_training_results(parts).withColumn(
        "model_ordinal", ch.model_ordinal(F.col("model_type"), models)
    )
    valid = pp.require_non_empty(ch.valid_results(results, metric), f"{metric} is missing in every result")
    return ch.select_global_champion(valid, metric)


def run_multi_model_single_fit(
    spark: SparkSession,
    table: DataFrame | str,
    config: GlobalConfig,
    run_ts: dt.datetime,
    source_table: str = "panel",
    output: str | None = None,
    run_id: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """All models in one call; predictions wide with one column per model, best model named on each row."""
    split = prepare_global(src.read_panel(spark, table), config)
    joined, fitted = validation_forecast(split, list(config.models), config)
    wide = materialize(
        joined.groupBy("unique_id", "ds", "y").pivot("model", list(config.models)).agg(F.first("prediction"))
    )
    pp.require_non_empty(wide, "no forecast meets a held-out date")
    results = materialize(ev.multi_model_metrics(wide, list(config.models)))
    best = ch.select_global_champion(results).first()
    tagged = wide.withColumns(
        {
            "run_ts": F.lit(run_ts).cast("timestamp"),
            "model_display_name": F.lit(config.model_display_name),
            "source_table": F.lit(source_table),
            "forecast_freq": F.lit(config.freq),
            "horizon": F.lit(config.horizon).cast("bigint"),
            "best_model": F.lit(best["model"]),
        }
    )
    if output:
        run_id = run_id or tables.run_id_of(run_ts, config.model_display_name)
        tables.write_run(tagged, tables.target(output, "predictions"), run_id)
        tables.write_csv(tagged, f"{output}/evaluation/run_id={run_id}")
        best_named = results.withColumn("best_model", F.lit(best["model"])).coalesce(1)
        tables.write_json(best_named, f"{output}/model_results/run_id={run_id}")
        for name, model in fitted.items():
            tables.save_model(model, f"{output}/models", config.model_display_name, name, run_id=run_id)
    return tagged, results


def run_monthly_ml(
    spark: SparkSession,
    table: DataFrame | str,
    mapping: dict[str, str] | None = None,
    models: tuple[str, ...] = ("xgb", "lgbm", "lr"),
    horizon: int = 12,
    freq: str = "MS",
    lags: tuple[int, ...] = (1, 12),
    min_history: int = 24,
    profile: str = "monthly",
    output_csv: str | None = None,
) -> DataFrame:
    """Aggregate, keep long series, fit on everything, forecast; one column per model."""
    spec = FeatureSpec(list(lags))
    panel = pp.aggregate_period(pp.drop_null_keys(src.read_renamed_panel(spark, table, mapping)), freq)
    series = materialize(series_rows(panel).where(F.col("n") >= min_history))
    fitted = fit_global(training_rows_of(series, spec), list(models), spec, profile)
    state = series.withColumn("last_ds", F.element_at("dates", -1))
    wide = predict_paths(state, {f"path_{m}": v for m, v in fitted.items()}, horizon, freq, spec)
    zipped = F.arrays_zip(
        future_dates(F.col("last_ds"), horizon, freq).alias("ds"), *[F.col(f"path_{m}").alias(m) for m in models]
    )
    out = wide.select("unique_id", F.explode_outer(zipped).alias("p")).select("unique_id", "p.*")
    if output_csv:
        tables.write_csv(out, output_csv)
    return out


def run_batch_forecast(
    spark: SparkSession,
    table: DataFrame | str,
    champion_table: DataFrame | str,
    config: GlobalConfig,
    run_ts: dt.datetime,
    source_table: str = "panel",
    output: str | None = None,
    fallback_table: DataFrame | str | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """Forecast with the newest champion of the configured display name.

    When the current rows cannot be scored, ``fallback_table`` (the rows the
    model was trained on) takes their place. Without one, the table the champion
    was trained on, as its row names it, does, if that is another table that can be read.
    """
    row = src.champion_history(spark, champion_table, 1, config.model_display_name).first()
    if row is None:
        raise ValueError(f"no champion is stored for {config.model_display_name}")
    if fallback_table is None and isinstance(table, str) and row["source_table"] != table:
        named = row["source_table"]
        if named and tables.existing_schema(spark, named) is not None:
            fallback_table = named

    def forecast(panel):
        out = batch_forecast(
            pp.coerce_types(panel, config.freq),
            row["champion_model_type"],
            config.horizon,
            config.freq,
            config.features,
            run_ts,
            source_table,
            config.season,
            model_uri=row["champion_model_uri"],
        )
        return materialize(out) if fallback_table is not None else out

    try:
        out = forecast(src.read_panel(spark, table))
    except (PySparkException, ValueError) as failure:  # rows that cannot be read, cast or scored; faults of code go up
        if fallback_table is None:
            raise
        LOG.warning("the current rows cannot be scored, the champion's own table takes their place: %s", failure)
        out = forecast(src.read_panel(spark, fallback_table))
    if output:
        run_id = run_id or tables.run_id_of(run_ts, config.model_display_name)
        tables.write_run(out, tables.target(output, "batch_forecasts"), run_id)
    return out
