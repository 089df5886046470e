"""Schemas of the output tables. Non-nullable fields are the required columns."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(required: dict, optional: dict) -> T.StructType:
    fields = [T.StructField(name, kind, False) for name, kind in required.items()]
    return T.StructType(fields + [T.StructField(name, kind, True) for name, kind in optional.items()])


_S, _D, _L, _TS, _B = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType(), T.BooleanType()

PREDICTIONS = _schema(
    {"unique_id": _S, "ds": _TS, "run_ts": _TS},
    {
        "y": _D,
        "prediction": _D,
        "model_display_name": _S,
        "model_type": _S,
        "source_table": _S,
        "forecast_freq": _S,
        "horizon": _L,
        "run_id": _S,
    },
)
# One schema for both champion layouts: the second block is filled by the global job only.
CHAMPION = _schema(
    {"run_ts": _TS, "champion_model_type": _S, "champion_metric_name": _S},
    {
        "champion_metric_value": _D,
        "champion_model_uri": _S,
        "model_display_name": _S,
        "source_table": _S,
        "prediction_table": _S,
        "forecast_freq": _S,
        "horizon": _L,
        "lags": _S,
        "date_features": _S,
        "series_count": _L,
        "train_rows": _L,
        "rmse": _D,
        "mae": _D,
        "wmape": _D,
        "all_results": _S,
        "run_id": _S,
    },
)
BATCH_FORECASTS = _schema(
    {"unique_id": _S, "ds": _TS, "run_ts": _TS},
    {
        "prediction": _D,
        "model_type": _S,
        "source_table": _S,
        "forecast_freq": _S,
        "horizon": _L,
        "is_future": _B,
        "run_id": _S,
    },
)
RUN_LOG = _schema(
    {"sys_id": _S, "created_at": T.TimestampNTZType()},
    {
        "run_id": _S,
        "max_series": _L,
        "series_count": _L,
        "eligible_ids_for_full_audit": _L,
        "fallback_ids": _L,
        "ml_audit_shards_used": _L,
        "metrics_rows": _L,
        "champion_rows": _L,
        "forecast_rows": _L,
        "data_read_seconds": _D,
        "stats_audit_seconds": _D,
        "ml_audit_seconds": _D,
        "write_seconds": _D,
        "run_started_at": T.TimestampNTZType(),
        "run_finished_at": T.TimestampNTZType(),
        "run_duration_seconds": _D,
    },
)
TRAINING_RESULT = T.StructType(
    [
        T.StructField("model_display_name", _S),
        T.StructField("model_type", _S),
        T.StructField("source_table", _S),
        T.StructField("prediction_table", _S),
        T.StructField("forecast_freq", _S),
        T.StructField("horizon", T.IntegerType()),
        T.StructField("lags", T.ArrayType(T.IntegerType())),
        T.StructField("date_features", T.ArrayType(_S)),
        T.StructField("train_rows", _L),
        T.StructField("valid_rows", _L),
        T.StructField("series_count", _L),
        T.StructField("rmse", _D),
        T.StructField("mae", _D),
        T.StructField("wmape", _D),
        T.StructField("model_uri", _S),
        T.StructField("error", _S),
    ]
)
OUTPUT_TABLES = {
    "predictions": PREDICTIONS,
    "champion": CHAMPION,
    "batch_forecasts": BATCH_FORECASTS,
}


def required_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]
