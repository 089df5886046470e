"""Queries of joins, metrics and champion choice, on hold-out forecasts of three models."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.catalogue.panels import DEMAND, SALES, demand, sales, split_sql, table
from panelcast.catalogue.registry import query
from panelcast.functions.metrics import round_scaled
from panelcast.functions.text import metric_column, normalize_model_name
from panelcast.operators import champion as ch
from panelcast.operators import evaluate as ev
from panelcast.operators import prepare as pp
from panelcast.operators.series import hold_out, panel_rows, series_rows
from panelcast.plans.audit import native_forecast

MODELS = ["SeasonalNaive", "Naive", "ARCH(1)"]
H, MIN_HISTORY = 12, 24


def split(spark, sf_dir):
    rows = hold_out(series_rows(demand(spark, sf_dir)), H)
    return rows.where((F.col("n") > H) & (F.col("n") >= MIN_HISTORY))


def forecasts(rows):
    return native_forecast(rows, MODELS, H, "MS", 12, values="train", last_ds="train_end")


def valid_and_preds(spark, sf_dir):
    rows = split(spark, sf_dir)
    return panel_rows(rows, "valid_dates", "valid"), forecasts(rows)


def joined(spark, sf_dir):
    return ev.join_actual_pred(*valid_and_preds(spark, sf_dir))


PREDS = f"""
{DEMAND},
{split_sql("demand", H, MIN_HISTORY)},
flat AS (SELECT unique_id, arg_max(y, t) AS last_y, avg(y) AS mean_y FROM train GROUP BY unique_id),
preds AS (
  SELECT a.unique_id, a.ds, 'Naive' AS model, last_y AS prediction FROM ahead a JOIN flat f ON f.unique_id = a.unique_id
  UNION ALL
  SELECT a.unique_id, a.ds, 'ARCH(1)', mean_y FROM ahead a JOIN flat f ON f.unique_id = a.unique_id
  UNION ALL
  SELECT a.unique_id, a.ds, 'SeasonalNaive', t.y FROM ahead a
  LEFT JOIN train t ON t.unique_id = a.unique_id AND a.n >= 12 AND t.t = a.n - 12 + (a.k - 1) % 12 + 1
)"""
JOINED = (
    PREDS
    + """,
joined AS (
  SELECT v.unique_id, v.ds, v.y, p.model, p.prediction
  FROM valid v JOIN preds p ON p.unique_id = v.unique_id AND p.ds = v.ds
)"""
)
SERIES_RMSE = (
    JOINED
    + """,
scores AS (
  SELECT unique_id, model, sqrt(avg(pow(y - prediction, 2))) AS rmse FROM joined GROUP BY 1, 2
)"""
)
GLOBAL = (
    JOINED
    + """,
results AS (
  SELECT model, sqrt(avg(pow(y - prediction, 2))) AS rmse, avg(abs(y - prediction)) AS mae,
         sum(abs(y - prediction)) / nullif(sum(abs(y)), 0) AS wmape, CAST(count(*) AS BIGINT) AS n_rows,
         CAST(list_position(['SeasonalNaive', 'Naive', 'ARCH(1)'], model) AS BIGINT) AS model_ordinal
  FROM joined GROUP BY model
)"""
)


@query(
    "join_actual_pred",
    f"WITH {JOINED} SELECT unique_id, ds, model, y, round(prediction, 4) AS prediction FROM joined",
)
def join_actual_pred(spark, sf_dir):
    return joined(spark, sf_dir).select("unique_id", "ds", "model", "y", F.round("prediction", 4).alias("prediction"))


@query(
    "join_pred_actual_left",
    f"""
    WITH {PREDS}
    SELECT p.unique_id, p.ds, p.model, v.y, round(p.prediction, 4) AS prediction
    FROM preds p LEFT JOIN valid v ON p.unique_id = v.unique_id AND p.ds = v.ds
    """,
)
def join_pred_actual_left(spark, sf_dir):
    valid, preds = valid_and_preds(spark, sf_dir)
    out = ev.join_pred_actual_left(preds, valid)
    return out.select("unique_id", "ds", "model", "y", F.round("prediction", 4).alias("prediction"))


_ALIGNED = (
    PREDS
    + """,
aligned AS (
  SELECT coalesce(v.unique_id, p.unique_id) AS unique_id, coalesce(v.ds, p.ds) AS ds, v.y, p.prediction
  FROM valid v FULL JOIN (SELECT * FROM preds WHERE model = 'Naive') p ON p.unique_id = v.unique_id AND p.ds = v.ds
)"""
)


@query("align_outer", f"WITH {_ALIGNED} SELECT unique_id, ds, y, prediction FROM aligned")
def align_outer(spark, sf_dir):
    valid, preds = valid_and_preds(spark, sf_dir)
    return ev.align_outer(valid, preds.where("model = 'Naive'"))


@query(
    "align_outer_metrics",
    f"""
    WITH {_ALIGNED}
    SELECT round(sqrt(avg(pow(y - prediction, 2))), 4) AS rmse, round(avg(abs(y - prediction)), 4) AS mae,
           round(CASE WHEN coalesce(sum(abs(y)), 0) > 0
                 THEN 100.0 * coalesce(sum(abs(y - prediction)), 0) / sum(abs(y)) ELSE 0.0 END, 4) AS wmape
    FROM aligned
    """,
)
def align_outer_metrics(spark, sf_dir):
    valid, preds = valid_and_preds(spark, sf_dir)
    out = ev.percent_wmape(ev.align_outer(valid, preds.where("model = 'Naive'")))
    return out.select(*[F.round(c, 4).alias(c) for c in out.columns])


@query(
    "global_metrics",
    f"WITH {GLOBAL} SELECT model, round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(wmape, 6) AS wmape, n_rows FROM results",
)
def global_metrics(spark, sf_dir):
    out = ev.global_metrics(joined(spark, sf_dir))
    return out.withColumns({"rmse": F.round("rmse", 4), "mae": F.round("mae", 4), "wmape": F.round("wmape", 6)})


@query(
    "percent_wmape",
    f"WITH {GLOBAL} SELECT model, round(100.0 * wmape, 4) AS wmape FROM results",
)
def percent_wmape(spark, sf_dir):
    out = ev.global_metrics(joined(spark, sf_dir), wmape="percent")
    return out.select("model", F.round("wmape", 4).alias("wmape"))


_SERIES_METRICS = (
    JOINED
    + """,
series_scores AS (
  SELECT unique_id, model, avg(abs(y - prediction)) AS mae, sqrt(avg(pow(y - prediction, 2))) AS rmse,
         sum(abs(y - prediction)) / greatest(sum(abs(y)), 1e-9) AS wmape, CAST(count(*) AS BIGINT) AS n_validation_rows,
         list_position(['SeasonalNaive', 'Naive', 'ARCH(1)'], model) AS model_ordinal
  FROM joined GROUP BY 1, 2
)"""
)


@query(
    "series_metrics",
    f"""
    WITH {_SERIES_METRICS}
    SELECT unique_id, model, round(mae, 4) AS mae, round(rmse, 4) AS rmse, round(wmape, 4) AS wmape, n_validation_rows
    FROM series_scores
    """,
)
def series_metrics(spark, sf_dir):
    out = ev.series_metrics(joined(spark, sf_dir))
    return out.withColumns({c: round_scaled(F.col(c), 4) for c in ("mae", "rmse", "wmape")})


@query("series_rmse", f"WITH {SERIES_RMSE} SELECT unique_id, model, round(rmse, 4) AS rmse FROM scores")
def series_rmse(spark, sf_dir):
    return ev.evaluate(*valid_and_preds(spark, sf_dir)).withColumn("rmse", F.round("rmse", 4))


def _wide(preds):
    return preds.groupBy("unique_id", "ds").pivot("model", MODELS).agg(F.first("prediction"))


@query(
    "melt_models",
    f"WITH {PREDS} SELECT unique_id, ds, model, round(prediction, 4) AS prediction FROM preds",
)
def melt_models(spark, sf_dir):
    _, preds = valid_and_preds(spark, sf_dir)
    return ev.melt_models(_wide(preds), [f"`{m}`" for m in MODELS]).withColumn("prediction", F.round("prediction", 4))


@query(
    "multi_model_metrics",
    f"""
    WITH {GLOBAL}
    SELECT model, round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(wmape, 6) AS wmape, n_rows, model_ordinal FROM results
    """,
)
def multi_model_metrics(spark, sf_dir):
    valid, preds = valid_and_preds(spark, sf_dir)
    wide = ev.join_actual_pred(valid, _wide(preds))
    renamed = wide.withColumnRenamed("ARCH(1)", "ARCH")
    out = ev.multi_model_metrics(renamed, ["SeasonalNaive", "Naive", "ARCH"])
    return out.withColumns(
        {
            "model": F.when(F.col("model") == "ARCH", "ARCH(1)").otherwise(F.col("model")),
            "rmse": F.round("rmse", 4),
            "mae": F.round("mae", 4),
            "wmape": F.round("wmape", 6),
        }
    )


_CHAMPIONS = (
    SERIES_RMSE
    + """,
champions AS (
  SELECT unique_id, model AS best_model_name, rmse FROM (
    SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY rmse ASC NULLS LAST, model) AS pos FROM scores
  ) WHERE pos = 1
),
short AS (SELECT unique_id FROM demand GROUP BY unique_id HAVING count(*) < 24)"""
)


@query(
    "metrics_wide",
    f"""
    WITH {_CHAMPIONS}
    SELECT s.unique_id, round(max(CASE WHEN model = 'SeasonalNaive' THEN s.rmse END), 4) AS "SeasonalNaive_RMSE",
           round(max(CASE WHEN model = 'Naive' THEN s.rmse END), 4) AS "Naive_RMSE",
           round(max(CASE WHEN model = 'ARCH(1)' THEN s.rmse END), 4) AS "ARCH_1__RMSE",
           max(best_model_name) AS "Best_model_name", round(max(c.rmse), 4) AS "Best_model_RMSE"
    FROM scores s JOIN champions c ON c.unique_id = s.unique_id WHERE s.rmse IS NOT NULL GROUP BY s.unique_id
    """,
)
def metrics_wide(spark, sf_dir):
    metrics = ev.evaluate(*valid_and_preds(spark, sf_dir))
    out = ev.metrics_wide(metrics, MODELS, ch.series_champion_rmse(metrics))
    numbers = [metric_column(m) for m in MODELS] + ["Best_model_RMSE"]
    return out.withColumns({c: F.round(c, 4) for c in numbers})


@query(
    "series_champion_rmse",
    f"WITH {_CHAMPIONS} SELECT unique_id, best_model_name, round(rmse, 4) AS rmse FROM champions",
)
def series_champion_rmse(spark, sf_dir):
    metrics = ev.evaluate(*valid_and_preds(spark, sf_dir))
    return ch.series_champion_rmse(metrics).withColumn("rmse", F.round("rmse", 4))


@query(
    "champion_with_fallback",
    f"""
    WITH {_CHAMPIONS}
    SELECT unique_id, best_model_name, round(rmse, 4) AS rmse FROM champions
    UNION ALL SELECT unique_id, 'Naive_Fallback', NULL FROM short
    """,
)
def champion_with_fallback(spark, sf_dir):
    metrics = ev.evaluate(*valid_and_preds(spark, sf_dir))
    short = pp.flag_history(demand(spark, sf_dir), MIN_HISTORY).where("NOT is_eligible")
    out = ch.add_naive_fallback(ch.series_champion_rmse(metrics), short)
    return out.withColumn("rmse", F.round("rmse", 4))


@query(
    "series_champion_multi",
    f"""
    WITH {_SERIES_METRICS}
    SELECT unique_id, model AS champion_model, round(mae, 4) AS mae, round(rmse, 4) AS rmse, round(wmape, 4) AS wmape,
           n_validation_rows
    FROM (
      SELECT *, row_number() OVER (
        PARTITION BY unique_id ORDER BY rmse ASC NULLS LAST, mae ASC NULLS LAST, wmape ASC NULLS LAST, model_ordinal
      ) AS pos FROM series_scores
    ) WHERE pos = 1
    """,
)
def series_champion_multi(spark, sf_dir):
    out = ch.series_champion_multi(ev.series_metrics(joined(spark, sf_dir)), MODELS)
    return out.withColumns({c: round_scaled(F.col(c), 4) for c in ("mae", "rmse", "wmape")})


@query(
    "global_champion",
    f"""
    WITH {GLOBAL}
    SELECT model, round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(wmape, 6) AS wmape, n_rows, model_ordinal
    FROM results ORDER BY results.wmape ASC NULLS LAST, model_ordinal LIMIT 1
    """,
)
def global_champion(spark, sf_dir):
    results = ev.global_metrics(joined(spark, sf_dir))
    results = results.withColumn("model_ordinal", ch.model_ordinal(F.col("model"), MODELS))
    out = ch.select_global_champion(ch.valid_results(results, "wmape"), "wmape")
    return out.withColumns({"rmse": F.round("rmse", 4), "mae": F.round("mae", 4), "wmape": F.round("wmape", 6)})


@query(
    "lookup_champion",
    f"""
    WITH {_CHAMPIONS}
    SELECT best_model_name, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT d.unique_id) AS BIGINT) AS n_series
    FROM demand d JOIN champions c ON c.unique_id = d.unique_id GROUP BY best_model_name
    """,
)
def lookup_champion(spark, sf_dir):
    champions = ch.series_champion_rmse(ev.evaluate(*valid_and_preds(spark, sf_dir)))
    rows = ch.lookup_champion(demand(spark, sf_dir), champions)
    return rows.groupBy("best_model_name").agg(
        F.count("*").alias("n_rows"), F.count_distinct("unique_id").alias("n_series")
    )


@query(
    "normalize_model_names",
    """
    WITH labels AS (
      SELECT p_partkey, CASE p_partkey % 7
        WHEN 0 THEN concat('ARCH(', p_size, ')') WHEN 1 THEN concat(' ARCH (', p_size, ') ')
        WHEN 2 THEN concat('GARCH(', p_size, ',1)') WHEN 3 THEN 'NaiveFallback' WHEN 4 THEN concat('  ', p_name, ' ')
        WHEN 5 THEN '' END AS label
      FROM part
    )
    SELECT p_partkey, label, CASE WHEN replace(label, ' ', '') LIKE 'ARCH(%' THEN 'ARCH'
           WHEN replace(label, ' ', '') LIKE 'GARCH(%' THEN 'GARCH'
           WHEN trim(label) = 'NaiveFallback' THEN 'Naive_Fallback' ELSE trim(label) END AS model
    FROM labels
    """,
)
def normalize_model_names(spark, sf_dir):
    kind = F.col("p_partkey") % 7
    label = (
        F.when(kind == 0, F.concat(F.lit("ARCH("), "p_size", F.lit(")")))
        .when(kind == 1, F.concat(F.lit(" ARCH ("), "p_size", F.lit(") ")))
        .when(kind == 2, F.concat(F.lit("GARCH("), "p_size", F.lit(",1)")))
        .when(kind == 3, F.lit("NaiveFallback"))
        .when(kind == 4, F.concat(F.lit("  "), "p_name", F.lit(" ")))
        .when(kind == 5, F.lit(""))
    )
    labels = table(spark, sf_dir, "part").select("p_partkey", label.alias("label"))
    return labels.withColumn("model", normalize_model_name(F.col("label")))


_RESULT_ROWS = """
parts AS (
  SELECT p_brand AS model_type, CAST(count(*) AS BIGINT) AS valid_rows, avg(p_retailprice) AS rmse, avg(p_size) / 100.0 AS wmape,
         CASE WHEN sum(p_partkey) % 5 = 0 THEN 'fit failed' END AS error
  FROM part GROUP BY p_brand
)"""


def _result_rows(spark, sf_dir):
    return (
        table(spark, sf_dir, "part")
        .groupBy(F.col("p_brand").alias("model_type"))
        .agg(
            F.count("*").alias("valid_rows"),
            F.avg("p_retailprice").alias("rmse"),
            (F.avg("p_size") / 100.0).alias("wmape"),
            F.when(F.sum("p_partkey") % 5 == 0, F.lit("fit failed")).alias("error"),
        )
        .withColumn("mae", F.lit(None).cast("double"))
    )


@query(
    "failed_model_sentinel",
    f"""
    WITH {_RESULT_ROWS}
    SELECT model_type, valid_rows, round(CASE WHEN error IS NULL THEN rmse END, 3) AS rmse,
           round(CASE WHEN error IS NULL THEN wmape ELSE 999999.0 END, 5) AS wmape, error
    FROM parts
    """,
)
def failed_model_sentinel(spark, sf_dir):
    out = ch.failed_model_sentinel(_result_rows(spark, sf_dir)).drop("mae")
    return out.withColumns({"rmse": F.round("rmse", 3), "wmape": F.round("wmape", 5)})


@query(
    "filter_valid_results",
    f"WITH {_RESULT_ROWS} SELECT model_type, round(rmse, 3) AS rmse FROM parts WHERE error IS NULL",
)
def filter_valid_results(spark, sf_dir):
    """Failed fits have no RMSE, so they drop out of an RMSE ranking."""
    out = ch.valid_results(ch.failed_model_sentinel(_result_rows(spark, sf_dir)), "rmse")
    return out.select("model_type", F.round("rmse", 3).alias("rmse"))


@query(
    "collect_training_results",
    f"""
    WITH {_RESULT_ROWS}
    SELECT model_type, valid_rows, round(rmse, 3) AS rmse, round(wmape, 5) AS wmape, error,
           '[1,12]' AS lags_json, CAST(12 AS BIGINT) AS last_lag
    FROM parts
    """,
)
def collect_training_results(spark, sf_dir):
    """Results passed as JSON text, half of them from each of two runs."""
    rows = _result_rows(spark, sf_dir).withColumns(
        {"lags": F.array(F.lit(1), F.lit(12)), "rmse": F.round("rmse", 3), "wmape": F.round("wmape", 5)}
    )
    text = rows.select("model_type", F.to_json(F.struct("*")).alias("value"))
    first = text.where(F.col("model_type") < "Brand#2").select("value")
    second = text.where(F.col("model_type") >= "Brand#2").select("value")
    schema = "model_type string, valid_rows bigint, rmse double, wmape double, error string, lags array<int>"
    out = ch.collect_training_results([first, second], schema)
    return out.select(
        "model_type", "valid_rows", "rmse", "wmape", "error",
        F.to_json("lags").alias("lags_json"), F.element_at("lags", -1).cast("bigint").alias("last_lag"),
    )


@query(
    "flatten_batches",
    f"WITH {SALES} SELECT unique_id, ds, round(y, 2) AS y FROM sales",
)
def flatten_batches(spark, sf_dir):
    batches = series_rows(sales(spark, sf_dir)).select(
        F.transform(
            F.arrays_zip("dates", "values"),
            lambda p: F.struct(
                F.col("unique_id").alias("unique_id"), p["dates"].alias("ds"), F.round(p["values"], 2).alias("y")
            ),
        ).alias("records")
    )
    return ch.flatten_batches(batches, "records")


@query(
    "run_summary",
    f"""
    WITH {_CHAMPIONS}, flags AS (SELECT unique_id, count(*) >= 24 AS e FROM demand GROUP BY unique_id)
    SELECT (SELECT CAST(count(*) AS BIGINT) FROM flags) AS series_count,
           (SELECT CAST(count(*) AS BIGINT) FROM flags WHERE e) AS eligible_ids_for_full_audit,
           (SELECT CAST(count(*) AS BIGINT) FROM flags WHERE NOT e) AS fallback_ids,
           (SELECT CAST(count(*) AS BIGINT) FROM demand) AS panel_rows,
           (SELECT CAST(count(*) AS BIGINT) FROM scores) AS metrics_rows,
           (SELECT CAST(count(*) AS BIGINT) FROM champions) AS champions_rows
    """,
)
def run_summary(spark, sf_dir):
    panel = demand(spark, sf_dir)
    metrics = ev.evaluate(*valid_and_preds(spark, sf_dir))
    return ev.run_summary(
        panel, pp.flag_history(panel, MIN_HISTORY), metrics=metrics, champions=ch.series_champion_rmse(metrics)
    )
