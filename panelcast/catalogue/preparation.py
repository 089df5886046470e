"""Queries of cleaning, aggregation, thresholds, hold-out and features."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from panelcast.catalogue.panels import (
    DEMAND,
    DEMAND_RAW,
    EVENT_DAYS,
    SALES,
    SALES_RAW,
    TYPE_DAYS,
    demand,
    demand_raw,
    event_days,
    event_raw,
    sales,
    sales_raw,
    table,
)
from panelcast.catalogue.registry import query
from panelcast.functions.calendar import DATE_FEATURES, date_feature, floor_period, next_period
from panelcast.operators import prepare as pp
from panelcast.operators.features import FeatureSpec, build_features, default_lag_transforms
from panelcast.operators.series import series_rows
from panelcast.operators.shards import balanced_shards, shard_loads
from panelcast.sources.tables import split_valid

_TEXT_Y = "substr(props, 7, 2)"


def _text_panel(spark, sf_dir):
    """Values as text, some of them not numbers; some ids missing."""
    return table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 50 != 0, F.col("event_type")).alias("unique_id"),
        F.col("ts").alias("ds"),
        F.substring("props", 7, 2).alias("y"),
        "event_id",
    )


@query(
    "coerce_types",
    f"""
    SELECT event_type AS unique_id, CAST(ts AS DATE) AS ds, TRY_CAST({_TEXT_Y} AS DOUBLE) AS y, event_id
    FROM events WHERE event_id % 50 <> 0 AND event_type IS NOT NULL AND TRY_CAST({_TEXT_Y} AS DOUBLE) IS NOT NULL
    """,
)
def coerce_types(spark, sf_dir):
    return pp.coerce_types(_text_panel(spark, sf_dir))


@query(
    "drop_null_keys",
    f"SELECT event_type AS unique_id, CAST(ts AS DATE) AS ds, {_TEXT_Y} AS y, event_id FROM events WHERE event_id % 50 <> 0",
)
def drop_null_keys(spark, sf_dir):
    return pp.drop_null_keys(_text_panel(spark, sf_dir)).withColumn("ds", F.to_date("ds"))


@query(
    "append_valid_split",
    f"""
    SELECT event_id, TRY_CAST({_TEXT_Y} AS DOUBLE) AS y,
           (event_id % 50 <> 0 AND TRY_CAST({_TEXT_Y} AS DOUBLE) IS NOT NULL) AS is_valid_row
    FROM events
    """,
)
def append_valid_split(spark, sf_dir):
    rows = _text_panel(spark, sf_dir).withColumn("y", F.col("y").try_cast("double"))
    return split_valid(rows, ["unique_id", "y"]).select("event_id", "y", "is_valid_row")


@query("aggregate_monthly", f"WITH {SALES} SELECT unique_id, ds, round(y, 2) AS y FROM sales")
def aggregate_monthly(spark, sf_dir):
    return sales(spark, sf_dir).withColumn("y", F.round("y", 2))


_TRUNCATED = "SELECT unique_id, CAST(date_trunc('{unit}', ds) AS DATE) AS ds, round(sum(y), 2) AS y FROM sales_raw GROUP BY 1, 2"


@query("aggregate_quarterly", f"WITH {SALES_RAW} " + _TRUNCATED.format(unit="quarter"))
def aggregate_quarterly(spark, sf_dir):
    return sales(spark, sf_dir, "QS").withColumn("y", F.round("y", 2))


@query("aggregate_yearly", f"WITH {SALES_RAW} " + _TRUNCATED.format(unit="year"))
def aggregate_yearly(spark, sf_dir):
    return sales(spark, sf_dir, "YS").withColumn("y", F.round("y", 2))


@query("aggregate_daily", f"WITH {SALES_RAW} " + _TRUNCATED.format(unit="day"))
def aggregate_daily(spark, sf_dir):
    return sales(spark, sf_dir, "D").withColumn("y", F.round("y", 2))


@query(
    "aggregate_weekly",
    f"""
    WITH {SALES_RAW}
    SELECT unique_id, CAST(date_trunc('week', ds) + INTERVAL 6 DAY AS DATE) AS ds, round(sum(y), 2) AS y
    FROM sales_raw GROUP BY 1, 2
    """,
)
def aggregate_weekly(spark, sf_dir):
    """Weeks end on, and are labelled by, their Sunday."""
    return sales(spark, sf_dir, "W").withColumn("y", F.round("y", 2))


@query(
    "aggregate_hourly",
    """
    SELECT event_type AS unique_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ds, round(sum(value), 2) AS y
    FROM events GROUP BY 1, 2
    """,
)
def aggregate_hourly(spark, sf_dir):
    return pp.aggregate_period(event_raw(spark, sf_dir, by_user=False), "H").withColumn("y", F.round("y", 2))


@query(
    "aggregate_same_ts",
    f"WITH {SALES_RAW} SELECT unique_id, ds, round(sum(y), 2) AS y FROM sales_raw GROUP BY unique_id, ds",
)
def aggregate_same_ts(spark, sf_dir):
    return pp.aggregate_same_ts(sales_raw(spark, sf_dir)).withColumn("y", F.round("y", 2))


@query(
    "series_counts",
    f"WITH {DEMAND} SELECT unique_id, CAST(count(*) AS BIGINT) AS n_obs FROM demand GROUP BY unique_id",
)
def series_counts(spark, sf_dir):
    return pp.series_counts(demand(spark, sf_dir))


@query("count_series", f"WITH {DEMAND} SELECT CAST(count(DISTINCT unique_id) AS BIGINT) AS series_count FROM demand")
def count_series(spark, sf_dir):
    return pp.count_series(demand(spark, sf_dir))


@query(
    "history_flags",
    f"""
    WITH {DEMAND}
    SELECT unique_id, CAST(count(*) AS BIGINT) AS n_obs, count(*) >= 24 AS is_eligible FROM demand GROUP BY unique_id
    """,
)
def history_flags(spark, sf_dir):
    return pp.flag_history(demand(spark, sf_dir), 24)


@query(
    "short_series_filter",
    f"""
    WITH {DEMAND}
    SELECT unique_id, ds, y FROM demand
    WHERE unique_id IN (SELECT unique_id FROM demand GROUP BY unique_id HAVING count(*) > 25)
    """,
)
def short_series_filter(spark, sf_dir):
    return pp.filter_series(demand(spark, sf_dir), 25)


@query(
    "min_obs_filter",
    f"""
    WITH {EVENT_DAYS}
    SELECT unique_id, ds, round(y, 2) AS y FROM event_days
    WHERE unique_id IN (SELECT unique_id FROM event_days GROUP BY unique_id HAVING count(*) > 2)
    """,
)
def min_obs_filter(spark, sf_dir):
    return pp.filter_series(event_days(spark, sf_dir), 2).withColumn("y", F.round("y", 2))


@query(
    "eligible_panel",
    f"""
    WITH {DEMAND}
    SELECT unique_id, ds, y FROM demand
    WHERE unique_id IN (SELECT unique_id FROM demand GROUP BY unique_id HAVING count(*) >= 24)
    """,
)
def eligible_panel(spark, sf_dir):
    panel = demand(spark, sf_dir)
    return pp.semi_join_ids(panel, pp.flag_history(panel, 24).where("is_eligible"))


@query(
    "anti_join_unscored",
    f"""
    WITH {DEMAND}
    SELECT unique_id, ds, y FROM demand
    WHERE unique_id NOT IN (SELECT unique_id FROM demand GROUP BY unique_id HAVING count(*) >= 24)
    """,
)
def anti_join_unscored(spark, sf_dir):
    panel = demand(spark, sf_dir)
    return pp.anti_join_ids(panel, pp.flag_history(panel, 24).where("is_eligible"))


@query(
    "holdout_split",
    f"""
    WITH {DEMAND}, ranked AS (
      SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY ds DESC) AS rn,
             count(*) OVER (PARTITION BY unique_id) AS n FROM demand
    )
    SELECT unique_id, ds, y, rn <= 12 AS is_valid FROM ranked WHERE n > 12
    """,
)
def holdout_split(spark, sf_dir):
    return pp.holdout_split(demand(spark, sf_dir), 12)


@query(
    "holdout_split_raw",
    """
    WITH ranked AS (
      SELECT event_type AS unique_id, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) AS rn,
             count(*) OVER (PARTITION BY event_type) AS n
      FROM events
    )
    SELECT unique_id, event_id, rn <= 100 AS is_valid FROM ranked WHERE n > 100
    """,
)
def holdout_split_raw(spark, sf_dir):
    """Raw rows with very long series: no series is ever sorted in one task."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("unique_id"), F.col("ts").alias("ds"), "event_id"
    )
    return pp.holdout_split(events, 100, bounded=False).drop("ds")


@query(
    "short_series_filter_raw",
    f"""
    WITH {DEMAND_RAW}
    SELECT unique_id, CAST(count(*) AS BIGINT) AS n FROM demand_raw GROUP BY unique_id HAVING count(*) > 30
    """,
)
def short_series_filter_raw(spark, sf_dir):
    kept = pp.filter_series(demand_raw(spark, sf_dir), 30, bounded=False)
    return kept.groupBy("unique_id").agg(F.count("*").alias("n"))


@query(
    "recency_rank",
    f"""
    WITH {DEMAND}
    SELECT unique_id, ds, y, CAST(row_number() OVER (PARTITION BY unique_id ORDER BY ds DESC) AS BIGINT) AS rn
    FROM demand
    """,
)
def recency_rank(spark, sf_dir):
    return pp.recency_rank(demand(spark, sf_dir)).withColumn("rn", F.col("rn").cast("bigint"))


@query(
    "series_position",
    f"""
    WITH {DEMAND}
    SELECT unique_id, ds, y, CAST(row_number() OVER (PARTITION BY unique_id ORDER BY ds) AS BIGINT) AS position
    FROM demand
    """,
)
def series_position(spark, sf_dir):
    return pp.series_position(demand(spark, sf_dir)).withColumn("position", F.col("position").cast("bigint"))


@query(
    "top_k_per_series",
    f"""
    WITH {DEMAND}, ranked AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY unique_id ORDER BY ds DESC) AS BIGINT) AS rn FROM demand
    )
    SELECT unique_id, ds, y, rn FROM ranked WHERE rn <= 3
    """,
)
def top_k_per_series(spark, sf_dir):
    return pp.top_k_per_series(demand(spark, sf_dir), 3).withColumn("rn", F.col("rn").cast("bigint"))


@query(
    "tail_rows",
    f"WITH {SALES} SELECT unique_id, ds, round(y, 2) AS y FROM sales ORDER BY unique_id DESC, sales.ds DESC LIMIT 250",
)
def tail_rows(spark, sf_dir):
    return pp.tail_rows(sales(spark, sf_dir), 250).withColumn("y", F.round("y", 2))


@query(
    "sort_panel",
    f"WITH {DEMAND} SELECT unique_id, ds, y FROM demand ORDER BY unique_id, ds",
)
def sort_panel(spark, sf_dir):
    return pp.sort_panel(demand(spark, sf_dir))


@query(
    "lag_features",
    f"""
    WITH {SALES}
    SELECT unique_id, ds, round(y, 2) AS y, round(lag(y, 1) OVER w, 2) AS lag1, round(lag(y, 2) OVER w, 2) AS lag2,
           round(lag(y, 12) OVER w, 2) AS lag12
    FROM sales WINDOW w AS (PARTITION BY unique_id ORDER BY ds)
    """,
)
def lag_features(spark, sf_dir):
    out = build_features(sales(spark, sf_dir), FeatureSpec([1, 2, 12]))
    return out.select("unique_id", "ds", *[F.round(c, 2).alias(c) for c in ("y", "lag1", "lag2", "lag12")])


def _rolling_sql(lag: int, size: int) -> str:
    frame = f"OVER (PARTITION BY unique_id ORDER BY ds ROWS BETWEEN {lag + size - 1} PRECEDING AND {lag} PRECEDING)"
    return (
        f"round(CASE WHEN count(y) {frame} = {size} THEN avg(y) {frame} END, 3)"
        f" AS rolling_mean_lag{lag}_window_size{size}"
    )


_ROLLING = [(1, 3), (1, 6), (1, 12), (12, 3)]


@query(
    "rolling_features",
    f"WITH {DEMAND} SELECT unique_id, ds, y, " + ", ".join(_rolling_sql(k, w) for k, w in _ROLLING) + " FROM demand",
)
def rolling_features(spark, sf_dir):
    spec = FeatureSpec([], default_lag_transforms([1, 12]))
    out = build_features(demand(spark, sf_dir), spec)
    return out.select("unique_id", "ds", "y", *[F.round(c, 3).alias(c) for c in spec.columns])


@query(
    "date_features",
    """
    SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month,
           CAST(week(o_orderdate) AS BIGINT) AS week, CAST(day(o_orderdate) AS BIGINT) AS day,
           CAST(isodow(o_orderdate) - 1 AS BIGINT) AS dayofweek, CAST(dayofyear(o_orderdate) AS BIGINT) AS dayofyear,
           CAST(quarter(o_orderdate) AS BIGINT) AS quarter, CAST(dayofweek(o_orderdate) + 1 AS BIGINT) AS sql_dayofweek
    FROM orders
    """,
)
def date_features(spark, sf_dir):
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        *[date_feature(name, day).alias(name) for name in DATE_FEATURES],
        F.dayofweek(day).cast("bigint").alias("sql_dayofweek"),
    )


@query(
    "build_features",
    f"""
    WITH {DEMAND}, featured AS (
      SELECT unique_id, ds, y, lag(y, 1) OVER w AS lag1, lag(y, 12) OVER w AS lag12,
             {", ".join(_rolling_sql(k, w) for k, w in _ROLLING)},
             CAST(month(ds) AS BIGINT) AS month, CAST(quarter(ds) AS BIGINT) AS quarter, CAST(year(ds) AS BIGINT) AS year
      FROM demand WINDOW w AS (PARTITION BY unique_id ORDER BY ds)
    )
    SELECT * FROM featured WHERE lag12 IS NOT NULL AND rolling_mean_lag1_window_size12 IS NOT NULL
      AND rolling_mean_lag12_window_size3 IS NOT NULL
    """,
)
def build_features_query(spark, sf_dir):
    spec = FeatureSpec([1, 12], default_lag_transforms([1, 12]), ["month", "quarter", "year", "unknown"])
    out = build_features(demand(spark, sf_dir), spec, drop_incomplete=True)
    return out.withColumns({c: F.round(c, 3) for c in spec.columns if c.startswith("rolling")})


def _future_sql(panel: str, step: str, h: int, roll: str = "max(ds)") -> str:
    return f"""
    WITH {panel}, last AS (SELECT unique_id, {roll} AS last_ds FROM source GROUP BY unique_id),
    steps AS (SELECT unnest(range(1, {h} + 1)) AS k)
    SELECT unique_id, {step} AS ds, CAST(k AS BIGINT) AS step FROM last CROSS JOIN steps
    """


_FUTURE_SALES = SALES + ", source AS (SELECT * FROM sales)"
_FUTURE_DAYS = EVENT_DAYS + ", source AS (SELECT * FROM event_days)"


@query(
    "future_dates_monthly",
    _future_sql(_FUTURE_SALES, "CAST(last_ds + to_months(CAST(k AS INTEGER)) AS DATE)", 12),
)
def future_dates_monthly(spark, sf_dir):
    return pp.future_dates(sales(spark, sf_dir), 12, "MS").withColumn("step", F.col("step").cast("bigint"))


@query(
    "future_dates_daily",
    _future_sql(_FUTURE_DAYS, "CAST(last_ds + to_days(CAST(k AS INTEGER)) AS DATE)", 7),
)
def future_dates_daily(spark, sf_dir):
    return pp.future_dates(event_days(spark, sf_dir), 7, "D").withColumn("step", F.col("step").cast("bigint"))


@query(
    "future_dates_weekly",
    _future_sql(
        _FUTURE_DAYS,
        "CAST(date_trunc('week', last_ds) + to_days(CAST(CASE WHEN isodow(last_ds) = 7 THEN 6 ELSE -1 END + 7 * k AS INTEGER))"
        " AS DATE)",
        4,
    ),
)
def future_dates_weekly(spark, sf_dir):
    """Last days off the weekly grid roll to the next Sunday first."""
    return pp.future_dates(event_days(spark, sf_dir), 4, "W").withColumn("step", F.col("step").cast("bigint"))


@query(
    "future_dates_hourly",
    """
    WITH last AS (SELECT event_type AS unique_id, date_trunc('hour', max(ts)) AS last_ds FROM events GROUP BY 1),
    steps AS (SELECT unnest(range(1, 25)) AS k)
    SELECT unique_id, CAST(last_ds + to_hours(k) AS TIMESTAMP) AS ds, CAST(k AS BIGINT) AS step FROM last CROSS JOIN steps
    """,
)
def future_dates_hourly(spark, sf_dir):
    hourly = pp.aggregate_period(event_raw(spark, sf_dir, by_user=False), "H")
    return pp.future_dates(hourly, 24, "H").withColumn("step", F.col("step").cast("bigint"))


@query(
    "calendar_steps",
    """
    SELECT o_orderkey, CAST(date_trunc('quarter', o_orderdate) + INTERVAL 6 MONTH AS DATE) AS two_quarters,
           CAST(date_trunc('year', o_orderdate) + INTERVAL 3 YEAR AS DATE) AS three_years,
           CAST(date_trunc('week', o_orderdate) + INTERVAL 6 DAY AS DATE) AS week_label
    FROM orders
    """,
)
def calendar_steps(spark, sf_dir):
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        next_period(day, 2, "QS").alias("two_quarters"),
        next_period(day, 3, "YS").alias("three_years"),
        floor_period(day, "W").alias("week_label"),
    )


@query(
    "series_layout",
    f"""
    WITH {DEMAND}
    SELECT unique_id, CAST(count(*) AS BIGINT) AS n, min(ds) AS first_ds, max(ds) AS last_ds,
           arg_min(y, ds) AS first_y, arg_max(y, ds) AS last_y
    FROM demand GROUP BY unique_id
    """,
)
def series_layout(spark, sf_dir):
    rows = series_rows(demand(spark, sf_dir))
    return rows.select(
        "unique_id",
        F.col("n").cast("bigint").alias("n"),
        F.element_at("dates", 1).alias("first_ds"),
        F.element_at("dates", -1).alias("last_ds"),
        F.element_at("values", 1).alias("first_y"),
        F.element_at("values", -1).alias("last_y"),
    )


_SHARDS = 7
_GREEDY = f"""
{DEMAND},
counts AS (SELECT unique_id, CAST(count(*) AS BIGINT) AS n_obs FROM demand GROUP BY unique_id),
ordered AS MATERIALIZED (SELECT n_obs, row_number() OVER (ORDER BY n_obs DESC) AS i FROM counts),
picks AS (
  SELECT 0 AS i, list_transform(range({_SHARDS}), lambda s: CAST(0 AS BIGINT)) AS loads,
         CAST(NULL AS BIGINT) AS n_obs, CAST(NULL AS BIGINT) AS shard
  UNION ALL
  SELECT i, list_transform(range({_SHARDS}), lambda s: loads[s + 1] + CASE WHEN s = pick THEN n_obs ELSE 0 END),
         n_obs, pick
  FROM (
    SELECT o.i, p.loads, o.n_obs, list_position(p.loads, list_min(p.loads)) - 1 AS pick
    FROM picks p JOIN ordered o ON o.i = p.i + 1
  )
)"""


@query(
    "balanced_shards",
    f"""
    WITH RECURSIVE {_GREEDY},
    taken AS (SELECT n_obs, shard, count(*) AS c FROM picks WHERE n_obs IS NOT NULL GROUP BY 1, 2),
    runs AS (SELECT n_obs, shard, c, sum(c) OVER (PARTITION BY n_obs ORDER BY shard) AS upto FROM taken),
    ranked AS (
      SELECT unique_id, n_obs,
             row_number() OVER (PARTITION BY n_obs ORDER BY substr(md5(unique_id), 1, 3), unique_id) AS r FROM counts
    )
    SELECT unique_id, ranked.n_obs, CAST(shard AS BIGINT) AS shard
    FROM ranked JOIN runs ON ranked.n_obs = runs.n_obs AND r <= upto AND r > upto - c
    """,
)
def balanced_shards_query(spark, sf_dir):
    return balanced_shards(demand(spark, sf_dir), _SHARDS).withColumn("shard", F.col("shard").cast("bigint"))


@query(
    "shard_loads",
    f"""
    WITH RECURSIVE {_GREEDY}
    SELECT CAST(shard AS BIGINT) AS shard, CAST(count(*) AS BIGINT) AS series, CAST(sum(n_obs) AS BIGINT) AS rows
    FROM picks WHERE shard IS NOT NULL GROUP BY shard
    """,
)
def shard_loads_query(spark, sf_dir):
    loads = shard_loads(balanced_shards(demand(spark, sf_dir), _SHARDS))
    return loads.withColumn("shard", F.col("shard").cast("bigint"))


@query(
    "tag_run_columns",
    f"""
    WITH {TYPE_DAYS}
    SELECT unique_id, ds, round(y, 2) AS y, TIMESTAMP '2024-02-01 00:00:00' AS run_ts, 'naive' AS model_type,
           'events' AS source_table, 'D' AS forecast_freq, CAST(2 AS BIGINT) AS horizon,
           'demo' AS model_display_name, true AS is_future
    FROM type_days
    """,
)
def tag_run_columns(spark, sf_dir):
    days = event_days(spark, sf_dir, by_user=False).withColumn("y", F.round("y", 2))
    tagged = pp.tag_run_columns(days, dt.datetime(2024, 2, 1), "naive", "events", "D", 2, "demo", True)
    return pp.project_output(
        tagged.withColumn("run_ts", F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")),
        [
            "unique_id", "ds", "y", "run_ts", "model_type", "source_table",
            "forecast_freq", "horizon", "model_display_name", "is_future",
        ],
    )
