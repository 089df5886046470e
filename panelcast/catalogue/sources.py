"""Queries of the panel readers and the generator."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.catalogue.panels import (
    DEMAND,
    SALES,
    SALES_RAW,
    demand,
    event_raw,
    sales,
    sales_source,
    table,
)
from panelcast.catalogue.registry import query
from panelcast.functions.text import is_identifier, tenant_of
from panelcast.operators.prepare import filter_tenant, limit_series, union_parts
from panelcast.sources import panel as src
from panelcast.sources import synthetic


@query(
    "read_panel",
    """
    SELECT concat(event_type, '_', user_id) AS unique_id, CAST(ts AS DATE) AS ds, round(value, 2) AS y
    FROM events WHERE event_type IS NOT NULL AND ts IS NOT NULL AND value IS NOT NULL
    """,
)
def read_panel(spark, sf_dir):
    panel = src.read_panel(spark, event_raw(spark, sf_dir))
    return panel.select("unique_id", F.to_date("ds").alias("ds"), F.round("y", 2).alias("y"))


@query(
    "read_panel_raw",
    """
    SELECT concat(event_type, '_', user_id) AS unique_id, CAST(ts AS DATE) AS ds,
           CASE WHEN value >= 5 THEN round(value, 2) END AS y
    FROM events
    """,
)
def read_panel_raw(spark, sf_dir):
    """Rows without a value stay."""
    with_gaps = event_raw(spark, sf_dir).withColumn("y", F.when(F.col("y") >= 5, F.round("y", 2)))
    return src.read_panel_raw(spark, with_gaps).withColumn("ds", F.to_date("ds"))


@query(
    "read_mapped_panel",
    f"WITH {SALES_RAW} SELECT unique_id, ds, round(y, 2) AS y, sys_id FROM sales_raw WHERE sys_id = 'BUILDING'",
)
def read_mapped_panel(spark, sf_dir):
    return src.read_mapped_panel(
        spark, sales_source(spark, sf_dir), "product_id", "date", "sales", "_", "BUILDING"
    ).withColumn("y", F.round("y", 2))


@query(
    "read_renamed_panel",
    "SELECT event_type AS unique_id, CAST(ts AS DATE) AS ds, round(value, 2) AS y FROM events",
)
def read_renamed_panel(spark, sf_dir):
    source = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("unique_id"), F.to_date("ts").alias("date"), F.round("value", 2).alias("target")
    )
    return src.read_renamed_panel(spark, source)


@query(
    "recent_rows",
    f"WITH {SALES} SELECT unique_id, ds, round(y, 2) AS y FROM sales ORDER BY sales.ds DESC, unique_id LIMIT 1000",
)
def recent_rows(spark, sf_dir):
    return src.recent_rows(sales(spark, sf_dir), 1000).withColumn("y", F.round("y", 2))


@query(
    "scoring_window",
    f"""
    WITH {DEMAND}, ranked AS (
      SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY ds DESC) AS rn FROM demand
    )
    SELECT unique_id, ds, y FROM ranked WHERE rn <= 24
    """,
)
def scoring_window(spark, sf_dir):
    return src.scoring_window(demand(spark, sf_dir), [1, 12], 12)


@query(
    "champion_history",
    """
    SELECT ts AS run_ts, event_type AS champion_model_type, round(value, 2) AS champion_metric_value
    FROM events ORDER BY ts DESC LIMIT 10
    """,
)
def champion_history(spark, sf_dir):
    runs = table(spark, sf_dir, "events").select(
        F.col("ts").alias("run_ts"),
        F.col("event_type").alias("champion_model_type"),
        F.round("value", 2).alias("champion_metric_value"),
    )
    return src.champion_history(spark, runs, 10)


@query("table_row_count", "SELECT CAST(count(*) AS BIGINT) AS row_count FROM lineitem")
def table_row_count(spark, sf_dir):
    return src.table_row_count(spark, f"{sf_dir}/lineitem.parquet")


@query(
    "parameterised_query",
    """
    SELECT event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value), 2) AS total
    FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND event_type <> 'error' GROUP BY event_type
    """,
)
def parameterised_query(spark, sf_dir):
    return src.parameterised_query(
        spark,
        f"""
        SELECT event_type, count(*) AS n, round(sum(value), 2) AS total
        FROM parquet.`{sf_dir}/events.parquet`
        WHERE ts >= CAST(:start AS TIMESTAMP_NTZ) AND event_type <> :excluded GROUP BY event_type
        """,
        start="2024-01-10 00:00:00",
        excluded="error",
    )


@query(
    "split_tenant",
    """
    SELECT concat(p_brand, '.', p_partkey) AS unique_id, p_brand AS sys_id,
           concat('x', p_partkey) AS plain_id, concat('x', p_partkey) AS plain_sys_id
    FROM part
    """,
)
def split_tenant(spark, sf_dir):
    """The delimiter is literal text; an id without it is its own tenant."""
    ids = table(spark, sf_dir, "part").select(
        F.concat_ws(".", "p_brand", "p_partkey").alias("unique_id"), F.concat(F.lit("x"), "p_partkey").alias("plain_id")
    )
    return ids.withColumns(
        {"sys_id": tenant_of(F.col("unique_id"), "."), "plain_sys_id": tenant_of(F.col("plain_id"), ".")}
    )


@query(
    "filter_tenant",
    f"""
    WITH {SALES_RAW} SELECT unique_id, CAST(count(*) AS BIGINT) AS n FROM sales_raw
    WHERE sys_id = 'MACHINERY' GROUP BY unique_id
    """,
)
def filter_tenant_query(spark, sf_dir):
    panel = src.read_mapped_panel(spark, sales_source(spark, sf_dir), "product_id", "date", "sales")
    return filter_tenant(panel, "MACHINERY").groupBy("unique_id").agg(F.count("*").alias("n"))


@query(
    "limit_series",
    f"""
    WITH {DEMAND}, first_ids AS (SELECT DISTINCT unique_id FROM demand ORDER BY unique_id LIMIT 100)
    SELECT unique_id, ds, y FROM demand WHERE unique_id IN (SELECT unique_id FROM first_ids)
    """,
)
def limit_series_query(spark, sf_dir):
    return limit_series(demand(spark, sf_dir), 100)


@query(
    "identifier_check",
    """
    SELECT p_name AS name, regexp_full_match(p_name, '[A-Za-z0-9_]+') AS plain_ok,
           regexp_full_match(replace(p_name, ' ', '_'), '[A-Za-z0-9_]+') AS joined_ok
    FROM part
    """,
)
def identifier_check(spark, sf_dir):
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("name"))
    return names.withColumns(
        {
            "plain_ok": is_identifier(F.col("name")),
            "joined_ok": is_identifier(F.replace(F.col("name"), F.lit(" "), F.lit("_"))),
        }
    )


_ACCOUNT_DAYS = """
accounts AS (
  SELECT c_nationkey + 1 AS sys_id, c_custkey AS account_id,
         CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
),
daily AS (
  SELECT sys_id, account_id, first_day,
         CAST(unnest(generate_series(CAST(first_day AS TIMESTAMP), CAST(last_day AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
           AS day
  FROM accounts
)"""


def account_panel(spark, sf_dir):
    """Every customer with orders is an account, observed from its first to its last order day."""
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.to_date(F.min("o_orderdate")).alias("first_day"), F.to_date(F.max("o_orderdate")).alias("last_day")
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    accounts = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        (F.col("c_nationkey") + 1).alias("sys_id"), F.col("c_custkey").alias("account_id"), "first_day", "last_day"
    )
    return synthetic.panel_for_accounts(accounts, F.col("first_day"), F.col("last_day"))


@query(
    "synthetic_panel",
    f"""
    WITH {_ACCOUNT_DAYS}, points AS (
      SELECT sys_id, printf('SYS%02d_ACC%04d', sys_id, account_id) AS unique_id, day,
             round(greatest(0, 100 + 2.5 * sys_id + 1.1 * (account_id % 17)
                   + 0.03 * date_diff('day', first_day, day)
                   + 18 * cos(2 * acos(-1) * dayofyear(day) / 365.25)
                   + 6 * cos(2 * acos(-1) * (dayofweek(day) + 1) / 7.0)), 2) AS target
      FROM daily
    )
    SELECT unique_id, CAST(count(*) AS BIGINT) AS days, min(day) AS first_day, max(day) AS last_day,
           round(sum(target), 2) AS total, round(max(target), 2) AS top
    FROM points GROUP BY unique_id
    """,
)
def synthetic_panel(spark, sf_dir):
    return (
        account_panel(spark, sf_dir)
        .groupBy("unique_id")
        .agg(
            F.count("*").alias("days"),
            F.min("date").alias("first_day"),
            F.max("date").alias("last_day"),
            F.round(F.sum("target"), 2).alias("total"),
            F.round(F.max("target"), 2).alias("top"),
        )
    )


@query("synthetic_row_count", f"WITH {_ACCOUNT_DAYS} SELECT CAST(count(*) AS BIGINT) AS row_count FROM daily")
def synthetic_row_count(spark, sf_dir):
    return src.table_row_count(spark, account_panel(spark, sf_dir))


@query(
    "union_parts",
    f"""
    WITH {SALES}, {DEMAND}
    SELECT src, CAST(count(*) AS BIGINT) AS n, round(sum(y), 0) AS total
    FROM (SELECT 'sales' AS src, y FROM sales UNION ALL SELECT 'demand' AS src, y FROM demand) GROUP BY src
    """,
)
def union_parts_query(spark, sf_dir):
    parts = [
        sales(spark, sf_dir).withColumn("src", F.lit("sales")),
        demand(spark, sf_dir).withColumn("src", F.lit("demand")),
    ]
    return union_parts(parts).groupBy("src").agg(F.count("*").alias("n"), F.round(F.sum("y"), 0).alias("total"))
