"""Panels derived from the test tables, in Spark and as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.operators.prepare import aggregate_period
from panelcast.sources.panel import read_mapped_panel


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a product-like id ``segment_nation``, as a user table with its own column names."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .select(
            F.concat_ws("_", "c_mktsegment", "n_name").alias("product_id"),
            F.col("o_orderdate").alias("date"),
            F.col("o_totalprice").alias("sales"),
        )
    )


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_mapped_panel(spark, sales_source(spark, sf_dir), "product_id", "date", "sales")


def sales(spark: SparkSession, sf_dir: str, freq: str = "MS") -> DataFrame:
    return aggregate_period(sales_raw(spark, sf_dir), freq)


def demand_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate", "l_quantity")
    return lines.join(part, lines.l_partkey == part.p_partkey).select(
        F.concat_ws("_", "p_brand", "l_partkey").alias("product_id"),
        F.col("l_shipdate").alias("date"),
        F.col("l_quantity").alias("quantity"),
    )


def demand_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_mapped_panel(spark, demand_source(spark, sf_dir), "product_id", "date", "quantity")


def demand(spark: SparkSession, sf_dir: str, freq: str = "MS") -> DataFrame:
    return aggregate_period(demand_raw(spark, sf_dir), freq)


def event_raw(spark: SparkSession, sf_dir: str, by_user: bool = True) -> DataFrame:
    events = table(spark, sf_dir, "events")
    uid = F.concat_ws("_", "event_type", "user_id") if by_user else F.col("event_type")
    return events.select(uid.alias("unique_id"), F.col("ts").alias("ds"), F.col("value").alias("y"))


def event_days(spark: SparkSession, sf_dir: str, by_user: bool = True) -> DataFrame:
    return aggregate_period(event_raw(spark, sf_dir, by_user), "D")


def flag_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_suppkey", "l_shipdate", "l_extendedprice")
    raw = lines.select(
        F.concat_ws("_", "l_returnflag", "l_suppkey").alias("unique_id"),
        F.to_date("l_shipdate").alias("ds"),
        F.col("l_extendedprice").alias("y"),
    )
    return aggregate_period(raw, "MS")


# -- the same panels in SQL -------------------------------------------------------------------

SALES_RAW = """
sales_raw AS (
  SELECT concat(c_mktsegment, '_', n_name) AS unique_id, CAST(o_orderdate AS DATE) AS ds,
         o_totalprice AS y, c_mktsegment AS sys_id
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE o_orderdate IS NOT NULL AND o_totalprice IS NOT NULL
)"""

SALES = (
    SALES_RAW
    + """,
sales AS (
  SELECT unique_id, CAST(date_trunc('month', ds) AS DATE) AS ds, sum(y) AS y
  FROM sales_raw GROUP BY 1, 2
)"""
)

DEMAND_RAW = """
demand_raw AS (
  SELECT concat(p_brand, '_', l_partkey) AS unique_id, CAST(l_shipdate AS DATE) AS ds,
         l_quantity AS y, p_brand AS sys_id
  FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE l_shipdate IS NOT NULL AND l_quantity IS NOT NULL
)"""

DEMAND = (
    DEMAND_RAW
    + """,
demand AS (
  SELECT unique_id, CAST(date_trunc('month', ds) AS DATE) AS ds, sum(y) AS y
  FROM demand_raw GROUP BY 1, 2
)"""
)

EVENT_RAW = """
event_raw AS (
  SELECT concat(event_type, '_', user_id) AS unique_id, ts AS ds, value AS y FROM events
)"""

EVENT_DAYS = (
    EVENT_RAW
    + """,
event_days AS (
  SELECT unique_id, CAST(ds AS DATE) AS ds, sum(y) AS y FROM event_raw GROUP BY 1, 2
)"""
)

TYPE_DAYS = """
type_days AS (
  SELECT event_type AS unique_id, CAST(ts AS DATE) AS ds, sum(value) AS y FROM events GROUP BY 1, 2
)"""


def split_sql(panel: str, h: int, min_history: int = 0) -> str:
    """CTEs ``train``, ``valid`` and ``ahead`` (calendar steps after the training end)."""
    return f"""
numbered AS (
  SELECT unique_id, ds, y,
         row_number() OVER (PARTITION BY unique_id ORDER BY ds DESC) AS rn,
         count(*) OVER (PARTITION BY unique_id) AS n
  FROM {panel}
),
train AS (
  SELECT unique_id, ds, y, row_number() OVER (PARTITION BY unique_id ORDER BY ds) AS t, n - {h} AS n
  FROM numbered WHERE rn > {h} AND n > {h} AND n >= {min_history}
),
valid AS (
  SELECT unique_id, ds, y FROM numbered WHERE rn <= {h} AND n > {h} AND n >= {min_history}
),
train_end AS (SELECT unique_id, max(ds) AS last_ds, max(n) AS n FROM train GROUP BY unique_id),
ahead AS (
  SELECT unique_id, k, CAST(last_ds + to_months(CAST(k AS INTEGER)) AS DATE) AS ds, n
  FROM train_end CROSS JOIN (SELECT unnest(range(1, {h} + 1)) AS k)
)"""
