"""Synthetic panels for trials at any scale."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SYSTEMS = 21
ACCOUNTS = 66


def target(sys_id: Column, account_id: Column, date: Column, start: Column, noise: Column | None = None) -> Column:
    """Level per system and account, linear trend, yearly and weekly waves, optional noise."""
    turn = F.lit(2.0) * F.acos(F.lit(-1.0))
    value = (
        F.lit(100.0)
        + F.lit(2.5) * sys_id
        + F.lit(1.1) * (account_id % 17)
        + F.lit(0.03) * F.date_diff(date, start)
        + F.lit(18.0) * F.cos(turn * F.dayofyear(date) / F.lit(365.25))
        + F.lit(6.0) * F.cos(turn * F.dayofweek(date) / F.lit(7.0))
    )
    if noise is not None:
        value = value + noise * F.lit(8.0)
    return F.round(F.greatest(F.lit(0.0), value), 2)


def uniform_noise(seed: int, *keys: Column) -> Column:
    """Number in [0, 1) that depends on the row's keys only, so a recomputed task gives the same rows."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 30)) / F.lit(float(1 << 30))


def panel_for_accounts(accounts: DataFrame, start: Column, end: Column, seed: int | None = None) -> DataFrame:
    """One row per account and day; ``accounts`` holds ``sys_id, account_id`` (and any bound columns).

    A few account rows grow into many days, so they are spread over all cores first.
    """
    spread = accounts.sparkSession.sparkContext.defaultParallelism * 4
    daily = (
        accounts.repartition(spread, "sys_id", "account_id")
        .withColumns({"unique_id": F.format_string("SYS%02d_ACC%04d", "sys_id", "account_id"), "start_date": start})
        .select(
            "sys_id", "account_id", "unique_id", "start_date", F.explode(F.sequence(start, end)).alias("date")
        )
    )
    noise = None if seed is None else uniform_noise(seed, F.col("sys_id"), F.col("account_id"), F.col("date"))
    return daily.select(
        "sys_id",
        "account_id",
        "unique_id",
        "date",
        target(F.col("sys_id"), F.col("account_id"), F.col("date"), F.col("start_date"), noise).alias("target"),
    )


def generate_panel(
    spark: SparkSession,
    start: dt.date,
    end: dt.date,
    num_systems: int = SYSTEMS,
    num_accounts: int = ACCOUNTS,
    seed: int | None = 42,
) -> DataFrame:
    """Every system x account x day.

    The pairs come from one range split by division, so no side of a cross join
    has to be sent to all executors.
    """
    if end < start:
        raise ValueError("the end date must not be before the start date")
    if num_accounts < 1 or num_systems < 1:
        raise ValueError("need at least one system and one account")
    pairs = spark.range(num_systems * num_accounts).select(
        (F.floor(F.col("id") / num_accounts) + 1).cast("bigint").alias("sys_id"),
        (F.col("id") % num_accounts + 1).alias("account_id"),
    )
    return panel_for_accounts(pairs, F.lit(start), F.lit(end), seed)


def expected_rows(start: dt.date, end: dt.date, num_systems: int = SYSTEMS, num_accounts: int = ACCOUNTS) -> int:
    return math.prod((num_systems, num_accounts, (end - start).days + 1))
