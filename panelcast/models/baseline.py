"""Naive models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelcast.functions.arrays import at, constant, steps


def naive(y: Column, h: int, m: int) -> Column:
    return constant(at(y, F.size(y) - 1), h)


def seasonal_naive(y: Column, h: int, m: int) -> Column:
    """Repeat the last season; NULL when less than one season is known."""
    return F.when(
        F.size(y) >= m,
        F.transform(steps(h), lambda k: at(y, F.size(y) - m + (k - 1) % m)),
    )
