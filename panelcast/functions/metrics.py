"""Forecast error measures as aggregate columns.

Three rules exist for a zero denominator of WMAPE and are kept apart:
``wmape`` gives NULL, ``wmape_percent`` gives 0 and ``wmape_floored`` divides by
a small floor.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def settled(value: Column) -> Column:
    """The value to twelve significant digits, so that the last ones, which depend on the order of sums, decide nothing."""
    size = F.abs(value)
    scale = F.pow(F.lit(10.0), 11 - F.floor(F.log10(size)))
    return F.when((size > 1e-290) & (size < 1e290), F.rint(value * scale) / scale).otherwise(value)


def round_scaled(value: Column, digits: int) -> Column:
    """Half away from zero, judged on the scaled double as SQL engines do, not on its shortest decimal form."""
    scale = 10.0**digits
    return F.signum(value) * F.floor(F.abs(value) * scale + 0.5) / scale


def rmse(y: Column, yhat: Column) -> Column:
    return F.sqrt(F.avg(F.pow(y - yhat, F.lit(2.0))))


def mae(y: Column, yhat: Column) -> Column:
    return F.avg(F.abs(y - yhat))


def wmape(y: Column, yhat: Column) -> Column:
    return F.try_divide(F.sum(F.abs(y - yhat)), F.sum(F.abs(y)))


def wmape_percent(y: Column, yhat: Column) -> Column:
    total = F.coalesce(F.sum(F.abs(y)), F.lit(0.0))
    error = F.coalesce(F.sum(F.abs(y - yhat)), F.lit(0.0))
    return F.when(total > 0, 100.0 * F.try_divide(error, total)).otherwise(F.lit(0.0))


def wmape_floored(y: Column, yhat: Column, floor: float = 1e-9) -> Column:
    return F.sum(F.abs(y - yhat)) / F.greatest(F.sum(F.abs(y)), F.lit(floor))
