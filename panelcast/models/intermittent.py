"""Croston family and temporal aggregation (ADIDA, IMAPA).

Simple exponential smoothing starts at the first value. The optimised variants
search the smoothing weight on a 0.01 grid over [0.1, 0.3].
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from panelcast.functions.arrays import at, best, constant, let
from panelcast.models.ses_grid import croston_batch, fit_batch, rates_batch
from panelcast.staging import ship

ALPHA = 0.1
ALPHA_GRID = [round(0.10 + 0.01 * i, 2) for i in range(21)]


def ses_run(x: Column, alpha: Column) -> Column:
    """struct(level, sse) after smoothing all of ``x`` with one weight."""
    start = F.struct(at(x, 0).alias("level"), F.lit(0.0).alias("sse"))

    # The error is written out twice: inside a fold that is cheaper than binding it.
    def smooth(s: Column, v: Column) -> Column:
        e = v - s["level"]
        return F.struct((s["level"] + alpha * e).alias("level"), (s["sse"] + e * e).alias("sse"))

    return F.aggregate(x, start, smooth)


def ses_level(x: Column, alpha: float = ALPHA) -> Column:
    return F.aggregate(x, at(x, 0), lambda level, v: level + F.lit(alpha) * (v - level))


def ses_best(x: Column, grid: list[float] = ALPHA_GRID) -> Column:
    """struct(sse, alpha, level) of the weight with the least squared one-step error."""
    alphas = F.expr(f"array({', '.join(f'{a}D' for a in grid)})")
    return let(
        x,
        lambda v: F.when(
            F.size(v) > 0,
            best(
                F.transform(
                    alphas,
                    lambda a: let(
                        ses_run(v, a),
                        lambda s: F.struct(s["sse"].alias("sse"), a.alias("alpha"), s["level"].alias("level")),
                    ),
                )
            ),
        ),
    )


def ses_fit(x: Column, grid: list[float] = ALPHA_GRID) -> Column:
    """The same as :func:`ses_best` for batches of series; not inside of array functions."""
    ship(SparkSession.active())

    @F.arrow_udf("sse double, alpha double, level double")
    def fit(values: pa.Array) -> pa.Array:
        return fit_batch(values, grid)

    return fit(x.cast("array<double>"))


def demand(y: Column) -> Column:
    return F.filter(y, lambda v: v != 0)


def intervals(y: Column) -> Column:
    """Steps between non-zero values; the first counts from the start of the series."""
    positions = F.filter(F.transform(y, lambda v, i: F.when(v != 0, i + 1)), lambda p: p.isNotNull())
    return let(
        positions,
        lambda p: F.transform(p, lambda v, i: (v - F.coalesce(F.get(p, i - 1), F.lit(0))).cast("double")),
    )


def _rate(size_level: Column, interval_level: Column) -> Column:
    return F.when(interval_level != 0, size_level / interval_level).otherwise(size_level)


def _croston(y: Column, h: int, level, factor: float = 1.0) -> Column:
    rate = let(level(demand(y)), lambda z: let(level(intervals(y)), lambda p: _rate(z, p)))
    return constant(F.coalesce(rate * F.lit(factor), F.lit(0.0)), h)


def croston(y: Column, h: int, m: int) -> Column:
    return _croston(y, h, ses_level)


def croston_sba(y: Column, h: int, m: int) -> Column:
    return _croston(y, h, ses_level, factor=0.95)


def croston_optimized(y: Column, h: int, m: int) -> Column:
    ship(SparkSession.active())
    alphas = ALPHA_GRID

    @F.arrow_udf("double")
    def rates(values: pa.Array) -> pa.Array:
        return croston_batch(values, alphas)

    return constant(F.coalesce(rates(y.cast("array<double>")), F.lit(0.0)), h)


def _aggregated(y: Column, h: int, all_levels: bool) -> Column:
    ship(SparkSession.active())
    alphas = ALPHA_GRID

    @F.arrow_udf("double")
    def rates(values: pa.Array) -> pa.Array:
        return rates_batch(values, alphas, all_levels)

    return constant(F.coalesce(rates(y.cast("array<double>")), F.lit(0.0)), h)


def adida(y: Column, h: int, m: int) -> Column:
    """Smoothed sums over the average interval, rounded half to even."""
    return _aggregated(y, h, all_levels=False)


def imapa(y: Column, h: int, m: int) -> Column:
    """The mean of the rates from sums over 1, 2, ... periods up to the average interval."""
    return _aggregated(y, h, all_levels=True)
