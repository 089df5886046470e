"""ARCH and GARCH with a constant mean.

ARCH(p) regresses squared residuals on their lags (Engle 1982). GARCH(p, q)
targets the sample variance and searches the summed weights on a grid for the
highest Gaussian likelihood (Bollerslev 1986). The point forecast is the mean;
the variance path is available on its own.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from panelcast.functions.arrays import constant, least_squares, let, mean, steps, tail
from panelcast.models.autoregression import lagged
from panelcast.models.garch_grid import fit_batch
from panelcast.staging import ship

ALPHA_SUMS = [0.05, 0.1, 0.15, 0.2]
BETA_SUMS = [0.3, 0.5, 0.7, 0.75, 0.8, 0.9]
GARCH_GRID = [(a, b) for a in ALPHA_SUMS for b in BETA_SUMS if a + b < 0.999]


def mean_forecast(y: Column, h: int, m: int) -> Column:
    return constant(mean(y), h)


def squared_residuals(y: Column) -> Column:
    return let(mean(y), lambda mu: F.transform(y, lambda v: (v - mu) * (v - mu)))


def arch_coefficients(y: Column, p: int) -> Column:
    """[omega, alpha_1 .. alpha_p]; NULL entries when they are not identified."""
    return let(
        squared_residuals(y),
        lambda e2: least_squares([lagged(e2, i, p) for i in range(1, p + 1)], lagged(e2, 0, p)),
    )


def arch_variance(y: Column, h: int, p: int) -> Column:
    def extend(coef: Column):
        def step(past: Column, _: Column) -> Column:
            value = F.get(coef, F.lit(0))
            for i in range(1, p + 1):
                value = value + F.get(coef, F.lit(i)) * F.get(past, F.size(past) - i)
            return F.concat(past, F.array(F.greatest(value, F.lit(0.0))))

        return step

    return let(
        arch_coefficients(y, p),
        lambda coef: tail(F.aggregate(steps(h), tail(squared_residuals(y), p), extend(coef)), h),
    )


_FIT = (
    "nll double, alpha double, beta double, omega double, variance double, "
    "e2 array<double>, s2 array<double>, path array<double>"
)


def garch_fit(y: Column, p: int, q: int, h: int = 0) -> Column:
    """struct(nll, alpha, beta, omega, variance, e2, s2, path) of the best grid point; ``path`` holds ``h`` variances.

    All grid points of a batch of series advance together, one period at a time: as a projection of array
    expressions every step of every point was interpreted on its own.
    """
    ship(SparkSession.active())
    points = GARCH_GRID

    @F.arrow_udf(_FIT)
    def fit(values: pa.Array) -> pa.Array:
        return fit_batch(values, points, p, q, h)

    return fit(y.cast("array<double>"))


def garch_variance(y: Column, h: int, p: int, q: int) -> Column:
    return garch_fit(y, p, q, h)["path"]


def arch(y: Column, h: int, m: int) -> Column:
    return mean_forecast(y, h, m)


def garch(y: Column, h: int, m: int) -> Column:
    return mean_forecast(y, h, m)
