"""Theta method and exponential smoothing state-space models chosen by AICc on a parameter grid."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from panelcast.functions.arrays import at, let, mean, steps
from panelcast.models.ets_grid import fit_batch
from panelcast.models.intermittent import ses_best, ses_fit
from panelcast.staging import ship

THETA_GRID = [round(0.05 * i, 2) for i in range(1, 20)]


def trend_line(y: Column) -> Column:
    """struct(slope, intercept) of ``y`` on 0..n-1; slope 0 for a single point."""
    n = F.size(y)
    tbar = (n - 1) / 2.0
    sxx = n * (F.pow(n.cast("double"), F.lit(2.0)) - 1.0) / 12.0
    weighted = F.aggregate(
        F.transform(y, lambda v, i: (i.cast("double") - tbar) * v), F.lit(0.0), lambda acc, v: acc + v
    )
    return let(
        F.struct(F.coalesce(F.try_divide(weighted, sxx), F.lit(0.0)).alias("slope"), mean(y).alias("ybar")),
        lambda s: F.struct(s["slope"].alias("slope"), (s["ybar"] - s["slope"] * tbar).alias("intercept")),
    )


def theta(y: Column, h: int, m: int) -> Column:
    """Two-line theta forecast: smoothing plus half of the linear trend as drift."""

    def path(slope: Column, fit: Column) -> Column:
        a = fit["alpha"]
        warm = (F.lit(1.0) - F.pow(F.lit(1.0) - a, F.size(y).cast("double"))) / a
        return F.transform(steps(h), lambda k: fit["level"] + slope / 2.0 * (k - 1 + warm))

    both = F.struct(trend_line(y)["slope"].alias("slope"), ses_fit(y, THETA_GRID).alias("fit"))
    return let(both, lambda s: path(s["slope"], s["fit"]))


# Smoothing weights searched per model form: (level, trend, damping, season).
_LEVELS = [0.1, 0.3, 0.5, 0.7, 0.9]
_TRENDS = [0.1, 0.3]
_DAMPING = [0.8, 0.98]
_SEASONS = [0.1, 0.3]


def _plain_grid() -> list[tuple]:
    """(parameter count, alpha, beta, phi); a zero phi switches the trend off."""
    level = [(3, a, 0.0, 0.0) for a in _LEVELS]
    trend = [(5, a, round(a * b, 4), 1.0) for a in _LEVELS for b in _TRENDS]
    damped = [(6, a, round(a * b, 4), phi) for a in _LEVELS for b in _TRENDS for phi in _DAMPING]
    return level + trend + damped


def _seasonal_grid(m: int) -> list[tuple]:
    """(parameter count, alpha, beta, phi, gamma)."""
    level = [(m + 3, a, 0.0, 0.0, g) for a in _LEVELS for g in _SEASONS]
    trend = [(m + 5, a, round(a * b, 4), 1.0, g) for a in _LEVELS for b in _TRENDS for g in _SEASONS]
    return level + trend


def aicc(sse: Column, n: Column, k: Column) -> Column:
    """NULL when there are too few points for the parameter count."""
    n = n.cast("double")
    room = n - k - 1.0
    return F.when(
        room > 0,
        n * F.log(F.greatest(sse / n, F.lit(1e-12))) + 2.0 * k + F.try_divide(2.0 * k * (k + 1.0), room),
    )


_FIT = (
    "aicc double, k double, alpha double, beta double, phi double, "
    "level double, trend double, season array<double>"
)


def ets_fit(y: Column, m: int) -> Column:
    """struct(aicc, k, alpha, beta, phi, level, trend, season) of the best form; NULL where none can be scored.

    Non-seasonal forms (level, trend, damped trend) start from the line through the first ten points; additive seasonal
    ones need two full seasons. All grid points of a batch of series advance together, one period at a time.
    """
    ship(SparkSession.active())
    plain, seasonal = _plain_grid(), _seasonal_grid(m) if m > 1 else []

    @F.arrow_udf(_FIT)
    def fit(values: pa.Array) -> pa.Array:
        return fit_batch(values, plain, seasonal, m)

    return fit(y.cast("array<double>"))


def ets_path(fit: Column, h: int) -> Column:
    def damped(k: Column) -> Column:
        phi = fit["phi"]
        powers = F.when(phi == 1.0, k.cast("double")).otherwise(
            F.try_divide(phi * (1.0 - F.pow(phi, k.cast("double"))), 1.0 - phi)
        )
        return F.when(phi > 0, powers * fit["trend"]).otherwise(F.lit(0.0))

    return F.transform(
        steps(h), lambda k: fit["level"] + damped(k) + at(fit["season"], (k - 1) % F.size(fit["season"]))
    )


def ets(y: Column, h: int, m: int) -> Column:
    """Lowest-AICc smoothing model; series too short to score fall back to plain smoothing."""
    fit = ets_fit(y, m)
    fallback = let(
        ses_best(y)["level"], lambda v: F.when(v.isNotNull(), F.array_repeat(v, h))
    )
    return let(fit, lambda f: F.when(f.isNotNull(), ets_path(f, h)).otherwise(fallback))
