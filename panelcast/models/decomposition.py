"""Additive seasonal decomposition by centred moving averages, and the forecast built on it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelcast.functions.arrays import at, let, mean, steps, total
from panelcast.models.autoregression import arima


def centred_average(y: Column, m: int) -> Column:
    """Moving average over one season; NULL where the window leaves the series."""
    half = m // 2
    n = F.size(y)

    def window(i: Column) -> Column:
        inside = total(F.slice(y, i - half + 1, 2 * half + 1))
        if m % 2 == 0:
            inside = inside - (F.get(y, i - half) + F.get(y, i + half)) / 2.0
        return inside / m

    return F.transform(y, lambda v, i: F.when((i >= half) & (i + half < n), window(i)))


def seasonal_means(y: Column, m: int) -> Column:
    """``m`` seasonal effects that sum to zero, for positions 0..m-1 of the series."""

    def effects(detrended: Column) -> Column:
        return F.transform(
            steps(m),
            lambda j: mean(
                F.filter(F.transform(detrended, lambda v, i: F.when(i % m == j - 1, v)), lambda v: v.isNotNull())
            ),
        )

    def centre(raw: Column) -> Column:
        return let(mean(raw), lambda c: F.transform(raw, lambda v: v - c))

    detrended = let(centred_average(y, m), lambda t: F.zip_with(y, t, lambda a, b: a - b))
    return let(let(detrended, effects), centre)


def deseasonalise(y: Column, seasonal: Column, m: int) -> Column:
    return F.transform(y, lambda v, i: v - F.get(seasonal, i % m))


def mstl(y: Column, h: int, m: int | list[int]) -> Column:
    """Remove each seasonal pattern in turn, forecast the rest, add the patterns back.

    A period needs two full seasons of data; shorter series skip it.
    """
    periods = sorted({p for p in (m if isinstance(m, list) else [m]) if p > 1})

    def forecast(rest: Column, remaining: list[int]) -> Column:
        if not remaining:
            return arima(rest, h, 1)
        p = remaining[0]
        flat = F.array_repeat(F.lit(0.0), p)
        pattern = F.when(F.size(rest) >= 2 * p, seasonal_means(rest, p)).otherwise(flat)
        return let(
            pattern,
            lambda s: let(
                deseasonalise(rest, s, p),
                lambda d: let(
                    forecast(d, remaining[1:]),
                    lambda f: F.transform(f, lambda v, k: v + at(s, (F.size(rest) + k) % p)),
                ),
            ),
        )

    return forecast(y, periods)
