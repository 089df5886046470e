"""Seasonal ARMA models on differenced series, fitted in two stages of least squares.

A long autoregression estimates the innovations; then the series is regressed on its own lags and on theirs. All
orders share one sample and one table of products, so a candidate order is a subset of the same normal equations and
the series is read once, whatever the number of orders. Differences are decided by tests: a seasonal one by the
strength of the seasonal pattern, a plain one by the level-stationarity statistic of Kwiatkowski et al. (1992).

:func:`differences` and :func:`fit` are array expressions over one series; :func:`sarima` takes the same steps for batches
of series in an Arrow function (:mod:`panelcast.models.sarima_grid`).
"""

from __future__ import annotations

from itertools import product

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from panelcast.functions.arrays import at, best, dot, let, steps
from panelcast.models.autoregression import difference, lagged
from panelcast.models.decomposition import centred_average
from panelcast.models.sarima_grid import path_batch
from panelcast.models.smoothing import aicc
from panelcast.staging import ship

#: Lags of the long autoregression.
LONG_ORDER = 3
#: Five per cent point of the stationarity statistic, and the strength from which a season is differenced (fixed values).
STATIONARITY_LIMIT, STRENGTH_LIMIT = 0.463, 0.64
#: Seasonal terms and tests need this many seasons.
SEASONS_NEEDED = 3
#: Coefficients stay this far inside the region where the model is stationary and invertible.
_INSIDE = 0.99


def _average(a: Column) -> Column:
    """Mean of the known values, as one fold: deep nests of bound values would exhaust the analyser's iterations."""
    return F.aggregate(
        F.filter(a, lambda v: v.isNotNull()),
        F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("n")),
        lambda t, v: F.struct((t["s"] + v).alias("s"), (t["n"] + 1.0).alias("n")),
        lambda t: F.try_divide(t["s"], t["n"]),
    )


def _spread(a: Column) -> Column:
    """Variance of the known values, which have a mean near zero."""
    return F.aggregate(
        F.filter(a, lambda v: v.isNotNull()),
        F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("q"), F.lit(0.0).alias("n")),
        lambda t, v: F.struct((t["s"] + v).alias("s"), (t["q"] + v * v).alias("q"), (t["n"] + 1.0).alias("n")),
        lambda t: F.try_divide(t["q"], t["n"]) - F.pow(F.try_divide(t["s"], t["n"]), F.lit(2.0)),
    )


def _centre(y: Column) -> Column:
    return let(_average(y), lambda mu: F.transform(y, lambda v: v - mu))


def stationarity_statistic(y: Column) -> Column:
    """Squared partial sums of the centred series over its long-run variance; near 0 for a constant series.

    The variance weighs autocovariances down linearly to lag ``floor(4 (n / 100)^(1/4))``.
    """

    def statistic(e: Column) -> Column:
        n = F.size(e)
        width = F.floor(4.0 * F.pow(n / 100.0, F.lit(0.25)))
        squares = F.aggregate(
            e,
            F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("q")),
            lambda a, v: F.struct((a["s"] + v).alias("s"), (a["q"] + (a["s"] + v) * (a["s"] + v)).alias("q")),
            lambda a: a["q"],
        )
        weighted = F.transform(
            F.filter(steps(width), lambda j: j < n),
            lambda j: (1.0 - j / (width + 1.0)) * dot(F.slice(e, j + 1, n - j), F.slice(e, F.lit(1), n - j)),
        )
        long_run = F.aggregate(weighted, dot(e, e), lambda total, v: total + 2.0 * v)
        return F.try_divide(squares, n * F.greatest(long_run, F.lit(1e-12)))

    return let(_centre(y), statistic)


def seasonal_strength(y: Column, m: int) -> Column:
    """Share of the detrended variance that the seasonal pattern explains, 0 to 1."""

    def share(detrended: Column) -> Column:
        effects = F.transform(
            steps(m), lambda j: _average(F.transform(detrended, lambda v, i: F.when(i % m == j - 1, v)))
        )
        rest = let(effects, lambda s: _spread(F.transform(detrended, lambda v, i: v - F.get(s, i % m))))
        everything = _spread(detrended)
        return F.when(everything > 1e-12, F.greatest(1.0 - F.try_divide(rest, everything), F.lit(0.0))).otherwise(0.0)

    return let(let(centred_average(y, m), lambda t: F.zip_with(y, t, lambda a, b: a - b)), share)


def differences(y: Column, m: int) -> Column:
    """struct(d, seasonal, w): how often, and the differenced series."""

    def moving(v: Column) -> Column:
        return (stationarity_statistic(v) > STATIONARITY_LIMIT).cast("int")

    def apply(code: Column) -> Column:
        d, seasonal = code % 2, (code >= 2).cast("int")
        drop = d + seasonal * m

        def back(i: Column, k: Column | int) -> Column:
            return F.coalesce(F.get(y, i + drop - k), F.lit(0.0))

        w = F.transform(
            F.slice(y, drop + 1, F.greatest(F.size(y) - drop, F.lit(0))),
            lambda v, i: v - d * back(i, 1) - seasonal * (back(i, m) - d * back(i, m + 1)),
        )
        return F.struct(d.alias("d"), seasonal.alias("seasonal"), w.alias("w"))

    code = moving(y)
    if m > 1:
        strong = (F.size(y) >= SEASONS_NEEDED * m) & (seasonal_strength(y, m) > STRENGTH_LIMIT)
        code = F.when(strong, moving(difference(y, m)) + 2).otherwise(code)
    return let(code, apply)


def all_orders(seasonal: bool) -> list[tuple[int, int, int, int]]:
    """(p, q, P, Q): lags 1..p and 1..q, and the lag of one season where P or Q is 1."""
    last = (0, 1) if seasonal else (0,)
    return list(product((0, 1, 2), (0, 1, 2), last, last))


def _solve(system: Column, k: int) -> Column:
    """Solution of a k x (k+1) augmented symmetric system, NULLs where it is singular.

    The eliminations of ``arrays.solve`` with nothing bound in between, for expressions that are deep already.
    """

    def run(start: Column) -> Column:
        def step(m: Column, j: Column) -> Column:
            pivot = F.get(F.get(m, j), j)
            usable = F.abs(pivot) > F.lit(1e-10) * F.abs(F.get(F.get(start, j), j))

            def unit(v: Column) -> Column:
                return F.when(usable, F.try_divide(v, pivot))

            return F.transform(
                m,
                lambda row, i: F.zip_with(
                    row, F.get(m, j), lambda a, b: F.when(i == j, unit(b)).otherwise(a - F.get(row, j) * unit(b))
                ),
            )

        reduced = F.aggregate(F.sequence(F.lit(0), F.lit(k - 1)), start, step)
        return F.transform(reduced, lambda row: F.get(row, F.lit(k)))

    return let(system, run)


def _products(columns: Column) -> Column:
    """Products of all pairs of columns."""
    return F.transform(columns, lambda a: F.transform(columns, lambda b: dot(a, b)))


def _aligned(parts: list[tuple[Column, int]], drop: int) -> Column:
    """The target, a column of ones and the lagged ``parts``, without the first ``drop`` points."""
    target = lagged(parts[0][0], 0, drop)
    ones = F.transform(target, lambda v: F.lit(1.0))
    return F.array(target, ones, *[lagged(a, lag, drop) for a, lag in parts])


def innovations(w: Column, lags: list[int]) -> Column:
    """Residuals of the long autoregression, 0 before its first one; NULLs where it is not identified."""
    drop, k = max(lags), len(lags) + 1

    def residuals(coef: Column) -> Column:
        def one(v: Column, i: Column) -> Column:
            fitted = at(coef, 0)
            for j, lag in enumerate(lags, 1):
                fitted = fitted + at(coef, j) * F.get(w, i - lag)
            return F.when(i < drop, F.lit(0.0)).otherwise(v - fitted)

        return F.transform(w, one)

    def coefficients(x: Column) -> Column:
        rows = F.transform(F.slice(_products(x), 2, k), lambda r: F.concat(F.slice(r, 2, k), F.slice(r, 1, 1)))
        return _solve(rows, k)

    return let(let(_aligned([(w, i) for i in lags], drop), coefficients), residuals)


def _inside(first: Column, second: Column, season: Column) -> Column:
    """Whether ``1 - first B - second B^2 - season B^m`` has its roots outside the unit circle (sufficient with a season)."""
    triangle = (F.abs(second) < _INSIDE) & (first + second < _INSIDE) & (second - first < _INSIDE)
    return F.when(season == 0.0, triangle).otherwise(F.abs(first) + F.abs(second) + F.abs(season) < _INSIDE)


def fit(w: Column, m: int = 1, orders: list[tuple[int, int, int, int]] | None = None) -> Column:
    """struct(aicc, size, c, phi, theta) of the order with the lowest AICc; the mean where none can be scored.

    ``phi`` and ``theta`` belong to lags 1, 2 and, with a season, ``m``. NULL for an empty series.
    """
    lags = [1, 2, m] if m > 1 else [1, 2]
    orders = all_orders(m > 1) if orders is None else orders
    width = len(lags)
    k = 2 * width + 1
    long_lags = sorted({*range(1, LONG_ORDER + 1), *lags})
    drop = max(long_lags)
    season = (lambda order: [order]) if m > 1 else (lambda order: [])
    masks = [[1, p >= 1, p >= 2, *season(P), q >= 1, q >= 2, *season(Q)] for p, q, P, Q in orders]
    candidates = F.expr("array(" + ", ".join(f"array({', '.join(str(int(x)) for x in mask)})" for mask in masks) + ")")
    zeros = F.array(*[F.lit(0.0)] * width)

    def scored(mask: Column, n: Column, mu: Column, g: Column) -> Column:
        def entry(row: Column, i: Column, j: Column) -> Column:
            both = (F.get(mask, i) == 1) & (F.get(mask, j) == 1)
            return F.when(both, F.get(row, j + 1)).otherwise((i == j).cast("double"))

        def equation(row: Column, i: Column) -> Column:
            right = F.when(F.get(mask, i) == 1, F.get(row, F.lit(0))).otherwise(0.0)
            return F.concat(F.transform(mask, lambda _, j: entry(row, i, j)), F.array(right))

        def candidate(b: Column) -> Column:
            used = F.aggregate(mask, F.lit(-1.0), lambda a, v: a + v)
            right = F.zip_with(mask, F.slice(at(g, 0), 2, k), lambda use, v: F.when(use == 1, v).otherwise(0.0))
            score = aicc(at(at(g, 0), 0) - dot(b, right), n, used + 2.0)
            phi, theta = F.slice(b, 2, width), F.slice(b, width + 2, width)
            third = (lambda a: at(a, 2)) if m > 1 else (lambda a: F.lit(0.0))
            stable = _inside(at(phi, 0), at(phi, 1), third(phi)) & _inside(-at(theta, 0), -at(theta, 1), -third(theta))
            c = at(b, 0) + mu * F.aggregate(phi, F.lit(1.0), lambda a, v: a - v)
            return F.when(
                score.isNotNull() & stable,
                F.struct(
                    score.alias("aicc"), used.alias("size"), c.alias("c"), phi.alias("phi"), theta.alias("theta")
                ),
            )

        return let(_solve(F.transform(F.slice(g, 2, k), equation), k), candidate)

    def search(mu: Column) -> Column:
        centred = F.transform(w, lambda v: v - mu)

        def on(z: Column) -> Column:
            table = let(innovations(z, long_lags), lambda e: _aligned([(z, i) for i in lags] + [(e, i) for i in lags], drop))
            n = F.size(z) - drop
            return let(
                let(table, _products), lambda g: best(F.transform(candidates, lambda mask: scored(mask, n, mu, g)))
            )

        mean_only = F.struct(
            F.lit(0.0).alias("aicc"), F.lit(0.0).alias("size"), mu.alias("c"), zeros.alias("phi"), zeros.alias("theta")
        )
        return F.when(F.size(w) > drop, F.coalesce(let(centred, on), mean_only)).when(F.size(w) > 0, mean_only)

    return let(_average(w), search)


def sarima(y: Column, h: int, m: int) -> Column:
    """Forecast of the best seasonal ARMA order on the differenced series.

    Seasonal terms are searched where the differenced series has three seasons. NULL for an empty series. Batches of series
    are worked out together by the same sums as those of :func:`differences` and :func:`fit`.
    """
    ship(SparkSession.active())
    orders = {seasonal: all_orders(seasonal) for seasonal in (False, True)}
    limits = {"stationarity": STATIONARITY_LIMIT, "strength": STRENGTH_LIMIT, "seasons": SEASONS_NEEDED, "inside": _INSIDE}

    @F.arrow_udf("array<double>")
    def forecast(values: pa.Array) -> pa.Array:
        return path_batch(values, h, m, orders, limits, LONG_ORDER)

    return forecast(y.cast("array<double>"))
