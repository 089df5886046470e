"""Differenced autoregressions fitted by per-series least squares.

The differencing order is the one with the smallest standard deviation; the
autoregressive order (0, 1 or 2) is the one with the lowest AICc on a common
sample. Moving-average terms are not estimated.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelcast.functions.arrays import best, dot, least_squares, let, mean, steps, tail
from panelcast.functions.metrics import settled
from panelcast.models.smoothing import aicc

_MAX_ORDER = 2
_MIN_POINTS = 6


def difference(a: Column, lag: int) -> Column:
    return let(
        a,
        lambda x: F.transform(
            F.slice(x, lag + 1, F.greatest(F.size(x) - lag, F.lit(0))), lambda v, i: v - F.get(x, i)
        ),
    )


def variance(a: Column) -> Column:
    return let(
        F.struct(a.alias("v"), mean(a).alias("mu")),
        lambda s: mean(F.transform(s["v"], lambda v: (v - s["mu"]) * (v - s["mu"]))),
    )


def lagged(a: Column, lag: int, drop: int) -> Column:
    """``a`` shifted by ``lag``, aligned with ``a`` without its first ``drop`` values."""
    return F.slice(a, drop - lag + 1, F.greatest(F.size(a) - drop, F.lit(0)))


def ar_coefficients(w: Column, p: int, drop: int | None = None) -> Column:
    """[constant, phi_1 .. phi_p] on the sample left after ``drop`` (default ``p``) points."""
    drop = p if drop is None else drop
    return least_squares([lagged(w, i, drop) for i in range(1, p + 1)], lagged(w, 0, drop))


def _products(w: Column) -> Column:
    """Means and centred products of ``w`` with its first two lags on their common sample."""

    def product(x: Column, i: int, j: int, name: str) -> Column:
        return dot(F.get(x, F.lit(i)), F.get(x, F.lit(j))).alias(name)

    def gather(x: Column, mu: Column) -> Column:
        centred = F.zip_with(x, mu, lambda column, c: F.transform(column, lambda v: v - c))
        return let(
            centred,
            lambda z: F.struct(
                mu.alias("mu"),
                product(z, 0, 0, "yy"),
                product(z, 1, 1, "s11"),
                product(z, 2, 2, "s22"),
                product(z, 1, 2, "s12"),
                product(z, 0, 1, "s1y"),
                product(z, 0, 2, "s2y"),
            ),
        )

    lags = F.array(*[lagged(w, i, _MAX_ORDER) for i in range(_MAX_ORDER + 1)])
    return let(lags, lambda x: let(F.transform(x, mean), lambda mu: gather(x, mu)))


def _order_candidates(n: Column, s: Column) -> Column:
    """Scored orders 0, 1, 2; NULL where the order is not identified or not stationary."""
    zero = F.lit(0.0)
    phi = F.when(s["s11"] > 0, F.try_divide(s["s1y"], s["s11"]))
    det = s["s11"] * s["s22"] - s["s12"] * s["s12"]
    det = F.when(det > F.lit(1e-10) * s["s11"] * s["s22"], det)
    phi1 = F.try_divide(s["s1y"] * s["s22"] - s["s2y"] * s["s12"], det)
    phi2 = F.try_divide(s["s2y"] * s["s11"] - s["s1y"] * s["s12"], det)
    weights = F.array(
        F.struct(F.lit(0).alias("p"), zero.alias("phi1"), zero.alias("phi2")),
        F.struct(F.lit(1).alias("p"), phi.alias("phi1"), zero.alias("phi2")),
        F.struct(F.lit(2).alias("p"), phi1.alias("phi1"), phi2.alias("phi2")),
    )

    def score(c: Column) -> Column:
        sse = s["yy"] - c["phi1"] * s["s1y"] - c["phi2"] * s["s2y"]
        usable = (F.abs(c["phi2"]) < 0.99) & (c["phi1"] + c["phi2"] < 0.99) & (c["phi2"] - c["phi1"] < 0.99)
        level = F.get(s["mu"], F.lit(0)) - c["phi1"] * F.get(s["mu"], F.lit(1)) - c["phi2"] * F.get(s["mu"], F.lit(2))
        return let(
            aicc(sse, n, c["p"].cast("double") + 2.0),
            lambda a: F.when(
                a.isNotNull() & usable,
                F.struct(
                    settled(a).alias("aicc"),
                    c["p"].alias("p"),
                    level.alias("c"),
                    c["phi1"].alias("phi1"),
                    c["phi2"].alias("phi2"),
                ),
            ),
        )

    return F.transform(weights, score)


def ar_order(w: Column) -> Column:
    """struct(aicc, p, c, phi1, phi2) of the best order; the mean when no order can be scored."""
    mean_only = F.struct(
        F.lit(0.0).alias("aicc"),
        F.lit(0).alias("p"),
        mean(w).alias("c"),
        F.lit(0.0).alias("phi1"),
        F.lit(0.0).alias("phi2"),
    )
    scored = let(_products(w), lambda s: best(_order_candidates(F.size(w) - _MAX_ORDER, s)))
    return F.coalesce(scored, mean_only)


def differencing(y: Column, m: int) -> Column:
    """struct(sd, d, seasonal, w) of the differencing with the smallest spread."""
    options = [(0, 0), (1, 0)]
    if m > 1:
        options += [(0, 1), (1, 1)]

    def option(d: int, seasonal: int) -> Column:
        w = difference(y, m) if seasonal else y
        w = difference(w, 1) if d else w
        return let(
            w,
            lambda v: F.when(
                F.size(v) >= (_MIN_POINTS if seasonal else 1),
                F.struct(
                    let(F.sqrt(variance(v)), settled).alias("sd"),
                    F.lit(d).alias("d"),
                    F.lit(seasonal).alias("seasonal"),
                    v.alias("w"),
                ),
            ),
        )

    return best(F.array(*[option(d, s) for d, s in options]))


def _path(y: Column, h: int, m: int, diff: Column, ar: Column) -> Column:
    """Recursive forecast, undone differencing included."""
    depth = m + 4

    def back(hist: Column, k: int) -> Column:
        return F.coalesce(F.get(hist, F.size(hist) - k), F.lit(0.0))

    def differenced(hist: Column, k: int) -> Column:
        plain = back(hist, k) - diff["d"] * back(hist, k + 1)
        seasonal = back(hist, k + m) - diff["d"] * back(hist, k + m + 1)
        return plain - diff["seasonal"] * seasonal

    def step(hist: Column, _: Column) -> Column:
        level = ar["c"] + ar["phi1"] * differenced(hist, 1) + ar["phi2"] * differenced(hist, 2)
        undo = (
            diff["d"] * back(hist, 1)
            + diff["seasonal"] * back(hist, m)
            - diff["d"] * diff["seasonal"] * back(hist, m + 1)
        )
        return F.concat(hist, F.array(level + undo))

    return tail(F.aggregate(steps(h), tail(y, depth), step), h)


def arima(y: Column, h: int, m: int) -> Column:
    return let(
        differencing(y, m),
        lambda diff: F.when(
            diff.isNotNull(), let(ar_order(diff["w"]), lambda ar: _path(y, h, m, diff, ar))
        ),
    )


def ar_forecast(y: Column, h: int, p: int = 1) -> Column:
    """Plain AR(p) with a constant, on the levels."""

    def step(coef: Column):
        def extend(hist: Column, _: Column) -> Column:
            value = F.get(coef, F.lit(0))
            for i in range(1, p + 1):
                value = value + F.get(coef, F.lit(i)) * F.get(hist, F.size(hist) - i)
            return F.concat(hist, F.array(value))

        return extend

    return let(
        ar_coefficients(y, p), lambda coef: tail(F.aggregate(steps(h), tail(y, p), step(coef)), h)
    )
