"""Seasonal ARMA models against plain numpy: every order solved by itself, every statistic by its formula."""

import datetime as dt
import math
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.models import autoregression, sarima, sarima_grid
from panelcast.operators.series import series_rows
from panelcast.plans.audit import native_forecast

RNG = np.random.default_rng(11)


def month(i):
    return dt.date(2000 + i // 12, i % 12 + 1, 1)


def arma(n, phi, theta):
    e, w = RNG.normal(0, 1, n + 50), [0.0]
    for t in range(1, n + 50):
        w.append(phi * w[-1] + e[t] + theta * e[t - 1])
    return np.array(w[50:])


def make():
    def season(n):
        return 10 * np.sin(2 * np.pi * np.arange(n) / 12)

    out = {
        "arma240": 30 + arma(240, 0.6, 0.5),
        "ma120": 5 + arma(120, 0.0, 0.8),
        "walk90": np.cumsum(RNG.normal(0, 1, 90)),
        "season84": 50 + season(84) + RNG.normal(0, 1, 84),
        "trend60": 20 + 0.5 * np.arange(60) + season(60) + RNG.normal(0, 1, 60),
        "noise37": RNG.normal(20, 3, 37),
        "short9": RNG.normal(20, 3, 9),
        "gappy48": np.where(RNG.random(48) < 0.4, RNG.integers(1, 9, 48), 0).astype(float),
        "flat30": np.full(30, 7.0),
        "zero14": np.zeros(14),
        "two": np.array([3.0, 5.0]),
        "one": np.array([4.0]),
    }
    return {k: np.round(v, 3) for k, v in out.items()}


SERIES = make()


@pytest.fixture(scope="module")
def rows(spark):
    data = [(k, month(i), float(v)) for k, y in SERIES.items() for i, v in enumerate(y)]
    return series_rows(spark.createDataFrame(data, "unique_id string, ds date, y double")).persist()


def values(rows, column):
    return {r[0]: r[1] for r in rows.select("unique_id", column.alias("v")).collect()}


def statistic(y):
    n = len(y)
    e = np.asarray(y) - np.mean(y)
    width = math.floor(4 * (n / 100) ** 0.25)
    s = e @ e + 2 * sum((1 - j / (width + 1)) * (e[j:] @ e[: n - j]) for j in range(1, width + 1) if j < n)
    return float(np.sum(np.cumsum(e) ** 2) / (n * s)) if s > 1e-12 else 0.0


def strength(y, m):
    n, half = len(y), m // 2
    detrended = {}
    for i in range(half, n - half):
        window = y[i - half : i + half + 1]
        trend = (sum(window) - (window[0] + window[-1]) / 2) / m if m % 2 == 0 else sum(window) / m
        detrended[i] = y[i] - trend
    raw = np.array([np.mean([v for i, v in detrended.items() if i % m == j]) for j in range(m)])
    effects = raw - raw.mean()
    rest = [v - effects[i % m] for i, v in detrended.items()]
    spread = np.var(list(detrended.values()))
    return max(1 - np.var(rest) / spread, 0.0) if spread > 1e-12 else 0.0


def differenced(y, m):
    seasonal = int(m > 1 and len(y) >= 3 * m and strength(y, m) > 0.64)
    w = y[m:] - y[:-m] if seasonal else y
    d = int(statistic(w) > 0.463)
    return d, seasonal, (w[1:] - w[:-1] if d else w)


def regress(target, columns):
    x = np.column_stack([np.ones(len(target)), *columns])
    coef, _, rank, _ = np.linalg.lstsq(x, target, rcond=1e-9)
    return (coef, target - x @ coef) if rank == x.shape[1] else (None, None)


def shift(a, lag, drop):
    return a[drop - lag : len(a) - lag]


def inside(a, b, c):
    if c == 0:
        return abs(b) < 0.99 and a + b < 0.99 and b - a < 0.99
    return abs(a) + abs(b) + abs(c) < 0.99


def fitted(w, m):
    """(c, phi, theta) on lags 1, 2 (and m) by solving every order by itself."""
    lags = [1, 2, m] if m > 1 else [1, 2]
    long_lags = sorted({1, 2, 3, *lags})
    drop, flat = max(long_lags), (float(np.mean(w)), [0.0] * len(lags), [0.0] * len(lags))
    if len(w) <= drop:
        return flat
    _, rest = regress(shift(w, 0, drop), [shift(w, i, drop) for i in long_lags])
    e = None if rest is None else np.concatenate([np.zeros(drop), rest])
    found, n = [], len(w) - drop
    for p, q, P, Q in product(range(3), range(3), *[(0, 1) if m > 1 else (0,)] * 2):
        ar = [1, 2][:p] + [m] * P
        ma = [1, 2][:q] + [m] * Q
        size = len(ar) + len(ma)
        if n - size - 3 <= 0 or (ma and e is None):
            continue
        coef, left = regress(shift(w, 0, drop), [shift(w, i, drop) for i in ar] + [shift(e, i, drop) for i in ma])
        if coef is None:
            continue
        phi = [coef[1 + ar.index(i)] if i in ar else 0.0 for i in lags]
        theta = [coef[1 + len(ar) + ma.index(i)] if i in ma else 0.0 for i in lags]
        if inside(*(phi + [0.0])[:3]) and inside(*[-v for v in (theta + [0.0])[:3]]):
            k = size + 2
            score = n * math.log(max(left @ left / n, 1e-12)) + 2 * k + 2 * k * (k + 1) / (n - k - 1)
            found.append((score, size, coef[0], phi, theta))
    return min(found)[2:] if found else flat


def reference(y, h, m):
    d, seasonal, w = differenced(y, m)
    season = m if m > 1 and len(w) >= 3 * m else 1
    lags = [1, 2, season] if season > 1 else [1, 2]
    c, phi, theta = fitted(w, season)
    shocks = []
    for t in range(len(w)):
        value = w[t] - c - sum(f * w[t - i] + g * shocks[t - i] for i, f, g in zip(lags, phi, theta)) if t >= max(lags) else 0.0
        shocks.append(value)
    hist, w, n = list(y), list(w), len(w)
    for _ in range(h):
        level = c
        for i, f, g in zip(lags, phi, theta):
            t = len(w) - i
            level += f * (w[t] if t >= 0 else 0.0) + g * (shocks[t] if 0 <= t < n else 0.0)
        w.append(level)
        back = lambda k: hist[-k] if k <= len(hist) else 0.0
        hist.append(level + d * back(1) + seasonal * (back(m) - d * back(m + 1)))
    return hist[-h:]


def test_stationarity_statistic(rows):
    got = values(rows, sarima.stationarity_statistic(F.col("values")))
    for uid, y in SERIES.items():
        assert got[uid] == pytest.approx(statistic(y), rel=1e-9, abs=1e-12)
    assert got["walk90"] > sarima.STATIONARITY_LIMIT > got["noise37"]


def test_seasonal_strength(rows):
    rows = rows.where(F.size("values") >= 36)
    got = values(rows, sarima.seasonal_strength(F.col("values"), 12))
    for uid, v in got.items():
        assert v == pytest.approx(strength(SERIES[uid], 12), rel=1e-9, abs=1e-12)
    assert got["season84"] > sarima.STRENGTH_LIMIT > got["ma120"]


@pytest.mark.parametrize("m", [1, 12, 4])
def test_forecast(rows, m):
    got = values(rows, sarima.sarima(F.col("values"), 14, m))
    for uid, y in SERIES.items():
        np.testing.assert_allclose(got[uid], reference(y, 14, m), rtol=1e-6, atol=1e-6, err_msg=uid)


def test_moving_average_is_found(rows):
    """The innovations' weight, which an autoregression of order two cannot express."""
    got = values(rows, sarima.fit(F.col("values"), 1, [(0, 1, 0, 0)]))
    assert got["ma120"]["theta"][0] == pytest.approx(0.8, abs=0.2)
    got = values(rows, sarima.fit(F.col("values"), 1, [(1, 1, 0, 0)]))
    assert got["arma240"]["phi"][0] == pytest.approx(0.6, abs=0.2)
    assert got["arma240"]["theta"][0] == pytest.approx(0.5, abs=0.25)


def test_beats_autoregression_on_a_season(rows):
    """One-season hold-out of a seasonal series: the seasonal form is no worse than naive seasonal differences."""
    y = SERIES["season84"]
    spark = rows.sparkSession
    data = [("s", month(i), float(v)) for i, v in enumerate(y[:-12])]
    one = series_rows(spark.createDataFrame(data, "unique_id string, ds date, y double"))

    def rmse(column):
        return float(np.sqrt(np.mean((np.array(values(one, column)["s"]) - y[-12:]) ** 2)))

    assert rmse(sarima.sarima(F.col("values"), 12, 12)) < 1.1 * rmse(autoregression.arima(F.col("values"), 12, 12))


def test_registered(rows):
    out = native_forecast(rows, ["sarima"], 3, "MS", 12)
    assert out.count() == 3 * len(SERIES)
    assert out.where("prediction IS NULL").count() == 0


def test_empty_series(spark):
    one = spark.sql("SELECT 'a' AS unique_id, CAST(array() AS array<double>) AS values")
    assert values(one, sarima.sarima(F.col("values"), 3, 12)) == {"a": None}


def test_orders_are_searched_in_batches(rows):
    """No order is interpreted as an expression: the plan holds one Arrow function and no fold over the values."""
    plan = rows.select(sarima.sarima(F.col("values"), 3, 12).alias("f"))._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" in plan and "aggregate(" not in plan


def test_batches_hold_short_empty_and_broken_series(spark):
    """Series of all lengths in one batch: each gets what it gets alone; nothing is forecast where a value is missing."""
    rng = np.random.default_rng(6)
    data = {f"n{n}-{k}": [float(v) for v in rng.integers(1, 50, n)] for n in [*range(1, 12), 36, 37, 50] for k in range(3)}
    odd = {"none": [], "gap": [1.0] * 9 + [None], "nan": [1.0] * 9 + [float("nan")], "flat": [3.0] * 40, "line": [2.0 * t for t in range(40)]}
    frame = spark.createDataFrame([*data.items(), *odd.items(), ("null", None)], "unique_id string, values array<double>").coalesce(1)
    got = values(frame, sarima.sarima(F.col("values"), 4, 12))
    assert got["none"] is None and got["gap"] is None and got["null"] is None and np.isnan(got["nan"]).all()
    assert got["flat"] == [3.0] * 4 and got["line"] == [80.0, 82.0, 84.0, 86.0]
    for uid in data:
        np.testing.assert_allclose(got[uid], reference(np.array(data[uid]), 4, 12), rtol=1e-6, atol=1e-6, err_msg=uid)
    alone = values(frame.where("unique_id IN ('n50-1', 'n3-0')").repartition(2, "unique_id"), sarima.sarima(F.col("values"), 4, 12))
    assert all(got[uid] == v for uid, v in alone.items()) and len(alone) == 2


@pytest.mark.parametrize("m", [1, 12])
def test_batches_take_the_steps_of_the_expressions(rows, m):
    """Constant and weights of the best order equal those of the array expression, digit by digit."""
    long = rows.where(F.size("values") >= 36)
    found = values(long, sarima.fit(F.col("values"), m))
    lags = [1, 2, m] if m > 1 else [1, 2]
    season = (lambda order: [order]) if m > 1 else (lambda order: [])
    masks = np.array([[1, p >= 1, p >= 2, *season(P), q >= 1, q >= 2, *season(Q)] for p, q, P, Q in sarima.all_orders(m > 1)], bool)
    for uid, f in found.items():
        w = np.repeat(SERIES[uid][:, None], 2, 1)
        c, phi, theta = sarima_grid.best_order(w, lags, sorted({1, 2, 3, *lags}), masks, 0.99)
        assert (c[0], phi[:, 0].tolist(), theta[:, 0].tolist()) == (f["c"], f["phi"], f["theta"])
