"""Per-series models against plain numpy loops, global models against closed forms."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.models import autoregression, decomposition, intermittent, smoothing, volatility
from panelcast.models.registry import REGISTRY_KEYS, get_model, register_model
from panelcast.operators.features import FeatureSpec
from panelcast.operators.series import series_rows
from panelcast.plans.audit import stats_forecast
from panelcast.plans.recursive import predict_recursive
from panelcast.plans.training import fit_global, training_rows

RNG = np.random.default_rng(7)


def month(i):
    return dt.date(2010 + i // 12, i % 12 + 1, 1)


def series(n, kind):
    t = np.arange(n)
    if kind == "season":
        return 50 + 0.5 * t + 10 * np.sin(2 * np.pi * t / 12) + RNG.normal(0, 1, n)
    if kind == "walk":
        return 100 + np.cumsum(RNG.normal(0, 1, n))
    if kind == "gappy":
        return np.where(RNG.random(n) < 0.4, RNG.integers(1, 9, n), 0).astype(float)
    return RNG.normal(20, 3, n)


SERIES = {f"{k}{n}": np.round(series(n, k), 3) for k in ("season", "walk", "gappy", "noise") for n in (26, 61)}


@pytest.fixture(scope="module")
def rows(spark):
    data = [(k, month(i), float(v)) for k, y in SERIES.items() for i, v in enumerate(y)]
    df = series_rows(spark.createDataFrame(data, "unique_id string, ds date, y double"))
    return df.persist()


def values(rows, column):
    return {r[0]: r[1] for r in rows.select("unique_id", column.alias("v")).collect()}


def ses(x, a):
    level, sse = x[0], 0.0
    for v in x[1:]:
        sse += (v - level) ** 2
        level += a * (v - level)
    return level, sse


def ses_best(x, grid):
    return min((ses(x, a)[1], a, ses(x, a)[0]) for a in grid)


def aicc(sse, n, k):
    return n * math.log(max(sse / n, 1e-12)) + 2 * k + 2 * k * (k + 1) / (n - k - 1)


def gaps(y):
    pos = [i + 1 for i, v in enumerate(y) if v != 0]
    return [float(p - q) for p, q in zip(pos, [0, *pos])]


def test_intermittent(rows):
    y = F.col("values")
    got = {
        name: values(rows, fn(y, 1, 12))
        for name, fn in (
            ("croston", intermittent.croston), ("sba", intermittent.croston_sba),
            ("opt", intermittent.croston_optimized), ("adida", intermittent.adida), ("imapa", intermittent.imapa),
        )
    }

    def bucket(x, k):
        x = x[len(x) % k :]
        return ses_best([sum(x[i : i + k]) for i in range(0, len(x), k)], intermittent.ALPHA_GRID)[2] / k

    for uid, x in SERIES.items():
        z, p = [v for v in x if v != 0], gaps(x)
        base = ses(z, 0.1)[0] / ses(p, 0.1)[0]
        k = round(sum(p) / len(p))
        assert got["croston"][uid][0] == pytest.approx(base)
        assert got["sba"][uid][0] == pytest.approx(0.95 * base)
        grid = intermittent.ALPHA_GRID
        assert got["opt"][uid][0] == pytest.approx(ses_best(z, grid)[2] / ses_best(p, grid)[2])
        assert got["adida"][uid][0] == pytest.approx(bucket(list(x), k))
        assert got["imapa"][uid][0] == pytest.approx(np.mean([bucket(list(x), i) for i in range(1, k + 1)]))


def test_all_zero_series(spark):
    df = spark.createDataFrame([("z", [0.0] * 30)], "unique_id string, values array<double>")
    for fn in (intermittent.croston, intermittent.croston_optimized, intermittent.adida, intermittent.imapa):
        assert df.select(fn(F.col("values"), 2, 12)).first()[0] == [0.0, 0.0]


def ets_reference(y, h, m):
    n, found = len(y), []

    def line(x):
        if len(x) < 2:
            return 0.0, float(np.mean(x))
        b, a = np.polyfit(np.arange(len(x)), x, 1)
        return b, a

    slope, intercept = line(y[:10])
    for k, a, b, phi in smoothing._plain_grid():
        level, trend = (intercept - slope, slope) if phi > 0 else (float(np.mean(y[:10])), 0.0)
        sse = 0.0
        for v in y:
            f = level + phi * trend
            level, trend, sse = f + a * (v - f), phi * trend + b * (v - f), sse + (v - f) ** 2
        if n - k - 1 > 0:
            found.append((aicc(sse, n, k), k, a, b, phi, level, trend, [0.0]))
    if n >= 2 * m:
        first = np.mean(y[:m])
        drift = (np.mean(y[m : 2 * m]) - first) / m
        for k, a, b, phi, g in smoothing._seasonal_grid(m):
            level, trend = (first - drift * (m + 1) / 2, drift) if phi > 0 else (first, 0.0)
            s = [y[i] - (level + trend * (i + 1)) for i in range(m)]
            sse = 0.0
            for v in y:
                f = level + phi * trend
                e = v - f - s[0]
                level, trend, s, sse = f + a * e, phi * trend + b * e, s[1:] + [s[0] + g * e], sse + e * e
            if n - k - 1 > 0:
                found.append((aicc(sse, n, k), k, a, b, phi, level, trend, s))
    _, _, _, _, phi, level, trend, s = min(found)
    return [
        level + (sum(phi**j for j in range(1, i + 1)) * trend if phi > 0 else 0) + s[(i - 1) % len(s)]
        for i in range(1, h + 1)
    ]


def test_ets(rows):
    got = values(rows, smoothing.ets(F.col("values"), 15, 12))
    for uid, y in SERIES.items():
        np.testing.assert_allclose(got[uid], ets_reference(list(y), 15, 12), rtol=1e-6, atol=1e-6)


def test_theta(rows):
    got = values(rows, smoothing.theta(F.col("values"), 6, 12))
    for uid, y in SERIES.items():
        b = np.polyfit(np.arange(len(y)), y, 1)[0]
        _, a, level = ses_best(list(y), smoothing.THETA_GRID)
        want = [level + b / 2 * (k - 1 + (1 - (1 - a) ** len(y)) / a) for k in range(1, 7)]
        np.testing.assert_allclose(got[uid], want, rtol=1e-8)


def arima_reference(y, h, m):
    y = np.asarray(y, float)

    def diff(x, k):
        return x[k:] - x[:-k]

    options = [(0, 0, y), (1, 0, diff(y, 1))]
    if m > 1:
        s = diff(y, m)
        options += [(0, 1, s), (1, 1, diff(s, 1))]
    _, d, D, w = min(((np.std(w), d, D, w) for d, D, w in options if len(w) >= (6 if D else 1)), key=lambda o: o[:3])
    found = []
    n = len(w) - 2
    for p in range(3):
        if n - p - 3 <= 0:
            continue
        x = np.column_stack([np.ones(n)] + [w[2 - i : len(w) - i] for i in range(1, p + 1)])
        coef, *_ = np.linalg.lstsq(x, w[2:], rcond=None)
        phi = list(coef[1:]) + [0.0] * (2 - p)
        if abs(phi[1]) < 0.99 and phi[0] + phi[1] < 0.99 and phi[1] - phi[0] < 0.99:
            found.append((aicc(float(np.sum((w[2:] - x @ coef) ** 2)), n, p + 2), p, coef[0], *phi))
    c, f1, f2 = min(found)[2:] if found else (np.mean(w), 0.0, 0.0)
    hist = list(y)

    def back(k):
        return hist[-k] if k <= len(hist) else 0.0

    def dif(k):
        return back(k) - d * back(k + 1) - D * (back(k + m) - d * back(k + m + 1))

    for _ in range(h):
        new = c + f1 * dif(1) + f2 * dif(2) + d * back(1) + D * back(m) - d * D * back(m + 1)
        hist.append(new)
    return hist[-h:]


@pytest.mark.parametrize("m", [1, 12])
def test_arima(rows, m):
    got = values(rows, autoregression.arima(F.col("values"), 14, m))
    for uid, y in SERIES.items():
        np.testing.assert_allclose(got[uid], arima_reference(y, 14, m), rtol=1e-6, atol=1e-6)


def season_reference(y, m):
    n, half = len(y), m // 2
    effects = [[] for _ in range(m)]
    for i in range(half, n - half):
        window = y[i - half : i + half + 1]
        trend = (sum(window) - (window[0] + window[-1]) / 2) / m if m % 2 == 0 else sum(window) / m
        effects[i % m].append(y[i] - trend)
    means = np.array([np.mean(e) for e in effects])
    return means - means.mean()


@pytest.mark.parametrize("periods", [[12], [4, 12], [5]])
def test_mstl(rows, periods):
    got = values(rows, decomposition.mstl(F.col("values"), 13, periods if len(periods) > 1 else periods[0]))
    for uid, y in SERIES.items():
        rest, add, n = list(y), np.zeros(13), len(y)
        for m in periods:
            if n >= 2 * m:
                s = season_reference(rest, m)
                rest = [v - s[i % m] for i, v in enumerate(rest)]
                add = add + np.array([s[(n + k) % m] for k in range(13)])
        np.testing.assert_allclose(got[uid], np.array(arima_reference(rest, 13, 1)) + add, rtol=1e-6, atol=1e-6)


@pytest.mark.parametrize("p", [1, 2, 3])
def test_arch_variance(rows, p):
    got = values(rows, volatility.arch_variance(F.col("values"), 4, p))
    for uid, y in SERIES.items():
        e2 = (y - y.mean()) ** 2
        x = np.column_stack([np.ones(len(e2) - p)] + [e2[p - i : len(e2) - i] for i in range(1, p + 1)])
        coef, *_ = np.linalg.lstsq(x, e2[p:], rcond=None)
        path = list(e2)
        for _ in range(4):
            path.append(max(coef[0] + sum(coef[i] * path[-i] for i in range(1, p + 1)), 0.0))
        np.testing.assert_allclose(got[uid], path[-4:], rtol=1e-6)


@pytest.mark.parametrize("p,q", [(1, 1), (3, 2)])
def test_garch_variance(rows, p, q):
    got = values(rows, volatility.garch_variance(F.col("values"), 3, p, q))
    for uid, y in SERIES.items():
        e2 = (y - y.mean()) ** 2
        var, found = e2.mean(), []
        for a, b in volatility.GARCH_GRID:
            es, ss, nll = [var] * p, [var] * q, 0.0
            for e in e2:
                v = max(var * (1 - a - b) + a / p * sum(es[-p:]) + b / q * sum(ss[-q:]), 1e-12)
                nll += 0.5 * (math.log(v) + e / v)
                es.append(e)
                ss.append(v)
            found.append((nll, a, b, es, ss))
        _, a, b, es, ss = min(found, key=lambda f: f[:3])
        for _ in range(3):
            v = max(var * (1 - a - b) + a / p * sum(es[-p:]) + b / q * sum(ss[-q:]), 1e-12)
            es.append(v)
            ss.append(v)
        np.testing.assert_allclose(got[uid], ss[-3:], rtol=1e-8)


def test_singular_regression_is_null(spark):
    df = spark.createDataFrame([([5.0] * 20,)], "v array<double>")
    assert df.select(autoregression.ar_coefficients(F.col("v"), 1)).first()[0] == [None, None]


def test_registry():
    assert len(REGISTRY_KEYS) == 25
    for key in [*REGISTRY_KEYS, "lr", "naive", "seasonal_naive", "ARCH(1)", "GARCH(1,1)", "XGBoost", "arch_4", "garch_1_4"]:
        assert get_model(key, "parallel").family in ("native", "global")
    assert get_model("garch_2_1").key == "garch_2_1"
    with pytest.raises(ValueError, match="supported"):
        get_model("prophet")


def test_user_model_failures_become_rows(spark):
    def half(pdf, h, freq, season):
        if len(pdf) < 30:
            raise RuntimeError("too short")
        return pdf.tail(1).assign(prediction=pdf["y"].iloc[-1] / 2)[["ds", "prediction"]]

    register_model("half", "grouped", half)
    data = [(k, month(i), float(v)) for k, y in SERIES.items() for i, v in enumerate(y)]
    df = spark.createDataFrame(data, "unique_id string, ds date, y double")
    preds, errors = stats_forecast(df, ["half", "naive"], 2, "MS", 12)
    assert preds.where("model = 'half'").count() == 4
    assert {r["unique_id"] for r in errors.collect()} == {k for k, v in SERIES.items() if len(v) < 30}
    assert preds.where("model = 'naive'").count() == 2 * len(SERIES)


@pytest.fixture(scope="module")
def panel(spark):
    data = [(k, month(i), float(v)) for k, y in SERIES.items() for i, v in enumerate(y)]
    return spark.createDataFrame(data, "unique_id string, ds date, y double").persist()


SPEC = FeatureSpec([1, 3], {1: [3]}, ["month"])


def design(y):
    return [[y[i - 1], y[i - 3], np.mean(y[i - 3 : i]), month(i).month] for i in range(3, len(y))]


def test_ridge_closed_form_and_recursion(spark, panel):
    fitted = fit_global(training_rows(panel, SPEC), ["ridge", "lr"], SPEC)
    x = np.array([r for y in SERIES.values() for r in design(y)])
    t = np.array([v for y in SERIES.values() for v in y[3:]])
    xc, tc = x - x.mean(0), t - t.mean()
    for name, alpha in (("ridge", 1.0), ("lr", 0.0)):
        beta = np.linalg.solve(xc.T @ xc + alpha * np.eye(4), xc.T @ tc)
        model = fitted[name].stages[-1]
        np.testing.assert_allclose(model.coefficients.toArray(), beta, rtol=1e-6)
        state = series_rows(panel).withColumn("last_ds", F.element_at("dates", -1))
        out = predict_recursive(state, {name: fitted[name]}, 18, "MS", SPEC)
        got = {}
        for r in out.orderBy("unique_id", "ds").collect():
            got.setdefault(r["unique_id"], []).append(r["prediction"])
        for uid, y in SERIES.items():
            hist = list(y)
            for k in range(18):
                row = np.array([hist[-1], hist[-3], np.mean(hist[-3:]), month(len(hist)).month])
                hist.append(float((row - x.mean(0)) @ beta + t.mean()))
            np.testing.assert_allclose(got[uid], hist[-18:], rtol=1e-6)


def test_short_history_gives_null(spark, panel):
    fitted = fit_global(training_rows(panel, SPEC), ["lr"], SPEC)
    schema = "unique_id string, dates array<date>, values array<double>, last_ds date"
    short = spark.createDataFrame([("s", [month(0), month(1)], [1.0, 2.0], month(1))], schema)
    assert [r["prediction"] for r in predict_recursive(short, fitted, 2, "MS", SPEC).collect()] == [None, None]


@pytest.mark.parametrize("key", ["svr", "et", "gb"])
def test_global_models_learn(spark, panel, key):
    rows = training_rows(panel, SPEC)
    model = fit_global(rows, [key], SPEC, "fast")[key]
    scored = model.transform(rows).agg(
        F.avg(F.pow(F.col("y") - F.col("prediction"), F.lit(2.0))).alias("mse"), F.var_pop("y").alias("var")
    ).first()
    assert scored["mse"] < 0.25 * scored["var"]


def test_garch_batches(spark):
    """Series of all lengths share a batch and its steps; a missing or empty one has no fit, alone or not the fit is the same."""
    data = [(i, [float((7 * i + 3 * t * t) % 23) for t in range(i % 9)]) for i in range(5000)] + [(5000, None), (5001, [4.0] * 5)]
    frame = spark.createDataFrame(data, "i int, v array<double>").coalesce(1)
    fit = frame.select("i", volatility.garch_fit(F.col("v"), 2, 1, 3).alias("f"))
    assert "ArrowEvalPython" in fit._jdf.queryExecution().toString()
    got = {r["i"]: r["f"] for r in fit.collect()}
    assert all((got[i] is None) == (not v) for i, v in data)
    assert got[5001]["variance"] == 0.0 and (got[5001]["alpha"], got[5001]["beta"]) == volatility.GARCH_GRID[0]
    alone = frame.where("i IN (8, 4400)").repartition(2, "i").select("i", volatility.garch_fit(F.col("v"), 2, 1, 3).alias("f"))
    assert all(got[r["i"]] == r["f"] and len(r["f"]["path"]) == 3 for r in alone.collect())


def test_ets_batches_hold_short_empty_and_broken_series(spark):
    """Series of all lengths in one batch: each gets what it gets alone; nothing is scored where a value is missing."""
    rng = np.random.default_rng(4)
    data = {f"n{n}": [float(v) for v in rng.integers(1, 50, n)] for n in range(1, 45)}
    rows = spark.createDataFrame([*data.items(), ("none", []), ("gap", [1.0] * 9 + [None]), ("flat", [3.0] * 30)], "unique_id string, y array<double>").coalesce(1)
    fits = values(rows, smoothing.ets_fit(F.col("y"), 12))
    assert fits["none"] is None and fits["gap"] is None and all(fits[f"n{n}"] is None for n in range(1, 5))
    assert all((len(f["season"]) == 12) == (f["k"] >= 15) for f in fits.values() if f)
    got = values(rows, smoothing.ets(F.col("y"), 15, 12))
    for n in range(5, 45):
        np.testing.assert_allclose(got[f"n{n}"], ets_reference(data[f"n{n}"], 15, 12), rtol=1e-6, atol=1e-6)
    assert got["flat"] == [3.0] * 15 and got["n1"] == data["n1"] * 15


def test_ets_is_searched_in_batches(spark):
    """No grid point is interpreted as an expression: the plan holds one Arrow function and no fold over the values."""
    df = spark.createDataFrame([([1.0, 2.0],)], "y array<double>").select(smoothing.ets_fit(F.col("y"), 12))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" in plan and "aggregate(" not in plan


def test_smoothing_weights_are_searched_in_batches(spark):
    """Croston, ADIDA, IMAPA and theta search their weights in Arrow functions; series without demand or values stay as they were."""
    data = [("a", [0.0, 3.0, 0.0, 0.0, 5.0, 2.0]), ("zero", [0.0, 0.0]), ("none", []), ("gap", [1.0, None, 2.0]), ("one", [4.0])]
    rows = spark.createDataFrame(data, "unique_id string, y array<double>").coalesce(1)
    for fn in (intermittent.croston_optimized, intermittent.adida, intermittent.imapa, smoothing.theta):
        out = rows.select("unique_id", fn(F.col("y"), 2, 12).alias("v"))
        assert "ArrowEvalPython" in out._jdf.queryExecution().optimizedPlan().toString()
        got = {r[0]: r[1] for r in out.collect()}
        if fn is smoothing.theta:
            assert got["none"] == [None, None] and got["one"] == [4.0, 4.0] and got["zero"] == [0.0, 0.0]
        else:
            assert got["zero"] == got["none"] == [0.0, 0.0] and got["one"] == [4.0, 4.0] and got["a"][0] == got["a"][1] > 0
    fits = values(rows, intermittent.ses_fit(F.col("y")))
    plain = values(rows, intermittent.ses_best(F.col("y")))
    assert {k: v for k, v in fits.items() if k != "gap"} == {k: v for k, v in plain.items() if k != "gap"}
