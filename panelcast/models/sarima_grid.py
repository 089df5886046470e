"""The seasonal ARMA search of :mod:`panelcast.models.sarima` on many series at once, without Spark: what a task works out of an Arrow batch.

Series of equal length that are differenced alike are worked on together: arrays are (points x series), all orders of all of
them are eliminated at the same time. Sums are added in the order of the expressions, so both give the same.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa

from panelcast.models.ets_grid import aicc, running_sum
from panelcast.models.garch_grid import unpack

#: Series that are worked on together; their equations stay in the processor's cache.
TOGETHER = 256


def statistic(y: np.ndarray) -> np.ndarray:
    """Squared partial sums of the centred series over its long-run variance."""
    n = len(y)
    e = y - running_sum(y) / n
    width = math.floor(4.0 * (n / 100.0) ** 0.25)
    long_run = running_sum(e * e)
    for j in range(1, min(width, n - 1) + 1):
        long_run = long_run + 2.0 * ((1.0 - j / (width + 1.0)) * running_sum(e[j:] * e[: n - j]))
    return running_sum(np.cumsum(e, 0) ** 2) / (n * np.maximum(long_run, 1e-12))


def spread(a: np.ndarray) -> np.ndarray:
    return running_sum(a * a) / len(a) - (running_sum(a) / len(a)) ** 2.0


def strength(y: np.ndarray, m: int) -> np.ndarray:
    """Share of the detrended variance that the seasonal pattern explains."""
    n, half = len(y), m // 2
    trend = []
    for i in range(half, n - half):
        inside = running_sum(y[i - half : i + half + 1])
        trend.append((inside - (y[i - half] + y[i + half]) / 2.0 if m % 2 == 0 else inside) / m)
    detrended, place = y[half : n - half] - np.stack(trend), np.arange(half, n - half) % m
    effects = np.stack([running_sum(detrended[place == j]) / (place == j).sum() for j in range(m)])
    rest, everything = spread(detrended - effects[place]), spread(detrended)
    some = everything > 1e-12
    return np.where(some, np.maximum(1.0 - rest / np.where(some, everything, 1.0), 0.0), 0.0)


def solved(system: np.ndarray) -> np.ndarray:
    """Solutions of symmetric systems (..., k, k + 1, series), NaN where they are singular."""
    k = system.shape[-3]
    start = np.stack([system[..., j, j, :] for j in range(k)])
    for j in range(k):
        pivot = system[..., j, j, :]
        usable = np.abs(pivot) > 1e-10 * np.abs(start[j])
        unit = system[..., j, :, :] / np.where(usable, pivot, np.nan)[..., None, :]
        system = system - system[..., :, j, :][..., :, None, :] * unit[..., None, :, :]
        system[..., j, :, :] = unit
    return system[..., k, :]


def products(columns: np.ndarray) -> np.ndarray:
    """Products of all pairs of columns (columns x points x series)."""
    a, b = np.triu_indices(len(columns))
    sums = running_sum(np.ascontiguousarray((columns[a] * columns[b]).transpose(1, 0, 2)))
    out = np.empty((len(columns), len(columns), columns.shape[2]))
    out[a, b], out[b, a] = sums, sums
    return out


def aligned(parts: list[tuple[np.ndarray, int]], drop: int) -> np.ndarray:
    """The target, a column of ones and the lagged parts, without the first ``drop`` points."""
    target = parts[0][0][drop:]
    return np.stack([target, np.ones_like(target), *[a[drop - lag : len(a) - lag] for a, lag in parts]])


def innovations(z: np.ndarray, lags: list[int]) -> np.ndarray:
    """Residuals of the long autoregression, 0 before its first one; NaN where it is not identified."""
    drop = max(lags)
    g = products(aligned([(z, lag) for lag in lags], drop))
    coef = solved(np.concatenate([g[1:, 1:], g[1:, :1]], axis=1))
    fitted = coef[0]
    for c, lag in zip(coef[1:], lags):
        fitted = fitted + c * z[drop - lag : len(z) - lag]
    return np.concatenate([np.zeros((drop, z.shape[1])), z[drop:] - fitted])


def within(first: np.ndarray, second: np.ndarray, season: np.ndarray, limit: float) -> np.ndarray:
    triangle = (np.abs(second) < limit) & (first + second < limit) & (second - first < limit)
    return np.where(season == 0.0, triangle, np.abs(first) + np.abs(second) + np.abs(season) < limit)


def best_order(w: np.ndarray, lags: list[int], long_lags: list[int], masks: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(constant, weights of the lags, weights of the innovations) of each series' order with the lowest AICc; the mean without one."""
    drop, width, count = max(long_lags), len(lags), w.shape[1]
    mu = running_sum(w) / len(w)
    constant, phi, theta = mu, np.zeros((width, count)), np.zeros((width, count))
    if len(w) <= drop:
        return constant, phi, theta
    z = w - mu
    e = innovations(z, long_lags)
    g = products(aligned([(z, lag) for lag in lags] + [(e, lag) for lag in lags], drop))
    k, n = 2 * width + 1, float(len(w) - drop)
    use = masks[:, :, None, None] & masks[:, None, :, None]
    left = np.where(use, g[None, 1:, 1:], np.eye(k)[None, :, :, None])
    right = np.where(masks[:, :, None], g[None, 1:, 0], 0.0)
    b = solved(np.concatenate([left, right[:, :, None]], axis=2))  # orders x coefficients x series
    used = masks.sum(1) - 1.0
    found = ~np.isnan(b).any(1)
    sse = g[0, 0] - running_sum((b * right).transpose(1, 0, 2))
    score = aicc(np.where(found, sse, 1.0), np.full((1, 1), n), (used + 2.0)[:, None])
    seasonal = (lambda a: a[:, 2]) if width > 2 else (lambda a: np.zeros_like(a[:, 0]))
    ar, ma = b[:, 1 : width + 1], b[:, width + 1 :]
    with np.errstate(invalid="ignore"):
        stable = within(ar[:, 0], ar[:, 1], seasonal(ar), limit) & within(-ma[:, 0], -ma[:, 1], -seasonal(ma), limit)
    score = np.where(found & stable, score, np.inf)
    rest = np.ones_like(b[:, 0])
    for i in range(width):
        rest = rest - ar[:, i]
    c = b[:, 0] + mu * rest
    best, every = np.argmin(score, axis=0), np.arange(count)
    for i in np.flatnonzero(((score == score[best, every]) & np.isfinite(score)).sum(0) > 1):  # ties: terms, then coefficients
        same = np.flatnonzero(score[:, i] == score[best[i], i])
        best[i] = min(same, key=lambda o: (used[o], c[o, i], *ar[o, :, i], *ma[o, :, i]))
    known = np.isfinite(score[best, every])
    chosen = b[best, :, every].T
    return np.where(known, c[best, every], mu), np.where(known, chosen[1 : width + 1], 0.0), np.where(known, chosen[width + 1 :], 0.0)


def path(y: np.ndarray, w: np.ndarray, d: int, seasonal: int, h: int, m: int, lags: list[int], model) -> np.ndarray:
    """Recursive forecast (steps x series) with no further innovations, the differences undone."""
    (c, phi, theta), depth, none = model, max(lags), np.zeros(y.shape[1])
    shocks = [none] * depth
    for t in range(depth, len(w)):
        value = w[t] - c
        for k, lag in enumerate(lags):
            value = value - phi[k] * w[t - lag] - theta[k] * shocks[-lag]
        shocks.append(value)
    hist = [none] * (depth + m + 1) + list(y)  # before its first value a series counts as 0

    def undone(k: int) -> np.ndarray:
        return hist[-k] - d * hist[-k - 1]

    for _ in range(h):
        level = c
        for k, lag in enumerate(lags):
            plain = undone(lag)
            level = level + phi[k] * (plain - undone(lag + m) if seasonal else plain)
            level = level + theta[k] * shocks[-lag]
        hist.append(level + (d * hist[-1] + (undone(m) if seasonal else 0.0)))
        shocks.append(none)
    return np.stack(hist[len(hist) - h :])


def forecasts(y: np.ndarray, h: int, m: int, orders: dict[bool, list[tuple]], limits: dict[str, float], long_order: int) -> np.ndarray:
    """Forecasts (steps x series) of series of one length."""
    n, count = y.shape
    strong = strength(y, m) > limits["strength"] if m > 1 and n >= limits["seasons"] * m else np.zeros(count, bool)
    moving = statistic(y) > limits["stationarity"]
    if strong.any():
        moving[strong] = statistic(y[m:, strong] - y[:-m, strong]) > limits["stationarity"]
    out = np.full((h, count), np.nan)
    for code in range(4):
        d, seasonal = code % 2, code // 2
        rows = np.flatnonzero((moving == bool(d)) & (strong == bool(seasonal)))
        w = y[:, rows]
        w = w[m:] - w[:-m] if seasonal else w
        w = w[1:] - w[:-1] if d else w
        if not len(rows):
            continue
        season = m if m > 1 and len(w) >= limits["seasons"] * m else 1
        lags = [1, 2, season] if season > 1 else [1, 2]
        extra = (lambda order: [order]) if season > 1 else (lambda order: [])
        masks = np.array([[1, p >= 1, p >= 2, *extra(P), q >= 1, q >= 2, *extra(Q)] for p, q, P, Q in orders[season > 1]], bool)
        model = best_order(w, lags, sorted({*range(1, long_order + 1), *lags}), masks, limits["inside"])
        out[:, rows] = path(y[:, rows], w, d, seasonal, h, m, lags, model)
    return out


def path_batch(values: pa.ListArray, h: int, m: int, orders: dict[bool, list[tuple]], limits: dict[str, float], long_order: int) -> pa.ListArray:
    """``h`` values per series; NULL for series without values or with a missing one, NaN where one is not a number."""
    numbers, places = unpack(values)
    size = places[1:] - places[:-1]
    gaps = np.concatenate([[0], np.cumsum(np.asarray(values.flatten().is_null()))])
    odd = np.concatenate([[0], np.cumsum(~np.isfinite(numbers))])
    known = (size > 0) & (gaps[places[1:]] == gaps[places[:-1]])
    plain = known & (odd[places[1:]] == odd[places[:-1]])
    out = np.full((len(size), h), np.nan)
    for n in np.unique(size[plain]):
        same = np.flatnonzero(plain & (size == n))
        for begin in range(0, len(same), TOGETHER):
            rows = same[begin : begin + TOGETHER]
            y = numbers[places[rows][None, :] + np.arange(n)[:, None]]
            out[rows] = forecasts(y, h, m, orders, limits, long_order).T
    offsets = pa.array(np.arange(len(size) + 1, dtype=np.int32) * h)
    return pa.ListArray.from_arrays(offsets, pa.array(out.ravel()), mask=pa.array(~known))
