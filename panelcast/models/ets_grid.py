"""The smoothing models' grid search on many series at once, without Spark: what a task works out of an Arrow batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from panelcast.models.garch_grid import unpack

#: Series that are worked on together; their states stay in the processor's cache.
TOGETHER = 512
_STATE = ("aicc", "k", "alpha", "beta", "phi", "level", "trend")


def running_sum(values: np.ndarray) -> np.ndarray:
    """Sums over the first axis, added one by one in its order."""
    out = np.zeros(values.shape[1:])
    for part in values:
        out = out + part
    return out


def line_start(y: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean, slope, intercept one step before the first) of the line through at most ten first points."""
    n = np.minimum(size, 10).astype(np.float64)
    first = y[:10]
    place = np.arange(len(first))[:, None]
    inside = place < n
    middle, spread = (n - 1) / 2.0, n * (n**2.0 - 1.0) / 12.0
    weighted = running_sum(np.where(inside, (place - middle) * first, 0.0))
    slope = np.where(spread > 0, weighted / np.where(spread > 0, spread, 1.0), 0.0)
    mean = running_sum(np.where(inside, first, 0.0)) / n
    return mean, slope, (mean - slope * middle) - slope


def aicc(sse: np.ndarray, n: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Infinite when there are too few points for the parameter count."""
    room = n - k - 1.0
    enough = room > 0
    score = n * np.log(np.maximum(sse / n, 1e-12)) + 2.0 * k + 2.0 * k * (k + 1.0) / np.where(enough, room, 1.0)
    return np.where(enough, np.where(np.isnan(score), np.finfo(float).max, score), np.inf)


def plain_runs(y, size, alive, points):
    """(level, trend, sse) of all points (series x points): level, trend or damped trend."""
    alpha, beta, phi = points
    mean, slope, intercept = line_start(y, size)
    level = np.where(phi > 0, intercept[:, None], mean[:, None])
    trend = np.where(phi > 0, slope[:, None], 0.0)
    sse = np.zeros_like(level)
    for t, c in enumerate(alive):
        drift = phi * trend[:c]
        f = level[:c] + drift
        e = y[t, :c, None] - f
        level[:c], trend[:c] = f + alpha * e, drift + beta * e
        sse[:c] += e * e
    return level, trend, sse


def seasonal_runs(y, alive, points, m):
    """The same and the season (places x series x points), whose first place is the next one's."""
    alpha, beta, phi, gamma = points
    first = running_sum(y[:m]) / m
    slope = (running_sum(y[m : 2 * m]) / m - first) / m
    level = np.where(phi > 0, (first - slope * (m + 1) / 2.0)[:, None], first[:, None])
    trend = np.where(phi > 0, slope[:, None], 0.0)
    season = np.stack([y[i][:, None] - (level + trend * (i + 1)) for i in range(m)])
    sse = np.zeros_like(level)
    for t, c in enumerate(alive):
        drift = phi * trend[:c]
        base = level[:c] + drift
        e = y[t, :c, None] - base - season[t % m, :c]
        level[:c], trend[:c] = base + alpha * e, drift + beta * e
        season[t % m, :c] += gamma * e
        sse[:c] += e * e
    return level, trend, sse, season


def searched(numbers: np.ndarray, limits: np.ndarray, rows: np.ndarray, plain: np.ndarray, seasonal: np.ndarray, m: int):
    """The best candidate of some series (longest first): a dict of arrays, and a season per series."""
    size, count = (limits[1:] - limits[:-1])[rows], len(rows)
    y = np.zeros((int(size[0]), count))
    for i, r in enumerate(rows):
        y[: size[i], i] = numbers[limits[r] : limits[r + 1]]
    alive = [int(np.searchsorted(-size, -t, "left")) for t in range(len(y))]  # those with a value at place t
    n = size.astype(np.float64)[:, None]

    level, trend, sse = plain_runs(y, size, alive, plain[:, 1:].T)
    grid = np.concatenate([plain, np.zeros((len(plain), 1))], axis=1)
    score = aicc(sse, n, plain[:, 0])
    whole, season = int(np.searchsorted(-size, -2 * m, "right")) if m > 1 else 0, None
    if whole:  # two full seasons
        some = [min(c, whole) for c in alive]
        more = seasonal_runs(y[:, :whole], some, seasonal[:, 1:].T, m)
        grid, season = np.concatenate([grid, seasonal]), more[3]

        def joined(a, b, rest):
            out = np.full((count, len(grid)), rest)
            out[:, : len(plain)], out[:whole, len(plain) :] = a, b
            return out

        score = joined(score, aicc(more[2], n[:whole], seasonal[:, 0]), np.inf)
        level, trend = joined(level, more[0], 0.0), joined(trend, more[1], 0.0)

    def season_at(i, c):
        return np.roll(season[:, i, c - len(plain)], -(size[i] % m)) if c >= len(plain) else np.zeros(1)

    order = np.lexsort(grid[:, [4, 3, 2, 1, 0]].T)  # ties: parameter count, weights, then the states
    every, best = np.arange(count), order[np.argmin(score[:, order], axis=1)]
    tied = (score == score[every, best][:, None]).sum(1) > 1
    for i in np.flatnonzero(tied & np.isfinite(score[every, best])):
        same = [c for c in np.flatnonzero(score[i] == score[i, best[i]]) if (grid[c, :4] == grid[best[i], :4]).all()]
        best[i] = min(same, key=lambda c: (level[i, c], trend[i, c], *season_at(i, c)))
    state = (score[every, best], *grid[best, :4].T, level[every, best], trend[every, best])
    return dict(zip(_STATE, state)), [season_at(i, c) for i, c in enumerate(best)]


def fit_batch(values: pa.ListArray, plain: list[tuple], seasonal: list[tuple], m: int) -> pa.StructArray:
    """A struct per series, NULL for series that are too short to score or miss a value."""
    numbers, limits = unpack(values)
    size = limits[1:] - limits[:-1]
    gaps = np.concatenate([[0], np.cumsum(np.asarray(values.flatten().is_null()))])
    usable = (size > 0) & (gaps[limits[1:]] == gaps[limits[:-1]])
    order = np.argsort(-size, kind="stable")
    order = order[usable[order]]
    found = {name: np.full(len(size), np.inf) for name in _STATE}
    seasons = [np.zeros(0)] * len(size)
    for begin in range(0, len(order), TOGETHER):
        rows = order[begin : begin + TOGETHER]
        state, season = searched(numbers, limits, rows, np.array(plain, np.float64), np.array(seasonal, np.float64).reshape(-1, 5), m)
        for name in _STATE:
            found[name][rows] = state[name]
        for r, s in zip(rows, season):
            seasons[r] = s
    places = np.concatenate([[0], np.cumsum([len(s) for s in seasons])]).astype(np.int32)
    flat = np.concatenate(seasons) if seasons else np.zeros(0)
    columns = [*[pa.array(found[name]) for name in _STATE], pa.ListArray.from_arrays(pa.array(places), pa.array(flat))]
    return pa.StructArray.from_arrays(columns, [*_STATE, "season"], mask=pa.array(np.isinf(found["aicc"])))
