"""The GARCH grid search on many series at once, without Spark: what a task works out of an Arrow batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Series that are worked on together; their states stay in the processor's cache.
TOGETHER = 2048


def unpack(values: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, limits): series ``i`` holds ``numbers[limits[i]:limits[i + 1]]``; missing numbers are NaN."""
    sizes = np.asarray(values.value_lengths().fill_null(0))
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.concatenate([[0], np.cumsum(sizes)])


def searched(numbers: np.ndarray, limits: np.ndarray, rows: np.ndarray, grid: np.ndarray, p: int, q: int, h: int) -> dict[str, np.ndarray]:
    """The best grid point of some series (longest first), its state after the last value and ``h`` variances."""
    size, count = (limits[1:] - limits[:-1])[rows], len(rows)
    longest = int(size[0])
    y = np.zeros((longest, count))
    for i, r in enumerate(rows):
        y[: size[i], i] = numbers[limits[r] : limits[r + 1]]
    alive = [int(np.searchsorted(-size, -t, "left")) for t in range(longest)]  # those with a value at place t

    def mean(a):
        out = np.zeros(count)
        for t, k in enumerate(alive):
            out[:k] += a[t, :k]
        return out / size

    e2 = (y - mean(y)) ** 2
    var = mean(e2)
    a, b = grid[:, 0], grid[:, 1]

    def next_variance(omega, alpha, beta, shocks, past):
        shock, old = sum(shocks[1:], shocks[0]), sum(past[1:], past[0])
        return np.maximum(omega + alpha / p * shock + beta / q * old, 1e-12)

    omega = var[:, None] * (1.0 - a - b)
    shocks = np.repeat(var[None], p, 0)
    past = np.repeat(np.repeat(var[:, None], len(grid), 1)[None], q, 0)
    nll = np.zeros((count, len(grid)))
    for t, k in enumerate(alive):
        e = e2[t, :k]
        v = next_variance(omega[:k], a, b, shocks[:, :k, None], past[:, :k])
        nll[:k] += 0.5 * (np.log(v) + e[:, None] / v)
        shocks[:-1, :k], past[:-1, :k] = shocks[1:, :k], past[1:, :k]
        shocks[-1, :k], past[-1, :k] = e, v
    at = np.argmin(np.where(np.isnan(nll), np.inf, nll), axis=1), np.arange(count)  # ties: the first point
    best, every = at
    state = {"nll": nll[every, best], "alpha": a[best], "beta": b[best], "omega": omega[every, best], "variance": var}
    shocks, past = list(shocks), list(past[:, every, best])
    state["e2"], state["s2"], path = np.stack(shocks, 1), np.stack(past, 1), []
    for _ in range(h):
        path.append(next_variance(state["omega"], state["alpha"], state["beta"], shocks, past))
        shocks, past = [*shocks[1:], path[-1]], [*past[1:], path[-1]]
    return {**state, "path": np.stack(path, 1) if h else np.zeros((count, 0))}


def fit_batch(values: pa.ListArray, points: list[tuple[float, float]], p: int, q: int, h: int = 0) -> pa.StructArray:
    """A struct per series, NULL for series without values."""
    numbers, limits = unpack(values)
    size = limits[1:] - limits[:-1]
    order = np.argsort(-size, kind="stable")[: int((size > 0).sum())]
    grid, found = np.array(points, np.float64), {}
    for begin in range(0, len(order), TOGETHER):
        rows = order[begin : begin + TOGETHER]
        for name, part in searched(numbers, limits, rows, grid, p, q, h).items():
            if name not in found:
                found[name] = np.full((len(size), *part.shape[1:]), np.nan)
            found[name][rows] = part
    widths = {"nll": 0, "alpha": 0, "beta": 0, "omega": 0, "variance": 0, "e2": p, "s2": q, "path": h}

    def column(name):
        part = found.get(name, np.zeros((len(size), widths[name]) if name in ("e2", "s2", "path") else len(size)))
        if part.ndim == 1:
            return pa.array(part)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1, dtype=np.int32) * part.shape[1]), pa.array(part.ravel()))

    return pa.StructArray.from_arrays([column(n) for n in widths], list(widths), mask=pa.array(size == 0))
