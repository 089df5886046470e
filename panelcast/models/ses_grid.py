"""Simple exponential smoothing with searched weights on many series at once, without Spark: what a task works out of an Arrow batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from panelcast.models.garch_grid import unpack

#: Arrays that are smoothed together; their states stay in the processor's cache.
TOGETHER = 1024


def smoothed(arrays: list[np.ndarray], alphas: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(least squared error, its weight, level after the last value) of every array; NaN for empty ones."""
    size = np.array([len(a) for a in arrays], np.int64)
    out = np.full((3, len(arrays)), np.nan)
    order = np.argsort(-size, kind="stable")[: int((size > 0).sum())]
    for begin in range(0, len(order), TOGETHER):
        rows = order[begin : begin + TOGETHER]
        lengths = size[rows]
        x = np.zeros((int(lengths[0]), len(rows)))
        for i, r in enumerate(rows):
            x[: lengths[i], i] = arrays[r]
        level, sse = np.repeat(x[0][:, None], len(alphas), 1), np.zeros((len(rows), len(alphas)))
        for t in range(len(x)):
            c = int(np.searchsorted(-lengths, -t, "left"))  # those with a value at place t
            e = x[t, :c, None] - level[:c]
            level[:c] += alphas * e
            sse[:c] += e * e
        best = np.argmin(np.where(np.isnan(sse), np.inf, sse), axis=1)  # ties: the smallest weight
        every = np.arange(len(rows))
        out[:, rows] = sse[every, best], alphas[best], level[every, best]
    return out[0], out[1], out[2]


def series_of(values: pa.ListArray) -> tuple[list[np.ndarray], np.ndarray]:
    """The arrays of a batch, and which of them miss a value."""
    numbers, limits = unpack(values)
    gaps = np.concatenate([[0], np.cumsum(np.asarray(values.flatten().is_null()))])
    return [numbers[a:b] for a, b in zip(limits[:-1], limits[1:])], gaps[limits[1:]] > gaps[limits[:-1]]


def fit_batch(values: pa.ListArray, alphas: list[float]) -> pa.StructArray:
    """A struct(sse, alpha, level) per array, NULL for empty ones; without error and level where a value is missing."""
    arrays, broken = series_of(values)
    sse, alpha, level = smoothed(arrays, np.array(alphas))
    columns = [pa.array(sse, mask=broken), pa.array(np.where(broken, alphas[0], alpha)), pa.array(level, mask=broken)]
    return pa.StructArray.from_arrays(columns, ["sse", "alpha", "level"], mask=pa.array([not len(a) for a in arrays], pa.bool_()))


def bucket_sums(y: np.ndarray, k: int) -> np.ndarray:
    """Sums of consecutive blocks of ``k`` values; the oldest incomplete block is left out."""
    blocks, out = y[len(y) % k :].reshape(-1, k), 0.0
    for place in range(k):
        out = out + blocks[:, place]
    return out


def rates_batch(values: pa.ListArray, alphas: list[float], all_levels: bool) -> pa.Array:
    """The rate per period from sums over the mean interval between demands, or averaged over all lengths up to it.

    NULL for series without demand or with a missing value.
    """
    arrays, broken = series_of(values)
    sums, levels, owner = [], [], []
    for i, y in enumerate(arrays):
        places = np.flatnonzero(y != 0)
        if broken[i] or not len(places):
            continue
        k = int(np.rint((places[-1] + 1.0) / len(places)))
        for level in range(1, k + 1) if all_levels else [k]:
            sums.append(bucket_sums(y, level))
            levels.append(level)
            owner.append(i)
    owner = np.array(owner, np.int64)
    total, count = np.zeros(len(arrays)), np.bincount(owner, minlength=len(arrays))
    np.add.at(total, owner, smoothed(sums, np.array(alphas))[2] / np.array(levels, np.float64))  # added in the order of lengths
    return pa.array(total / np.maximum(count, 1), mask=count == 0)


def croston_batch(values: pa.ListArray, alphas: list[float]) -> pa.Array:
    """The smoothed demand over the smoothed interval between demands; NULL for series without demand."""
    numbers, limits = unpack(values)
    numbers = np.where(np.asarray(values.flatten().is_null()), 0.0, numbers)  # a missing value is no demand
    arrays = [numbers[a:b] for a, b in zip(limits[:-1], limits[1:])]
    places = [np.flatnonzero(y != 0) for y in arrays]
    _, _, size = smoothed([y[p] for y, p in zip(arrays, places)], np.array(alphas))
    _, _, interval = smoothed([np.diff(p, prepend=-1).astype(np.float64) for p in places], np.array(alphas))
    return pa.array(size / interval, mask=np.array([not len(p) for p in places], bool))
