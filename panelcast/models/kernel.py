"""Huber regression on random Fourier features (Rahimi and Recht 2007), fitted by Newton's method.

The features are never stored: every step is one pass in which tasks work them out of the inputs, some rows at a time, and
keep only sums, as many as coefficients squared. The loss is that of Owen (2007), whose scale is estimated with the
coefficients; the penalty is on the squared coefficients of standardised features.
"""

from __future__ import annotations

import json
import math
import random

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.staging import ship

#: Rows whose features are worked out together; they stay in the processor's cache.
CHUNK = 1 << 11
#: Residuals of more than so many scales count linearly (95 % efficiency under normal errors).
EPSILON = 1.35
#: Shares of a step that are tried, each half of the one before.
HALVINGS = 8


def draw(means: list[float], deviations: list[float], size: int, seed: int) -> dict[str, list]:
    """Weights (features x inputs) and offsets of the phases of standardised inputs."""
    rng, gamma = random.Random(seed), 1.0 / len(means)
    offsets, weights = [], []
    for _ in range(size):
        offsets.append(rng.uniform(0.0, 2.0 * math.pi))
        weights.append([rng.gauss(0.0, math.sqrt(2.0 * gamma)) / sd for sd in deviations])
    return {"means": means, "weights": weights, "offsets": offsets}


def fourier(x: np.ndarray, drawn: dict[str, list]) -> np.ndarray:
    """A column of ones and the features of some rows (rows x inputs)."""
    out = np.ones((len(x), 1 + len(drawn["offsets"])))
    phase = (x - np.array(drawn["means"])) @ np.array(drawn["weights"]).T + np.array(drawn["offsets"])
    np.multiply(np.cos(phase), math.sqrt(2.0 / len(drawn["offsets"])), out=out[:, 1:])
    return out


def huber_sums(x: np.ndarray, y: np.ndarray, drawn: dict[str, list], coef: np.ndarray, scale: float) -> np.ndarray:
    """Sums over rows: products of the features and of features and residuals within the limit, signs beyond it, four numbers."""
    k = len(coef)
    products, inner, outer, numbers = np.zeros((k, k)), np.zeros(k), np.zeros(k), np.zeros(4)
    for begin in range(0, len(y), CHUNK):
        z = fourier(x[begin : begin + CHUNK], drawn)
        r = y[begin : begin + CHUNK] - z @ coef
        near = np.abs(r) <= EPSILON * scale
        some, far = z[near], r[~near]
        products += some.T @ some
        inner += some.T @ r[near]
        outer += z[~near].T @ np.sign(far)
        numbers += [near.sum(), r[near] @ r[near], len(far), np.abs(far).sum()]
    return np.concatenate([products.ravel(), inner, outer, numbers])


class Sums:
    """The loss at one point, its slopes and its curvature, from the sums over all rows."""

    def __init__(self, flat: np.ndarray, k: int, coef: np.ndarray, scale: float):
        self.products, self.inner, self.outer = flat[: k * k].reshape(k, k), flat[k * k : k * k + k], flat[k * k + k : -4]
        self.near, self.squares, self.far, self.distance = flat[-4:]
        self.rows, self.coef, self.scale = self.near + self.far, coef, scale

    def loss(self, penalty: np.ndarray) -> float:
        s = self.scale
        total = self.near * s + self.squares / s + 2.0 * EPSILON * self.distance + self.far * s * (1.0 - EPSILON**2)
        return float(0.5 * total / self.rows + 0.5 * (penalty * self.coef**2).sum())

    def slopes(self, penalty: np.ndarray) -> np.ndarray:
        s = self.scale
        by_coef = penalty * self.coef - (self.inner / s + EPSILON * self.outer) / self.rows
        by_scale = 0.5 * (self.near - self.squares / s**2 + self.far * (1.0 - EPSILON**2)) / self.rows
        return np.append(by_coef, by_scale)

    def curvature(self, penalty: np.ndarray) -> np.ndarray:
        s, side = self.scale, self.inner[:, None] / self.scale**2
        whole = np.block([[self.products / s, side], [side.T, np.array([[self.squares / s**3]])]]) / self.rows
        return whole + np.diag(np.append(penalty, 0.0))


def least_huber(sums, k: int, c: float, iterations: int, tolerance: float) -> Sums:
    """The point of least loss. ``sums(coef, scale)`` is one pass; the start is the line of least squares.

    Every step lowers the loss; the last one does by less than ``tolerance`` of it.
    """
    start = sums(np.zeros(k), math.inf)
    n, total, squares = start.rows, start.products[0], np.diag(start.products)
    if not n:
        raise ValueError("no rows to fit a regression on")
    # The penalty c weighs the sum of the losses, the loss here is their mean: hence the number of rows.
    penalty = np.maximum(squares - total**2 / n, 0.0) / max(n - 1.0, 1.0) / (c * n)
    penalty[0] = 0.0
    coef = np.linalg.lstsq(start.products + n * np.diag(penalty), start.inner, rcond=1e-12)[0]
    rest = start.squares - 2.0 * coef @ start.inner + coef @ start.products @ coef
    least = 1e-7 * math.sqrt(start.squares / n) + 1e-100
    here = sums(coef, max(math.sqrt(max(rest, 0.0) / n), least))
    for _ in range(iterations):
        if here.scale <= least:  # all residuals are rounding errors
            break
        slopes = here.slopes(penalty)
        step = -np.linalg.lstsq(here.curvature(penalty), slopes, rcond=1e-14)[0]
        share = min(1.0, -0.75 * here.scale / step[-1]) if step[-1] < 0 else 1.0
        for _ in range(HALVINGS):
            there = sums(here.coef + share * step[:-1], max(here.scale + share * step[-1], least))
            if there.loss(penalty) <= here.loss(penalty) + 1e-4 * share * float(slopes @ step):
                break
            share /= 2.0
        gain = here.loss(penalty) - there.loss(penalty)
        here = there if gain > 0 else here
        if share == 1.0 and gain <= tolerance * here.loss(penalty) or gain <= 0:
            break
    return here


class KernelModel(Model, DefaultParamsWritable, DefaultParamsReadable):
    """Adds ``prediction``, NULL where an input is missing."""

    state = Param(Params._dummy(), "state", "inputs, phases and coefficients as text", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, state: str = ""):
        super().__init__()
        self._set(**self._input_kwargs)

    @property
    def content(self) -> dict:
        return json.loads(self.getOrDefault(self.state))

    #: Chained in one plan, every step would hold a worker of its own.
    runs_in_workers = True

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship(dataset.sparkSession)
        content = self.content

        @F.pandas_udf("double")
        def predict(rows: pd.DataFrame) -> pd.Series:
            x, coef = rows.to_numpy(np.float64, na_value=np.nan), np.array(content["coefficients"])
            parts = [fourier(x[i : i + CHUNK], content["drawn"]) @ coef for i in range(0, len(x), CHUNK)]
            return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

        columns = [F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(content["features"])]
        return dataset.withColumn("prediction", predict(F.struct(*columns)))


class KernelRegression(Estimator):
    """Fits ``y`` on some columns. ``p``: c (the weight of the losses), features, iterations, tolerance, seed."""

    def __init__(self, p: dict, features: list[str]):
        super().__init__()
        self.p, self.features = p, features

    def _fit(self, dataset: DataFrame) -> KernelModel:
        ship(dataset.sparkSession)
        names = [f"f{i}" for i in range(len(self.features))]
        inputs = dataset.select(F.col("y").cast("double").alias("y"), *[F.col(c).cast("double").alias(n) for c, n in zip(self.features, names)]).dropna()
        stats = inputs.agg(*[F.avg(n) for n in names], *[F.stddev_pop(n) for n in names]).first()
        means, deviations = [v or 0.0 for v in stats[: len(names)]], [v or 1.0 for v in stats[len(names) :]]
        drawn, k = draw(means, deviations, self.p["features"], self.p["seed"]), self.p["features"] + 1

        def sums(coef: np.ndarray, scale: float) -> Sums:
            def run(batches):
                total = np.zeros(k * k + 2 * k + 4)
                for batch in batches:
                    y, *x = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns))
                    total += huber_sums(np.stack(x, 1), y, drawn, coef, scale)
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["sums"])

            parts = inputs.mapInArrow(run, "sums binary").rdd.map(lambda r: np.frombuffer(bytes(r["sums"])))
            return Sums(parts.treeReduce(np.add), k, coef, scale)

        found = least_huber(sums, k, self.p["c"], self.p["iterations"], self.p["tolerance"])
        return KernelModel(state=json.dumps({"features": self.features, "drawn": drawn, "coefficients": found.coef.tolist(), "scale": found.scale}))
