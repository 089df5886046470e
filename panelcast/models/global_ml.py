"""Global models: one regressor over the feature rows of all series.

``lgbm``, ``xgb``, ``gb``, ``rf`` and ``et`` are the histogram trees of :mod:`panelcast.models.trees`: ``lgbm`` grows best gain first
to a number of leaves, ``xgb`` level by level with an L2 penalty, both take missing features; ``gb`` has neither; ``rf``
draws its rows with replacement, ``et`` its thresholds. ``svr`` is the Huber regression on random Fourier features of
:mod:`panelcast.models.kernel`, an approximation of the RBF kernel; Huber's loss takes the place of the insensitive one, so there
is no epsilon. The rest are Spark ML's.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.models.kernel import KernelRegression
from panelcast.models.trees import HistogramTrees

GLOBAL_KEYS = ("lgbm", "xgb", "rf", "et", "gb", "ridge", "lr", "svr")

# Hyper-parameters per profile (fixed values). "fast" is for tests and small runs.
_BOOST_300 = {"trees": 300, "rate": 0.05, "rows": 0.9, "cols": 0.9, "seed": 42}
# By leaves, at least 20 rows in each; by depth, with a penalty on the squared leaf values.
_LEAVES = {"leaves": 64, "leaf": 20, "missing": True}
_LEVELS = {"depth": 6, "l2": 1.0, "missing": True}
_LGBM_300, _XGB_300 = {**_BOOST_300, **_LEAVES}, {**_BOOST_300, **_LEVELS}
_LGBM_PLAIN = {"trees": 100, "rate": 0.1, **_LEAVES, "leaves": 31, "seed": 0}
_XGB_PLAIN = {"trees": 100, "rate": 0.3, **_LEVELS, "seed": 0}
_FOREST_300 = {"trees": 300, "depth": 10, "leaf": 2, "seed": 42}
# Of the approximation of the support vector machine: random features, iterations and tolerance of the solver.
_KERNEL = {"features": 64, "iterations": 50, "tolerance": 1e-4, "seed": 42}
PROFILES: dict[str, dict[str, dict]] = {
    "panel": {
        "lgbm": _LGBM_300,
        "xgb": _XGB_300,
        "rf": _FOREST_300,
        "et": _FOREST_300,
        "ridge": {"alpha": 1.0},
    },
    "parallel": {
        "lgbm": _LGBM_300,
        "xgb": {**_XGB_300, "rows": 0.8, "cols": 0.8},
        "rf": _FOREST_300,
        "et": _FOREST_300,
        "gb": {"trees": 300, "rate": 0.05, "depth": 5, "leaf": 2, "rows": 0.8, "seed": 42},
        "ridge": {"alpha": 1.0},
        "svr": {"c": 100.0, **_KERNEL},
    },
    "library": {
        "lgbm": _LGBM_PLAIN,
        "xgb": _XGB_PLAIN,
        "rf": {"trees": 100, "depth": 30, "seed": 0},
        "et": {"trees": 100, "depth": 30, "seed": 0},
        "gb": {"trees": 100, "rate": 0.1, "depth": 3, "seed": 0},
        "ridge": {"alpha": 1.0},
        "svr": {"c": 1.0, **_KERNEL},
    },
    "audit": {
        "lgbm": {**_LGBM_300, "trees": 400},
        "xgb": {**_XGB_300, "trees": 400},
    },
    "series_ml": {
        "lgbm": _LGBM_300,
        "xgb": _XGB_300,
        "rf": {"trees": 300, "depth": 30, "seed": 42},
        "et": {"trees": 300, "depth": 30, "seed": 42},
        "lr": {},
    },
    "monthly": {
        "lgbm": _LGBM_PLAIN,
        "xgb": _XGB_PLAIN,
        "lr": {},
    },
    "fast": {
        "lgbm": {**_LGBM_300, "trees": 10, "leaves": 16, "leaf": 5, "rate": 0.2},
        "xgb": {**_XGB_300, "trees": 10, "depth": 4, "rate": 0.2},
        "rf": {**_FOREST_300, "trees": 20, "depth": 6},
        "et": {**_FOREST_300, "trees": 20, "depth": 6},
        "gb": {"trees": 10, "rate": 0.2, "depth": 4, "leaf": 2, "rows": 0.8, "seed": 42},
    },
}


def params(key: str, profile: str) -> dict:
    """Profile values, falling back to ``parallel`` then ``library`` for keys a profile does not list."""
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}; supported: {', '.join(PROFILES)}")
    for name in (profile, "parallel", "library"):
        if key in PROFILES[name]:
            return PROFILES[name][key]
    return {}


def _linear(alpha: float, rows: DataFrame) -> LinearRegression:
    """Closed-form least squares; ``alpha`` is the penalty on the squared coefficients."""
    reg = 0.0
    if alpha:
        # The solver scales its penalty by 1/n and the label's deviation, so undo both here.
        s = rows.agg(F.count("y").alias("n"), F.stddev_pop("y").alias("sd")).first()
        reg = alpha * (s["sd"] or 0.0) / max(s["n"], 1)
    return LinearRegression(
        featuresCol="features",
        labelCol="y",
        predictionCol="prediction",
        regParam=reg,
        elasticNetParam=0.0,
        standardization=False,
        solver="normal",
    )


def estimator(key: str, profile: str, feature_cols: list[str], rows: DataFrame) -> Pipeline:
    """Unfitted pipeline for one global model; ``rows`` serves for small summary statistics only."""
    p = params(key, profile)
    if key == "rf":
        p = {**p, "bootstrap": True}
    if key in ("lgbm", "xgb", "gb", "rf", "et"):
        return Pipeline(stages=[HistogramTrees(p, feature_cols, boosted=key not in ("rf", "et"))])
    if key == "svr":
        return Pipeline(stages=[KernelRegression(p, feature_cols)])
    assemble = [VectorAssembler(inputCols=feature_cols, outputCol="features", handleInvalid="keep")]
    if key == "ridge":
        model = _linear(p.get("alpha", 1.0), rows)
    elif key == "lr":
        model = _linear(0.0, rows)
    else:
        raise ValueError(f"unknown global model {key!r}; supported: {', '.join(GLOBAL_KEYS)}")
    return Pipeline(stages=[*assemble, model])


def fit(key: str, profile: str, feature_cols: list[str], rows: DataFrame) -> PipelineModel:
    return estimator(key, profile, feature_cols, rows).fit(rows)
