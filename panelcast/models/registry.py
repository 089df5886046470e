"""Model registry: key -> how to build the model, plus the model lists of the jobs.

Families: ``native`` (array expression over one series), ``global`` (Spark ML
estimator over all series' feature rows) and ``grouped`` (user function on one
series' pandas frame).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelcast.models import (
    autoregression,
    baseline,
    decomposition,
    global_ml,
    intermittent,
    sarima,
    smoothing,
    volatility,
)


@dataclass(frozen=True)
class Model:
    key: str
    family: str
    # native: (y, h, season) -> array<double>; global: () -> Estimator; grouped: (pdf, h, freq, season) -> pdf
    build: Callable
    # native only: (y, h) -> array<double> forecast variance
    variance: Callable | None = None


_NATIVE = {
    "arima": autoregression.arima,
    "sarima": sarima.sarima,
    "ets": smoothing.ets,
    "theta": smoothing.theta,
    "mstl": decomposition.mstl,
    "imapa": intermittent.imapa,
    "adida": intermittent.adida,
    "croston": intermittent.croston,
    "croston_optimized": intermittent.croston_optimized,
    "croston_sba": intermittent.croston_sba,
    "naive": baseline.naive,
    "seasonal_naive": baseline.seasonal_naive,
    "naive_fallback": baseline.naive,
}

# Display labels of the per-series audit and the registry keys behind them (fixed values).
AUDIT_LABELS = {
    "AutoARIMA": "arima",
    "AutoETS": "ets",
    "AutoTheta": "theta",
    "MSTL": "mstl",
    "ARCH(1)": "arch_1",
    "GARCH(1,1)": "garch_1_1",
    "ADIDA": "adida",
    "CrostonOptimized": "croston_optimized",
    "Naive": "naive",
    "SeasonalNaive": "seasonal_naive",
}
ML_LABELS = {"XGBoost": "xgb", "LightGBM": "lgbm"}
FALLBACK_LABEL = "Naive_Fallback"

_LABELS = {**AUDIT_LABELS, **ML_LABELS, FALLBACK_LABEL: "naive_fallback", "ARCH": "arch_1", "GARCH": "garch_1_1"}

# The 25 keys of the parallel training registry (fixed values).
REGISTRY_KEYS = [
    "lgbm", "rf", "et", "xgb", "gb", "ridge", "svr",
    "imapa", "adida", "croston", "croston_optimized", "croston_sba", "arima", "ets", "theta",
    "garch_1_1", "garch_1_2", "garch_2_1", "garch_2_2", "garch_3_1", "garch_3_2", "garch_3_3",
    "arch_2", "arch_3", "mstl",
]

_custom: dict[str, Model] = {}


def supported_keys() -> list[str]:
    return sorted({*REGISTRY_KEYS, *_NATIVE, "lr", "arch_<p>", "garch_<p>_<q>", *_custom})


def register_model(key: str, family: str, build: Callable) -> Model:
    """Add a user model. A ``grouped`` function gets one series' frame and returns ``ds, prediction``."""
    if family not in ("native", "global", "grouped"):
        raise ValueError(f"unknown model family {family!r}")
    _custom[key] = Model(key, family, build)
    return _custom[key]


def _orders(key: str, prefix: str, count: int) -> list[int] | None:
    parts = key.removeprefix(prefix).split("_")
    if len(parts) == count and all(p.isdigit() and int(p) > 0 for p in parts):
        return [int(p) for p in parts]
    return None


def get_model(key: str, profile: str = "library") -> Model:
    """Model for a registry key or an audit label; unknown names raise with the supported keys."""
    if key in _custom:
        return _custom[key]
    name = _LABELS.get(key, key)
    if name in _NATIVE:
        return Model(name, "native", _NATIVE[name])
    if name.startswith("garch_") and (orders := _orders(name, "garch_", 2)):
        p, q = orders
        return Model(name, "native", volatility.garch, partial(_garch_variance, p=p, q=q))
    if name.startswith("arch_") and (orders := _orders(name, "arch_", 1)):
        return Model(name, "native", volatility.arch, partial(_arch_variance, p=orders[0]))
    if name in global_ml.GLOBAL_KEYS:
        return Model(name, "global", partial(global_ml.estimator, name, profile))
    raise ValueError(f"unsupported model {key!r}; supported: {', '.join(supported_keys())}")


def _garch_variance(y: Column, h: int, p: int, q: int) -> Column:
    return volatility.garch_variance(y, h, p, q)


def _arch_variance(y: Column, h: int, p: int) -> Column:
    return volatility.arch_variance(y, h, p)


def linear_penalty(name: str, profile: str = "library") -> float | None:
    """Penalty on the squared coefficients of a linear model; None if the model is not linear."""
    key = get_model(name, profile).key
    return {"lr": 0.0, "ridge": global_ml.params("ridge", profile).get("alpha", 1.0)}.get(key)


# Periods in a year, week or day by frequency; periods some profiles give single models (fixed values).
SEASONS = {"MS": 12, "QS": 4, "YS": 1, "W": 52, "D": 7, "H": 24}
PROFILE_SEASONS = {
    "library": {"arima": 12, "sarima": 12, "ets": 12, "mstl": 24},
    "parallel": {"mstl": 24},
}
_SEASONAL_ONLY = ("mstl", "seasonal_naive")


def season_of(name: str, profile: str, freq: str) -> int:
    """Season length of a model: what its profile says, else the one of the frequency."""
    key = _LABELS.get(name, name)
    return PROFILE_SEASONS.get(profile, {}).get(key, SEASONS[freq])


def forecast_path(name: str, y: Column, h: int, m) -> Column:
    """Forecast of a native model, one value per step; NULLs where it cannot be computed.

    ``m`` is the season length or a function from the model's name to it.
    """
    m = m(name) if callable(m) else m
    if m <= 1 and _LABELS.get(name, name) in _SEASONAL_ONLY:
        raise ValueError(f"{name} needs a season of more than one period")
    path = get_model(name).build(y, h, m)
    return F.coalesce(path, F.array_repeat(F.lit(None).cast("double"), h))


def split_families(names: list[str], profile: str = "library") -> dict[str, list[str]]:
    groups: dict[str, list[str]] = {"native": [], "global": [], "grouped": []}
    for name in names:
        groups[get_model(name, profile).family].append(name)
    return groups
