"""Lag, rolling and calendar features of an aggregated panel, all over one window order.

Lags are positional: the previous row of the series, whether or not a period is missing.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.arrays import mean
from panelcast.functions.calendar import date_feature, select_date_features


def default_lag_transforms(lags: list[int]) -> dict[int, list[int]]:
    """Rolling means of 3, 6 and 12 over the first lag and of 3 over the last.

    With a single lag the second rule replaces the first.
    """
    return {lags[0]: [3, 6, 12], lags[-1]: [3]}


@dataclass(frozen=True)
class FeatureSpec:
    """Which features a global model sees; ``rolling`` maps a lag to window sizes."""

    lags: list[int] = field(default_factory=list)
    rolling: dict[int, list[int]] = field(default_factory=dict)
    date_features: list[str] = field(default_factory=list)

    def __post_init__(self):
        object.__setattr__(self, "date_features", select_date_features(self.date_features))

    @property
    def columns(self) -> list[str]:
        return (
            [f"lag{k}" for k in self.lags]
            + [rolling_name(k, w) for k, sizes in self.rolling.items() for w in sizes]
            + list(self.date_features)
        )

    @property
    def warm_up(self) -> int:
        """How many rows at the start of a series lack a feature."""
        needs = list(self.lags) + [k + w - 1 for k, sizes in self.rolling.items() for w in sizes]
        return max(needs, default=0)

    @property
    def history(self) -> int:
        """How many trailing values the features of the next step need."""
        return max(self.warm_up, 1)


def rolling_name(lag: int, size: int) -> str:
    return f"rolling_mean_lag{lag}_window_size{size}"


def series_order() -> Window:
    return Window.partitionBy("unique_id").orderBy("ds")


def lag_column(lag: int) -> Column:
    return F.lag("y", lag).over(series_order())


def rolling_mean(lag: int, size: int) -> Column:
    """Mean of ``size`` values ending ``lag`` rows back; NULL until that many exist."""
    frame = series_order().rowsBetween(-(lag + size - 1), -lag)
    return F.when(F.count("y").over(frame) == size, F.avg("y").over(frame))


def build_features(df: DataFrame, spec: FeatureSpec, drop_incomplete: bool = False) -> DataFrame:
    """Add all features in one pass; every window shares one partitioning and order."""
    columns = {f"lag{k}": lag_column(k) for k in spec.lags}
    for lag, sizes in spec.rolling.items():
        columns.update({rolling_name(lag, w): rolling_mean(lag, w) for w in sizes})
    columns.update({name: date_feature(name, F.col("ds")) for name in spec.date_features})
    out = df.withColumns(columns) if columns else df
    return out.dropna(subset=spec.columns) if drop_incomplete and columns else out


def feature_at(spec: FeatureSpec, values: Column, dates: Column, i: Column) -> dict[str, Column]:
    """All features of the point at index ``i`` of a series; ``i`` has ``warm_up`` points before it."""
    columns = {f"lag{k}": F.get(values, i - k) for k in spec.lags}
    for lag, sizes in spec.rolling.items():
        columns.update({rolling_name(lag, w): mean(F.slice(values, i - lag - w + 2, w)) for w in sizes})
    columns.update({name: date_feature(name, F.get(dates, i)) for name in spec.date_features})
    return columns


def series_features(series: DataFrame, spec: FeatureSpec, dates: str = "dates", values: str = "values") -> DataFrame:
    """Complete feature rows of the series layout: the arrays hold all a row needs, so nothing is shuffled or sorted."""
    y, ds = F.col(values), F.col(dates)
    first, last = F.lit(spec.warm_up), F.size(y) - 1
    index = F.when(last >= first, F.sequence(first, F.greatest(last, first)))

    def point(i: Column) -> Column:
        columns = {"y": F.get(y, i), **feature_at(spec, y, ds, i)}
        return F.struct(F.get(ds, i).alias("ds"), *[c.alias(name) for name, c in columns.items()])

    rows = series.select("unique_id", F.explode(F.transform(index, point)).alias("p"))
    return rows.select("unique_id", "p.*").dropna(subset=["y", *spec.columns])
