"""One row per series: the layout in which per-series models run.

The panel is aggregated first, so an array is never longer than the calendar
(some hundred points per century of months, some ten thousand of days). All
work on it is a projection: no further shuffle and no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.arrays import head, let, tail
from panelcast.functions.calendar import future_dates


def series_rows(panel: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``unique_id``, kept keys, ``dates``, ``values``, ``n`` with the points in date order."""
    points = F.array_sort(F.collect_list(F.struct("ds", "y")))
    # Fitting models costs far more per byte than a scan, so these partitions must not be merged by
    # size: the explicit number keeps them apart. Kept keys depend on the series; grouping by the id
    # alone keeps the rows usable for windows by id.
    spread = int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        panel.repartition(spread, "unique_id")
        .groupBy("unique_id")
        .agg(points.alias("points"), *[F.first(k).alias(k) for k in keep or []])
        .select(
            "unique_id",
            *(keep or []),
            F.col("points.ds").alias("dates"),
            F.col("points.y").alias("values"),
            F.size("points").alias("n"),
        )
    )


#: Series that a partition holds at least, beyond one partition per core.
SERIES_PER_PART = 64


def in_few_parts(series: DataFrame, count: int) -> DataFrame:
    """Written rows of ``count`` series in no more partitions than that number needs.

    A panel may have few series however many raw rows it sums up. Fits and forecasts are chains of stages, and each would
    start a worker in every partition of the shuffle.
    """
    cores = series.sparkSession.sparkContext.defaultParallelism
    return series.coalesce(max(cores, -(-count // SERIES_PER_PART)))


def hold_out(series: DataFrame, h: int) -> DataFrame:
    """Split the arrays: ``train``, ``valid_dates``, ``valid`` and the last training date."""
    return series.withColumns(
        {
            "train": F.when(F.col("n") > h, head(F.col("values"), F.col("n") - h)),
            "train_end": F.when(F.col("n") > h, F.get(F.col("dates"), F.col("n") - h - 1)),
            "valid_dates": F.when(F.col("n") > h, tail(F.col("dates"), h)),
            "valid": F.when(F.col("n") > h, tail(F.col("values"), h)),
        }
    )


_SEQUENCE_STEP = {"D": "1 day", "W": "7 days", "MS": "1 month", "QS": "3 months", "YS": "1 year", "H": "1 hour"}


def fill_gaps(series: DataFrame, freq: str, value: float = 0.0) -> DataFrame:
    """Put ``value`` at every missing period between a series' first and last. Never done unasked."""
    grid = F.sequence(F.get("dates", F.lit(0)), F.element_at("dates", -1), F.expr(f"INTERVAL {_SEQUENCE_STEP[freq]}"))
    filled = let(
        F.map_from_arrays("dates", "values"),
        lambda known: F.transform(grid, lambda d: F.coalesce(F.try_element_at(known, d), F.lit(value))),
    )
    return series.withColumns({"values": filled, "dates": grid}).withColumn("n", F.size("dates"))


def panel_rows(series: DataFrame, dates: str = "dates", values: str = "values") -> DataFrame:
    """Back to one row per point."""
    return series.select(
        "unique_id", F.explode_outer(F.arrays_zip(F.col(dates).alias("ds"), F.col(values).alias("y"))).alias("p")
    ).select("unique_id", F.col("p.ds").alias("ds"), F.col("p.y").alias("y"))


def forecast_rows(
    series: DataFrame,
    paths: dict[str, Column],
    h: int,
    freq: str,
    last_ds: Column,
    actual: tuple[str, str] | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """``unique_id, ds, model, prediction`` from one array of ``h`` values per model, and kept columns.

    ``actual`` names the date and value arrays of the hold-out; they are looked up
    inside the row, which joins predictions with actuals without a shuffle. The
    outer explodes keep the optimizer from repeating model expressions in a filter.
    """
    models = F.array(*[F.struct(F.lit(name).alias("model"), path.alias("path")) for name, path in paths.items()])
    keep = keep or []
    columns = ["unique_id", *keep, F.explode_outer(models).alias("m")]
    steps = [F.col("ahead").alias("ds"), F.col("m.path").alias("prediction")]
    if actual:
        known = F.map_from_arrays(*actual)
        columns.append(known.alias("known"))
        steps.append(F.transform("ahead", lambda d: F.try_element_at("known", d)).alias("y"))
    exploded = series.select(*columns, future_dates(last_ds, h, freq).alias("ahead")).select(
        "unique_id", *keep, F.col("m.model").alias("model"), F.explode_outer(F.arrays_zip(*steps)).alias("p")
    )
    out = ["unique_id", *keep, F.col("p.ds").alias("ds"), "model", F.col("p.prediction").alias("prediction")]
    return exploded.select(*out, *([F.col("p.y").alias("y")] if actual else []))


def rmse_of(dates, actual, predicted_dates, predicted):
    """RMSE over the dates both sides have; NULL predictions do not count, no shared date gives NULL.

    Positional matching would be wrong for series with gaps: actual dates skip
    periods, predicted dates follow the calendar.
    """
    def score(lookup):
        errors = F.zip_with(
            predicted_dates, predicted, lambda d, p: F.pow(F.try_element_at(lookup, d) - p, F.lit(2.0))
        )
        return let(
            F.filter(errors, lambda e: e.isNotNull()),
            lambda e: F.when(
                F.size(e) > 0, F.sqrt(F.aggregate(e, F.lit(0.0), lambda acc, v: acc + v) / F.size(e))
            ),
        )

    return let(F.map_from_arrays(dates, actual), score)
