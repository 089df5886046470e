"""Period arithmetic for the supported frequencies.

``D W MS QS YS`` work on DATE columns, ``H`` on TIMESTAMP_NTZ, so nothing here
depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FREQUENCIES = ("H", "D", "W", "MS", "QS", "YS")
_MONTHS = {"MS": 1, "QS": 3, "YS": 12}
_TRUNC = {"MS": "MM", "QS": "QUARTER", "YS": "YEAR"}


def check_freq(freq: str) -> str:
    if freq not in FREQUENCIES:
        raise ValueError(f"unsupported frequency {freq!r}; supported: {', '.join(FREQUENCIES)}")
    return freq


def floor_period(ds: Column, freq: str) -> Column:
    """Label of the period a date falls in. Weeks are labelled by the Sunday that closes them."""
    check_freq(freq)
    if freq == "H":
        return F.to_date(ds).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(ds))
    day = F.to_date(ds)
    if freq == "D":
        return day
    if freq == "W":
        return F.next_day(F.date_sub(day, 1), "SUN")
    return F.trunc(day, _TRUNC[freq])


def next_period(ds: Column, step: Column | int, freq: str) -> Column:
    """The period label ``step`` (>= 1) periods after ``ds``; dates off the grid roll forward first."""
    check_freq(freq)
    step = F.lit(step) if isinstance(step, int) else step
    step = step.cast("int")
    if freq == "H":
        return ds + F.make_dt_interval(F.lit(0), step)
    if freq == "D":
        return F.date_add(ds, step)
    if freq == "W":
        return F.date_add(F.next_day(ds, "SUN"), (step - 1) * 7)
    return F.add_months(F.trunc(ds, _TRUNC[freq]), step * _MONTHS[freq])


def future_dates(last_ds: Column, h: int, freq: str) -> Column:
    """Array of the next ``h`` period labels."""
    return F.transform(F.sequence(F.lit(1), F.lit(h)), lambda k: next_period(last_ds, k, freq))


# Monday is 0 in dayofweek and weeks are ISO weeks; Spark's own dayofweek() has Sunday as 1.
DATE_FEATURES = {
    "year": F.year,
    "month": F.month,
    "week": F.weekofyear,
    "day": F.dayofmonth,
    "dayofweek": F.weekday,
    "dayofyear": F.dayofyear,
    "quarter": F.quarter,
}


def select_date_features(names) -> list[str]:
    """Keep the known feature names; unknown names are dropped without an error."""
    return [name for name in names if name in DATE_FEATURES]


def date_feature(name: str, ds: Column) -> Column:
    return DATE_FEATURES[name](ds).cast("bigint")
