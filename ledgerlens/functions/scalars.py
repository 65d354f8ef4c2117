"""Column expressions shared by the operators. All of them stay inside codegen."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

EARTH_RADIUS_KM = 6371.0
# Fixed value: elapsed hours used where two events share a second.
ZERO_GAP_HOURS = 0.001

# Lower bounds of the severity buckets, highest first; fixed values.
SEVERITY_BUCKETS = [(0.8, "critical"), (0.5, "high"), (0.2, "medium")]
SEVERITY_RANGES = [(0.8, "Critical (0.8-1.0)"), (0.5, "High (0.5-0.8)"), (0.2, "Medium (0.2-0.5)")]


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def instant(as_of: str | dt.datetime | dt.date) -> Column:
    """A timestamp literal in the session zone (UTC)."""
    if isinstance(as_of, dt.datetime) and as_of.tzinfo is not None:
        as_of = as_of.astimezone(dt.timezone.utc).replace(tzinfo=None)
    text = as_of if isinstance(as_of, str) else as_of.isoformat(sep=" ") if isinstance(as_of, dt.datetime) else as_of.isoformat()
    return F.lit(text).cast("timestamp")


def day_literal(day: str | dt.date) -> Column:
    return F.lit(str(day)).cast("date")


def time_key(day: str | Column) -> Column:
    """yyyymmdd as an integer."""
    d = as_col(day)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def surrogate_key(*cols: str | Column) -> Column:
    return F.md5(F.concat_ws("|", *[as_col(c).cast("string") for c in cols]))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great circle distance. `least` guards against rounding above 1, where asin gives NaN."""
    p1, p2 = F.radians(as_col(lat1)), F.radians(as_col(lat2))
    half_lat = (p2 - p1) / 2
    half_lon = (F.radians(as_col(lon2)) - F.radians(as_col(lon1))) / 2
    chord = F.pow(F.sin(half_lat), F.lit(2.0)) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(half_lon), F.lit(2.0))
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))


def _bucket(score, bounds, default) -> Column:
    out = None
    for low, label in bounds:
        hit = as_col(score) >= F.lit(str(low)).cast("decimal(5,4)")
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(default)


def severity_bucket(score="severity_score") -> Column:
    return _bucket(score, SEVERITY_BUCKETS, "low")


def severity_range_label(score="severity_score") -> Column:
    return _bucket(score, SEVERITY_RANGES, "Low (0-0.2)")


def percent(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole, NULL for an empty whole. Both sides are exact counts."""
    return F.round(part.cast("double") * 100.0 / F.nullif(whole, F.lit(0)).cast("double"), digits)


def mean(value: str | Column) -> Column:
    """Average as a double, from the exact sum; a decimal average would round to a few digits."""
    return F.sum(as_col(value)).cast("double") / F.nullif(F.count(as_col(value)), F.lit(0)).cast("double")


def lookback(df: DataFrame, column: str, as_of, *, days: int = 0, hours: int = 0, kind: str = "timestamp") -> DataFrame:
    """Rows whose time is at or after `as_of` minus the given span.

    `kind` says what the column holds: a timestamp, a date or a yyyymmdd key. The
    bound is a literal, so it reaches the scan as a partition or Parquet filter.
    """
    start = instant(as_of) - F.make_dt_interval(F.lit(days), F.lit(hours))
    bound = {
        "timestamp": lambda: start,
        # A date is compared at its midnight, so a start within a day leaves that day out.
        "date": lambda: F.to_date(start + F.expr("INTERVAL '1' DAY") - F.expr("INTERVAL '0.000001' SECOND")),
        "key": lambda: time_key(F.to_date(start)),
    }[kind]()
    return df.where(F.col(column) >= bound)
