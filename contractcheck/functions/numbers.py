"""Integer arithmetic for percentages and ages.

Percentages and hours are computed on whole numbers and divided once at the
end, so the result never depends on floating point rounding or on the order in
which partitions are added up.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_HOUR = 3_600_000_000


def ntz(moment: str | datetime | Column) -> Column:
    """A zone-free timestamp from text, a datetime or an existing column."""
    if isinstance(moment, Column):
        return moment.cast("timestamp_ntz")
    if isinstance(moment, datetime):
        moment = moment.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(moment).cast("timestamp_ntz")


def whole_div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def basis_points(part: Column, whole: Column) -> Column:
    """``part / whole`` in hundredths of a percent, half up; NULL for 0 rows."""
    part, whole = part.cast("bigint"), whole.cast("bigint")
    return F.when(whole > 0, whole_div(part * 20000 + whole, whole * 2))


def pct2(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent with two places; NULL for 0 rows."""
    return basis_points(part, whole).cast("double") / 100


def mean_pct2(total_points: Column, n: Column) -> Column:
    """Mean of ``n`` basis-point scores, in percent with two places."""
    total_points, n = total_points.cast("bigint"), n.cast("bigint")
    return F.when(n > 0, whole_div(total_points * 2 + n, n * 2)).cast("double") / 100


def age_micros(ts: Column, as_of: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", ts.cast("timestamp_ntz"), as_of)


def hours2(micros: Column) -> Column:
    """Microseconds as hours with two places, half up."""
    return whole_div(micros * 200 + MICROS_PER_HOUR, F.lit(2 * MICROS_PER_HOUR)).cast("double") / 100


def fraction_to_percent(value: Column) -> Column:
    """Thresholds are written as 0.99 or as 99; both mean 99 percent.

    The point moves in decimals, so 0.99999 gives 99.999 and no digit more.
    """
    value = value.cast("double")
    written = value.try_cast("decimal(20,18)")
    moved = F.when(written.cast("double") == value, (written * F.lit(100)).cast("double"))
    return F.when(value <= 1, F.coalesce(moved, value * 100)).otherwise(value)


def count_where(condition: Column) -> Column:
    """Rows where the condition is true, as BIGINT, 0 for an empty input."""
    return F.count_if(condition)


def days_before(as_of: Column, days: int) -> Column:
    return as_of - F.make_dt_interval(F.lit(days))


def day_bounds(ts: Column, day: str) -> Column:
    """``DATE(ts) = day`` as a half-open range, which reaches the file scan."""
    start = ntz(f"{day} 00:00:00")
    return (ts >= start) & (ts < start + F.make_dt_interval(F.lit(1)))
