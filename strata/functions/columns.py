"""O-08..O-22: Column -> Column helpers. All are built-in Spark expressions (codegen, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

__all__ = [
    "to_instant", "strict_cast", "blank_to_null_cast", "trim_spaces", "lower_text", "region_from_place",
    "normalize_label", "to_day", "calendar_parts", "is_weekend", "iso_day_of_week", "day_name_padded",
    "week_start", "bucketize", "MAG_BUCKETS", "DEPTH_BUCKETS", "mag_bucket", "depth_bucket",
    "unscaled", "round_half_away_div", "hundredths_to_decimal", "zero_if_null",
]


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# O-08 -------------------------------------------------------------------------------------------
def to_instant(x: Column | str) -> Column:
    """ISO-8601 text (``...Z``) to a timestamp instant; the session zone is UTC."""
    return _c(x).cast("timestamp")


# O-09 -------------------------------------------------------------------------------------------
def strict_cast(x: Column | str, dtype: DataType | str) -> Column:
    """Text to a fixed type with no blank handling: under ANSI '' and overflow raise, NULL stays NULL,
    and a decimal is rounded half away from zero to the target scale."""
    return _c(x).cast(dtype)


# O-10 -------------------------------------------------------------------------------------------
def blank_to_null_cast(x: Column | str, dtype: DataType | str) -> Column:
    """``NULLIF(x, '')::type``: an empty string becomes NULL before the (strict) cast."""
    return F.nullif(_c(x), F.lit("")).cast(dtype)


# O-11 / O-12 ------------------------------------------------------------------------------------
def trim_spaces(x: Column | str) -> Column:
    """Strip leading/trailing spaces (only spaces: tabs and newlines stay)."""
    return F.trim(_c(x))


def lower_text(x: Column | str) -> Column:
    return F.lower(_c(x))


# O-13 -------------------------------------------------------------------------------------------
# Fixed value: the label given to a place that has no comma (or is NULL).
NO_REGION = "Unknown"


def region_from_place(place: Column | str) -> Column:
    """Text after the last comma, trimmed; a place without a comma (or NULL) gives 'Unknown'.

    ``(?s)`` lets ``.`` cross newlines so the *last* comma of a multi-line place wins.
    """
    p = _c(place)
    return (
        F.when(p.contains(","), F.trim(F.regexp_replace(p, r"(?s)^.*,\s*", "")))
        .otherwise(F.lit(NO_REGION))
    )


# O-14 -------------------------------------------------------------------------------------------
# Fixed value: the label a blank dimension attribute gets.
BLANK_LABEL = "unknown"


def normalize_label(x: Column | str) -> Column:
    """``COALESCE(NULLIF(TRIM(x), ''), 'unknown')`` — one helper for dimension loads and fact lookups."""
    return F.coalesce(F.nullif(F.trim(_c(x)), F.lit("")), F.lit(BLANK_LABEL))


# O-15 -------------------------------------------------------------------------------------------
def to_day(ts: Column | str) -> Column:
    """``CAST(ts AS DATE)`` in the session zone (UTC)."""
    return F.to_date(_c(ts))


# O-16 / O-17 ------------------------------------------------------------------------------------
def is_weekend(ts: Column | str) -> Column:
    """Day-of-week in (Sunday, Saturday); Spark's dayofweek is 1=Sunday..7=Saturday."""
    return F.dayofweek(_c(ts)).isin(1, 7)


def iso_day_of_week(ts: Column | str) -> Column:
    """ISO day of week, 1=Monday..7=Sunday."""
    return F.extract(F.lit("DAYOFWEEK_ISO"), _c(ts)).cast("int")


def day_name_padded(ts: Column | str) -> Column:
    """English day name blank-padded to 9 characters (``'Monday   '``)."""
    return F.rpad(F.date_format(_c(ts), "EEEE"), 9, " ")


def calendar_parts(ts: Column | str) -> list[Column]:
    """year, month, day, hour, quarter (int), day_of_week (padded name), is_weekend."""
    t = _c(ts)
    return [
        F.year(t).alias("year"), F.month(t).alias("month"), F.dayofmonth(t).alias("day"),
        F.hour(t).alias("hour"), F.quarter(t).alias("quarter"),
        day_name_padded(t).alias("day_of_week"), is_weekend(t).alias("is_weekend"),
    ]


# O-18 -------------------------------------------------------------------------------------------
def week_start(ts: Column | str) -> Column:
    """Monday of the week, as a date."""
    return F.to_date(F.date_trunc("week", _c(ts)))


# O-19 / O-20 ------------------------------------------------------------------------------------
# Bucket upper edges (exclusive) and labels, in order; the last label has no edge.
MAG_BUCKETS = ([2, 3, 4, 5, 6], ["<2", "2-3", "3-4", "4-5", "5-6", "6+"])
DEPTH_BUCKETS = ([10, 30, 70, 150], ["0-10 km", "10-30 km", "30-70 km", "70-150 km", "150+ km"])


def bucketize(x: Column | str, edges: list, labels: list[str]) -> Column:
    """Half-open buckets as a ``CASE WHEN x < edge`` chain; values at or above the last edge (and
    NULL, as in a CASE with ELSE) get the last label."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    v = _c(x)
    expr = F.when(v < F.lit(edges[0]), F.lit(labels[0]))
    for edge, label in zip(edges[1:], labels[1:-1]):
        expr = expr.when(v < F.lit(edge), F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def mag_bucket(x: Column | str) -> Column:
    return bucketize(x, *MAG_BUCKETS)


def depth_bucket(x: Column | str) -> Column:
    return bucketize(x, *DEPTH_BUCKETS)


# O-21 -------------------------------------------------------------------------------------------
# Exact decimal averages: Spark's avg(decimal) rounds to scale+4 first, so ROUND(AVG(x), 2) can
# round twice. Instead sum the unscaled integers and round once with integer arithmetic.
def unscaled(x: Column | str, dtype: DecimalType) -> Column:
    """The decimal as an integer count of its last digit (2.34 as decimal(5,2) -> 234)."""
    return (_c(x) * F.lit(10 ** dtype.scale)).cast("long")


def round_half_away_div(num: Column, den: Column) -> Column:
    """``round(num / den)`` half away from zero for integers, exactly; NULL when den is 0 or NULL.

    floor((2|num| + den) / 2den) is computed as an exact decimal quotient of a multiple of 2den.
    """
    a = F.abs(num) * 2 + den
    b = den * 2
    multiple = (a - F.pmod(a, b)).cast("decimal(38,0)")
    quotient = F.when(den > 0, (multiple / b.cast("decimal(38,0)")).cast("long"))
    return F.when(num < 0, -quotient).otherwise(quotient)


def hundredths_to_decimal(h: Column) -> Column:
    """An integer count of hundredths as decimal(18,2), exactly."""
    return (h.cast("decimal(18,0)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(18,2)")


# O-22 -------------------------------------------------------------------------------------------
def zero_if_null(x: Column | str) -> Column:
    return F.coalesce(_c(x), F.lit(0))
