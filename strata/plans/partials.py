"""Maintained aggregates of the fact: what the reports add up, kept per day.

A table beside the fact, partitioned like it by ``event_date``: for each day and set of grouping columns (a family) one row
per group with parts that can be merged, the number of rows, the sum and number of magnitudes, the greatest, and how many
are 5 and more. Counts of different days add up, so a report over any range of days reads a few rows per day instead of
the fact. A load rewrites the days whose fact it rewrote; a corrected or replaced day is computed anew from its fact rows,
so nothing has to be subtracted.

All families come from one scan of the fact (GROUPING SETS).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import contracts as C
from strata.functions.columns import depth_bucket, mag_bucket

MAG_SCALE = 2  # mag is decimal(5,2)

#: family -> its grouping columns, beside the day and whether the row has a time.
FAMILIES = {"day": [], "location": ["location_id"], "status": ["event_type_id", "status_id"], "buckets": ["depth_bucket", "mag_bucket"]}
GROUPS = {"location_id": T.LongType(), "event_type_id": T.LongType(), "status_id": T.LongType(), "depth_bucket": T.StringType(), "mag_bucket": T.StringType()}
PARTS = ["cnt", "mag_s", "mag_n", "mag_max", "mag5"]

AGGREGATE = C.Contract(
    "dm.agg_fact",
    T.StructType([T.StructField("family", T.StringType()), T.StructField("timed", T.BooleanType()),
                  *[T.StructField(n, t) for n, t in GROUPS.items()],
                  *[T.StructField(p, T.DecimalType(5, 2) if p == "mag_max" else T.LongType()) for p in PARTS]]),
    partition_by="event_date",
)


def partial_columns() -> list[Column]:
    """The parts of a group of fact rows."""
    return [F.count(F.lit(1)).alias("cnt"), F.sum((F.col("mag") * F.lit(10 ** MAG_SCALE)).cast("long")).alias("mag_s"),
            F.count("mag").alias("mag_n"), F.max("mag").alias("mag_max"), F.count_if(F.col("mag") >= 5).alias("mag5")]


def merged_columns() -> list[Column]:
    """The parts of a group of parts."""
    return [F.sum("cnt").alias("cnt"), F.sum("mag_s").alias("mag_s"), F.sum("mag_n").alias("mag_n"), F.max("mag_max").alias("mag_max"), F.sum("mag5").alias("mag5")]


def _grouped(fact: DataFrame) -> DataFrame:
    """Fact rows with the grouping columns; depth and magnitude buckets are NULL where the measure is."""
    return fact.select("event_date", F.col("time_id").isNotNull().alias("timed"), "location_id", "event_type_id", "status_id", "mag",
                       F.when(F.col("depth").isNotNull(), depth_bucket("depth")).alias("depth_bucket"),
                       F.when(F.col("mag").isNotNull(), mag_bucket("mag")).alias("mag_bucket"))


def aggregate(fact: DataFrame) -> DataFrame:
    """The maintained aggregates of fact rows, with ``event_date``."""
    always, groups = ["event_date", "timed"], list(GROUPS)
    sets = [always + by for by in FAMILIES.values()]
    found = _grouped(fact).groupingSets(sets, *always, *groups).agg(F.grouping_id().alias("__set"), *partial_columns())
    which = F.lit(None).cast("string")
    for family, by in FAMILIES.items():
        number = int("00" + "".join("0" if g in by else "1" for g in groups), 2)
        which = F.when(F.col("__set") == number, F.lit(family)).otherwise(which)
    return found.select(which.alias("family"), "timed", *groups, *PARTS, "event_date")


def parts_by(fact: DataFrame, agg: DataFrame | None, family: str, by: list[str], where: Column | None = None, timed: bool = True) -> DataFrame:
    """Parts per ``by`` (columns of the family, or ``event_date``), of rows with a time key only (``timed``) and ``where``, a
    condition on these columns: merged from the aggregates if there are any, else from the fact."""
    rows = _grouped(fact) if agg is None else agg.where(F.col("family") == family)
    if timed:
        rows = rows.where("timed")
    if where is not None:
        rows = rows.where(where)
    return rows.groupBy(*by).agg(*(partial_columns() if agg is None else merged_columns()))
