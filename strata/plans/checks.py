"""Q-01..Q-09: data-quality checks that reconcile ODS with the star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.contracts import FACT_KEYS
from strata.functions.columns import to_day, zero_if_null
from strata.operators.relational import any_null, is_small, labelled_union, side_by_side
from strata.plans.model import SMALL_DIM_MAX_ROWS, Star


# Q-01 -------------------------------------------------------------------------------------------
def total_counts(ods: DataFrame, star: Star) -> DataFrame:
    both = side_by_side(ods.agg(F.count(F.lit(1)).alias("ods_cnt")),
                        star.fact.agg(F.count(F.lit(1)).alias("fact_cnt")))
    return both.withColumn("diff_cnt", F.col("ods_cnt") - F.col("fact_cnt"))


# Q-02 -------------------------------------------------------------------------------------------
def missing_in_fact(ods: DataFrame, star: Star) -> DataFrame:
    missing = ods.select("id").join(star.fact.select("id"), "id", "left_anti")
    return missing.agg(F.count(F.lit(1)).alias("missing_in_fact"))


# Q-03 -------------------------------------------------------------------------------------------
def daily_reconciliation(ods: DataFrame, star: Star) -> DataFrame:
    """Days whose ODS and fact counts differ (a day missing on either side counts as 0 there).
    Both sides are aggregated to one row per day before the full outer join."""
    o = ods.groupBy(to_day("event_time").alias("dt")).agg(F.count(F.lit(1)).alias("o_cnt"))
    per_time = star.fact.groupBy("time_id").agg(F.count(F.lit(1)).alias("cnt"))
    f = (per_time.join(star.dim_time.select("time_id", to_day("event_time").alias("dt")), "time_id")
         .groupBy("dt").agg(F.sum("cnt").alias("f_cnt")))
    j = o.alias("o").join(f.alias("f"), F.col("o.dt") == F.col("f.dt"), "full_outer")
    oc, fc = zero_if_null(F.col("o_cnt")), zero_if_null(F.col("f_cnt"))
    return (j.select(F.coalesce(F.col("o.dt"), F.col("f.dt")).alias("dt"), oc.alias("ods_cnt"),
                     fc.alias("fact_cnt"), (oc - fc).alias("diff"))
            .where(F.col("ods_cnt") != F.col("fact_cnt")).orderBy("dt"))


# Q-04 / Q-05 --------------------------------------------------------------------------------------
def fact_fk_nulls(star: Star) -> DataFrame:
    return star.fact.where(any_null(FACT_KEYS)).agg(F.count(F.lit(1)).alias("fact_fk_nulls"))


def fact_fk_null_rows(star: Star) -> DataFrame:
    return star.fact.where(any_null(FACT_KEYS)).select("id", *FACT_KEYS).orderBy("id")


# Q-06 -------------------------------------------------------------------------------------------
_FK_DIMS = [("time_id", "dim_time"), ("location_id", "dim_location"), ("mag_type_id", "dim_magnitude"),
            ("network_id", "dim_network"), ("status_id", "dim_status"), ("event_type_id", "dim_event_type")]


def broken_dim_links(star: Star) -> DataFrame:
    """Fact rows with a key that resolves to no dimension row (NULL keys count too).

    Written as left joins, as the source check is: a duplicated dimension key would multiply rows. The fact is collapsed to
    its different key tuples first, so tuples are joined, and a place that a third of the rows share weighs no more
    than its tuples; their counts stand for the rows.
    """
    f = star.fact.groupBy(*FACT_KEYS).agg(F.count(F.lit(1)).alias("__rows"))
    for key, dim in _FK_DIMS:
        d = getattr(star, dim).select(F.col(key).alias(f"__{key}"))
        if dim not in ("dim_time", "dim_location") and is_small(getattr(star, dim), SMALL_DIM_MAX_ROWS):
            d = F.broadcast(d)  # the two others grow with the events and are never broadcast
        f = f.join(d, F.col(key) == F.col(f"__{key}"), "left")
    broken = f.where(any_null([f"__{k}" for k, _ in _FK_DIMS]))
    return broken.agg(F.coalesce(F.sum("__rows"), F.lit(0)).cast("long").alias("broken_dim_links"))


# Q-07 / Q-08 --------------------------------------------------------------------------------------
def _duplicates(dim: DataFrame, cols: list[str]) -> DataFrame:
    return (dim.groupBy(*cols).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)
            .orderBy(F.col("cnt").desc()))


def magnitude_duplicates(star: Star) -> DataFrame:
    return _duplicates(star.dim_magnitude, ["mag_type", "mag_source"])


def network_duplicates(star: Star) -> DataFrame:
    return _duplicates(star.dim_network, ["net", "location_source"])


# Q-09 -------------------------------------------------------------------------------------------
def orphan_dimension_rows(star: Star) -> DataFrame:
    def orphans(dim: DataFrame, key: str) -> DataFrame:
        # the fact's distinct keys first: a hot key collapses map-side before the shuffle
        used = star.fact.select(key).where(F.col(key).isNotNull()).distinct()
        return (dim.select(key).join(used, key, "left_anti")
                .agg(F.count(F.lit(1)).alias("orphan_rows")))
    return labelled_union([("dim_status", orphans(star.dim_status, "status_id")),
                           ("dim_event_type", orphans(star.dim_event_type, "event_type_id"))], "dim_name")
