"""R-01..R-15: star-schema reports. Each takes a ``Star`` and optional closed date bounds.

Scale notes
* A fact row's ``event_date`` is the date of the event time its ``time_id`` was looked up by, and loads
  enforce the keys. So a report by day, week or date bound needs ``time_id IS NOT NULL`` and ``event_date``,
  not the time dimension; only the heatmap joins it, for the hour.
* Reports that group by dimension attributes first aggregate the fact on its foreign keys (partial
  aggregation runs map-side), so a hot key — one place, one timestamp — is collapsed to one row
  before any join shuffle, and the joins see one row per key instead of one per event. Inner-join
  multiplicity is kept: counts and sums are merged after the join.
* Small dimensions are broadcast behind a row-count check; ``dim_time`` and ``dim_location`` grow
  with the events and are joined by key shuffle.
* A date bound filters ``event_date``, by which the fact is stored, so the scan is pruned.
* Where the star has maintained aggregates (partials.py), R-01..R-06, R-08 and R-10..R-14 merge these instead of reading the fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import hundredths_to_decimal, iso_day_of_week, round_half_away_div, to_day, week_start
from strata.operators.relational import (
    checked_broadcast, date_range_filter, moving_average_rows, top_k,
)
from strata.plans.model import SMALL_DIM_MAX_ROWS, Star
from strata.plans.partials import parts_by


def _small(dim: DataFrame, *cols: str) -> DataFrame:
    """A dimension projected to ``cols``, broadcast when proven small (checked once per dimension)."""
    return checked_broadcast(dim, SMALL_DIM_MAX_ROWS, list(cols))


def _with_date(star: Star, f: DataFrame) -> DataFrame:
    return f.join(star.dim_time.select("time_id", to_day("event_time").alias("event_date")), "time_id")


def _dated(star: Star, date_from=None, date_to=None) -> DataFrame:
    """Fact rows with a time key (in range) and their ``event_date``; a fact that doesn't carry the date gets
    it from the time dimension."""
    f = star.fact.where(F.col("time_id").isNotNull())
    if "event_date" not in f.columns:
        f = _with_date(star, f)
    if date_from is not None or date_to is not None:
        f = f.where(date_range_filter("event_date", date_from, date_to))
    return f


def _times(star: Star, date_from=None, date_to=None) -> DataFrame:
    t = star.dim_time.select("time_id", "event_time", to_day("event_time").alias("day"))
    if date_from is not None or date_to is not None:
        t = t.where(date_range_filter("day", date_from, date_to))
    return t


# partial aggregates that survive a join (merged by sum / max afterwards)
def _parts(star: Star, family: str, by: list[str], date_from=None, date_to=None, where: Column | None = None, timed: bool = True) -> DataFrame:
    """Parts per ``by`` of the fact rows in range: from the maintained aggregates if the star has them, else from the fact."""
    fact = star.fact
    if star.agg is None and "event_date" not in fact.columns:
        fact = _with_date(star, fact) if timed else fact.withColumn("event_date", F.lit(None).cast("date"))
    if date_from is not None or date_to is not None:
        in_range = date_range_filter("event_date", date_from, date_to)
        where = in_range if where is None else where & in_range
    return parts_by(fact, star.agg, family, by, where, timed)


def _merge(with_mag: bool = True, with_max: bool = False, with_5plus: bool = False) -> list[Column]:
    out = [F.sum("cnt").alias("events_cnt")]
    if with_mag:
        out += [F.sum("mag_s").alias("mag_s"), F.sum("mag_n").alias("mag_n")]
    if with_max:
        out.append(F.max("mag_max").alias("max_mag"))
    if with_5plus:
        out.append(F.sum("mag5").alias("events_mag_5_plus"))
    return out


def _avg_mag(df: DataFrame) -> DataFrame:
    """ROUND(AVG(mag), 2) from merged (sum of hundredths, count) parts, exactly."""
    return (df.withColumn("avg_mag", hundredths_to_decimal(round_half_away_div(F.col("mag_s"), F.col("mag_n"))))
            .drop("mag_s", "mag_n"))


# R-01 -------------------------------------------------------------------------------------------
def daily_events(star: Star, date_from=None, date_to=None) -> DataFrame:
    per = _parts(star, "day", ["event_date"], date_from, date_to)
    return per.select(F.col("event_date").alias("day"), F.col("cnt").alias("events_cnt")).orderBy("day")


# R-02 -------------------------------------------------------------------------------------------
def daily_events_ma7(star: Star, date_from=None, date_to=None) -> DataFrame:
    """Daily counts with the average of the last 7 *rows* (missing days are not filled). The window
    runs on the per-day series (one row per day), not on events."""
    daily = daily_events(star, date_from, date_to)
    return moving_average_rows(daily, "day", "events_cnt", 7, "ma7").orderBy("day")


# R-03 -------------------------------------------------------------------------------------------
def top_regions(star: Star, date_from=None, date_to=None, min_events: int = 10, k: int = 20) -> DataFrame:
    per = _parts(star, "location", ["location_id"], date_from, date_to)
    loc = star.dim_location.select("location_id", "region_id")
    reg = _small(star.dim_region, "region_id", "region_name")
    g = per.join(loc, "location_id").join(reg, "region_id").groupBy("region_name").agg(*_merge())
    g = _avg_mag(g.where(F.col("events_cnt") >= min_events))
    return top_k(g.select("region_name", "events_cnt", "avg_mag"),
                 [F.col("events_cnt").desc(), F.col("region_name").asc_nulls_last()], k)


# R-04 / R-05 --------------------------------------------------------------------------------------
def magnitude_distribution(star: Star, date_from=None, date_to=None) -> DataFrame:
    per = _parts(star, "buckets", ["mag_bucket"], date_from, date_to, F.col("mag_bucket").isNotNull())
    return per.select("mag_bucket", F.col("cnt").alias("events_cnt")).orderBy("mag_bucket")


def depth_distribution(star: Star, date_from=None, date_to=None) -> DataFrame:
    per = _parts(star, "buckets", ["depth_bucket"], date_from, date_to, F.col("depth_bucket").isNotNull())
    return per.select("depth_bucket", F.col("cnt").alias("events_cnt")).orderBy("depth_bucket")


# R-06 -------------------------------------------------------------------------------------------
def status_distribution(star: Star, date_from=None, date_to=None) -> DataFrame:
    per = _parts(star, "status", ["status_id"], date_from, date_to)
    j = per.join(_small(star.dim_status, "status_id", "status"), "status_id")
    return j.groupBy("status").agg(F.sum("cnt").alias("events_cnt")).orderBy(F.col("events_cnt").desc())


# R-07 / R-15 --------------------------------------------------------------------------------------
EVENT_COLUMNS = ["event_time", "region_name", "place", "mag", "depth", "net", "location_source", "status",
                 "event_type"]


_STRONG_KEYS = ["location_id", "network_id", "status_id", "event_type_id"]


def _strong_rows(star: Star, date_from=None, date_to=None) -> DataFrame:
    """Strong events with all the keys that the report joins on."""
    f = _dated(star, date_from, date_to).where(F.col("mag") >= F.lit(5))
    return f.dropna(subset=_STRONG_KEYS).select("id", "time_id", *_STRONG_KEYS, "mag", "depth", "event_date")


def _newest_days(rows: DataFrame, k: int) -> DataFrame:
    """The newest days that hold at least ``k`` of ``rows`` together (all days, if there are fewer rows): one
    count per day, added up over the days."""
    per = rows.groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))
    newer = F.sum("n").over(Window.orderBy(F.col("event_date").desc()).rowsBetween(Window.unboundedPreceding, -1))
    return per.withColumn("newer", F.coalesce(newer, F.lit(0))).where(F.col("newer") < k).select("event_date")


def _described(star: Star, rows: DataFrame) -> DataFrame:
    """Rows with their time, if they don't carry it yet, and their dimensions' attributes."""
    if "event_time" not in rows.columns:
        rows = rows.join(star.dim_time.select("time_id", "event_time"), "time_id")
    return (rows.join(star.dim_location.select("location_id", "region_id", "place"), "location_id")
            .join(_small(star.dim_region, "region_id", "region_name"), "region_id")
            .join(_small(star.dim_network, "network_id", "net", "location_source"), "network_id")
            .join(_small(star.dim_status, "status_id", "status"), "status_id")
            .join(_small(star.dim_event_type, "event_type_id", "event_type"), "event_type_id"))


def _strong_events(star: Star, date_from, date_to, k: int) -> DataFrame:
    """Newest k strong events, in one query: a count of them per day says which days hold the newest k, and
    only rows of these days are joined (on a fact stored by day the scan is pruned to them at run time), and only to times of
    these days. The k rows of that are sent to the other dimensions, which are scanned where they lie. Exact: rows of
    older days are older than any of these, and loads see to it that keys resolve. The list of days has a row per day at most."""
    rows = _strong_rows(star, date_from, date_to)
    days = F.broadcast(_newest_days(rows, k))
    newest = rows.join(days, "event_date", "left_semi")
    times = star.dim_time.select("time_id", "event_time", to_day("event_time").alias("event_date")).join(days, "event_date", "left_semi")
    order = [F.col("event_time").desc_nulls_first(), F.col("id").desc()]
    top = F.broadcast(top_k(newest.join(times.select("time_id", "event_time"), "time_id"), order, k))  # k rows
    return _described(star, top).orderBy(*order).select(
        F.col("event_time").cast("timestamp_ntz").alias("event_time"), *EVENT_COLUMNS[1:])


def recent_strong_events(star: Star, date_from=None, date_to=None, k: int = 100) -> DataFrame:
    return _strong_events(star, date_from, date_to, k)


def recent_significant_events(star: Star, k: int = 200) -> DataFrame:
    return _strong_events(star, None, None, k)


# R-08 -------------------------------------------------------------------------------------------
def map_points(star: Star, date_from=None, date_to=None) -> DataFrame:
    """Per (lat, lon, region): count and average magnitude. Without bounds, rows without a time count too."""
    bounded = date_from is not None or date_to is not None
    per = _parts(star, "location", ["location_id"], date_from, date_to, timed=bounded)
    loc = (star.dim_location.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
           .select("location_id", "region_id", "latitude", "longitude"))
    reg = _small(star.dim_region, "region_id", "region_name")
    g = per.join(loc, "location_id").join(reg, "region_id").groupBy("latitude", "longitude", "region_name").agg(*_merge())
    return _avg_mag(g).orderBy(F.col("events_cnt").desc())


# R-09 -------------------------------------------------------------------------------------------
def heatmap_day_hour(star: Star, date_from=None, date_to=None) -> DataFrame:
    per = _dated(star, date_from, date_to).groupBy("time_id").agg(F.count(F.lit(1)).alias("cnt"))
    j = per.join(_times(star, date_from, date_to), "time_id")
    g = j.groupBy(iso_day_of_week("event_time").alias("day_of_week"),
                  F.hour("event_time").alias("hour_utc")).agg(F.sum("cnt").cast("long").alias("events_cnt"))
    return g.orderBy("day_of_week", "hour_utc")


# R-10 -------------------------------------------------------------------------------------------
def regions_intensity(star: Star, min_events: int = 10, k: int = 25) -> DataFrame:
    per = _parts(star, "location", ["location_id"], timed=False)
    loc = star.dim_location.select("location_id", "region_id")
    reg = _small(star.dim_region, "region_id", "region_name")
    g = (per.join(loc, "location_id").join(reg, "region_id").groupBy("region_name")
         .agg(*_merge(with_max=True, with_5plus=True)))
    g = _avg_mag(g.where(F.col("events_cnt") >= min_events))
    g = g.select("region_name", "events_cnt", "avg_mag", "max_mag", "events_mag_5_plus")
    # NULL averages sort first under DESC, as in the source database
    return top_k(g, [F.col("events_cnt").desc(), F.col("avg_mag").desc_nulls_first(),
                     F.col("region_name").asc_nulls_last()], k)


# R-11 / R-12 --------------------------------------------------------------------------------------
def daily_trend(star: Star) -> DataFrame:
    days = _parts(star, "day", ["event_date"])
    return _avg_mag(days.select(F.col("event_date").alias("day"), F.col("cnt").alias("events_cnt"), "mag_s", "mag_n")).orderBy("day")


def weekly_trend(star: Star) -> DataFrame:
    weeks = _parts(star, "day", ["event_date"]).groupBy(week_start("event_date").alias("week_start")).agg(*_merge())
    return _avg_mag(weeks).orderBy("week_start")


# R-13 -------------------------------------------------------------------------------------------
def event_type_status(star: Star) -> DataFrame:
    per = _parts(star, "status", ["event_type_id", "status_id"], timed=False)
    j = (per.join(_small(star.dim_event_type, "event_type_id", "event_type"), "event_type_id")
         .join(_small(star.dim_status, "status_id", "status"), "status_id"))
    g = _avg_mag(j.groupBy("event_type", "status").agg(*_merge()))
    return g.orderBy(F.col("events_cnt").desc(), F.col("avg_mag").desc_nulls_first())


# R-14 -------------------------------------------------------------------------------------------
def depth_vs_magnitude(star: Star) -> DataFrame:
    known = F.col("depth_bucket").isNotNull() & F.col("mag_bucket").isNotNull()
    per = _parts(star, "buckets", ["depth_bucket", "mag_bucket"], where=known, timed=False)
    return per.select("depth_bucket", "mag_bucket", F.col("cnt").alias("events_cnt")).orderBy("depth_bucket", "mag_bucket")
