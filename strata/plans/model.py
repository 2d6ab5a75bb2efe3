"""The seismic-event configuration: how the generic operators compose into STG, ODS and the star.

Everything here is a pure DataFrame -> DataFrame function; persistence lives in ``jobs.py``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import contracts as C
from strata.functions.columns import (
    blank_to_null_cast, calendar_parts, lower_text, normalize_label, region_from_place, strict_cast,
    to_day, to_instant, trim_spaces,
)
from strata.operators.maintain import insert_if_new, upsert, with_new_rows
from strata.operators.relational import in_days, lookup

# Dimensions whose size does not grow with the events may be broadcast, behind this row check.
SMALL_DIM_MAX_ROWS = 100_000


def stamp(now: dt.datetime | None) -> Column:
    """Audit time: a fixed instant when given (reproducible runs), else the query's current time."""
    return F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()


# O-07 / O-05: feed -> STG ------------------------------------------------------------------------
def stg_from_feed(feed: DataFrame, now: dt.datetime | None = None, extra: list[str] = ()) -> DataFrame:
    """Rename camelCase feed columns to snake_case and stamp ``loaded_at`` (its default); ``extra``
    columns are carried along unchanged."""
    cols = [F.col(src).alias(C.FEED_TO_STG.get(src, src)) for src in C.FEED_COLUMNS]
    return feed.select(stamp(now).alias("loaded_at"), *cols, *extra)


# O-08..O-13: STG -> typed ODS rows ---------------------------------------------------------------
def standardize(stg: DataFrame) -> DataFrame:
    """Typed ODS rows (without ``ods_loaded_at``). Coordinates, depth and magnitude are cast
    strictly (a blank there is an error); the other numbers treat '' as NULL. The region is derived
    from the untrimmed place; ODS stores the trimmed place."""
    ods = dict((f.name, f.dataType) for f in C.ODS.schema.fields)
    strict = ["latitude", "longitude", "depth", "mag"]
    lenient = ["nst", "gap", "dmin", "rms", "horizontal_error", "depth_error", "mag_error", "mag_nst"]
    as_is = ["mag_type", "net", "status", "location_source", "mag_source"]
    exprs = {
        "id": F.col("id"),
        "event_time": to_instant("time"),
        "updated_at": to_instant("updated"),
        **{c: strict_cast(c, ods[c]) for c in strict},
        **{c: blank_to_null_cast(c, ods[c]) for c in lenient},
        **{c: F.col(c) for c in as_is},
        "place": trim_spaces("place"),
        "region": region_from_place("place"),
        "event_type": lower_text("type"),
    }
    return stg.select(*[exprs[c].alias(c) for c in C.ODS.columns if c != "ods_loaded_at"])


# The ODS columns an upsert overwrites for an already known event.
ODS_UPDATE_COLUMNS = ["updated_at", "mag", "status", "place", "region"]


def upsert_ods(ods: DataFrame, stg: DataFrame, now: dt.datetime | None = None,
               on_duplicate: str = "error") -> DataFrame:
    """O-41/O-49: upsert all given STG rows into ODS; known ids change only the five update columns."""
    return upsert(ods, standardize(stg), key=["id"], update_cols=ODS_UPDATE_COLUMNS,
                  insert_defaults={"ods_loaded_at": stamp(now)}, on_duplicate=on_duplicate,
                  order_by=["updated_at"])


# Star schema ----------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Star:
    fact: DataFrame
    dim_time: DataFrame
    dim_location: DataFrame
    dim_region: DataFrame
    dim_magnitude: DataFrame
    dim_network: DataFrame
    dim_status: DataFrame
    dim_event_type: DataFrame
    agg: DataFrame | None = None  # maintained aggregates of the fact (partials.py), if there are any

    def dims(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self) if f.name not in ("fact", "agg")}

    def tables(self) -> dict[str, DataFrame]:
        return {"fact": self.fact, **self.dims()}

    def with_(self, **kw) -> "Star":
        return replace(self, **kw)


def empty_frame(spark: SparkSession, schema) -> DataFrame:
    """An empty relation the optimizer knows is empty (``WHERE false`` on one row becomes an empty
    LocalRelation), so joins against it are simplified away."""
    cols = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).select(*cols).where(F.lit(False))


def empty(spark: SparkSession, c: C.Contract) -> DataFrame:
    return empty_frame(spark, c.schema)


def empty_star(spark: SparkSession) -> Star:
    fact = empty(spark, C.FACT).withColumn("event_date", F.lit(None).cast("date"))
    return Star(fact, *[empty(spark, c) for c in (C.DIM_TIME, C.DIM_LOCATION, C.DIM_REGION, C.DIM_MAGNITUDE,
                                                  C.DIM_NETWORK, C.DIM_STATUS, C.DIM_EVENT_TYPE)])


def ods_for_days(ods: DataFrame, days: list | None) -> DataFrame:
    """ODS rows of the given days (all dated rows when ``days`` is None)."""
    if days is None:
        return ods.where(F.col("event_time").isNotNull())
    return in_days(ods, "event_time", days)


# O-39 / O-40: the seven dimension loads -------------------------------------------------------------
# Dimension -> (natural key columns, id column) for the label dimensions.
LABEL_DIMS = {
    "dim_magnitude": (["mag_type", "mag_source"], "mag_type_id"),
    "dim_network": (["net", "location_source"], "network_id"),
    "dim_status": (["status"], "status_id"),
    "dim_event_type": (["event_type"], "event_type_id"),
}
# Load order: location needs the region ids, so region comes first.
DIMENSION_ORDER = ["dim_region", "dim_location", "dim_time", *LABEL_DIMS]


def time_window(dim_time: DataFrame, days: list | None) -> DataFrame:
    """Time rows of the given days only (all when None): a batch's event times can only equal time
    rows of its own days. A half-open range on ``event_time`` prunes Parquet row groups by their
    min/max statistics (the table is appended day by day, so its files are time-clustered)."""
    if not days:
        return dim_time
    lo, hi = min(days), max(days) + dt.timedelta(days=1)
    return dim_time.where((F.col("event_time") >= F.lit(str(lo)).cast("timestamp"))
                          & (F.col("event_time") < F.lit(str(hi)).cast("timestamp")))


def dimension_rows(name: str, star: Star, ods_rows: DataFrame, days: list | None = None,
                   base: int | None = None) -> DataFrame:
    """New rows of one dimension for the given ODS rows (existing rows never change). For
    ``dim_location`` the region ids are looked up in ``star.dim_region``, which must already hold the
    regions of these rows. ``base``: the dimension's largest id, when known without a scan."""
    e = ods_rows
    if name == "dim_region":
        cands = e.select(normalize_label("region").alias("region_name"))
        return insert_if_new(star.dim_region, cands, ["region_name"], "region_id", base=base)
    if name == "dim_time":
        cands = e.select(F.col("event_time"), *calendar_parts("event_time"))
        return insert_if_new(star.dim_time, cands, ["event_time"], "time_id",
                             existing=time_window(star.dim_time, days), reduce_existing=days is not None,
                             base=base)
    if name == "dim_location":
        # distinct first (partial aggregation collapses a hot place map-side), then the region lookup
        keys = e.select(normalize_label("region").alias("region_label"), "latitude", "longitude",
                        normalize_label("place").alias("place")).distinct()
        located = lookup(keys, star.dim_region, [(F.col("region_label"), "region_name", False)], "region_id",
                         broadcast_max_rows=SMALL_DIM_MAX_ROWS)
        cands = located.select("region_id", "latitude", "longitude", "place")
        return insert_if_new(star.dim_location, cands, ["latitude", "longitude", "place"], "location_id",
                             reduce_existing=days is not None, base=base)
    cols, id_col = LABEL_DIMS[name]
    cands = e.select(*[normalize_label(c).alias(c) for c in cols])
    return insert_if_new(getattr(star, name), cands, cols, id_col, base=base)


def new_dimension_rows(star: Star, ods_rows: DataFrame) -> dict[str, DataFrame]:
    """New rows per dimension, computed against in-memory dimensions (region rows are added before
    the location rows are derived)."""
    new = {}
    for name in DIMENSION_ORDER:
        new[name] = dimension_rows(name, star, ods_rows)
        if name == "dim_region":
            star = star.with_(dim_region=with_new_rows(star.dim_region, new[name]))
    return new


def add_dimension_rows(star: Star, new: dict[str, DataFrame]) -> Star:
    return star.with_(**{k: with_new_rows(getattr(star, k), v) for k, v in new.items()})


# O-45: fact rows by key lookup --------------------------------------------------------------------------
def fact_rows(star: Star, ods_rows: DataFrame, now: dt.datetime | None = None, days: list | None = None
              ) -> DataFrame:
    """One fact row per ODS row: six left lookups (an unmatched dimension gives a NULL key, the row
    stays) and ten measures. ``event_date`` is carried as a storage/pruning column. With ``days`` the
    time lookup reads only those days' time rows."""
    small = SMALL_DIM_MAX_ROWS
    daily = days is not None  # a batch of days against dimensions that grow with the events
    f = lookup(ods_rows, time_window(star.dim_time, days), [(F.col("event_time"), "event_time", False)], "time_id",
               reduce_dim=daily)
    f = lookup(f, star.dim_location, [(F.col("latitude"), "latitude", True),
                                      (F.col("longitude"), "longitude", True),
                                      (normalize_label("place"), "place", False)], "location_id", reduce_dim=daily,
               probe_from=ods_rows)
    f = lookup(f, star.dim_magnitude, [(normalize_label("mag_type"), "mag_type", False),
                                       (normalize_label("mag_source"), "mag_source", False)], "mag_type_id", small)
    f = lookup(f, star.dim_network, [(normalize_label("net"), "net", False),
                                     (normalize_label("location_source"), "location_source", False)],
               "network_id", small)
    f = lookup(f, star.dim_status, [(normalize_label("status"), "status", False)], "status_id", small)
    f = lookup(f, star.dim_event_type, [(normalize_label("event_type"), "event_type", False)], "event_type_id", small)
    measures = [c for c, _ in C.FACT_MEASURES]
    return f.select("id", *C.FACT_KEYS, *measures, stamp(now).alias("dwh_loaded_at"),
                    to_day("event_time").alias("event_date"))


# Fact columns the fact upsert overwrites (all but the key; the stamp is re-set).
FACT_UPDATE_COLUMNS = C.FACT_KEYS + [c for c, _ in C.FACT_MEASURES] + ["event_date"]


def load_dm_frames(star: Star, ods: DataFrame, days: list | None, now: dt.datetime | None = None,
                   on_duplicate: str = "error") -> tuple[Star, dict[str, DataFrame], DataFrame]:
    """O-50 as frames: (star with new dimension rows, the new rows per dimension, the upserted fact)."""
    rows = ods_for_days(ods, days)
    new = new_dimension_rows(star, rows)
    star2 = add_dimension_rows(star, new)
    batch = fact_rows(star2, rows, now)
    fact = upsert(star.fact, batch, key=["id"], update_cols=FACT_UPDATE_COLUMNS,
                  touch={"dwh_loaded_at": stamp(now)}, on_duplicate=on_duplicate)
    return star2.with_(fact=fact), new, batch
