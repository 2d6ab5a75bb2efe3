"""The seismic feed derived from the driver's test tables (``events`` joined to ``nation``).

The projection is a fixed rule per column (FIXTURES.md §3): every feed row is one ``events`` row, so
the feed, and all the work after it, grows with the test tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.contracts import FEED_COLUMNS
from strata.operators.relational import checked_broadcast, spread_rows

ISO_MS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
NATIONS_MAX = 1000  # nation is a fixed-size table; checked before it is broadcast


def _dec(x: Column, k: int) -> Column:
    """An integer as a decimal with k places, by decimal multiplication (exact, engine-neutral text)."""
    step = F.lit(f"{10 ** -k:.{k}f}").cast(f"decimal({k + 1},{k})")
    return (x.cast("decimal(9,0)") * step).cast(f"decimal(12,{k})")


def _txt(x: Column) -> Column:
    return x.cast("string")


def _blank_every(n: int, value: Column) -> Column:
    return F.when(F.col("event_id") % n == 0, F.lit("")).otherwise(value)


def _null_every(n: int, value: Column) -> Column:
    return F.when(F.col("event_id") % n != 0, value)


def feed_from_events(events: DataFrame, nation: DataFrame) -> DataFrame:
    """All 22 feed columns as text, one row per event."""
    eid, uid, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    hours = (eid % 5).cast("int")
    updated = ts + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), hours, F.lit(0), F.lit(0))
    place = (
        F.when(eid % 1999 == 0, F.concat(F.lit("1 km N of X, RARE_"), _txt(eid % 3)))
        .when(eid % 13 == 0, F.lit(None).cast("string"))
        .when(eid % 11 == 0, F.lit("Mid-ocean ridge"))
        .when(eid % 17 == 0, F.lit("5 km N of Camp, "))
        .otherwise(F.concat(F.lit(" "), _txt(uid % 40), F.lit(" km NE of Town "), _txt(uid % 9),
                            F.lit(", Area, "), F.col("n_name")))
    )
    kind = F.col("event_type")
    # Event kind of the test table -> feed 'type' text.
    type_ = (F.when(kind == "click", "Earthquake").when(kind == "view", "earthquake")
             .when(kind == "error", "Quarry Blast").when(kind == "signup", "explosion").otherwise(""))
    cols = {
        "time": F.date_format(ts, ISO_MS),
        "latitude": _null_every(97, _txt(_dec((uid * 3701) % 18001 - 9000, 2))),
        "longitude": _null_every(97, _txt(_dec((uid * 5303) % 36001 - 18000, 2))),
        "depth": _null_every(89, _txt(_dec((eid * 17) % 7031 - 20, 1))),
        "mag": _null_every(83, _txt(_dec((eid * 31 + uid) % 903 - 100, 2))),
        "magType": (F.when(eid % 4 == 0, "ml").when(eid % 4 == 1, "md").when(eid % 4 == 2, " mb ")
                    .otherwise("")),
        "nst": _blank_every(5, _txt(eid % 60)),
        "gap": _blank_every(6, _txt(_dec((eid * 13) % 36000, 2))),
        "dmin": _blank_every(7, _txt(_dec((eid * 11) % 9000, 4))),
        "rms": _blank_every(8, _txt(_dec((eid * 7) % 3000, 3))),
        "net": F.when(eid % 3 == 0, "us").when(eid % 3 == 1, "ci").otherwise("nc"),
        "id": F.concat(F.lit("ev"), _txt(eid)),
        "updated": F.date_format(updated, ISO_MS),
        "place": place,
        "type": type_,
        "horizontalError": _blank_every(9, _txt(_dec((eid * 19) % 99991, 5))),
        "depthError": _blank_every(10, _txt(_dec((eid * 23) % 99991, 5))),
        "magError": _blank_every(12, _txt(_dec((eid * 29) % 99991, 5))),
        "magNst": _blank_every(14, _txt(eid % 77)),
        "status": F.when(eid % 10 == 0, "automatic").when(eid % 10 == 1, " ").otherwise("reviewed"),
        "locationSource": F.when(eid % 2 == 0, "us").otherwise("ci"),
        "magSource": _null_every(19, F.lit("us")),
    }
    nations = checked_broadcast(nation.select("n_nationkey", "n_name"), NATIONS_MAX)
    joined = events.join(nations, F.col("n_nationkey") == uid % 25, "inner")
    return joined.select(*[cols[c].alias(c) for c in FEED_COLUMNS])


def load_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed of a test-data folder (columns pruned to what the projection reads)."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    return feed_from_events(spread_rows(events, "event_id"), nation)


# Second batch for the upserts (FIXTURES.md §4), derived from the same feed.
def _shift_iso(col: str, hours: int) -> Column:
    t = F.col(col).cast("timestamp") + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0),
                                                        F.lit(hours), F.lit(0), F.lit(0))
    return F.date_format(t, ISO_MS)


def _num(col: str = "id") -> Column:
    return F.substring(F.col(col), 3, 40).cast("long")


def corrections(feed: DataFrame) -> DataFrame:
    """Rows with n % 20 = 3: later update, new mag/status/place, and a depth the upsert must ignore."""
    return (feed.where(_num() % 20 == 3)
            .withColumn("updated", _shift_iso("updated", 24)).withColumn("mag", F.lit("1.11"))
            .withColumn("status", F.lit("deleted")).withColumn("place", F.lit("Moved, New Region"))
            .withColumn("depth", F.lit("999.9")))


def stale(feed: DataFrame) -> DataFrame:
    """Rows with n % 50 = 7: an *older* update that must still overwrite (no newer-wins rule)."""
    return (feed.where(_num() % 50 == 7)
            .withColumn("updated", _shift_iso("updated", -24)).withColumn("mag", F.lit("0.50")))


def new_events(feed: DataFrame) -> DataFrame:
    """Rows with n % 40 = 9 under new ids ('nx' prefix), 30 days later: must be inserted."""
    return (feed.where(_num() % 40 == 9)
            .withColumn("id", F.concat(F.lit("nx"), F.substring(F.col("id"), 3, 40)))
            .withColumn("time", _shift_iso("time", 24 * 30)))


def second_batch(feed: DataFrame) -> DataFrame:
    return corrections(feed).unionByName(stale(feed)).unionByName(new_events(feed))
