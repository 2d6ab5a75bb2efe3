"""O-47..O-52: the daily jobs over Parquet layers (RAW -> STG -> ODS -> DM).

Layout below a warehouse root (a folder every executor can reach):

    raw/earthquake/load_date=D/         feed rows as landed, all text (O-02)
    stg/earthquake_raw/stg_date=D/      snake_case text rows; D = the row's own date
    ods/earthquakes/event_date=D/       typed, one row per id
    dm/dim_*/                           dimensions (append-only)
    dm/fact_earthquakes/event_date=D/   fact
    dm/agg_fact/event_date=D/           maintained aggregates of the fact (plans/partials.py)
    index/ods_earthquakes/              id -> event_date of every ODS row, by a hash of the id (sources/index.py)
    ledger/                             finished steps and begun publications (sources/ledger.py)

Each job touches only the partitions its batch affects: the index names the partitions of ids that ODS has, so no other
partition of ODS is read. ``load_ods(days=None)`` re-reads all of STG on every run as the source pipeline does (pass
``days`` to load incrementally).

``run_step`` runs one step of a day and refuses one whose predecessor isn't finished; ``run_day`` and ``backfill`` run
them in order and, with ``resume``, go on where a broken-off run has ended.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import contracts as C
from strata.functions.columns import to_day
from strata.operators.maintain import (
    assert_not_null, assert_unique, materialize, merge_versions, replace_day, replace_days, upsert,
)
from strata.operators.relational import KEY_BROADCAST_MAX_ROWS, checked_broadcast
from strata.operators.validate import assert_valid, validate, validate_rows
from strata.plans.model import (
    DIMENSION_ORDER, FACT_UPDATE_COLUMNS, Star, dimension_rows, fact_rows, stamp, stg_from_feed,
    standardize, ODS_UPDATE_COLUMNS,
)
from strata.plans.partials import AGGREGATE, aggregate
from strata.session import configure
from strata.sources.feed import feed_reader, read_feed, read_layer, read_raw_day, read_raw_days, write_raw_day, RAW_PARTITION
from strata.sources.index import KeyIndex
from strata.sources.ledger import Ledger, files_token
from strata.sources.tables import append, distinct_values, footer_max, has_partitions, partition_filter, rewrite_partitions

DIM_TABLES = {
    "dim_time": C.DIM_TIME, "dim_location": C.DIM_LOCATION, "dim_region": C.DIM_REGION,
    "dim_magnitude": C.DIM_MAGNITUDE, "dim_network": C.DIM_NETWORK, "dim_status": C.DIM_STATUS,
    "dim_event_type": C.DIM_EVENT_TYPE,
}


@dataclass(frozen=True)
class Warehouse:
    """A warehouse is written by one run at a time. ``root``: a folder that every executor can reach."""

    root: str

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def raw(self) -> str:
        return self.path("raw", "earthquake")

    @property
    def stg(self) -> str:
        return self.path("stg", "earthquake_raw")

    @property
    def ods(self) -> str:
        return self.path("ods", "earthquakes")

    def dm(self, name: str) -> str:
        return self.path("dm", name)

    @property
    def ods_index(self) -> KeyIndex:
        return KeyIndex(self.path("index", "ods_earthquakes"), "id", C.ODS.partition_by)

    def ledger(self, spark: SparkSession) -> Ledger:
        return Ledger(spark, self.path("ledger"))

    # readers ---------------------------------------------------------------------------------------
    def read_stg(self, spark: SparkSession) -> DataFrame:
        return read_layer(spark, self.stg, C.STG, keep_partition=True)

    def read_ods(self, spark: SparkSession, keep_partition: bool = False) -> DataFrame:
        return read_layer(spark, self.ods, C.ODS, keep_partition=keep_partition)

    def read_star(self, spark: SparkSession) -> Star:
        dims = {k: read_layer(spark, self.dm(k), c) for k, c in DIM_TABLES.items()}
        fact = read_layer(spark, self.dm("fact_earthquakes"), C.FACT, keep_partition=True)
        agg = None
        if has_partitions(spark, self.dm("agg_fact"), C.FACT.partition_by):
            agg = read_layer(spark, self.dm("agg_fact"), AGGREGATE, keep_partition=True)
        return Star(fact=fact, agg=agg, **dims)


def _day(day: dt.date | str) -> dt.date:
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(str(day))


# O-47 -------------------------------------------------------------------------------------------
def ingest_raw(spark: SparkSession, wh: Warehouse, csv_path: str, day: dt.date | str | None = None) -> None:
    """Land one day's CSV file(s) in RAW as Parquet (a rerun replaces the day). With ``day=None`` a
    multi-day file is split by each row's own date, one partition per day, in one job."""
    configure(spark)
    feed = read_feed(spark, csv_path)
    if day is not None:
        write_raw_day(feed, wh.raw, day)
    else:
        (feed.withColumn(RAW_PARTITION, F.col("time").try_cast("date")).hint("rebalance", F.col(RAW_PARTITION))
         .write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(RAW_PARTITION).parquet(wh.raw))


# O-48 -------------------------------------------------------------------------------------------
def load_stg(spark: SparkSession, wh: Warehouse, day: dt.date | str, now: dt.datetime | None = None,
             done: dict | None = None) -> list:
    """Replace the STG rows dated ``day`` by every row of that day's RAW file (rows of other dates in
    the file are appended too). A file without a non-NULL id changes nothing. Returns the STG
    partitions it rewrote (empty when the day was skipped). ``done``: what the ledger shall say once it is published."""
    configure(spark)
    ledger = wh.ledger(spark)
    ledger.recover()
    d = _day(day)
    batch = (stg_from_feed(read_raw_day(spark, wh.raw, d), now)
             .withColumn(C.STG.partition_by, F.col("time").try_cast("date")))
    batch = materialize(batch, "batch")  # read once; the day's file may be re-landed meanwhile
    part = C.STG.partition_by
    # one job: is there a row with an id, and which dates does the file hold (a handful of values)
    stats = batch.agg(F.count("id").alias("n"), F.collect_set(F.coalesce(F.col(part).cast("string"), F.lit("")))
                      .alias("days")).first()
    if stats["n"] == 0:
        return []
    dates = {None if v == "" else dt.date.fromisoformat(v) for v in stats["days"]}
    affected = sorted(dates | {d}, key=lambda v: (v is not None, v))
    target = wh.read_stg(spark).where(partition_filter(part, affected))
    merged = replace_day(target, batch, F.col(part), d, checked=True)
    done = done and {**done, "detail": {"touched": [None if v is None else str(v) for v in affected]}}
    rewrite_partitions(spark, merged, wh.stg, part, affected, ledger=ledger, done=done)
    return affected


# O-49 -------------------------------------------------------------------------------------------
def load_ods(spark: SparkSession, wh: Warehouse, now: dt.datetime | None = None, days: list | None = None,
             on_duplicate: str = "error", rows: DataFrame | None = None, done: dict | None = None) -> None:
    """Upsert STG into ODS: all of STG (``days=None``, as the source pipeline does), only the STG
    partitions of ``days``, or the given ``rows`` of STG's shape. A NULL id, and by default an id that
    stands twice, or a value that is longer than its column, fails the load before ODS is touched. Only ODS partitions holding a batch id, or receiving one, are rewritten;
    known ids keep their partition because their event time is never updated, and the key index says which it is."""
    configure(spark)
    ledger = wh.ledger(spark)
    ledger.recover()
    stg = wh.read_stg(spark) if rows is None else rows
    if days is not None:
        stg = stg.where(partition_filter(C.STG.partition_by, [None if x is None else _day(x) for x in days]))
    batch = materialize(stg.drop(C.STG.partition_by), "batch")
    part = C.ODS.partition_by
    ods = wh.read_ods(spark, keep_partition=True)
    ids = batch.select("id").where(F.col("id").isNotNull())
    index, known, known_days = wh.ods_index, None, []
    has_rows = has_partitions(spark, wh.ods, part)
    index.ensure(spark, ods.select("id", part) if has_rows else None)
    if has_rows:
        known = materialize(index.lookup(ids), "known")
        known_days = distinct_values(known, part)
    new_days = distinct_values(batch.select(to_day(F.col("time").try_cast("timestamp")).alias(part)), part)
    affected = sorted(set(known_days) | set(new_days), key=lambda v: (v is not None, v))
    target = ods.where(partition_filter(part, affected)).drop(part)
    checked_later = on_duplicate == "error"  # checked on the staged output: no second pass over STG

    def check(staged: DataFrame) -> None:
        if checked_later:
            assert_unique(staged, ["id"], C.ODS.name)
        assert_valid(validate_rows(staged, C.ODS.name, C.ODS))
        placed = staged.select("id", part)  # of all affected partitions: the batch's new ids are those the index lacks
        index.add(placed if known is None else placed.join(ids.distinct(), "id", "left_semi").join(known, "id", "left_anti"), ledger)

    merged = upsert(target, standardize(batch), key=["id"], update_cols=ODS_UPDATE_COLUMNS,
                    insert_defaults={"ods_loaded_at": stamp(now)},
                    on_duplicate="unchecked" if checked_later else on_duplicate, order_by=["updated_at"])
    rewrite_partitions(spark, merged.withColumn(part, to_day("event_time")), wh.ods, part, affected, check=check,
                       ledger=ledger, done=done)


# O-50 -------------------------------------------------------------------------------------------
def load_dm(spark: SparkSession, wh: Warehouse, days, now: dt.datetime | None = None,
            check: bool = False, done: dict | None = None) -> None:
    """Load the star for one day (or a list of days in one pass): insert-if-new into the seven
    dimensions (region before location), then upsert the days' fact rows. Dimensions are append-only;
    the fact rewrites the partitions of ``days``. A list gives the same rows as one call per day;
    only the order in which new surrogate ids are handed out differs.

    Everything is staged and checked before anything is published: NOT NULL and length rules of the new
    dimension rows and the fact, and the fact's primary key. Foreign keys hold by construction, as they are
    looked up in the dimensions; ``check=True`` checks all rules against the whole dimensions."""
    configure(spark)
    ledger = wh.ledger(spark)
    ledger.recover()
    ds = sorted(_day(x) for x in (days if isinstance(days, (list, tuple, set)) else [days]))
    part = C.ODS.partition_by
    rows = wh.read_ods(spark, keep_partition=True).where(partition_filter(part, ds)).drop(part)
    star = wh.read_star(spark)
    fact_part = star.fact.where(partition_filter(C.FACT.partition_by, ds))
    new: dict[str, DataFrame] = {}
    for name in DIMENSION_ORDER:
        base = footer_max(spark, wh.dm(name), DIM_TABLES[name].key[0])  # no scan of the id column
        new[name] = materialize(dimension_rows(name, star, rows, ds, base), name)  # ids are fixed once written
        star = star.with_(**{name: getattr(star, name).unionByName(new[name])})
    batch = fact_rows(star, rows, now, ds)
    fact = upsert(fact_part, batch, key=["id"], update_cols=FACT_UPDATE_COLUMNS,
                  touch={"dwh_loaded_at": stamp(now)}, on_duplicate="unchecked")

    def publish_dimensions(staged: DataFrame) -> None:
        assert_unique(staged, ["id"], C.FACT.name)
        own = [validate_rows(df, DIM_TABLES[name].name, DIM_TABLES[name]) for name, df in new.items()]
        assert_valid(reduce(DataFrame.unionByName, [*own, validate_rows(staged, C.FACT.name, C.FACT)]))
        if check:
            tables = {c.name: (getattr(star, k), c) for k, c in DIM_TABLES.items()}
            assert_valid(validate(tables | {C.FACT.name: (staged, C.FACT)}))
        # dimensions before the fact: a rerun after a loss in between finds its rows there and adds none
        for name, df in new.items():
            append(df, wh.dm(name))

    rewrite_partitions(spark, fact, wh.dm("fact_earthquakes"), C.FACT.partition_by, ds, check=publish_dimensions, ledger=ledger)
    # the aggregates of these days; if the run is broken off in between, the step isn't finished and is run again
    written = wh.read_star(spark).fact.where(partition_filter(C.FACT.partition_by, ds))
    rewrite_partitions(spark, aggregate(written), wh.dm("agg_fact"), C.FACT.partition_by, ds, ledger=ledger, done=done)


# O-51 / O-52 --------------------------------------------------------------------------------------
#: The steps of a day, each with the one it builds on.
STEPS = {"raw": None, "stg": "raw", "ods": "stg", "dm": "ods"}


def _unit(day: dt.date) -> str:
    return f"day={day}"


def run_step(spark: SparkSession, wh: Warehouse, step: str, day: dt.date | str, csv_path: str | None = None,
             now: dt.datetime | None = None, ods_days: bool = True, resume: bool = False) -> bool:
    """One step of a day: ``raw`` (of the files at ``csv_path``), ``stg``, ``ods`` or ``dm``. Raises ``NotReady`` unless the
    step before it is finished, as a scheduler's sensor waits for it. With ``resume`` nothing is done if the step is
    finished for the same input: the same files, or the same run of the step before. Returns whether it ran."""
    configure(spark)
    ledger, d = wh.ledger(spark), _day(day)
    unit = _unit(d)
    ledger.recover()
    before = STEPS[step]
    above = ledger.require(unit, before, step) if before else None
    inputs = above["run"] if above else files_token(spark, csv_path)
    was = ledger.finished(unit, step)
    if resume and was and was["inputs"] == inputs:
        return False
    done = {"unit": unit, "step": step, "inputs": inputs}
    if step == "raw":
        ingest_raw(spark, wh, csv_path, d)
        ledger.finish(**done)
    elif step == "stg":
        if not load_stg(spark, wh, d, now, done=done):  # an empty file: nothing was published
            ledger.finish(**done, detail={"touched": []})
    elif step == "ods":
        touched = [None if x is None else _day(x) for x in above["detail"]["touched"]]
        if touched or not ods_days:
            load_ods(spark, wh, now, days=touched if ods_days else None, done=done)
        else:
            ledger.finish(**done)
    else:
        load_dm(spark, wh, d, now, done=done)
    return True


def run_day(spark: SparkSession, wh: Warehouse, csv_path: str, day: dt.date | str,
            now: dt.datetime | None = None, ods_days: bool = True, resume: bool = False) -> None:
    """The four layers for one day, in order. With ``resume``, steps that are finished for the same files are left out.

    ``ods_days=True`` (default) upserts into ODS only the STG partitions this day's file rewrote;
    ``False`` re-upserts all of STG, as the source pipeline does. Re-applying an unchanged STG row is a
    no-op, so both give the same ODS whenever STG holds at most one version of an event — the only
    other case is one where the source's upsert fails ("cannot affect row a second time"). The
    incremental form rewrites a day's partitions instead of the whole ODS."""
    for step in STEPS:
        run_step(spark, wh, step, day, csv_path, now, ods_days, resume)


def backfill(spark: SparkSession, wh: Warehouse, landing: str, days: list, now: dt.datetime | None = None,
             mode: str = "daily", ods_days: bool = True, resume: bool = True) -> None:
    """Load a range of days (``landing/day=<D>`` holds day D's files). A run that was broken off goes on at its first
    unfinished step; days whose files haven't changed since they were loaded are left out (``resume=False``: nothing is).

    * ``mode="daily"``: the day chain once per day, in order (what a scheduler catch-up does).
    * ``mode="one_pass"``: one job per layer for the whole range, with the daily result. STG: see
      ``replace_days``. ODS: an id's first file gives the columns that are only inserted, its last the
      updated ones. A day's facts are loaded before files of later days correct its events, so these
      versions reach ODS after the star is loaded.
    """
    ds = sorted(_day(x) for x in days)
    if mode == "daily":
        for d in ds:
            run_day(spark, wh, f"{landing.rstrip('/')}/day={d}", d, now, ods_days=ods_days, resume=resume)
        return
    if mode != "one_pass":
        raise ValueError(f"unknown mode: {mode}")
    configure(spark)
    ledger = wh.ledger(spark)
    ledger.recover()
    paths = [f"{landing.rstrip('/')}/day={d}" for d in ds]
    files = hashlib.sha256("".join(files_token(spark, p) for p in paths).encode()).hexdigest()
    unit = f"range={ds[0]}_{ds[-1]}_{hashlib.sha256(','.join(map(str, ds)).encode()).hexdigest()[:16]}" if ds else "range=none"

    def finished(step: str, inputs: str) -> dict | None:
        was = ledger.finished(unit, step)
        return was if resume and was and was["inputs"] == inputs else None

    # RAW: every file of the range, its header checked, each under the day its folder names
    raw_done = finished("raw", files)
    if not raw_done:
        day = F.regexp_extract(F.col("_metadata.file_path"), "/day=([0-9]{4}-[0-9]{2}-[0-9]{2})/", 1).cast("date")
        (feed_reader(spark).csv(paths).withColumn(RAW_PARTITION, day).hint("rebalance", F.col(RAW_PARTITION)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(RAW_PARTITION).parquet(wh.raw))
        raw_done = ledger.finish(unit, "raw", files)
    inputs = raw_done["run"]
    if finished("late", inputs):
        return _mark_days(spark, wh, landing, ds, finished("stg", inputs))
    # STG: all files at once, with the outcome of the sequential delete-then-append
    raw = read_raw_days(spark, wh.raw, ds)
    part = C.STG.partition_by
    batch = materialize(stg_from_feed(raw, now, extra=[RAW_PARTITION])
                        .withColumn(part, F.col("time").try_cast("date")), "batch")
    live = distinct_values(batch.where(F.col("id").isNotNull()), RAW_PARTITION)  # non-empty files
    affected = sorted(set(distinct_values(batch, part)) | set(live), key=lambda v: (v is not None, v))
    versions = batch.where(partition_filter(RAW_PARTITION, live))
    if not finished("stg", inputs):
        target = wh.read_stg(spark).where(partition_filter(part, affected))
        merged = replace_days(target, batch, F.col(part), F.col(RAW_PARTITION), live)
        assert_not_null(versions, ["id"], "the files")
        assert_unique(versions, ["id", RAW_PARTITION], "the files")
        of_file = F.collect_set(F.coalesce(F.col(part).cast("string"), F.lit("")))  # the dates in each file
        touched = {str(r[0]): sorted({*r[1], str(r[0])}) for r in versions.groupBy(RAW_PARTITION).agg(of_file).collect()}
        rewrite_partitions(spark, merged, wh.stg, part, affected, ledger=ledger,
                           done={"unit": unit, "step": "stg", "inputs": inputs, "detail": {"touched": touched}})
    # as upserting a day's partitions does: an id that stands in STG twice fails before ODS is touched
    assert_unique(wh.read_stg(spark).where(partition_filter(part, affected)), ["id"], C.STG.name)
    # (id, file) of the versions in files after the day their event has by its first file: found among narrow rows
    home = versions.groupBy("id").agg(F.min_by(part, RAW_PARTITION).alias("__home"))
    later = versions.select("id", RAW_PARTITION).join(home, "id").where(F.col(RAW_PARTITION) > F.col("__home")).drop("__home")
    later = checked_broadcast(materialize(later, "late"), KEY_BROADCAST_MAX_ROWS)
    for step, late in (("ods", False), ("late", True)):
        some = versions.join(later, ["id", RAW_PARTITION], "left_semi" if late else "left_anti").drop(part).select(*[c for c in versions.columns if c != part])
        done = {"unit": unit, "step": step, "inputs": inputs}
        if not finished(step, inputs):
            if not late or some.limit(1).count():
                load_ods(spark, wh, now, rows=merge_versions(some, "id", RAW_PARTITION, ["updated", "mag", "status", "place"]), done=done)
            else:
                ledger.finish(**done)
        if not late and not finished("dm", inputs):
            load_dm(spark, wh, ds, now, done={"unit": unit, "step": "dm", "inputs": inputs})
    _mark_days(spark, wh, landing, ds, ledger.finished(unit, "stg"))


def _mark_days(spark: SparkSession, wh: Warehouse, landing: str, days: list, stg: dict) -> None:
    """Write the days of a range down as finished, so that a daily run leaves them alone unless their files change."""
    ledger = wh.ledger(spark)
    for d in days:
        above = files_token(spark, f"{landing.rstrip('/')}/day={d}")
        was = ledger.finished(_unit(d), "dm")
        if was and was["detail"].get("range") == stg["run"]:
            continue
        touched = [v or None for v in stg["detail"]["touched"].get(str(d), [])]
        for step in STEPS:
            detail = {"touched": touched} if step == "stg" else {"range": stg["run"]} if step == "dm" else None
            above = ledger.finish(_unit(d), step, above, detail)["run"]
