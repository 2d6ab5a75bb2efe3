"""The worked example on the driver's test tables: first load, second batch, defect injection.

``first_load`` builds RAW-shaped feed -> STG -> ODS -> star in one pass over all days and writes each
table once to the shared scratch folder (so every report of a session reads the same star, lineage is
cut, and the tables carry file statistics). Audit stamps use a fixed instant so results reproduce.
"""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import contracts as C
from strata.plans.model import Star, empty, empty_star, load_dm_frames, stg_from_feed, upsert_ods
from strata.plans.partials import aggregate
from strata.operators.maintain import assert_unique, materialize
from strata.session import configure
from strata.sources.testdata import load_feed, second_batch

# Fixed value: the audit instant of the worked example (reproducible stamps).
FIXED_NOW = dt.datetime(2026, 1, 1, 0, 0, 0)

_cache: dict[tuple[str, str], tuple[DataFrame, DataFrame, Star]] = {}
_aggregates: dict[tuple[str, str], DataFrame] = {}
_lock = threading.Lock()


def _fix(df: DataFrame, name: str = "table") -> DataFrame:
    # the fact is stored by event date, as in the persisted warehouse (partition pruning, newest-days top-k)
    return materialize(df, name, partition_by="event_date" if name == "fact" else None)


def first_load(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, Star]:
    """(stg, ods, star) after loading every day of the feed once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key in _cache:
            return _cache[key]
        configure(spark)
        stg = stg_from_feed(load_feed(spark, sf_dir), FIXED_NOW)
        # duplicate keys are checked on the written tables (cheap) rather than on recomputed batches
        ods = _fix(upsert_ods(empty(spark, C.ODS), stg, FIXED_NOW, on_duplicate="unchecked"), "ods")
        assert_unique(ods, ["id"], "ods.earthquakes")
        star, _, _ = load_dm_frames(empty_star(spark), ods, None, FIXED_NOW, on_duplicate="unchecked")
        # every report reads this star: fix each table once
        star = Star(**{k: _fix(v, k) for k, v in star.tables().items()})
        assert_unique(star.fact, ["id"], "dm.fact_earthquakes")
        _cache[key] = (stg, ods, star)
        return _cache[key]


def maintained_load(spark: SparkSession, sf_dir: str) -> Star:
    """The star of the first load with its maintained aggregates."""
    key = (spark.sparkContext.applicationId, sf_dir)
    _, _, star = first_load(spark, sf_dir)
    with _lock:
        if key not in _aggregates:
            _aggregates[key] = materialize(aggregate(star.fact), "agg", partition_by="event_date")
        return star.with_(agg=_aggregates[key])


def second_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ODS after the second batch (corrections, stale updates, new events) is upserted."""
    stg, ods, _ = first_load(spark, sf_dir)
    batch = stg_from_feed(second_batch(load_feed(spark, sf_dir)), FIXED_NOW)
    return upsert_ods(ods, batch, FIXED_NOW)


def _n() -> F.Column:
    return F.substring(F.col("id"), 3, 40).cast("long")


def inject_defects(ods: DataFrame, star: Star) -> tuple[DataFrame, Star]:
    """Break a healthy star so every check has a non-zero answer (FIXTURES.md §5)."""
    fact = (star.fact.where(_n() % 101 != 0)
            .withColumn("status_id", F.when(_n() % 103 != 0, F.col("status_id")))
            .withColumn("location_id", F.when(_n() % 107 == 0, F.lit(-1)).otherwise(F.col("location_id"))))

    def redo_first(dim: DataFrame, id_col: str) -> DataFrame:
        m = dim.agg(F.max(id_col)).first()[0] or 0
        dup = dim.where(F.col(id_col) == 1).withColumn(id_col, F.lit(m + 1).cast("long"))
        return dim.unionByName(dup)

    def add_label(dim: DataFrame, id_col: str, col: str, label: str) -> DataFrame:
        m = dim.agg(F.max(id_col)).first()[0] or 0
        extra = dim.sparkSession.createDataFrame([(m + 1, label)], dim.select(id_col, col).schema)
        return dim.unionByName(extra)

    star2 = star.with_(
        fact=fact,
        dim_magnitude=redo_first(star.dim_magnitude, "mag_type_id"),
        dim_network=redo_first(star.dim_network, "network_id"),
        dim_status=add_label(star.dim_status, "status_id", "status", "retired"),
        dim_event_type=add_label(star.dim_event_type, "event_type_id", "event_type", "landslide"),
    )
    first_day = ods.agg(F.min(F.to_date("event_time"))).first()[0]
    ods2 = ods.where(~F.coalesce(F.to_date("event_time") == F.lit(first_day), F.lit(False)))
    return ods2, star2


def defect_load(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Star]:
    _, ods, star = first_load(spark, sf_dir)
    return inject_defects(ods, star)
