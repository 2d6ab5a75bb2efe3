"""Partitioned Parquet layer tables: staged partition rewrites and appends.

Without a table format, a rewrite never overwrites a folder it is reading: the new content of the
affected partitions is first written to a staging folder beside the table, and checked there. Then the
partitions' folders are moved into the table: rows are written once. With a ledger, the move is written down
before it begins, so that a run after a lost driver completes it.
"""

from __future__ import annotations

import datetime as dt
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def partition_filter(col: str, values: list):
    """``col IN (values)``, where a None value selects the NULL partition."""
    dated = [F.lit(str(v)).cast("date") for v in values if v is not None]
    cond = F.col(col).isin(dated) if dated else F.lit(False)
    if any(v is None for v in values):
        cond = cond | F.col(col).isNull()
    return cond


def has_partitions(spark: SparkSession, path: str, col: str) -> bool:
    """Whether the table at ``path`` exists and has a partition of ``col`` (from a listing of its folder)."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(at) and any(s.getPath().getName().startswith(f"{col}=") for s in fs.listStatus(at))


def move_partitions(spark: SparkSession, publication: dict) -> None:
    """Carry out a publication of ``staged_partitions``: each affected partition's folder makes way for the staged one,
    or for nothing. Partitions that have been moved already are left alone, so it may be repeated."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def at(*parts: str):
        return jvm.org.apache.hadoop.fs.Path("/".join(parts))

    path, staging = publication["path"], publication["staging"]
    fs = at(path).getFileSystem(conf)
    for name in publication["emptied"]:
        fs.delete(at(path, name), True)
    fs.mkdirs(at(path))
    for name in publication["written"]:
        if not fs.exists(at(staging, name)):
            continue  # moved before
        move_folder(fs, at(staging, name), at(path, name))
    fs.delete(at(staging), True)


def move_folder(fs, source, target) -> None:
    """``target`` makes way for ``source``."""
    fs.delete(target, True)
    if not fs.rename(source, target):
        raise OSError(f"can't move {source} to {target}")


def folder_of(col: str, value) -> str:
    return f"{col}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def staged_partitions(spark: SparkSession, df: DataFrame, path: str, col: str, affected: list, check=None) -> dict:
    """Write the new rows ``df`` of the ``affected`` partitions beside the table, gathered by partition first: a task writes
    into few folders, and a large partition is split (AQE's rebalancing). ``check`` (optional) runs on the staged rows.
    Returns the publication: what ``move_partitions`` has to do."""
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    df.hint("rebalance", F.col(col)).write.mode("overwrite").partitionBy(col).parquet(staging)
    staged = spark.read.schema(df.schema).parquet(staging)
    folders = {f.rsplit("/", 2)[1] for f in staged.inputFiles()}  # from the listing, no job
    written = sorted(f for f in folders if f.startswith(f"{col}="))
    if check is not None:
        check(staged)
    emptied = sorted({folder_of(col, v) for v in affected} - set(written))
    return {"path": path.rstrip("/"), "staging": staging, "written": written, "emptied": emptied}


def rewrite_partitions(spark: SparkSession, df: DataFrame, path: str, col: str, affected: list,
                       check=None, ledger=None, done: dict | None = None) -> None:
    """Replace exactly the ``affected`` partitions of the table at ``path`` with the rows of ``df``. If ``check``
    raises, the table is untouched. With a ``ledger`` a broken-off move is completed by the next run, and ``done`` is
    written down as the finished step."""
    publication = staged_partitions(spark, df, path, col, affected, check)
    if ledger is None:
        move_partitions(spark, publication)
    else:
        ledger.publish(publication, done)


@contextmanager
def _scoped_conf(spark: SparkSession, settings: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def footer_max(spark: SparkSession, path: str, col: str) -> int:
    """``MAX(col)`` of a Parquet table answered from file footers (row-group statistics) rather than
    by scanning the column: the V2 Parquet scan with aggregate pushdown. 0 for an absent table."""
    v1 = spark.conf.get("spark.sql.sources.useV1SourceList", "")
    v2_parquet = ",".join(x for x in v1.split(",") if x.strip().lower() != "parquet")
    with _scoped_conf(spark, {"spark.sql.sources.useV1SourceList": v2_parquet,
                              "spark.sql.parquet.aggregatePushdown": "true"}):
        try:
            row = spark.read.parquet(path).agg(F.max(col)).first()
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
                return 0
            raise
    return int(row[0] or 0)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def distinct_values(df: DataFrame, col: str) -> list[dt.date | None]:
    """Distinct partition values (one per day: a bounded list)."""
    return sorted((r[0] for r in df.select(col).distinct().collect()), key=lambda v: (v is not None, v))
