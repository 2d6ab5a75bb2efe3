"""O-01..O-05: the landed CSV feed, the RAW day-partitioned Parquet layer, named layer tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from strata.contracts import FEED_SCHEMA, Contract
from strata.operators.relational import spread
from strata.sources.tables import partition_filter

RAW_PARTITION = "load_date"


# O-01 -------------------------------------------------------------------------------------------
# Unquoted empty field -> NULL, quoted empty field ("") -> ''. Spark maps a parsed value equal to
# ``nullValue`` to NULL; the parser hands unquoted empties over as ``nullValue`` and quoted ones as
# ``emptyValue``, so a nullValue that never occurs in text keeps the two apart.
_NEVER_IN_TEXT = "\u0000"


def feed_reader(spark: SparkSession, schema: T.StructType = FEED_SCHEMA):
    """CSV reader of landed feed files: header row, RFC-4180 quoting (a quote inside a quoted field is
    doubled, fields may hold newlines), every field as text, a malformed row fails the read."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)  # header names must match the contract
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", _NEVER_IN_TEXT)
        .option("emptyValue", "")
        .option("mode", "FAILFAST")
    )


def read_feed(spark: SparkSession, path: str, schema: T.StructType = FEED_SCHEMA) -> DataFrame:
    """Read landed CSV event files (see ``feed_reader``) so the RAW layer has one schema forever.
    A multi-line CSV file cannot be split, so a few large files are spread over the cluster."""
    return spread(feed_reader(spark, schema).csv(path))


#: Rows of a landed file at most: one task reads a file, as it can't be split.
LANDED_ROWS = 100_000


def write_feed(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Write a feed DataFrame as CSV in the shape ``read_feed`` reads (used to land test files):
    NULL as an unquoted empty field, '' as \"\", spaces kept. Rows are gathered by ``partition_by`` first, and files are
    bounded in rows."""
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    w = (df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
         .option("maxRecordsPerFile", LANDED_ROWS)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


# O-02 -------------------------------------------------------------------------------------------
def write_raw_day(df: DataFrame, root: str, day: dt.date | str) -> None:
    """Store one day of feed rows as Parquet in ``root/load_date=<day>``. A rerun of the day replaces
    that folder only (also with an empty file, as the source overwrites the day's object); other days
    are untouched. Readers of ``root`` see ``load_date`` as a partition column."""
    df.select(*FEED_SCHEMA.fieldNames()).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{RAW_PARTITION}={day}")


# O-03 -------------------------------------------------------------------------------------------
def read_raw_day(spark: SparkSession, root: str, day: dt.date | str,
                 schema: T.StructType = FEED_SCHEMA) -> DataFrame:
    """Read one day of the RAW layer; the equality on the partition column prunes to one folder."""
    full = T.StructType(list(schema.fields) + [T.StructField(RAW_PARTITION, T.DateType(), True)])
    return (spark.read.schema(full).parquet(root)
            .where(F.col(RAW_PARTITION) == F.lit(str(day)).cast("date"))
            .drop(RAW_PARTITION))


def read_raw_days(spark: SparkSession, root: str, days: list, schema: T.StructType = FEED_SCHEMA) -> DataFrame:
    """Read several days of the RAW layer in one scan, with ``load_date``; the list of days prunes to their folders."""
    full = T.StructType(list(schema.fields) + [T.StructField(RAW_PARTITION, T.DateType(), True)])
    return spark.read.schema(full).parquet(root).where(partition_filter(RAW_PARTITION, days))


# O-04 -------------------------------------------------------------------------------------------
def storage_schema(c: Contract) -> T.StructType:
    fields = list(c.schema.fields)
    if c.partition_by:
        fields.append(T.StructField(c.partition_by, T.DateType(), True))
    return T.StructType(fields)


def read_layer(spark: SparkSession, path: str, c: Contract, keep_partition: bool = False) -> DataFrame:
    """Read a layer table with its contract schema; an absent table reads as an empty DataFrame."""
    schema = storage_schema(c)
    try:
        df = spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:  # path does not exist yet: first load
        if "PATH_NOT_FOUND" not in str(exc) and "Path does not exist" not in str(exc):
            raise
        df = spark.createDataFrame([], schema).where(F.lit(False))  # known to be empty when joins with it are planned
    return df if keep_partition or not c.partition_by else df.drop(c.partition_by)


# O-05 -------------------------------------------------------------------------------------------
def append_by_name(target: DataFrame, source: DataFrame,
                   defaults: dict[str, Column] | None = None) -> DataFrame:
    """``INSERT INTO target BY NAME SELECT ...``: source columns match target columns by name;
    target columns the source lacks take their default expression (else NULL); extra source
    columns are an error."""
    defaults = defaults or {}
    extra = set(source.columns) - set(target.columns)
    if extra:
        raise ValueError(f"columns not in target: {sorted(extra)}")
    dtypes = dict((f.name, f.dataType) for f in target.schema.fields)
    cols = [
        (F.col(c) if c in source.columns else defaults.get(c, F.lit(None))).cast(dtypes[c]).alias(c)
        for c in target.columns
    ]
    return target.unionByName(source.select(*cols))
