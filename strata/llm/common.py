"""Helpers shared by the operators: table access, staged results, Arrow columns as bytes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import configure, scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of one Arrow batch: bounds a Python worker's memory when every text is long.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> SparkSession:
    """The session settings the operators rely on."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below the shared checkpoint folder and read back: later plans
    start from the files, so neither a second use nor a lost executor computes ``df`` again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def let(value: Column, body) -> Column:
    """``body(v)`` with ``v`` bound to ``value``, which is evaluated once per row (a plain column
    reference inside a lambda would be evaluated once per element)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def utf8(column: pa.Array) -> Iterator[bytes]:
    """The texts of an Arrow string column as UTF-8 bytes; null reads as the empty text."""
    return (x or b"" for x in column.cast(pa.binary()).to_pylist())


def fs_path(uri: str):
    """(file system, path) of a folder URI as Spark writes it (``file:/x``, ``s3a://``, ``hdfs://``)."""
    from pyarrow import fs

    if "://" not in uri:
        uri = "file://" + re.sub(r"^file:", "", uri)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))
