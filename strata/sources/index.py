"""A stored key index: which partition of a table a key lives in.

A table that is partitioned by something else than its key (events by day, keyed by id) can only be searched for a key as a
whole. The index holds (key, partition) by a hash of the key, in as many folders as ``buckets`` says, sorted by key. A
load reads the folders that its keys fall into and gets the partitions it has to rewrite.

Entries are only added, before the rows they name are published: an entry without a row makes a load read a partition for
nothing, a row without an entry would be inserted a second time. A load that is run again finds its entries and adds none. Folders
with more than ``MAX_FILES`` files are written anew as one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.relational import KEY_BROADCAST_MAX_ROWS, is_small
from strata.sources.ledger import Folder, Ledger
from strata.sources.tables import has_partitions, move_partitions, staged_partitions

BUCKET = "bucket"
MAX_FILES = 16


@dataclass(frozen=True)
class KeyIndex:
    path: str
    key: str = "id"
    partition: str = "event_date"
    buckets: int = 64

    @property
    def folder(self) -> str:
        """Another number of buckets is another index."""
        return f"{self.path.rstrip('/')}/of-{self.buckets}"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _schema(self) -> T.StructType:
        return T.StructType([T.StructField(self.key, T.StringType()), T.StructField(self.partition, T.DateType()), T.StructField(BUCKET, T.IntegerType())])

    def exists(self, spark: SparkSession) -> bool:
        return "_COMPLETE.json" in Folder(spark, self.folder).names()

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self._schema()).parquet(self.folder)

    def entries(self, spark: SparkSession) -> DataFrame:
        """(key, partition) of the whole index."""
        return self.read(spark).select(self.key, self.partition)

    def ensure(self, spark: SparkSession, rows: DataFrame | None) -> None:
        """Build the index of ``rows`` (key, partition), all of a table's, if there is none yet; None: an empty table."""
        if self.exists(spark):
            return
        Folder(spark, self.path).remove(f"of-{self.buckets}")  # what a broken-off build has left
        if rows is not None:
            self._write(rows, "overwrite")
        Folder(spark, self.folder).write("_COMPLETE.json", {"buckets": self.buckets})

    def _write(self, rows: DataFrame, mode: str) -> None:
        placed = rows.select(self.key, self.partition, self._bucket().alias(BUCKET))
        (placed.hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, self.key).write.mode(mode).partitionBy(BUCKET).parquet(self.folder))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """(key, partition) of the ``keys`` that the index has: only the folders of their hashes are read, and where the
        keys are few, these are filtered without a shuffle."""
        spark = keys.sparkSession
        placed = keys.select(self.key).distinct().withColumn(BUCKET, self._bucket())
        wanted = sorted(r[0] for r in placed.select(BUCKET).distinct().collect())  # at most ``buckets`` numbers
        here = {n for n in Folder(spark, self.folder).names() if n.startswith(f"{BUCKET}=")}
        if not any(f"{BUCKET}={b}" in here for b in wanted):
            return spark.createDataFrame([], T.StructType(self._schema().fields[:2]))
        found = self.read(spark).where(F.col(BUCKET).isin(wanted))
        if is_small(placed, KEY_BROADCAST_MAX_ROWS):
            placed = F.broadcast(placed)
        return found.join(placed, [BUCKET, self.key], "left_semi").select(self.key, self.partition)

    def add(self, rows: DataFrame, ledger: Ledger | None = None) -> None:
        """Append ``rows`` (key, partition) of keys that the index doesn't have."""
        self._write(rows, "append")
        self.compact(rows.sparkSession, ledger)

    def compact(self, spark: SparkSession, ledger: Ledger | None = None) -> list[int]:
        """Write folders of more than ``MAX_FILES`` files anew; returns their numbers."""
        files: dict[str, int] = {}
        for f in self.read(spark).inputFiles() if has_partitions(spark, self.folder, BUCKET) else []:
            name = f.rsplit("/", 2)[1]
            files[name] = files.get(name, 0) + 1
        many = sorted(int(n.split("=")[1]) for n, k in files.items() if k > MAX_FILES)
        if many:
            rows = self.read(spark).where(F.col(BUCKET).isin(many)).dropDuplicates([self.key])
            publication = staged_partitions(spark, rows, self.folder, BUCKET, many)
            ledger.publish(publication) if ledger else move_partitions(spark, publication)
        return many
