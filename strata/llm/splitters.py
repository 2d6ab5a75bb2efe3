"""Sharding by sampled splitters: range partitions of near equal size from a size-weighted sample.

A bounded sample, in which a record's chance is proportional to its size, gives quantiles of the
(key, tie) order as boundaries of many ranges. Ranges are counted exactly; one that came out
overfull (a sample is a sample, and a hot key is one value) is subdivided by boundaries drawn from that range
alone, until all fit. Sums over ranges then say where each record lies in the whole order, and
the shards are equal stretches of it. Only (key, id, size) rows are shuffled, and no step sorts more
than a range in one task.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import staged

SHARDS, SAMPLES_PER_RANGE, MAX_ROUNDS, SEED = 16, 8, 8, 42
#: What a range should hold, in bytes of the records' sizes (only short rows are sorted); a shard has 64 ranges
#: at least, and all have RANGES_MAX at most, which bounds the sample at the driver: 512 K short rows.
RANGE_BYTES, RANGES_MAX = 256 << 20, 1 << 16


def _sampled(rows: DataFrame, weight: float, seed: int) -> list[tuple[int, int]]:
    """Sorted (key, tie) of a sample with chance ``size / weight``, decided by a hash of the record."""
    u = F.pmod(F.xxhash64(F.lit(seed), "key", "tie", "size"), F.lit(1 << 30)) / float(1 << 30)
    got = rows.where(u < F.col("size") / float(weight)).select("key", "tie").collect()
    return sorted((r[0], r[1]) for r in got)


def _boundaries(sample: list[tuple[int, int]], ranges: int) -> list[tuple[int, int]]:
    """Quantiles of the sample that cut it into ``ranges``."""
    if not sample:
        return []
    return sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)})


def _assign(rows: DataFrame, bounds: list[tuple[int, int]]) -> DataFrame:
    """``rows`` with ``part``: how many boundaries are at or below the record."""
    shared = rows.sparkSession.sparkContext.broadcast(bounds)

    def run(batches):
        b = shared.value
        keys = np.array([k for k, _ in b], dtype=np.int64)
        for batch in batches:
            key, tie = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            part = np.searchsorted(keys, key, side="left") if len(b) else np.zeros(len(key), np.int64)
            for i in np.flatnonzero(np.isin(key, keys)):  # a boundary's own key is decided by the tie
                part[i] = bisect_right(b, (int(key[i]), int(tie[i])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part.astype(np.int32))], names=[*batch.schema.names, "part"])

    return rows.mapInArrow(run, rows.withColumn("part", F.lit(0)).schema)


def split(rows: DataFrame, shards: int = SHARDS, range_bytes: int = RANGE_BYTES, seed: int = SEED) -> DataFrame:
    """``rows`` (key, tie, size, and whatever else; no nulls in these) with ``shard`` and ``slot``.

    Records are in the order of (key, tie); a record's shard is where its first byte lies among
    ``shards`` equal stretches of all bytes, so shards differ by one record at most, and slots count
    a shard's records from 0. Rows equal in key and tie have places in any order.
    """
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    size, n = int(total[0]), int(total[1])
    if not n:
        return rows.withColumn("shard", F.lit(0)).withColumn("slot", F.lit(0).cast("long"))
    ranges = max(1, min(max(64 * shards, -(-size // range_bytes)), RANGES_MAX, n // 8))
    target = size / ranges
    rows = rows.select("key", "tie", *[c for c in rows.columns if c not in ("key", "tie")])
    bounds = _boundaries(_sampled(rows, target / SAMPLES_PER_RANGE, seed), ranges)
    for turn in range(MAX_ROUNDS):
        placed = staged(_assign(rows, bounds), "ranges")
        sums = placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), F.min(F.struct("key", "tie")).alias("lo"), F.max(F.struct("key", "tie")).alias("hi"))
        over = [(r["part"], r["bytes"]) for r in sums.where((F.col("bytes") > 2 * target) & (F.col("lo") < F.col("hi")) & (F.col("n") > 1)).collect()]
        if not over:
            break
        inside = placed.where(F.col("part").isin([p for p, _ in over]))
        more = _sampled(inside.select("key", "tie", "size", "part"), target / SAMPLES_PER_RANGE / 2 ** (turn + 1), seed + 1 + turn)
        by_part: dict[int, list[tuple[int, int]]] = {}
        for x in more:
            by_part.setdefault(bisect_right(bounds, x), []).append(x)
        new = {b for p, held in over for b in _boundaries(by_part.get(p, []), int(held / target) + 1)} - set(bounds)
        if not new:  # what is left can't be told apart by key and tie, or is single records
            break
        bounds = sorted({*bounds, *new})
    sums = staged(placed.groupBy("part").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_n")), "range-sums")
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    base = sums.select("part", F.coalesce(F.sum("_bytes").over(upto), F.lit(0)).alias("_b0"), F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_n0"))
    inside = Window.partitionBy("part").orderBy("key", "tie", "size").rowsBetween(Window.unboundedPreceding, -1)
    at = (placed.withColumn("_b", F.coalesce(F.sum("size").over(inside), F.lit(0))).withColumn("_n", F.count("*").over(inside))
          .join(base, "part").withColumn("_pos", F.col("_n0") + F.col("_n"))
          .withColumn("shard", F.floor((F.col("_b0") + F.col("_b")).cast("decimal(28,0)") * shards / F.lit(size).cast("decimal(19,0)")).cast("int")))
    at = staged(at.drop("_b", "_n", "_b0", "_n0", "part"), "placed")
    first = at.groupBy("shard").agg(F.min("_pos").alias("_first"))
    return at.join(F.broadcast(first), "shard").withColumn("slot", F.col("_pos") - F.col("_first")).drop("_pos", "_first")


def shard(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shards: int = SHARDS,
          range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law (``bytes``), shard, slot, grown_shard (null).

    The order is by a hash of the text and, within equal texts, of the id: equal texts are neighbours,
    and a group of copies larger than a range is subdivided like any other overfull range. Null texts
    have size 1 and the checksum of no bytes; null ids are kept; other columns are not read.
    """
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.xxhash64(t).alias("key"), F.xxhash64(F.col(f"`{id_col}`")).alias("tie"),
                       (F.octet_length(t) + 1).cast("long").alias("size"),
                       F.col(f"`{id_col}`").alias("doc_id"), F.crc32(t.cast("binary")).alias("text_crc32"))
    return split(staged(rows, "shard-rows"), shards, range_bytes).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
