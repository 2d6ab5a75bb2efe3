"""O-39..O-44: table maintenance as pure DataFrame operators.

* ``assign_ids`` / ``insert_if_new``: insert-if-new dimension rows with surrogate keys.
* ``dedupe_batch``: a key that appears twice in one batch raises (``"error"``) or keeps the latest.
* ``upsert``: keyed insert-or-update of chosen columns.
* ``replace_day``: delete one day, then append a batch.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark import StorageLevel

from strata.operators.relational import reduce_to_keys
from strata.session import ensure_checkpoint_dir, scratch_path

_LOW_BITS = 33  # monotonically_increasing_id: partition index in the high bits, row index in the low 33


# O-39: surrogate ids -------------------------------------------------------------------------------
def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage (persisted first so the
    plan is computed once, not once for the count and again for the write)."""
    ensure_checkpoint_dir(df.sparkSession)
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    fixed = kept.checkpoint(eager=True)
    kept.unpersist()
    return fixed


def materialize(df: DataFrame, name: str = "table", partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared scratch folder and read it back: one job, lineage
    cut, and the result has file statistics (size-based join planning), columnar pruning and, with
    ``partition_by``, partition pruning; rows are gathered by it first, else each task writes a file into each partition."""
    path = scratch_path(df.sparkSession, name)
    if partition_by:
        df.hint("rebalance", F.col(partition_by)).write.mode("overwrite").partitionBy(partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def assign_ids(keys: DataFrame, key_cols: list[str], id_col: str, base: int = 0,
               num_partitions: int | None = None) -> DataFrame:
    """Number distinct ``keys`` rows base+1, base+2, ... in natural-key order (NULLs first).

    No global window (that would plan ``Exchange SinglePartition`` over all keys). The keys are
    range-partitioned and sorted inside each partition, the position inside the partition is taken
    from ``monotonically_increasing_id`` and fixed by writing it out (so a lost executor cannot
    renumber rows), and each partition's offset comes from its row count (one number per partition,
    broadcast back: the bound is the partition count).
    """
    spark = keys.sparkSession
    order = [F.col(c).asc_nulls_first() for c in key_cols]
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(keys.repartitionByRange(n, *order).sortWithinPartitions(*order)
                         .withColumn("__mid", F.monotonically_increasing_id()), "ids")
    part = F.shiftright(F.col("__mid"), _LOW_BITS)
    local = F.col("__mid").bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
    counts = sorted((r["p"], r["c"]) for r in ranged.groupBy(part.alias("p")).agg(F.count("*").alias("c")).collect())
    offsets, running = [], 0
    for p, c in counts:
        offsets.append((int(p), running))
        running += int(c)
    off_df = F.broadcast(spark.createDataFrame(offsets, "p long, off long"))
    numbered = ranged.join(off_df, part == off_df["p"], "inner")
    new_id = F.lit(base).cast("long") + F.col("off") + local + F.lit(1)
    return numbered.select(new_id.cast("long").alias(id_col), *keys.columns)


def max_id(dim: DataFrame, id_col: str) -> int:
    """Largest id already given (0 for an empty dimension): a one-row aggregate."""
    v = dim.agg(F.max(id_col)).first()[0]
    return int(v or 0)


def insert_if_new(dim: DataFrame, candidates: DataFrame, natural_key: list[str], id_col: str,
                  null_safe: bool = True, existing: DataFrame | None = None,
                  reduce_existing: bool = False, base: int | None = None) -> DataFrame:
    """Rows to append to ``dim``: distinct candidates whose natural key is not in ``dim`` yet, each
    with a new id above the current maximum. Existing rows never change, so a rerun adds nothing.

    ``null_safe=True`` treats NULL key parts as equal to each other, so a key with NULL coordinates
    is stored once (the source database's UNIQUE would store it again on every run).

    ``existing`` may narrow the rows the candidates are matched against (e.g. to the days of the
    batch when the natural key is a timestamp); the new ids still start above ``dim``'s maximum.
    """
    # of several rows of one key the least: a retry gives the same row
    other = [c for c in candidates.columns if c not in natural_key]
    fresh = candidates.groupBy(*natural_key).agg(*[F.min(F.struct(*other)).alias("__o")]).select(
        *natural_key, "__o.*") if other else candidates.dropDuplicates(natural_key)
    existing = (dim if existing is None else existing).select(*natural_key)
    if reduce_existing:  # a small batch against a large dimension: filter it map-side, no shuffle
        existing = reduce_to_keys(existing, fresh, [(c, c, null_safe) for c in natural_key])
    if null_safe:
        cond = None
        for c in natural_key:
            e = fresh[c].eqNullSafe(existing[c])
            cond = e if cond is None else cond & e
        new_keys = fresh.join(existing, cond, "left_anti")
    else:
        new_keys = fresh.join(existing, natural_key, "left_anti")
    rows = new_keys.select(*natural_key, *other)
    out_cols = [id_col] + [c for c in dim.columns if c != id_col]
    start = max_id(dim, id_col) if base is None else base
    return assign_ids(rows, natural_key, id_col, base=start).select(*out_cols)


def with_new_rows(dim: DataFrame, new_rows: DataFrame) -> DataFrame:
    return dim.unionByName(new_rows)


# O-44: duplicate keys inside one batch ----------------------------------------------------------------
def assert_unique(df: DataFrame, key: list[str], what: str = "table") -> None:
    """Fail when a key value occurs twice or a key part is NULL. A grouped count: its partial
    aggregation collapses even a key holding a third of all rows map-side; at most one offending key
    reaches the driver.

    Run on an upsert's *output* (target keys unique and not NULL) it is equivalent to checking the
    batch: a repeated or NULL batch key always yields a repeated or NULL output key."""
    null_key = reduce(or_, [F.col(k).isNull() for k in key])
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    bad = per_key.where((F.col("__n") > 1) | null_key).limit(1).collect()
    if bad:
        row = bad[0]
        kind = "NULL key" if any(row[k] is None for k in key) else "duplicate key"
        raise ValueError(f"{kind} {key} in {what}: {[row[k] for k in key]} x{row['__n']}")


def assert_not_null(df: DataFrame, key: list[str], what: str = "table") -> None:
    """Fail when a key part is NULL (primary keys are NOT NULL)."""
    bad = df.where(reduce(or_, [F.col(k).isNull() for k in key])).select(*key).limit(1).collect()
    if bad:
        raise ValueError(f"NULL key {key} in {what}: {list(bad[0])}")


def bad_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """The key values a load refuses, with their row counts: repeated ones, and those with a NULL part."""
    null_key = reduce(or_, [F.col(k).isNull() for k in key])
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | null_key)


def merge_versions(batch: DataFrame, key: str, version: str, latest: list[str]) -> DataFrame:
    """One row per key of several versions, as upserting them one by one would leave it: the ``latest``
    columns from the last version, every other from the first. One map-side aggregate, no window."""
    first = [c for c in batch.columns if c not in (key, version, *latest)]
    one = batch.groupBy(key).agg(F.min_by(F.struct(*first), version).alias("__f"), F.max_by(F.struct(*latest), version).alias("__l"))
    return one.select(key, "__f.*", "__l.*").select(*[c for c in batch.columns if c != version])


def dedupe_batch(batch: DataFrame, key: list[str], on_duplicate: str = "error",
                 order_by: list[str] | None = None) -> DataFrame:
    """Make ``batch`` unique on ``key``.

    * ``"error"``: a key present twice fails the load (the database raises "cannot affect row a second
      time"); a NULL key fails too (primary keys are NOT NULL). Checked by a grouped count, whose
      partial aggregation collapses even a key holding a third of all rows before the shuffle; only
      one offending key (if any) reaches the driver.
    * ``"unchecked"``: no check here; the caller runs ``assert_unique`` on the materialised output.
    * ``"latest"``: keep, per key, the row with the greatest ``order_by`` (remaining columns break
      ties so the pick is deterministic); ``max_by`` aggregates map-side, so a hot key with many
      versions is pre-combined before the shuffle. A NULL key fails the load here too.
    """
    if on_duplicate == "error":
        assert_unique(batch, key, "upsert batch")
        return batch
    if on_duplicate == "unchecked":  # the caller checks the upsert's materialised output instead
        return batch
    if on_duplicate == "latest":
        if not order_by:
            raise ValueError("on_duplicate='latest' needs order_by")
        assert_not_null(batch, key, "upsert batch")
        rest = [c for c in batch.columns if c not in key and c not in order_by]
        rank = F.struct(*[F.col(c) for c in order_by + rest])
        row = F.struct(*[F.col(c) for c in batch.columns if c not in key])
        picked = batch.groupBy(*key).agg(F.max_by(row, rank).alias("__row"))
        return picked.select(*key, "__row.*").select(*batch.columns)
    raise ValueError(f"unknown on_duplicate: {on_duplicate}")


# O-41 / O-42: keyed upsert ------------------------------------------------------------------------------
def upsert(target: DataFrame, batch: DataFrame, key: list[str], update_cols: list[str] | None = None,
           insert_defaults: dict[str, Column] | None = None, touch: dict[str, Column] | None = None,
           on_duplicate: str = "error", order_by: list[str] | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO UPDATE SET <update_cols> = EXCLUDED.<col>``.

    * a batch key not in ``target``: the batch row is inserted (columns missing from the batch get
      ``insert_defaults`` or NULL; ``touch`` columns get their expression);
    * a key in both: only ``update_cols`` (default: all batch columns) take the batch value, and
      ``touch`` columns are re-stamped; every other column keeps the target value;
    * a target key not in the batch: unchanged.
    There is no newer-wins test: the batch always wins for the update columns.
    One full outer join on the key (a hash shuffle of both sides on the key; keys are unique per side).
    """
    insert_defaults = insert_defaults or {}
    touch = touch or {}
    b = dedupe_batch(batch, key, on_duplicate, order_by)
    cols = target.columns
    upd = set(update_cols if update_cols is not None else [c for c in b.columns if c not in key])
    t = target.withColumn("__in_t", F.lit(True))
    s = b.withColumn("__in_s", F.lit(True))
    j = t.join(s, on=key, how="full_outer")
    in_t, in_s = F.col("__in_t").isNotNull(), F.col("__in_s").isNotNull()
    out = []
    dtypes = {f.name: f.dataType for f in target.schema.fields}
    for c in cols:
        if c in key:
            out.append(F.col(c))
            continue
        tv = t[c]
        if c in touch:
            val = F.when(in_s, touch[c]).otherwise(tv)
        else:
            sv = s[c] if c in b.columns else insert_defaults.get(c, F.lit(None))
            inserted = F.when(~in_t, sv)
            if c in upd and c in b.columns:
                val = F.when(in_s, sv).otherwise(tv)
            else:
                val = F.when(in_t, tv).otherwise(inserted)
        out.append(val.cast(dtypes[c]).alias(c))
    return j.select(*out)


# O-43: delete a day, then append ------------------------------------------------------------------------
def replace_day(target: DataFrame, batch: DataFrame, day_of: Column, day: dt.date | str,
                id_col: str = "id", checked: bool = False) -> DataFrame:
    """Rows of ``target`` dated ``day`` are replaced by *all* rows of ``batch`` (whatever their date).

    ``day_of`` is the row's date expression (rows whose date is NULL are never deleted). A batch with
    no non-NULL ``id_col`` changes nothing: the day is skipped and the old rows stay (``checked``:
    the caller has already established that the batch is not empty).
    """
    if not checked and batch.where(F.col(id_col).isNotNull()).limit(1).count() == 0:
        return target
    d = F.lit(str(day)).cast("date")
    kept = target.where(~F.coalesce(day_of == d, F.lit(False)))
    return kept.unionByName(batch)


def replace_days(target: DataFrame, batch: DataFrame, day_of: Column, file_day: Column, days: list) -> DataFrame:
    """``replace_day`` for several day files at once, equal to running them one by one in day order.

    ``batch`` holds the rows of every file, ``file_day`` names the file a row came from and ``days``
    the files that are not empty (an empty file is skipped, so its day is not deleted). Sequentially,
    a row appended by file f survives unless a *later* file deletes its date; so the result is the
    target without rows dated in ``days``, plus each file row unless its date is in ``days`` and
    after its file's day.
    """
    ds = [F.lit(str(d)).cast("date") for d in days]
    if not ds:
        return target
    in_days = F.coalesce(day_of.isin(ds), F.lit(False))
    kept = target.where(~in_days)
    from_files = batch.where(file_day.isin(ds)).where(~(in_days & F.coalesce(day_of > file_day, F.lit(False))))
    return kept.unionByName(from_files.select(*target.columns))
