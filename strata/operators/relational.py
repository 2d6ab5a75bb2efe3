"""O-23..O-38c: generic DataFrame operators (filters, lookups, windows, top-k, set operations)."""

from __future__ import annotations

import datetime as dt
import weakref
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import hundredths_to_decimal, round_half_away_div, to_day

DateLike = dt.date | str | None


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _date(d: DateLike) -> Column:
    return F.lit(str(d)).cast("date")


# broadcast behind a proven bound ------------------------------------------------------------------
BROADCAST_MAX_BYTES = 8 * 1024 * 1024
_verdicts: "weakref.WeakKeyDictionary[DataFrame, bool]" = weakref.WeakKeyDictionary()


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df`` (file sizes for scans; no job is run)."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size if isinstance(size, int) else size.toString())


def is_small(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether ``df`` is proven small: by the optimizer's estimate when that is below ``max_bytes``,
    else by counting at most max_rows + 1 rows. The verdict is remembered for this DataFrame object."""
    if df in _verdicts:
        return _verdicts[df]
    small = estimated_bytes(df) <= max_bytes or df.limit(max_rows + 1).count() <= max_rows
    _verdicts[df] = small
    return small


def checked_broadcast(df: DataFrame, max_rows: int, cols: list[str] | None = None) -> DataFrame:
    """Broadcast ``df`` (projected to ``cols``) only if it is proven small (``is_small``); otherwise
    return it unchanged so the planner shuffles (sort-merge) instead."""
    out = df.select(*cols) if cols else df
    return F.broadcast(out) if is_small(df, max_rows) else out


# input spreading --------------------------------------------------------------------------------------
def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over the cluster when its scan yields fewer partitions than there are task
    slots (a few unsplittable files, e.g. one multi-line CSV per day); otherwise leave it alone, so a
    scan of many files pays no shuffle."""
    spark = df.sparkSession
    want = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)


#: Rows of a scan that one task may hold; a scan with more in a task is dealt anew by ``spread_rows``.
TASK_ROWS = 250_000


def spread_rows(df: DataFrame, key: str, min_partitions: int | None = None) -> DataFrame:
    """Deal a Parquet scan anew by ranges of its ``key`` (different in nearly every row) when its splits don't share
    the rows out: a row group can't be split, so a file of few large ones leaves most splits empty, however many there
    are. Rows per split come from the row groups' counts; a scan that is even as it lies pays no shuffle."""
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    per = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]  # a number per split
    if not per or (max(per) <= TASK_ROWS and 2 * max(per) * want <= 3 * sum(per)):
        return df
    return df.repartitionByRange(max(want, -(-sum(per) // TASK_ROWS)), key)


# O-23 / O-24 --------------------------------------------------------------------------------------
def on_day(df: DataFrame, ts: Column | str, day: dt.date | str) -> DataFrame:
    """``WHERE CAST(ts AS DATE) = day``; Catalyst turns the cast-equality into a range the Parquet
    scan can skip row groups with."""
    return df.where(to_day(ts) == _date(day))


def in_days(df: DataFrame, ts: Column | str, days: list) -> DataFrame:
    return df.where(to_day(ts).isin([_date(d) for d in days]))


def date_range_filter(day_col: Column | str, date_from: DateLike = None, date_to: DateLike = None) -> Column:
    """Closed range on a date; each bound is optional (an absent bound adds no predicate)."""
    cond = F.lit(True)
    d = _c(day_col)
    if date_from is not None:
        cond = cond & (d >= _date(date_from))
    if date_to is not None:
        cond = cond & (d <= _date(date_to))
    return cond


def date_range(df: DataFrame, ts: Column | str, date_from: DateLike = None, date_to: DateLike = None) -> DataFrame:
    if date_from is None and date_to is None:
        return df
    return df.where(date_range_filter(to_day(ts), date_from, date_to))


# O-25 / O-26 --------------------------------------------------------------------------------------
def any_null(cols: list[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in cols])


def at_least(df: DataFrame, col: str, threshold) -> DataFrame:
    return df.where(F.col(col) >= F.lit(threshold))


# semi-join reduction -----------------------------------------------------------------------------
KEY_BROADCAST_MAX_ROWS = 200_000


def _key_cond(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str, bool]]) -> Column:
    conds = [left[a].eqNullSafe(right[b]) if ns else left[a] == right[b] for a, b, ns in pairs]
    return reduce(lambda x, y: x & y, conds)


def reduce_to_keys(big: DataFrame, keys: DataFrame, pairs: list[tuple[str, str, bool]],
                   max_rows: int = KEY_BROADCAST_MAX_ROWS) -> DataFrame:
    """Rows of ``big`` whose key occurs in ``keys`` — as a broadcast left-semi join when the distinct
    keys are proven small, so ``big`` is filtered map-side and never shuffled; otherwise, and where ``big`` is no larger
    than a large batch, ``big`` unchanged (the join after it then shuffles both sides). ``pairs``: (big col, keys col, null_safe)."""
    distinct_keys = keys.select(*[b for _, b, _ in pairs]).distinct()
    if BROADCAST_MAX_BYTES < estimated_bytes(distinct_keys) >= estimated_bytes(big):
        return big  # no larger than the batch itself: not worth counting the batch's keys
    if not is_small(distinct_keys, max_rows):
        return big
    k = F.broadcast(distinct_keys.select(*[F.col(b).alias(f"__rk{i}") for i, (_, b, _) in enumerate(pairs)]))
    cond = _key_cond(big, k, [(a, f"__rk{i}", ns) for i, (a, _, ns) in enumerate(pairs)])
    return big.join(k, cond, "left_semi")


# O-29 / O-30: left lookup of a surrogate key on a (normalised) natural key ---------------------------
def lookup(df: DataFrame, dim: DataFrame, on: list[tuple[Column, str, bool]], id_col: str,
           broadcast_max_rows: int | None = None, reduce_dim: bool = False,
           probe_from: DataFrame | None = None) -> DataFrame:
    """Left join ``dim`` and add its ``id_col``; unmatched rows keep a NULL key.

    ``on`` holds (expression over df, dim column, null_safe). A null-safe pair stays an equi-join key
    (Catalyst rewrites ``<=>`` to coalesce/isnull keys), so the join is hash/sort-merge, never a
    nested loop. Small dimensions are broadcast only behind a row-count check. ``reduce_dim`` first
    cuts a large dimension down to the keys of ``df`` (``reduce_to_keys``), for a small batch
    against a dimension that grows with the events; its keys are taken from ``probe_from`` (default
    ``df``), which should be the cheapest frame holding the key columns.
    """
    right_cols = [c for _, c, _ in on]
    if reduce_dim:
        src = df if probe_from is None else probe_from
        probe = src.select(*[expr.alias(f"__p{i}") for i, (expr, _, _) in enumerate(on)])
        dim = reduce_to_keys(dim, probe, [(c, f"__p{i}", ns) for i, (_, c, ns) in enumerate(on)])
    d = dim.select(F.col(id_col), *[F.col(c).alias(f"__k{i}") for i, c in enumerate(right_cols)])
    if broadcast_max_rows is not None and is_small(dim, broadcast_max_rows):
        d = F.broadcast(d)
    left = df
    conds = []
    for i, (expr, _, null_safe) in enumerate(on):
        left = left.withColumn(f"__l{i}", expr)
        lc, rc = F.col(f"__l{i}"), d[f"__k{i}"]
        conds.append(lc.eqNullSafe(rc) if null_safe else lc == rc)
    joined = left.join(d, reduce(lambda a, b: a & b, conds), "left")
    return joined.drop(*[f"__l{i}" for i in range(len(on))], *[f"__k{i}" for i in range(len(on))])


# O-37: moving average over the last N rows -----------------------------------------------------------
def moving_average_rows(df: DataFrame, order_col: str, value_col: str, rows: int, out: str) -> DataFrame:
    """``ROUND(AVG(v) OVER (ORDER BY o ROWS BETWEEN rows-1 PRECEDING AND CURRENT ROW), 2)``, exact.

    The frame is ordered over the whole (already aggregated) input, so it runs in one partition:
    call it on a per-day series (one row per day), never on raw events.
    """
    w = Window.orderBy(order_col).rowsBetween(-(rows - 1), 0)
    s = F.sum(F.col(value_col).cast("long")).over(w)
    n = F.count(F.col(value_col)).over(w)
    return df.withColumn(out, hundredths_to_decimal(round_half_away_div(s * 100, n)))


# O-21 exact average as a two-step aggregate ---------------------------------------------------------
def exact_avg_parts(x: Column | str, scale: int, name: str) -> list[Column]:
    """Aggregate columns (sum of unscaled integers, non-null count) for ``finish_exact_avg``."""
    v = _c(x)
    return [F.sum((v * F.lit(10 ** scale)).cast("long")).alias(f"__{name}_s"),
            F.count(v).alias(f"__{name}_n")]


def finish_exact_avg(df: DataFrame, name: str, scale: int, digits: int = 2) -> DataFrame:
    """``ROUND(AVG(x), digits)`` half away from zero, exactly, as decimal(18,digits)."""
    s, n = F.col(f"__{name}_s"), F.col(f"__{name}_n")
    if scale >= digits:
        h = round_half_away_div(s, n * F.lit(10 ** (scale - digits)))
    else:
        h = round_half_away_div(s * F.lit(10 ** (digits - scale)), n)
    if digits != 2:
        raise ValueError("only 2 digits are used by the reports")
    return df.withColumn(name, hundredths_to_decimal(h)).drop(f"__{name}_s", f"__{name}_n")


# O-38: top-k ----------------------------------------------------------------------------------------
def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """``ORDER BY ... LIMIT k`` — planned as TakeOrderedAndProject: each partition keeps k rows, so
    no task ever holds more than k rows per partition. Add a unique tie-breaker to ``order``."""
    return df.orderBy(*order).limit(k)


# O-38b / O-38c --------------------------------------------------------------------------------------
def labelled_union(parts: list[tuple[str, DataFrame]], label_col: str) -> DataFrame:
    """``SELECT 'a' AS label, ... UNION ALL SELECT 'b', ...``."""
    frames = [df.select(F.lit(label).alias(label_col), *df.columns) for label, df in parts]
    return reduce(DataFrame.unionByName, frames)


def side_by_side(*one_row_frames: DataFrame) -> DataFrame:
    """Put one-row aggregates next to each other in one row (scalar subqueries in one SELECT).

    Each frame is widened to all columns with NULLs and the union is folded by a global aggregate,
    so no join (and no cross product) is planned.
    """
    fields = [f for df in one_row_frames for f in df.schema.fields]
    names = [f.name for f in fields]
    if len(set(names)) != len(names):
        raise ValueError("column names must differ")
    wide = [df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
                        for f in fields]) for df in one_row_frames]
    return reduce(DataFrame.unionByName, wide).agg(*[F.max(n).alias(n) for n in names])
