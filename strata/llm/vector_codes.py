"""Vector codes: each vector is cut into parts, and each part is replaced by the index of its codebook's nearest entry.

Codebooks move for a few rounds, so most parts are assigned several times over. Drake and Hamerly's adaptive bounds save
most of that work. The table that is written between rounds holds, for each part, its entry, its ``b`` next closest
entries with a lower bound of the distance to each, in ascending order, and one outer bound for all others. When
the entries have moved, each bound shrinks by the way its entry went, the outer one by the longest way. The
distance to a part's own entry is computed anew, in integers; only entries whose bound isn't beyond it can be
nearer, and only these are looked at, again in integers. If the outer bound isn't beyond it either, all are. ``b``
follows what a round needed: it becomes the least length that would have answered all but ``SPILL`` of the parts.
Bounds are 16-bit floats rounded down, so they stay bounds; every decision is made by exact integers.

Rows aren't shuffled, but for the errors by label: each pass streams over a table, and what a round gathers is a sum
per part, entry and task.
"""

from __future__ import annotations

import hashlib
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import staged

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LEAST_B, SPILL = 2, 0.01
_SLACK = 1e-9  # of a distance: far beyond the rounding of a square root and a difference

RESULT = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"


def limit_of(dim: int) -> int:
    """The greatest size of a component: beyond it a vector's squared distance might not fit a long."""
    return min(1 << 27, isqrt((1 << 60) // max(1, dim)) // 2)


def _edges(dim: int, parts: int) -> list[int]:
    return [dim * i // parts for i in range(parts + 1)]


def _integers(column: pa.Array, dim: int) -> np.ndarray:
    """floor(256 * x) of vectors without nulls, one row each."""
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    top = float(limit_of(dim))
    return np.floor(np.clip(flat * SCALE, -top, top)).astype(np.int64).reshape(len(column), dim)


# -- one part of many vectors -------------------------------------------------------------------------

def _to_all(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances to all entries."""
    out = np.zeros((len(x), len(entries)), np.int64)
    for j in range(x.shape[1]):
        d = x[:, j, None] - entries[None, :, j]
        out += d * d
    return out


def _to_some(x: np.ndarray, entries: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Squared distances to the entries that ``which`` names, a row of them per vector."""
    d = x[:, None, :] - entries[which]
    return (d * d).sum(-1)


def _down(values: np.ndarray, unit: float) -> np.ndarray:
    """Bounds as 16-bit floats in ``unit``, never above what they were."""
    v = np.maximum(values / unit * (1 - _SLACK), 0.0)
    h = np.minimum(v, 60_000.0).astype(np.float16)
    return np.where(h > v, np.nextafter(h, np.float16(-1)), h).astype(np.float16).clip(min=np.float16(0))


class Nearest:
    """What is known of one part of some vectors: its entry (and squared distance), the next entries with their lower
    bounds, ascending, the outer bound, and how many bounds it took to tell."""

    def __init__(self, own, d2, near, low, outer, rank):
        self.own, self.d2, self.near, self.low, self.outer, self.rank = own, d2, near, low, outer, rank


def scan(x: np.ndarray, entries: np.ndarray, b: int) -> Nearest:
    """Without bounds: all entries are looked at."""
    d2 = _to_all(x, entries)
    own = d2.argmin(1)  # the first of equals
    best = np.take_along_axis(d2, own[:, None], 1)[:, 0]
    b = min(b, len(entries) - 1)
    d2[np.arange(len(x)), own] = np.iinfo(np.int64).max
    order = np.argsort(d2, axis=1)[:, :b + 1]
    dist = np.sqrt(np.take_along_axis(d2, order, 1).astype(np.float64))
    outer = dist[:, b] if b < len(entries) - 1 else np.full(len(x), np.inf)
    return Nearest(own, best, order[:, :b], dist[:, :b], outer, np.full(len(x), b + 1))


def settle(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, own: np.ndarray, near: np.ndarray, low: np.ndarray,
           outer: np.ndarray, b: int) -> Nearest:
    """The nearest entries after they moved by ``moved``, from bounds of before; lists of ``b``."""
    n, had = near.shape
    b = min(b, had)
    d2 = _to_some(x, entries, own[:, None])[:, 0]
    reach = np.sqrt(d2.astype(np.float64)) * (1 + _SLACK) + _SLACK
    out = np.maximum(outer - moved.max(initial=0.0) * (1 + _SLACK), 0.0)
    low = np.maximum(low - moved[near] * (1 + _SLACK), 0.0)
    low = np.minimum.accumulate(np.concatenate([low, out[:, None]], axis=1)[:, ::-1], axis=1)[:, ::-1][:, :had]  # ascending
    rank = (low <= reach[:, None]).sum(1)
    beyond = out <= reach
    own, near, low, out = own.copy(), near.copy(), low.copy(), out.copy()
    some = np.flatnonzero((rank > 0) & ~beyond)
    if len(some):
        most = int(rank[some].max())
        which = near[some, :most]
        exact = _to_some(x[some], entries, which)
        asked = np.arange(most)[None, :] < rank[some][:, None]
        low[some, :most] = np.where(asked, np.sqrt(exact.astype(np.float64)), low[some, :most])
        top = np.iinfo(np.int64).max
        best = np.where(asked, exact, top).min(1)
        first = np.where(asked & (exact == best[:, None]), which, len(entries)).min(1)
        new = (best < d2[some]) | ((best == d2[some]) & (first < own[some]))
        at = some[new]
        slot = (near[at] == first[new][:, None]).argmax(1)
        near[at, slot], low[at, slot] = own[at], np.sqrt(d2[at].astype(np.float64))
        own[at], d2[at] = first[new], best[new]
        order = np.argsort(low[some], axis=1, kind="stable")
        near[some], low[some] = np.take_along_axis(near[some], order, 1), np.take_along_axis(low[some], order, 1)
    if b < had:
        out = np.minimum(out, low[:, b])
        near, low = near[:, :b], low[:, :b]
    all_ = np.flatnonzero(beyond)
    if len(all_):
        fresh = scan(x[all_], entries, b)
        near, low = np.ascontiguousarray(near), np.ascontiguousarray(low)
        own[all_], d2[all_], near[all_], low[all_], out[all_] = fresh.own, fresh.d2, fresh.near, fresh.low, fresh.outer
    return Nearest(own, d2, near, low, out, np.where(beyond, had + 1, rank))


# -- passes over the table ----------------------------------------------------------------------------

class _Plan:
    """What all passes share: the cut of a vector, how its integers and bounds are stored."""

    def __init__(self, dim: int, parts: int, peak: int):
        self.dim, self.parts, self.edges = dim, parts, _edges(dim, parts)
        self.store = np.dtype("<i2" if peak < 1 << 15 else "<i4")
        reach = 2.0 * (peak + 1) * max(1.0, float(dim)) ** 0.5
        self.unit = 2.0 ** max(0, int(np.ceil(np.log2(max(1.0, reach / 60_000.0)))))

    def cut(self, x: np.ndarray) -> list[np.ndarray]:
        return [x[:, a:b] for a, b in zip(self.edges, self.edges[1:])]


_STATE = "vec_id long, label {label}, x binary, own binary, near binary, low binary, outer binary, rank binary"


def _rows(raw: np.ndarray) -> pa.Array:
    """A binary value per row of a contiguous array."""
    raw = np.ascontiguousarray(raw)
    size = raw.nbytes // max(1, len(raw))
    return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer((np.arange(len(raw) + 1) * size).astype(np.int32)), pa.py_buffer(raw)])


def _read(column: pa.Array, dtype, shape: tuple) -> np.ndarray:
    return np.frombuffer(b"".join(column.cast(pa.binary()).to_pylist()), dtype=dtype).reshape(len(column), *shape)


def _written(plan: _Plan, batch: pa.RecordBatch, x: np.ndarray, found: list[Nearest], names: list[str]) -> pa.RecordBatch:
    stack = lambda f: np.stack([f(p) for p in found], axis=1)
    return pa.RecordBatch.from_arrays([
        batch.column(0), batch.column(1), _rows(x.astype(plan.store)), _rows(stack(lambda p: p.own).astype(np.uint8)),
        _rows(stack(lambda p: p.near).astype(np.uint8)), _rows(stack(lambda p: _down(p.low, plan.unit))),
        _rows(stack(lambda p: _down(p.outer, plan.unit))), _rows(stack(lambda p: p.rank).astype(np.uint8))], names=names)


def _results(batch: pa.RecordBatch, found: list[Nearest]) -> pa.RecordBatch:
    own = np.ascontiguousarray(np.stack([p.own for p in found], axis=1).astype(np.uint8))
    codes = [row.tobytes().hex() for row in own]
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.string()),
                                       pa.array(sum(p.d2 for p in found), pa.int64())], names=["vec_id", "label", "code", "error"])


def _first(plan: _Plan, books: list[np.ndarray], b: int, names: list[str] | None):
    """Vectors to states, or without ``names`` to results."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = _integers(batch.column(2), plan.dim)
                found = [scan(p, c, b) for p, c in zip(plan.cut(x), books)]
                yield _written(plan, batch, x, found, names) if names else _results(batch, found)

    return run


def _next(plan: _Plan, books: list[np.ndarray], moved: list[np.ndarray], had: int, b: int, names: list[str] | None):
    """States to states, or without ``names`` to results."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _read(batch.column(2), plan.store, (plan.dim,)).astype(np.int64)
            own = _read(batch.column(3), np.uint8, (plan.parts,)).astype(np.int64)
            near = _read(batch.column(4), np.uint8, (plan.parts, had)).astype(np.int64)
            low = _read(batch.column(5), np.float16, (plan.parts, had)).astype(np.float64) * plan.unit
            outer = _read(batch.column(6), np.float16, (plan.parts,)).astype(np.float64) * plan.unit
            found = [settle(p, books[i], moved[i], own[:, i], near[:, i], low[:, i], outer[:, i], b) for i, p in enumerate(plan.cut(x))]
            yield _written(plan, batch, x, found, names) if names else _results(batch, found)

    return run


def _sums(plan: _Plan, entries: int):
    """Per part and entry: the count and the componentwise sum; per part and rank: how many parts needed it (entry -1 -
    rank). A row of each a task at most, so what meets in the driver is bounded by the codebooks' size."""
    def run(batches):
        count = np.zeros((plan.parts, entries), np.int64)
        total = [np.zeros((entries, b - a), np.int64) for a, b in zip(plan.edges, plan.edges[1:])]
        ranks = np.zeros((plan.parts, 256), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _read(batch.column(0), plan.store, (plan.dim,)).astype(np.int64)
            own, rank = (_read(batch.column(i), np.uint8, (plan.parts,)) for i in (1, 2))
            for i, p in enumerate(plan.cut(x)):
                count[i] += np.bincount(own[:, i], minlength=entries)
                ranks[i] += np.bincount(rank[:, i], minlength=256)
                np.add.at(total[i], own[:, i], p)
        rows = [(i, k, int(count[i, k]), total[i][k].tolist()) for i in range(plan.parts) for k in np.flatnonzero(count[i]).tolist()]
        rows += [(i, -1 - r, int(ranks[i, r]), []) for i in range(plan.parts) for r in np.flatnonzero(ranks[i]).tolist()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())))],
                                             names=["part", "entry", "n", "total"])

    return run


def _moved_books(plan: _Plan, state: DataFrame, books: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The codebooks of the parts' means, rounded down, and how many parts needed each rank."""
    some = state.select("x", "own", "rank").mapInArrow(_sums(plan, len(books[0])), "part int, entry int, n long, total array<long>")
    n = F.sum("n").alias("n")
    flat = some.select("part", "entry", "n", F.posexplode_outer("total").alias("at", "value"))
    got = flat.groupBy("part", "entry", "at").agg(n, F.sum(F.col("value").cast("decimal(38,0)")).alias("total")).collect()
    new, ranks = [c.copy() for c in books], np.zeros(256, np.int64)
    for r in got:
        if r["entry"] < 0:
            ranks[-1 - r["entry"]] += r["n"]
        elif r["at"] is not None:
            new[r["part"]][r["entry"], r["at"]] = int(r["total"]) // r["n"]
    return new, ranks


def _adapted(ranks: np.ndarray, had: int) -> int:
    """The least length of lists that would have been enough for all but ``SPILL`` of the parts."""
    upto = np.cumsum(ranks)
    return max(LEAST_B, min(had, int(np.searchsorted(upto, upto[-1] * (1 - SPILL)))))


# -- the operator -------------------------------------------------------------------------------------

def kept_vectors(rows: DataFrame, id_col: str, vector: str, label: str) -> tuple[DataFrame, int, int]:
    """(vec_id, label, vector) without null, empty and non-finite vectors, all of one dimension; that dimension
    (that of most vectors, the least of equals), and the greatest size of a component."""
    flat = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("vector"))
    big = F.lit(float("inf"))
    fine = F.col("vector").isNotNull() & (F.size("vector") > 0) & F.forall(
        "vector", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v.cast("double")) < big), F.lit(False)))
    good = flat.where(fine)
    peak = F.max(F.aggregate("vector", F.lit(0.0), lambda a, v: F.greatest(a, F.abs(v.cast("double")))))
    sizes = good.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n"), peak.alias("peak")).orderBy(F.desc("n"), "dim").limit(1).collect()
    if not sizes:
        return good, 0, 0
    dim = sizes[0]["dim"]
    return good.where(F.size("vector") == dim), dim, int(min(float(limit_of(dim)), sizes[0]["peak"] * SCALE + 1))


def _least(good: DataFrame, dim: int, entries: int) -> np.ndarray:
    """The integers of the ``entries`` smallest ids, ascending (a null id behind all others); of rows that share an id,
    the least vector. A task names as many at most."""
    def run(batches):
        held: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _integers(batch.column(1), dim)
            for i, vec in enumerate(batch.column(0).to_pylist()):
                key, row = (vec is None, vec or 0), None
                if key in held or len(held) < entries or key < max(held):
                    row = x[i].tolist()
                    held[key] = min(held.get(key, row), row)
                    if len(held) > entries:
                        del held[max(held)]
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in held]), pa.array([k[1] for k in held], pa.int64()),
                                              pa.array(list(held.values()), pa.list_(pa.int64()))], names=["nameless", "vec_id", "x"])

    some = good.select("vec_id", "vector").mapInArrow(run, "nameless boolean, vec_id long, x array<long>")
    got = some.groupBy("nameless", "vec_id").agg(F.min("x").alias("x")).orderBy("nameless", "vec_id").limit(entries).collect()
    return np.array([r["x"] for r in got], np.int64).reshape(len(got), dim)


def encode(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
           entries: int = ENTRIES, rounds: int = ROUNDS, b: int | None = None) -> DataFrame:
    """One row per kept vector: vec_id, code, error, label_error, codebooks_sha256.

    Null vectors, empty ones, and those with null or non-finite components are dropped, and so are those whose length
    isn't that of most. A length that ``parts`` doesn't divide is cut at ``length * i // parts``. Components beyond what
    squares in a long allow (``limit_of``) are taken as that limit. Repeated rows keep their rows; codebooks start from
    different ids, of rows that share one from its least vector; a null id stands behind all others. Null labels are
    one label. Other columns are not read. An empty table gives an empty result. ``b``: length of the first lists, an
    eighth of the entries unless given; it only changes the work, never a result.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry's index has two hex digits: 1 to 256 entries")
    spark = rows.sparkSession
    good, dim, peak = kept_vectors(rows, id_col, vector, label)
    if not dim:
        return spark.createDataFrame([], RESULT)
    plan = _Plan(dim, parts, peak)
    start = _least(good, dim, entries)
    books = [np.ascontiguousarray(c) for c in plan.cut(start)]
    had = max(0, min(b if b is not None else max(LEAST_B, entries // 8), len(start) - 1, 254))
    kind = good.schema["label"].dataType.simpleString()
    schema = _STATE.format(label=kind)
    names = [c.split()[0] for c in schema.split(", ")]
    final = f"vec_id long, label {kind}, code string, error long"
    state, moved = None, None
    for _ in range(rounds):
        if state is None:
            state = staged(good.mapInArrow(_first(plan, books, had, names), schema), "vector-states")
        else:
            state = staged(state.mapInArrow(_next(plan, books, moved, had, b_next, names), schema), "vector-states")
            had = b_next
        new, ranks = _moved_books(plan, state, books)
        b_next = had if moved is None else _adapted(ranks, had)  # the first pass has looked at all entries
        moved = [np.sqrt(((n - c) ** 2).sum(1).astype(np.float64)) for n, c in zip(new, books)]
        books = new
    last = _first(plan, books, had, None) if state is None else _next(plan, books, moved, had, b_next, None)
    out = staged((good if state is None else state).mapInArrow(last, final), "vector-codes")
    digest = hashlib.sha256(",".join(str(v) for c in books for v in c.ravel().tolist()).encode()).hexdigest()
    sums = staged(out.groupBy(F.col("label").alias("l_label")).agg(F.try_sum("error").alias("label_error")), "label-errors")
    return out.join(sums, F.col("label").eqNullSafe(F.col("l_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def encode_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same in DuckDB SQL, over whole tables of one dimension that ``parts`` divides, with different ids."""
    def nearest(i: int) -> str:
        # ties go to the lower index: the least (distance, index)
        return f"""a{i} AS (
  SELECT v.vec_id, v.label, v.part, v.x,
         min((list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, b.entry)) AS best
  FROM pieces v JOIN b{i} b USING (part) GROUP BY ALL)"""

    def moved(i: int) -> str:
        return f"""m{i} AS (
  SELECT part, entry, list(c ORDER BY pos) AS x FROM (
    SELECT part, best[2] AS entry, pos, ((sum(x[pos]) - ((sum(x[pos]) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS c
    FROM a{i - 1}, range(1, len(x) + 1) r(pos) GROUP BY ALL)
  GROUP BY ALL),
b{i} AS (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM b{i - 1} b LEFT JOIN m{i} m USING (part, entry))"""

    steps = [nearest(0)]
    for i in range(1, rounds + 1):
        steps += [moved(i), nearest(i)]
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda v: floor(v::DOUBLE * {SCALE})::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
pieces AS (
  SELECT vec_id, label, part, x[part * len(x) // {parts} + 1 : (part + 1) * len(x) // {parts}] AS x
  FROM kept, range({parts}) r(part)),
firsts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {entries}),
b0 AS (SELECT part, entry, x FROM pieces JOIN firsts USING (vec_id)),
{(", " + chr(10)).join(steps)},
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, sum(best[1])::BIGINT AS error
  FROM a{rounds} GROUP BY ALL),
digest AS (SELECT sha256(string_agg(c, ',' ORDER BY part, entry)) AS d FROM (SELECT part, entry, array_to_string(x, ',') AS c FROM b{rounds}))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, d AS codebooks_sha256 FROM coded, digest
"""
