"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``d`` bits have a value between them that lies within
``ceil(d / 2)`` of either: every fingerprint emits all such variants, and fingerprints that meet in a
variant are candidates. The whole ball of half the radius holds 2,081 variants at 64 bits and
``d = 4``, 33 KB per fingerprint, which outgrows the documents themselves. So the ball is taken on
projections: the 64 bits fall into ``blocks`` blocks, and leaving out the block with the most
differences leaves at most ``d - ceil(d / blocks)`` of them. With three blocks, radius 2 is left, its
half is 1, and a fingerprint emits 131 variants over keys of 42 or 43 bits. A shared key no longer
proves the distance, so every pair is verified. A key that more than ``bucket_cap`` different
fingerprints share (thousands of near copies) is not compared pair by pair: its members go through
the whole ball, where all members of a bucket *are* within ``d`` and a star of links to its first
member loses no connection. Both ways are exact; ``blocks=1`` sends everything through the whole ball.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import staged, utf8
from strata.llm.components import connected

BITS = 64
SHINGLE, MAX_BITS, SEED = 4, 4, 42
_VOTES = 1 << 15  # shingles voted at once


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned fingerprint of one text (UTF-8); 0 without a word."""
    words = text.lower().split()  # on bytes: ASCII letters, and blank or \x09-\x0D only
    n = len(words)
    if not n:
        return 0
    digest = xxhash.xxh64_intdigest
    if n <= shingle:
        return digest(b" ".join(words), seed)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, n) - 1).tolist()
    ends = (ends - 1).tolist()
    h = np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1:])], dtype="<u8")
    votes = np.zeros(BITS, np.int64)
    for i in range(0, len(h), _VOTES):
        part = h[i:i + _VOTES]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
                 shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``keep`` columns of every row and its ``fp`` (the fingerprint's 64 bits as a signed long)."""
    keep = keep or []
    cols = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("_text"))

    def run(batches):
        for batch in batches:
            out = np.fromiter((fingerprint(x, shingle, seed) for x in utf8(batch.column(len(keep)))), np.uint64,
                              batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [pa.array(out.view(np.int64))],
                                             names=[*keep, "fp"])

    return cols.mapInArrow(run, cols.drop("_text").withColumn("fp", F.lit(0).cast("long")).schema)


def _flips(bits: list[int], radius: int) -> np.ndarray:
    """XOR masks of all changes of up to ``radius`` of the given bits, fewest changes first."""
    masks = [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(bits, r)]
    return np.array(masks, dtype=np.uint64)


def projections(blocks: int, max_bits: int) -> tuple[list[tuple[int, np.ndarray]], int]:
    """[(mask of the kept bits, flips)] and the distance that the kept bits may have."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    left = max_bits - ceil(max_bits / blocks) if blocks > 1 else max_bits
    out = []
    for i in range(blocks):
        kept = [b for b in range(BITS) if blocks == 1 or not edges[i] <= b < edges[i + 1]]
        out.append((sum(1 << b for b in kept), _flips(kept, ceil(left / 2))))
    return out, left


def _ball(fps: DataFrame, kept: list[tuple[int, np.ndarray]], left: int) -> DataFrame:
    """(key, wide, fp): the variants of each fingerprint; ``wide`` marks those beyond ``left // 2`` changes,
    of which an odd distance needs only one side of a pair."""
    def run(batches):
        for batch in batches:
            fp = np.asarray(batch.column(0)).view(np.uint64)
            for i in range(0, len(fp), 1024):
                part = fp[i:i + 1024]
                for mask, flips in kept:
                    keys = ((part & np.uint64(mask))[:, None] ^ flips[None, :]).ravel()
                    wide = np.tile(np.bitwise_count(flips) > left // 2, len(part))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.view(np.int64)), pa.array(wide), pa.array(np.repeat(part, len(flips)).view(np.int64))],
                        names=["key", "wide", "fp"])

    return fps.select("fp").mapInArrow(run, "key long, wide boolean, fp long")


def _unsigned(column) -> np.ndarray:
    return np.asarray(column).view(np.uint64)


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


class _Forest:
    """Links that join two trees of what a task has seen; forgotten when ``room`` fingerprints are held, so that memory
    is bounded (a link may then come again, which is harmless)."""

    def __init__(self, room: int = 1 << 16):
        self.room, self.up = room, {}

    def _top(self, x: int) -> int:
        up = self.up
        top = x
        while (above := up.setdefault(top, top)) != top:
            top = above
        while up[x] != top:
            up[x], x = top, up[x]
        return top

    def joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places of the links (a, b) that join two trees."""
        if len(self.up) > self.room:
            self.up.clear()
        out = []
        for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
            x, y = self._top(x), self._top(y)
            if x != y:
                self.up[max(x, y)] = min(x, y)
                out.append(i)
        return np.array(out, dtype=np.int64)


def _flat(up: np.ndarray) -> np.ndarray:
    """The root of each node."""
    while True:
        above = up[up]
        if np.array_equal(above, up):
            return up
        up = above


def _spanning(key: np.ndarray, fp: np.ndarray, cap: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the pairs of one key within ``max_bits`` connect, fewer than the rows: members of a key
    are compared with the next, the one after it, and so on, and only links between different trees are kept."""
    _, at = np.unique(fp, return_inverse=True)
    root = np.arange(len(fp))
    left, right = [], []
    for s in range(1, cap):
        same = np.flatnonzero(key[s:] == key[:-s])
        if not len(same):
            break
        a, b = root[at[same]], root[at[same + s]]
        near = (a != b) & (np.bitwise_count(fp[same] ^ fp[same + s]) <= max_bits)
        if not near.any():
            continue
        pair, first = np.unique(np.sort(np.stack([a[near], b[near]]), axis=0), axis=1, return_index=True)
        same = same[near][first]
        for i, x, y in zip(same.tolist(), *pair.tolist()):
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            if x != y:
                root[max(x, y)] = min(x, y)
                left.append(i)
                right.append(i + s)
        root = _flat(root)
    return fp[left], fp[right]


def _verified(cap: int, max_bits: int):
    """Over rows sorted by key: links (a, b) that connect what the pairs of each key within ``max_bits`` connect, fewer
    than the rows; (a, a) for every member of a key with more than ``cap`` fingerprints. Holds at most one run of
    ``cap`` rows back."""
    def run(batches):
        key, fp, open_key = np.empty(0, np.uint64), np.empty(0, np.uint64), None
        forest = _Forest()

        def links(key, fp):
            if not len(key):
                return
            start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[start, len(key)])
            large = np.repeat(size > cap, size)
            if large.any():
                dense = np.unique(fp[large])
                yield _edges(dense, dense)
            alone = np.repeat(size == 1, size) | large
            a, b = _spanning(key[~alone], fp[~alone], cap, max_bits)
            new = forest.joined(a, b)
            if len(new):
                yield _edges(np.minimum(a[new], b[new]), np.maximum(a[new], b[new]))

        for batch in batches:
            k, f = _unsigned(batch.column(0)), _unsigned(batch.column(2))
            if open_key is not None:  # the rest of a run already known to be large
                more = int(np.searchsorted(k.view(np.int64), np.int64(open_key), side="right"))
                if more:
                    dense = np.unique(f[:more])
                    yield _edges(dense, dense)
                    k, f = k[more:], f[more:]
                if len(k):
                    open_key = None
            key, fp = np.concatenate([key, k]), np.concatenate([fp, f])
            if not len(key):
                continue
            cut = int(np.searchsorted(key.view(np.int64), key.view(np.int64)[-1], side="left"))
            yield from links(key[:cut], fp[:cut])
            key, fp = key[cut:], fp[cut:]
            if len(key) > cap:
                dense = np.unique(fp)
                yield _edges(dense, dense)
                open_key, key, fp = key.view(np.int64)[0], key[:0], fp[:0]
        yield from links(key, fp)

    return run


def _stars(max_bits: int):
    """Over rows sorted by key, then narrow variants first: links of each row to its key's first
    fingerprint, but for those between fingerprints that the task has connected before. Holds one row back."""
    def run(batches):
        last_key, hub, forest = None, None, _Forest()
        for batch in batches:
            if not batch.num_rows:
                continue
            key, wide, fp = np.asarray(batch.column(0)), np.asarray(batch.column(1)), _unsigned(batch.column(2))
            new = np.r_[last_key is None or key[0] != last_key, key[1:] != key[:-1]]
            first = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
            hubs = np.where(first >= 0, fp[np.maximum(first, 0)], np.uint64(hub[0] if hub else 0))
            hub_wide = np.where(first >= 0, wide[np.maximum(first, 0)], hub[1] if hub else False)
            near = ~hub_wide & (hubs != fp) & (np.bitwise_count(hubs ^ fp) <= max_bits)
            last_key, hub = key[-1], (hubs[-1], bool(hub_wide[-1]))
            if near.any():
                pair = np.unique(np.stack([np.minimum(hubs[near], fp[near]), np.maximum(hubs[near], fp[near])], axis=1), axis=0)
                pair = pair[forest.joined(pair[:, 0], pair[:, 1])]
                if len(pair):
                    yield _edges(np.ascontiguousarray(pair[:, 0]), np.ascontiguousarray(pair[:, 1]))

    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS, blocks: int = 3, bucket_cap: int = 256) -> DataFrame:
    """(a, b), a before b: verified links between different fingerprints of ``fps`` (column ``fp``,
    distinct) that connect exactly what distances of at most ``max_bits`` connect."""
    if not 0 <= max_bits < BITS:
        raise ValueError("max_bits must be from 0 to 63")
    whole, left = projections(1, max_bits)
    if blocks == 1:
        dense, found = fps, None
    else:
        kept, kept_left = projections(blocks, max_bits)
        met = (_ball(fps, kept, kept_left).repartition("key").sortWithinPartitions("key", "fp")
               .mapInArrow(_verified(bucket_cap, max_bits), "a long, b long"))
        met = staged(met.distinct(), "simhash-met")
        found = met.where("a <> b")
        dense = met.where("a = b").select(F.col("a").alias("fp"))
    stars = (_ball(dense, whole, left).repartition("key").sortWithinPartitions("key", "wide", "fp")
             .mapInArrow(_stars(max_bits), "a long, b long"))
    return stars.distinct() if found is None else found.unionByName(stars).distinct()


def _components(hashed: DataFrame, max_bits: int = MAX_BITS, blocks: int = 3, bucket_cap: int = 256) -> DataFrame:
    """(r_fp, component_id, group) of each fingerprint of ``hashed`` (doc_id, fp); ``group`` is a fingerprint that stands
    for the component, also where two components have the same least id."""
    reps = staged(hashed.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-reps")
    edges = links(reps.select("fp"), max_bits, blocks, bucket_cap)
    roots = connected(edges)  # (node, root) of the linked fingerprints
    linked = reps.join(roots, reps.fp == roots.node, "inner").select("fp", "rep", "root")
    least = linked.groupBy("root").agg(F.min("rep").alias("least"))
    of_fp = linked.join(least, "root").select(F.col("fp").alias("l_fp"), "least", "root")
    return reps.join(of_fp, reps.fp == of_fp.l_fp, "left").select(
        F.col("fp").alias("r_fp"), F.coalesce("least", "rep").alias("component_id"), F.coalesce("root", "fp").alias("group"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS,
                    shingle: int = SHINGLE, blocks: int = 3, bucket_cap: int = 256) -> DataFrame:
    """One row per input row: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` (the smallest
    id reachable over fingerprints that differ in at most ``max_bits`` bits).

    Null and blank texts have fingerprint zero and are linked like any other; repeated rows each keep
    their row; a null id never becomes a component id unless the component has no other. Other columns
    are not read. An empty table gives an empty result.
    """
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    hashed = staged(fingerprints(slim, "text", ["doc_id"], shingle), "simhash-fp")
    named = _components(hashed, max_bits, blocks, bucket_cap)
    return hashed.join(named, hashed.fp == named.r_fp).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, **params) -> DataFrame:
    """One row of each component, columns as they came: that with the least id (rows without an id stand behind all that
    have one), and of rows that share the id, with the least hash of the row and its text. An id on rows of several
    components stays once in each where it is the least."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.xxhash64(whole).alias("_hash"), whole.alias("_row"))
    slim = rows.select(F.col("_id").alias("doc_id"), "_hash", F.col("_row").getField(text).alias("text"))
    hashed = staged(fingerprints(slim, "text", ["doc_id", "_hash"], shingle), "simhash-fp")
    named = _components(hashed.select("doc_id", "fp"), **params)
    least = hashed.join(named, hashed.fp == named.r_fp).groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "_hash")).alias("least"))
    kept = least.select(F.col("least.doc_id").alias("_kept"), F.col("least._hash").alias("_kept_hash"))
    copies = Window.partitionBy("_kept", "_kept_hash").orderBy(F.col("_row").getField(text))  # rows alike in all columns
    one = rows.join(kept, F.col("_id").eqNullSafe(F.col("_kept")) & (F.col("_hash") == F.col("_kept_hash"))).withColumn(
        "_n", F.row_number().over(copies)).where("_n = 1")
    return one.select("_row.*")
