"""Conversations that share first turns, by a z-fast trie.

A conversation is a sequence of turns (role and text). Each prefix has a digest chained from turn to turn. The trie is
compacted: a node stands for a stretch of depths without a branch or an end, ``(depth of its parent, its own depth]``. Its
handle is the depth in that stretch which a power of two as high as possible divides (its two-fattest number), and a hash
table leads from the prefix of that length to the node. The node where a conversation leaves the trie is found by a fat binary
search over its length, with as many probes as the length has binary digits; the depth where it leaves, by a binary search in
the node's stretch. There the node is split, or a leaf is hung on.

Sequences are range-partitioned in the order of their turns, so each task holds a contiguous range and builds the trie of it,
a batch of conversations after another, and a prefix that a third of all conversations begin with is spread over many tasks. Two
neighbours share nothing but one path, the common beginning of the last sequence of one and the first of the next. Edges are
expanded to a row per depth with what the trie knows of it; what the right neighbour knows of the shared path is reduced by
what the left one has counted, and rows of one prefix are summed.

Conversations of any length: they are cut into segments of ``SEGMENT`` turns, whose tries hang from the prefix before
the segment. What lies below a segment's end is summed up the segments by doubling.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from strata.llm.common import staged

SEGMENT = 64  # turns
SEQUENCES = 50_000  # of one task, on average at most
HEAD, FAMILY = 6, 100  # a conversation takes fewer than HEAD turns from the first of its FAMILY
_NONE = hashlib.sha256(b"").hexdigest()
_ORIGIN = bytes(16)


def _digest(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*[p.cast("binary") for p in parts])))


# -- the trie -----------------------------------------------------------------------------------------

def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that the highest power of two divides."""
    return high & -(1 << ((low ^ high).bit_length() - 1))


class Node:
    __slots__ = ("low", "depth", "chain", "weights", "kids", "n", "least", "goes_on")

    def __init__(self, low: int, depth: int, chain: list[bytes], weights: list[int]):
        self.low, self.depth, self.chain, self.weights = low, depth, chain, weights
        self.kids: dict[bytes, Node] = {}
        self.n, self.least, self.goes_on = 0, None, False  # of the sequences that end here


class ZFastTrie:
    """Over sequences given by the digests of their prefixes (``chain[d]``, d from 0) and the sums of their weights."""

    def __init__(self, origin: bytes):
        self.root = Node(-1, 0, [origin], [0])
        self.handles: dict[bytes, Node] = {}

    def _name(self, node: Node) -> None:
        self.handles[node.chain[two_fattest(node.low, node.depth)]] = node

    def locate(self, chain: list[bytes]) -> tuple[Node, Node | None, int]:
        """(exit node, its parent, the depth where the sequence leaves)."""
        found, above, low, high = self.root, None, 0, len(chain) - 1
        n = high
        while low < high:
            at = two_fattest(low, high)
            node = self.handles.get(chain[at])
            if node is None:
                high = at - 1
            else:
                found, low = node, node.depth
        if found.depth <= n and found.chain[found.depth] == chain[found.depth]:
            if found.depth == n:
                return found, None, n
            node = found.kids.get(chain[found.depth + 1])
            if node is None:
                return found, None, found.depth
            found, above = node, found
        low, high = found.low, min(found.depth, n)
        while low < high:  # the longest beginning that both have
            at = (low + high + 1) // 2
            if found.chain[at] == chain[at]:
                low = at
            else:
                high = at - 1
        return found, above, low

    def insert(self, chain: list[bytes], weights: list[int], n: int, least: int, goes_on: bool) -> None:
        n_turns = len(chain) - 1
        node, above, depth = self.locate(chain)
        if depth < node.depth:  # inside a stretch
            above = above or self._above(node)
            upper = Node(node.low, depth, node.chain, node.weights)
            above.kids[node.chain[node.low + 1]] = upper
            upper.kids[node.chain[depth + 1]] = node
            node.low = depth
            self._name(upper)
            self._name(node)
            node = upper
        if depth < n_turns:
            leaf = Node(depth, n_turns, chain, weights)
            node.kids[chain[depth + 1]] = leaf
            self._name(leaf)
            node = leaf
        node.n += n
        node.least = least if node.least is None else min(node.least, least)
        node.goes_on |= goes_on

    def _above(self, node: Node) -> Node:
        """The parent: where the sequence of length ``node.low`` leaves."""
        return self.locate(node.chain[:node.low + 1])[0]

    def expanded(self):
        """(depth, digest, parent's digest, members, least member, sum of members * weight and of weights in the subtree, its
        leaves, children, weights above) for every depth of every stretch. A sequence that goes on elsewhere is no leaf."""
        order, stack = [], [self.root]
        while stack:
            node = stack.pop()
            order.append(node)
            stack.extend(node.kids.values())
        known: dict[int, tuple] = {}
        for node in reversed(order):
            n, least, total, once, leaves = node.n, node.least, 0, 0, 0 if node.kids or node.goes_on else 1
            for kid in node.kids.values():
                k = known.pop(id(kid))
                n, total, once, leaves = n + k[0], total + k[2], once + k[3], leaves + k[4]
                least = k[1] if least is None else least if k[1] is None else min(least, k[1])
            w, chain, children = node.weights, node.chain, len(node.kids)
            for d in range(node.depth, max(node.low, 0), -1):
                own = w[d] - w[d - 1]
                total, once = total + n * own, once + own
                yield d, chain[d], chain[d - 1], n, least, total, once, leaves, children, w[d - 1]
                children = 1
            if node is self.root:
                yield 0, chain[0], None, n, least, total, once, leaves, children, 0
            known[id(node)] = (n, least, total, once, leaves)


_ROWS = ("part int, depth long, id binary, parent binary, n long, least long, total long, once long, leaves long, children long, above long, "
         "first boolean, last boolean, segment long, turns binary, weights array<long>")


def _chained(origin: bytes, turns: bytes) -> list[bytes]:
    out, md5 = [origin], hashlib.md5
    for i in range(0, len(turns), 16):
        out.append(md5(out[-1] + turns[i:i + 16]).digest())
    return out


def _prefix_digests(origin: bytes, turns: bytes, end: bytes) -> list[bytes]:
    """The digests of a segment's prefixes, the last of which the next segment hangs from."""
    out = _chained(origin, turns)
    out[-1] = end
    return out


def _built(size: int):
    """Over sequences (segment, origin, turns, end, weights, n, least, goes_on): a row per prefix of the task's tries, and a row with
    ``turns`` for its least and for its greatest sequence. A task's tries are in memory, ``SEQUENCES`` sequences on average."""
    names = [c.split()[0] for c in _ROWS.split(", ")]
    types = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.bool_(), pa.bool_(), pa.int64(), pa.binary(), pa.list_(pa.int64())]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches):
        part, tries, ends = TaskContext.get().partitionId(), {}, []
        for batch in batches:
            for segment, origin, turns, end, sizes, n, least, goes_on in zip(*(c.to_pylist() for c in batch.columns)):
                chain, weights = _prefix_digests(origin, turns, end), [0]
                for w in sizes:
                    weights.append(weights[-1] + w)
                if (segment, origin) not in tries:
                    tries[segment, origin] = ZFastTrie(origin)
                tries[segment, origin].insert(chain, weights, n, least, goes_on)
                key = (segment, origin, turns, weights, end)
                ends = [min([*ends[:1], key]), max([*ends[1:], key])] if ends else [key, key]
        if not ends:
            return
        first, last = ({(e[0], x) for x in _prefix_digests(e[1], e[2], e[4])} for e in ends)
        out = [(part, None, e[1], None, *[None] * 7, i == 0, i == 1, e[0], e[2], e[3]) for i, e in enumerate(ends)]
        for (segment, _), trie in tries.items():
            for depth, id_, parent, n, least, total, once, leaves, children, above in trie.expanded():
                if segment and not depth:  # the prefix itself is in the segment before; only what hangs from it is told here
                    n, least = 0, None
                out.append((part, segment * size + depth, id_, parent, n, least, total, once, leaves, children, above,
                            (segment, id_) in first, (segment, id_) in last, segment, None, None))
                if len(out) >= 20_000:
                    yield batch_of(out)
                    out = []
        if out:
            yield batch_of(out)

    return run


def _seams(batches):
    """Of neighbours' rows (part, segment, origin, turns, weights, the same of the one before): how deep the first path is shared
    (null: nothing is), the weights down to there, and whether the neighbour's last sequence goes on here."""
    for batch in batches:
        out = []
        for part, seg, origin, turns, weights, b_part, b_seg, b_origin, b_turns in zip(*(c.to_pylist() for c in batch.columns)):
            if b_part is None or (seg, origin) != (b_seg, b_origin):
                continue
            depth, n = 0, min(len(turns), len(b_turns)) // 16
            while depth < n and turns[16 * depth:16 * depth + 16] == b_turns[16 * depth:16 * depth + 16]:
                depth += 1
            out.append((part, b_part, depth, weights[depth], 16 * depth == len(b_turns)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()))],
                                             names=["part", "before", "shared", "weight", "goes_on"])


# -- conversations ------------------------------------------------------------------------------------

def ordered_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, turn digest, weight) of ``rows`` (conv_id, turn, role, text). Positions are counted in sorted ranges and
    carried from one range to the next (a number per range), so that a conversation may be larger than a task."""
    head = F.substring("text", 1, 64)  # only where a range may end; rows are sorted by the whole text
    ranged = rows.repartitionByRange("conv_id", "turn", "role", head).sortWithinPartitions("conv_id", "turn", "role", "text")
    slim = ranged.select("conv_id", _digest(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).alias("token"),
                         F.length("text").cast("long").alias("weight"))

    def run(batches):
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if batch.num_rows:
                pos = []
                for conv in batch.column(0).to_pylist():
                    count = count + 1 if conv == last else 1
                    last = conv
                    pos.append(count)
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(pos), pa.int32()), batch.column(0), pa.array(pos, pa.int64()), *batch.columns[1:]],
                                                 names=["part", "conv_id", "pos", "token", "weight"])

    local = staged(slim.mapInArrow(run, "part int, conv_id long, pos long, token binary, weight long"), "trie-turns")
    ends = local.groupBy("part").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "pos")).alias("last")).orderBy("part").collect()
    carried, conv, count = [], None, 0  # a row per range at most
    for r in ends:
        before = count if r["first"] == conv else 0
        if before:
            carried.append((r["part"], conv, before))
        count = r["last"]["pos"] + (before if r["last"]["conv_id"] == r["first"] else 0)
        conv = r["last"]["conv_id"]
    if not carried:
        return local.drop("part")
    more = F.broadcast(local.sparkSession.createDataFrame(carried, "part int, conv_id long, before long"))
    return local.join(more, ["part", "conv_id"], "left").select(
        "conv_id", (F.col("pos") + F.coalesce("before", F.lit(0))).alias("pos"), "token", "weight")


def rebuilt_turns(turns: DataFrame, head: int = HEAD, family: int = FAMILY) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, token, weight, length) of conversations whose first ``crc32(id) % head`` turns are those of their family's
    first one (``id - id % family``, if there is one), and (conv_id, length) of each, also of those without turns."""
    id_ = F.col("conv_id")
    counted = staged(turns.groupBy("conv_id").agg(F.max("pos").alias("n")).select(
        "conv_id", "n", F.pmod(F.crc32(id_.cast("string").cast("binary")), F.lit(head)).alias("h"), (id_ - id_ % family).alias("base")), "trie-convs")
    base = counted.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = counted.join(base, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = staged(convs.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "trie-rebuilt")
    own = turns.join(convs.select("conv_id", "h", "taken", "length"), "conv_id").where("pos > h").select(
        "conv_id", (F.col("taken") + F.col("pos") - F.col("h")).alias("depth"), "token", "weight", "length")
    first = turns.where(F.col("pos") < head).select(F.col("conv_id").alias("base"), "pos", "token", "weight")
    taken = first.join(convs.select("conv_id", "base", "h", "length"), "base").where("pos <= h").select(
        "conv_id", F.col("pos").alias("depth"), "token", "weight", "length")
    return own.unionByName(taken), convs.select("conv_id", "length")


def _origins(items: DataFrame, size: int) -> DataFrame:
    """(conv_id, at, origin, after): a digest of the items (conv_id, at, digest) before each, and of those up to it, by groups of
    ``size``, groups of groups and so on. ``after`` is the next item's origin."""
    if not items.agg(F.max("at")).first()[0]:
        origin = F.lit(_ORIGIN)
        return items.select("conv_id", "at", origin.alias("origin"), F.unhex(F.md5(F.concat(origin, "digest"))).alias("after"))
    grouped = items.groupBy("conv_id", F.expr(f"at div {size}").alias("up")).agg(F.sort_array(F.collect_list(F.struct("at", "digest"))).alias("xs"))
    grouped = staged(grouped, "trie-groups")
    whole = F.aggregate("xs", F.lit(b""), lambda a, x: F.concat(a, x["digest"]))
    above = _origins(grouped.select("conv_id", F.col("up").alias("at"), _digest(whole).alias("digest")), size)
    joined = grouped.join(above.select("conv_id", F.col("at").alias("up"), "origin", "after"), ["conv_id", "up"])

    def run(batches):
        for batch in batches:
            out = []
            for conv, origin, after, ats, digests in zip(*(c.to_pylist() for c in batch.columns)):
                chain = _chained(origin, b"".join(digests))
                if len(ats) == size:
                    chain[-1] = after
                out += zip([conv] * len(ats), ats, chain, chain[1:])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                                                 names=["conv_id", "at", "origin", "after"])

    return staged(joined.select("conv_id", "origin", "after", "xs.at", "xs.digest").mapInArrow(
        run, "conv_id long, at long, origin binary, after binary"), "trie-origins")


def _segments(turns: DataFrame, convs: DataFrame, size: int) -> DataFrame:
    """(conv_id, at, origin, turns, weights, is_last, end) per segment of a conversation; ``end`` is its last prefix's digest."""
    cut = turns.groupBy("conv_id", F.expr(f"(depth - 1) div {size}").alias("at")).agg(
        F.sort_array(F.collect_list(F.struct("depth", "token", "weight"))).alias("xs"), F.max("length").alias("length"))  # ``size`` rows at most
    whole = F.aggregate("xs", F.lit(b""), lambda a, x: F.concat(a, x["token"]))
    cut = cut.select("conv_id", "at", whole.alias("turns"), F.col("xs.weight").alias("weights"), F.expr(f"at = (length - 1) div {size}").alias("is_last"))
    none = convs.where("length = 0").select("conv_id", F.lit(0).cast("long").alias("at"), F.lit(b"").alias("turns"),
                                            F.array().cast("array<long>").alias("weights"), F.lit(True).alias("is_last"))
    cut = staged(cut.unionByName(none), "trie-segments")
    origins = _origins(cut.select("conv_id", "at", _digest(F.col("turns")).alias("digest")), size)
    joined = cut.join(origins, ["conv_id", "at"]).select("conv_id", "at", "origin", "turns", "weights", "is_last", "after")

    def run(batches):
        for batch in batches:
            ends = [a if len(t) == 16 * size else _chained(o, t)[-1] for o, t, a in zip(*(batch.column(i).to_pylist() for i in (2, 3, 6)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, pa.binary())], names=[*batch.schema.names, "end"])

    return staged(joined.mapInArrow(run, joined.withColumn("end", F.lit(b"")).schema), "trie-ends")


def _below(sequences: DataFrame, hung: DataFrame) -> DataFrame:
    """(id, total, once, leaves) to add to each prefix of the segments that go on: what hangs from segments' ends below it.
    ``hung``: (id, total, once, leaves) of the tries that hang from a segment's end."""
    sums = ["total", "once", "leaves"]
    paths = sequences.where("goes_on").select("origin", "turns", "end", "at")
    tree = staged(hung.join(paths.select(F.col("end").alias("id"), F.col("origin").alias("up")), "id"), "trie-skeleton")
    while True:  # each round reaches twice as far: a number of rounds like the binary digits of the number of segments
        if not tree.where("up IS NOT NULL").limit(1).count():
            break
        more = tree.where("up IS NOT NULL").groupBy(F.col("up").alias("m_id")).agg(*[F.sum(c).alias(f"m_{c}") for c in sums])
        jump = tree.select(F.col("id").alias("j_id"), F.col("up").alias("j_up"))
        tree = tree.join(more, tree.id == F.col("m_id"), "left").join(jump, F.col("up") == F.col("j_id"), "left").select(
            "id", F.col("j_up").alias("up"), *[(F.col(c) + F.coalesce(f"m_{c}", F.lit(0))).alias(c) for c in sums])
        tree = staged(tree, "trie-skeleton")

    def run(batches):
        for batch in batches:
            out = []
            for origin, turns, end, at, *values in zip(*(c.to_pylist() for c in batch.columns)):
                out += [(x, *values) for x in _prefix_digests(origin, turns, end)[1 if at else 0:]]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), *[pa.int64()] * 3))], names=["id", *sums])

    reached = paths.join(tree, paths.end == tree.id).select("origin", "turns", "end", "at", *sums)
    return reached.mapInArrow(run, "id binary, total long, once long, leaves long")


def _end_digests(ends: DataFrame) -> DataFrame:
    """(end, sha) of the ids (end, conv_id) of each end, joined in ascending order. A digest reads its ids one after another, so
    those of one end go through one task, as a stream."""
    def run(batches):
        last, sha, out = None, None, []
        for batch in batches:
            for end, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if end != last:
                    if sha is not None:
                        out.append((last, sha.hexdigest()))
                    last, sha = end, hashlib.sha256(str(conv).encode())
                else:
                    sha.update(f",{conv}".encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.string()))], names=["end", "sha"])
                out = []
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([sha.hexdigest()])], names=["end", "sha"])

    return ends.select("end", "conv_id").repartition("end").sortWithinPartitions("end", "conv_id").mapInArrow(run, "end binary, sha string")


def nodes(segments: DataFrame, size: int = SEGMENT) -> DataFrame:
    """A row per different prefix of the conversations (``_segments``): id, parent, depth, n (members), least (member), children,
    leaves, saved."""
    spark = segments.sparkSession
    sequences = staged(segments.groupBy("at", "origin", "end").agg(
        F.first("turns").alias("turns"), F.first("weights").alias("weights"), F.count("*").alias("n"), F.min("conv_id").alias("least"),
        (F.count_if(~F.col("is_last")) > 0).alias("goes_on")), "trie-sequences")
    held = sequences.agg(F.count("*"), F.max("at")).first()
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-held[0] // SEQUENCES))
    ranged = sequences.select("at", "origin", "turns", "end", "weights", "n", "least", "goes_on").repartitionByRange(tasks, "at", "origin", "turns")
    rows = staged(ranged.mapInArrow(_built(size), _ROWS), "trie-rows")

    ends = rows.where("turns IS NOT NULL").select("part", "first", "segment", F.col("id").alias("origin"), "turns", "weights")
    in_order = Window.orderBy("part")  # a row per task
    firsts = ends.where("first")
    lasts = ends.where("NOT first").select("part", *[F.col(c).alias(f"l_{c}") for c in ("segment", "origin", "turns")])
    both = firsts.join(lasts, "part").select("part", "segment", "origin", "turns", "weights", *[
        F.lag(c).over(in_order).alias(f"b_{c}") for c in ("part", "l_segment", "l_origin", "l_turns")])
    seams = staged(both.mapInArrow(_seams, "part int, before int, shared long, weight long, goes_on boolean"), "trie-seams")
    found = rows.where("turns IS NULL").join(F.broadcast(seams.select("part", "shared", "weight")), "part", "left")
    found = found.join(F.broadcast(seams.where("goes_on").select(F.col("before").alias("part"), F.lit(1).alias("told"))), "part", "left")
    in_segment = F.col("depth") - F.col("segment") * size
    known = F.col("first") & (in_segment <= F.col("shared"))  # also told, and owned, by the task before
    found = found.select(
        "id", "parent", "depth", "segment", "n", "least", "total", "children",
        (F.col("once") - F.when(known, F.col("weight") - F.col("above")).otherwise(0)).alias("once"),
        (F.col("leaves") - F.when(F.col("last"), F.coalesce("told", F.lit(0))).otherwise(0)).alias("leaves"),
        F.when(known & (in_segment < F.col("shared")), 1).otherwise(0).alias("again"), in_segment.alias("in_segment"))
    found = found.withColumn("children", F.col("children") - F.col("again")).drop("again")
    if held[1]:  # some conversation has more than one segment
        found = staged(found, "trie-found")
        is_hung = (F.col("in_segment") == 0) & (F.col("segment") > 0)
        hung = found.where(is_hung).groupBy("id").agg(*[F.sum(c).alias(c) for c in ("total", "once", "leaves")])
        zero = F.lit(0).cast("long")
        found = found.select("id", "parent", "depth", "n", "least", "children", *[
            F.when(is_hung, zero).otherwise(F.col(c)).alias(c) for c in ("total", "once", "leaves")])
        more = _below(sequences, staged(hung, "trie-hung")).select(
            "id", F.lit(None).cast("binary").alias("parent"), F.lit(None).cast("long").alias("depth"), zero.alias("n"),
            F.lit(None).cast("long").alias("least"), zero.alias("children"), "total", "once", "leaves")
        found = found.unionByName(more)
    merged = found.groupBy("id").agg(F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.sum("n").alias("n"), F.min("least").alias("least"),
                                     F.sum("children").alias("children"), F.sum("leaves").alias("leaves"), (F.sum("total") - F.sum("once")).alias("saved"))
    return staged(merged, "trie-nodes")


def prefixes(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", size: int = SEGMENT) -> DataFrame:
    """One row per prefix of the rebuilt conversations: conv_id (the smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are in the order of ``turn``, null first, and rows of one turn in that of role and text. A null role or text is empty;
    rows without a conversation's id belong to none and are left out. A repeated row is a turn like any other. ``id % family``
    has the sign of the id. Other columns are not read. An empty table has no conversation, so no root and no rows. ``size``:
    turns of a segment; it only changes how work is cut.
    """
    if size < 2:
        raise ValueError("a segment has at least two turns")
    empty = F.lit("")
    slim = rows.select(F.col(f"`{conv}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
                       F.coalesce(F.col(f"`{role}`").cast("string"), empty).alias("role"), F.coalesce(F.col(f"`{text}`").cast("string"), empty).alias("text"))
    turns, convs = rebuilt_turns(ordered_turns(slim.where("conv_id IS NOT NULL")))
    segments = _segments(turns, convs, size)
    found = nodes(segments, size)
    shas = staged(_end_digests(segments.where("is_last")), "trie-digests")
    above = found.select(F.col("id").alias("p_id"), F.col("least").alias("parent_conv_id"))
    return found.join(above, found.parent == above.p_id, "left").join(shas, F.col("id") == F.col("end"), "left").select(
        F.col("least").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.lit(_NONE)).alias("ends_sha256"))


def prefixes_sql(head: int = HEAD, family: int = FAMILY) -> str:
    """The same in DuckDB SQL: every prefix as a list of turns, and every node's descendants one by one."""
    return f"""
WITH RECURSIVE turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
         {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said
  FROM conversations WHERE conv_id IS NOT NULL),
counted AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % {family} AS base FROM turns GROUP BY conv_id),
bits AS (  -- CRC-32, bit by bit: each character is put in before its eight steps
  SELECT conv_id, conv_id::VARCHAR AS s, 4294967295::BIGINT AS v, 0 AS k FROM counted
  UNION ALL
  SELECT conv_id, s, xor(u >> 1, 3988292384 * (u & 1)) AS v, k + 1 AS k FROM (
    SELECT conv_id, s, k, CASE WHEN k % 8 = 0 THEN xor(v, ascii(s[k // 8 + 1])::BIGINT) ELSE v END AS u FROM bits WHERE k < 8 * length(s))),
heads AS (SELECT conv_id, xor(v, 4294967295::BIGINT) % {head} AS h FROM bits WHERE k = 8 * length(s)),
rebuilt AS (
  SELECT c.conv_id, 0 AS whose, t.pos, t.said FROM counted c JOIN heads USING (conv_id) JOIN turns t ON t.conv_id = c.base AND t.pos <= h
  UNION ALL
  SELECT t.conv_id, 1, t.pos, t.said FROM turns t JOIN heads USING (conv_id) WHERE t.pos > h),
whole AS (
  SELECT c.conv_id, coalesce(list(said ORDER BY whose, pos) FILTER (WHERE said IS NOT NULL), []) AS seq
  FROM counted c LEFT JOIN rebuilt r USING (conv_id) GROUP BY c.conv_id),
members AS (SELECT conv_id, d AS depth, seq[1:d] AS node, len(seq) = d AS ends FROM whole, range(0, len(seq) + 1) r(d)),
nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM members GROUP BY node, depth),
kids AS (SELECT node[1:depth - 1] AS node, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
valued AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children, CASE WHEN n.depth > 0 THEN (n.n_convs - 1) * length(n.node[n.depth].text) ELSE 0 END AS saved
  FROM nodes n LEFT JOIN kids k ON k.depth = n.depth AND k.node = n.node),
sums AS (
  SELECT node[1:d] AS node, d AS depth, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved
  FROM valued, range(0, depth + 1) r(d) GROUP BY ALL)
SELECT v.conv_id, v.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children::BIGINT AS n_children, s.n_leaves,
       s.saved::BIGINT AS saved_tokens, v.ends_sha256
FROM valued v JOIN sums s ON s.depth = v.depth AND s.node = v.node
LEFT JOIN nodes p ON p.depth = v.depth - 1 AND p.node = v.node[1:v.depth - 1] AND v.depth > 0
"""
