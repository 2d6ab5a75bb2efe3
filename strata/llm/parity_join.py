"""Near-duplicate documents by an n-gram Jaccard join over parity sketches.

A document's set of shingles toggles bits: each shingle hashes to one place of a long bit sketch and flips it. The Hamming
distance of two sketches is at most the size of the sets' symmetric difference, as shingles in both cancel out and each other
one flips one bit. A Jaccard similarity of t bounds that difference by ``(|A| + |B|) * (1 - t) / (1 + t)``, and the sizes
by a ratio of t. So sets are joined within bands of sizes: a band knows the greatest difference D that a pair of its
own may have, and cuts the sketch into n > D pieces, of which such a pair shares at least n - D.

A set may then leave out n - D - 1 of its pieces, if every set leaves out by one order that depends on a piece alone: of the
pieces that two sets share, the highest in that order stands above the n - D - 1 others, so neither leaves it out.
Here the order is the number of odd bits, so empty and nearly empty pieces go, which would be alike in documents that
have nothing else in common. A set keeps D + k pieces, where D is the greatest difference from any set it may link with in that
band, and k, some more than one, belongs to the band. Then sets that link share k of the pieces they keep. A piece that very
many sets have (of a common passage, say) is left by all sets with fewer than k such pieces: they meet those
that they link with in another one.

Documents that meet in a piece are candidates. All pairs of a group aren't needed, only what they connect. Groups with the same
least member are put together, and each member travels once, however many pieces it shares. First each is compared
with the least. Then members that are still in different components are compared with each other, in blocks. Both look at
shorter sketches of the same kind first, whose distance must not be beyond the bound; what passes is verified on the sets
themselves. Equal sets are one node. Only keys travel for all documents; shingles and short
sketches are made anew for those that met others.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import staged, utf8
from strata.llm.components import connected

WORDS, SHARE, SEED = 5, 80, 42  # words of a shingle, least similarity in hundredths
SPARE = 0.25  # pieces beyond D + 1, as a share of them
SHARED = 0.1  # kept pieces beyond D + 1, as a share of the greatest D + 1 of the band
BITS_PER_SHINGLE, LEAST_BITS = 0.8, 128  # of the shorter sketches, at least
BLOCK = 1024  # members of a group compared at once
SENT = 2_000_000  # rows (id, signature, number) of documents wanted again that are sent to all nodes; if more, the join shuffles
_SEEN, _OUT_BYTES = 1 << 19, 8 << 20


def shingles(text: bytes, words: int = WORDS, seed: int = SEED) -> np.ndarray:
    """Sorted 64-bit hashes of the different shingles of a text (UTF-8); of the whole sequence if it is shorter."""
    found = text.lower().split()  # on bytes: ASCII letters, and blank or \x09-\x0D only
    if not found:
        return np.empty(0, np.uint64)
    joined, digest = b" ".join(found), xxhash.xxh64_intdigest
    if len(found) <= words:
        return np.array([digest(joined, seed)], np.uint64)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes).tolist()
    return np.unique(np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends[words - 1:].tolist())], np.uint64))


# -- bands and pieces ---------------------------------------------------------------------------------

def greatest_difference(a, b, share: int = SHARE):
    """The largest symmetric difference that sets of these sizes may have and still link."""
    return (a + b) * (100 - share) // (100 + share)


def bands(upto: int, share: int = SHARE) -> list[int]:
    """Least sizes of the bands, each at least 100 / share times the one before, up to one beyond ``upto``."""
    out = [1]
    while out[-1] <= upto:
        out.append(max(out[-1] + 1, -(-out[-1] * 100 // share)))
    return out


def pieces(least: int, beyond: int, share: int = SHARE) -> int:
    """Pieces of the sketch in the band of pairs whose smaller set has ``least`` to ``beyond`` - 1 shingles."""
    most = greatest_difference(beyond - 1, (beyond - 1) * 100 // share, share)
    return most + 1 + max(1, int((most + 1) * SPARE))


def shared_pieces(beyond: int, share: int = SHARE) -> int:
    """How many of the pieces they keep two sets share at least that link in the band that ends before ``beyond``."""
    most = greatest_difference(beyond - 1, (beyond - 1) * 100 // share, share)
    return 1 + int((most + 1) * SHARED)


def least_shared(size: int, share: int = SHARE) -> int:
    """The same in both bands of a set of this size."""
    return min(shared_pieces(beyond, share) for beyond in bands(size, share)[-2:])


def kept_pieces(size: int, beyond: int, share: int = SHARE) -> int:
    """How many of them a set of this size keeps: its greatest difference from a set that it may link with there, and those
    to be shared. The smaller set of a pair has fewer than ``beyond`` shingles."""
    other = size * 100 // share if size < beyond else beyond - 1
    return greatest_difference(size, other, share) + shared_pieces(beyond, share)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _odd_places(hashes: np.ndarray) -> np.ndarray:
    """Places of the odd bits of a sketch of 2 ** 48 bits, ascending."""
    place, n = np.unique(hashes >> np.uint64(16), return_counts=True)
    return place[n % 2 == 1]


def keys_of(hashes: np.ndarray, share: int = SHARE) -> np.ndarray:
    """A key for each piece that a set keeps, in its own band and the one below: a hash of band, piece and its odd bits."""
    size = len(hashes)
    edges = bands(size, share)
    place = _odd_places(hashes)
    value = _mixed(place + np.uint64(1))
    out = []
    for band in range(max(0, len(edges) - 3), len(edges) - 1):
        n, kept = pieces(edges[band], edges[band + 1], share), kept_pieces(size, edges[band + 1], share)
        piece = (place >> np.uint64(16)) * np.uint64(n) >> np.uint64(32)
        start = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]]) if len(piece) else np.empty(0, np.int64)
        content, odd = np.zeros(n, np.uint64), np.zeros(n, np.int64)
        if len(start):
            at = piece[start].astype(np.int64)
            content[at] = np.bitwise_xor.reduceat(value, start)
            odd[at] = np.diff(np.r_[start, len(piece)])
        keep = np.lexsort((np.arange(n), -odd))[:kept]
        out.append(_mixed(content[keep] ^ _mixed(np.uint64(band << 32) + keep.astype(np.uint64) + np.uint64(1))))
    return np.unique(np.concatenate(out)) if out else np.empty(0, np.uint64)


def sketch_bits(size: int) -> int:
    """Bits of the shorter sketch of a set: a power of two."""
    return max(LEAST_BITS, 1 << (ceil(BITS_PER_SHINGLE * size) - 1).bit_length())


def sketch_of(hashes: np.ndarray) -> bytes:
    """A parity sketch: its halves, XORed, are the parity sketch of half the bits."""
    m = sketch_bits(len(hashes))
    at = (hashes >> np.uint64(8) & np.uint64(m - 1)).astype(np.int64)
    out = np.zeros(m // 8, np.uint8)
    np.bitwise_xor.at(out, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return out.tobytes()


def _folded(sketch: np.ndarray, words: int) -> np.ndarray:
    while len(sketch) > words:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


# -- sets ---------------------------------------------------------------------------------------------

_SETS = "doc_id long, n long, sig binary, sid long, shared long, keys array<long>"
_MET = "leader long, sid long, hot boolean"
_NODES = "sid long, n long, sketch binary, shingles binary"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "boolean": pa.bool_()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def _prepared(words: int, share: int):
    """Over (doc_id, text): a row of ``_SETS`` each; ``sid``, ``shared`` and ``keys`` where the task meets a set for the first time."""
    def run(batches):
        part, made, seen = TaskContext.get().partitionId() << 33, 0, set()
        for batch in batches:
            out, held = [], 0
            for doc, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                h = shingles(text, words)
                sig = xxhash.xxh128_digest(h.tobytes()) if len(h) else None
                row = (doc, len(h), sig, None, None, None)
                if len(h) and sig not in seen:
                    if len(seen) >= _SEEN:
                        seen.clear()  # a set may then be named again, which is harmless
                    seen.add(sig)
                    row = (doc, len(h), sig, part + made, least_shared(len(h), share), keys_of(h, share).view(np.int64))
                    made += 1
                    held += len(row[5]) * 8
                out.append(row)
                if held > _OUT_BYTES:
                    yield _batch(out, _SETS)
                    out, held = [], 0
            if out:
                yield _batch(out, _SETS)

    return run


def _again(words: int):
    """Over (text, sig, sid): a row of ``_NODES`` for each text that has this signature, once a task."""
    def run(batches):
        seen = set()
        for batch in batches:
            out, held = [], 0
            for text, sig, sid in zip(utf8(batch.column(0)), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                if sid in seen:
                    continue
                raw = (h := shingles(text, words)).tobytes()
                if xxhash.xxh128_digest(raw) == sig:
                    if len(seen) >= _SEEN:
                        seen.clear()
                    seen.add(sid)
                    out.append((sid, len(h), sketch_of(h), raw))
                    held += 2 * len(raw)
                if held > _OUT_BYTES:
                    yield _batch(out, _NODES)
                    out, held = [], 0
            if out:
                yield _batch(out, _NODES)

    return run


# -- candidates ---------------------------------------------------------------------------------------

def _groups(block: int):
    """Over rows sorted by (key, sid): of keys that several sets have, up to ``block``: (leader, sid, False) of the rows but for
    the leader, the group's least set; once a task, as far as it remembers. Of keys that more have: (key, sid, True) of
    every row. Holds a group of up to ``block``."""
    def run(batches):
        seen, common = set(), None
        key, sid = np.empty(0, np.int64), np.empty(0, np.int64)

        def found(key, sid):
            start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[start, len(key)])
            hot = np.repeat(size > block, size) | (False if common is None else key == common)
            least = np.repeat(sid[start], size)
            plain = ~hot & (least != sid)
            out = []
            for pair in set(zip(least[plain].tolist(), sid[plain].tolist())):
                if pair not in seen:
                    if len(seen) >= _SEEN:
                        seen.clear()
                    seen.add(pair)
                    out.append((*pair, False))
            out += zip(key[hot].tolist(), sid[hot].tolist(), [True] * int(hot.sum()))
            if out:
                yield _batch(out, _MET)

        for batch in batches:
            if not batch.num_rows:
                continue
            key, sid = np.r_[key, np.asarray(batch.column(0))], np.r_[sid, np.asarray(batch.column(1))]
            last = int(np.searchsorted(key, key[-1]))
            end = len(key) if len(key) - last > block or key[-1] == common else last
            if end:
                yield from found(key[:end], sid[:end])
            if end > last:
                common = int(key[-1])
            key, sid = key[end:], sid[end:]
        if len(key):
            yield from found(key, sid)

    return run


def _met(named: DataFrame, again: DataFrame, block: int) -> DataFrame:
    """(leader, sid) of the sets that meet, each once."""
    keyed = named.select("sid", "keys").join(again, "sid", "left_anti").select(F.explode("keys").alias("key"), "sid")
    met = staged(keyed.repartition("key").sortWithinPartitions("key", "sid").mapInArrow(_groups(block), _MET), "parity-met")
    common = met.where("hot").select(F.col("leader").alias("key"), "sid")
    many = common.groupBy("sid").agg(F.count("*").alias("common")).join(named.select("sid", "shared"), "sid").where("common >= shared")
    stays = staged(common.join(staged(many.select("sid"), "parity-many"), "sid", "left_semi"), "parity-common")
    leaders = staged(stays.groupBy("key").agg(F.min("sid").alias("leader")), "parity-leaders")  # a row for ``block`` rows and more
    led = stays.join(leaders, "key").where("sid <> leader").select("leader", "sid")
    return met.where("NOT hot").select("leader", "sid").unionByName(led).distinct()


def _numbered(block: int):
    """Over rows sorted by (leader, sid), each once: (leader, sid, block), ``block`` members a block."""
    def run(batches):
        last, count = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            leader = np.asarray(batch.column(0))
            new = np.r_[last is None or leader[0] != last, leader[1:] != leader[:-1]]
            start = np.maximum.accumulate(np.where(new, np.arange(len(leader)), -1))
            place = np.where(start >= 0, np.arange(len(leader)) - start, np.arange(len(leader)) + count)
            last, count = leader[-1], int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(place // block)], names=["leader", "sid", "block"])

    return run


def _near(na: int, a: bytes, nb: int, b: bytes, share: int) -> bool:
    """Whether sizes and sketches allow a link."""
    if min(na, nb) * 100 < max(na, nb) * share:
        return False
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    words = min(len(x), len(y))
    return int(np.bitwise_count(_folded(x, words) ^ _folded(y, words)).sum()) <= greatest_difference(na, nb, share)


def _similar(na: int, a: bytes, nb: int, b: bytes, share: int) -> bool:
    """Whether two sets link."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= share * (na + nb - both)


def _with_leader(test, share: int):
    """Over rows (leader, block, sid, n, payload) sorted by leader, block and with the leader's own row first: (leader, sid) of the
    members that pass ``test``. Holds the leader."""
    def run(batches):
        held = None
        for batch in batches:
            out = []
            for leader, block, sid, n, payload in zip(*(c.to_pylist() for c in batch.columns)):
                if sid == leader:
                    held = (leader, block, n, payload)
                elif held[:2] == (leader, block) and test(held[2], held[3], n, payload, share):
                    out.append((leader, sid))
            if out:
                yield _batch(out, "leader long, sid long")

    return run


def _led(members: DataFrame, nodes: DataFrame, payload: str, test, share: int, name: str) -> DataFrame:
    """The members (leader, sid, block) that pass ``test`` with their leader, which is sent along with every block."""
    leaders = members.select("leader", "block").distinct().select("leader", F.col("leader").alias("sid"), "block")
    asked = staged(members.select("leader", "sid", "block").unionByName(leaders), "parity-asked")  # of known size: few are sent to the nodes
    rows = asked.join(nodes.select("sid", "n", payload), "sid")
    rows = rows.select("leader", "block", "sid", "n", payload).repartition("leader", "block").sortWithinPartitions(
        "leader", "block", F.col("sid") != F.col("leader"), "sid")
    return staged(rows.mapInArrow(_with_leader(test, share), "leader long, sid long"), name)


def _crossed(share: int):
    """Over rows (leader, low, high, block, sid, comp, n, sketch) sorted by leader, low, high: pairs of different components that
    sizes and sketches allow, between block ``low`` and block ``high`` of a group. Holds two blocks."""
    def pairs(held):
        words = min(len(r[7]) for r in held) // 8
        sketch = np.stack([_folded(np.frombuffer(r[7], np.uint64), words) for r in held])
        low, high, block = held[0][1], held[0][2], np.array([r[3] for r in held])
        sid, comp, n = (np.array([r[i] for r in held]) for i in (4, 5, 6))
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        step = max(1, (1 << 22) // max(1, words * len(right)))
        for i in range(0, len(left), step):
            a, b = left[i:i + step][:, None], right[None, :]
            fits = (comp[a] != comp[b]) & (np.minimum(n[a], n[b]) * 100 >= np.maximum(n[a], n[b]) * share)
            if low == high:
                fits &= a < b
            x, y = np.nonzero(fits)
            a, b = left[i:i + step][x], right[y]
            for j in range(0, len(a), 1 << 15):
                p, q = a[j:j + (1 << 15)], b[j:j + (1 << 15)]
                near = np.bitwise_count(sketch[p] ^ sketch[q]).sum(1, dtype=np.int64) <= greatest_difference(n[p], n[q], share)
                yield from zip(np.minimum(sid[p], sid[q])[near].tolist(), np.maximum(sid[p], sid[q])[near].tolist())

    def run(batches):
        held, seen = [], set()

        def new():
            out = []
            for pair in pairs(held) if len(held) > 1 else ():
                if pair not in seen:  # a pair may meet under several leaders
                    if len(seen) >= _SEEN:
                        seen.clear()
                    seen.add(pair)
                    out.append(pair)
            if out:
                yield _batch(out, "a long, b long")

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][:3] != row[:3]:
                    yield from new()
                    held = []
                held.append(row)
        yield from new()

    return run


def _linked(share: int):
    """Of rows (a, b, n_a, shingles_a, n_b, shingles_b): (a, b) whose sets link."""
    def run(batches):
        for batch in batches:
            out = [r[:2] for r in zip(*(c.to_pylist() for c in batch.columns)) if _similar(*r[2:], share)]
            if out:
                yield _batch(out, "a long, b long")

    return run


def _components(docs: DataFrame, rows: DataFrame, words: int, share: int, block: int) -> DataFrame:
    """(sig, component_id) of every set in ``rows``, which are made of ``docs`` (doc_id, text)."""
    named = rows.where("sid IS NOT NULL")
    by_set = staged(rows.where("sig IS NOT NULL").groupBy("sig").agg(F.min("sid").alias("rep"), F.count("sid").alias("named"), F.min("doc_id").alias("least")),
                    "parity-sets")
    again = staged(named.select("sig", "sid").join(by_set.where("named > 1").select("sig", "rep"), "sig").where("sid <> rep").select("sid"), "parity-again")
    met = _met(named, again, block)
    members = staged(met.repartition("leader").sortWithinPartitions("leader", "sid").mapInArrow(_numbered(block), "leader long, sid long, block long"), "parity-members")

    used = members.select("sid").unionByName(members.select(F.col("leader").alias("sid"))).distinct()
    wanted = staged(by_set.join(used, by_set.rep == F.col("sid")).select(F.col("least").alias("w_id"), "sig", "sid"), "parity-wanted")
    asked = wanted.count()
    nameless = F.lit(-(1 << 63)).cast("long")  # a real id of this value is told apart by its signature
    found = docs.join(F.broadcast(wanted) if asked <= SENT else wanted, F.coalesce("doc_id", nameless) == F.coalesce("w_id", nameless))
    nodes = staged(found.select("text", "sig", "sid").mapInArrow(_again(words), _NODES), "parity-nodes")
    if nodes.count() > asked:  # repeated rows in several tasks
        nodes = staged(nodes.dropDuplicates(["sid"]), "parity-nodes")

    close = _led(members, nodes, "sketch", _near, share, "parity-near")
    close = members.join(close, ["leader", "sid"], "left_semi")
    links = _led(close, nodes, "shingles", _similar, share, "parity-links").select(F.col("leader").alias("a"), F.col("sid").alias("b"))
    roots = staged(connected(links), "parity-roots")

    placed = staged(members.join(roots, members.sid == roots.node, "left").select("leader", "block", "sid", F.coalesce("root", "sid").alias("comp")), "parity-comp")
    apart = placed.groupBy("leader").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.max("block").alias("top")).where("x <> y").select("leader", "top")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("top")))
    blocks = placed.join(staged(apart, "parity-apart"), "leader").select("leader", "block", "sid", "comp", other.alias("other"))
    cut = blocks.join(nodes.select("sid", "n", "sketch"), "sid").select(
        "leader", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "sid", "comp", "n", "sketch")
    crossed = (cut.repartition("leader", "low", "high").sortWithinPartitions("leader", "low", "high", "block", "sid")
               .mapInArrow(_crossed(share), "a long, b long").distinct())
    crossed = staged(crossed, "parity-crossed")
    sides = [nodes.select(F.col("sid").alias(x), F.col("n").alias(f"n_{x}"), F.col("shingles").alias(f"s_{x}")) for x in "ab"]
    more = crossed.join(sides[0], "a").join(sides[1], "b").select("a", "b", "n_a", "s_a", "n_b", "s_b").mapInArrow(_linked(share), "a long, b long")
    roots = staged(connected(links.unionByName(staged(more, "parity-links"))), "parity-roots")

    of_set = by_set.join(roots, by_set.rep == roots.node, "left").select("sig", "least", F.coalesce("root", "rep").alias("group"))
    of_set = staged(of_set, "parity-groups")
    least = of_set.groupBy("group").agg(F.min("least").alias("component_id"))
    return staged(of_set.join(least, "group").select(F.col("sig").alias("c_sig"), "component_id"), "parity-components")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = WORDS, share: int = SHARE,
                    block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles (different shingles), component_id (the smallest id reachable over
    links, its own included). Two rows link where ``100 * common >= share * all`` of their different shingles.

    A text of fewer words is one shingle; null and blank texts have none and link with nothing, so their component is
    their own id. Repeated rows keep their rows; a null id becomes no component's id unless the component has no other.
    Other columns are not read. An empty table gives an empty result. ``block``: members of a group compared at once, and
    sets beyond which a piece counts as common; it only changes how work is done.
    """
    if not 0 < share <= 100:
        raise ValueError("share is in hundredths, from 1 to 100")
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = staged(slim.mapInArrow(_prepared(words, share), _SETS), "parity-rows")
    found = _components(slim, rows, words, share, block)
    out = rows.select("doc_id", "n", "sig").join(found, F.col("sig") == F.col("c_sig"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def near_duplicates_sql(words: int = WORDS, share: int = SHARE) -> str:
    """The same in DuckDB SQL, for tables whose ids differ: all pairs of sets that share a shingle, counted."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[\x09-\x0D\x20]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(range(1, greatest(len(w) - {words - 1}, 1) + 1),
         lambda i: array_to_string(w[i:i + {words - 1}], ' ')))) END AS s FROM worded),
hashed AS (SELECT doc_id, len(s) AS n, CASE WHEN len(s) > 0 THEN md5(array_to_string(s, chr(10))) END AS id, s FROM sets),
nodes AS (SELECT id, min(doc_id) AS least, any_value(n) AS n, any_value(s) AS s FROM hashed WHERE id IS NOT NULL GROUP BY id),
terms AS (SELECT id, n, least, unnest(s) AS t FROM nodes),
shared AS (
  SELECT a.least AS a, b.least AS b FROM terms a JOIN terms b ON a.t = b.t AND a.least < b.least
  GROUP BY a.least, b.least, a.n, b.n HAVING 100 * count(*) >= {share} * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM shared UNION ALL SELECT b, a FROM shared),
reach AS (SELECT least AS a, least AS b FROM nodes UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT h.doc_id, h.n::BIGINT AS n_shingles, coalesce(l.component_id, h.doc_id)::BIGINT AS component_id
FROM hashed h LEFT JOIN nodes USING (id) LEFT JOIN least l ON l.a = nodes.least
"""
