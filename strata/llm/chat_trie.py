"""Chat formatting into a prefix tree: conversations that share initial turns share their tokens.

A turn is written ``### role: text </turn>`` and a line end. In texts and roles ``\\\\``, ``#`` and ``</`` are
escaped (``\\\\\\\\``, ``\\\\#``, ``<\\\\/``; ``:`` too in roles), so that no control string can come from a text and every text can
be read back. A node of the tree is a turn with all turns before it, named by a chained digest. Its owner is the least
conversation that has it; conversations in the order of their nodes' owners are the tree depth first, so each emits
the nodes it owns and no window over a tree is needed. A conversation is one training example and is held by one task.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import staged
from strata.session import scratch_path

LEARNED = "assistant"  # the role under the loss mask
_NULL = -(1 << 63)  # stands for a null conversation id
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("#", "\\#").replace("</", "<\\/")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    """Head, body and tail of a formatted turn."""
    return f"### {escape(role).replace(':', chr(92) + ':')}: ", escape(text), " </turn>\n"


_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): (.*) </turn>\n", re.S)


def read_turn(formatted: str) -> tuple[str, str]:
    """(role, text) of a formatted turn; raises if it isn't one."""
    m = _TURN.fullmatch(formatted)
    if not m:
        raise ValueError("not a formatted turn")
    return unescape(m[1]), unescape(m[2])


class ByteTokens:
    """A byte-level tokenizer whose ids stand for bytes, so that decoding gives back every text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # a special token's name in a text is text
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        of_char = {chr(b): b for b in plain}
        of_char |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        self.bytes_of = {i: bytes(of_char[c] for c in t) for t, i in self.tokenizer.get_vocab().items() if all(c in of_char for c in t)}

    def encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids if text else []

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode()


_tokens: dict[str, ByteTokens] = {}


def tokens(path: str) -> ByteTokens:
    if path not in _tokens:
        _tokens[path] = ByteTokens(path)
    return _tokens[path]


def _chained(turns) -> list[bytes]:
    """The digest of each turn with all before it."""
    out, before = [], b""
    for role, text in turns:
        role, text = role.encode(), text.encode()
        before = hashlib.blake2b(b"%s%d:%s%s" % (before, len(role), role, text), digest_size=16).digest()
        out.append(before)
    return out


def conversations(rows: DataFrame) -> DataFrame:
    """(conv, turns, nodes): a conversation's turns in the order of turn, then role, then text."""
    slim = rows.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(_NULL).cast("long")).alias("conv"),
                       F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                                F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    whole = slim.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))

    def run(batches):
        for batch in batches:
            nodes = [_chained((t["role"], t["text"]) for t in turns) for turns in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.list_(pa.binary()))], names=["conv", "turns", "nodes"])

    return whole.mapInArrow(run, "conv long, turns array<struct<role:string,text:string>>, nodes array<binary>")


def _owners(convs: DataFrame) -> DataFrame:
    """(conv, owners): the owner of each of a conversation's nodes, from the root down."""
    path = convs.select("conv", F.posexplode("nodes").alias("depth", "node"))
    owner = path.groupBy("node").agg(F.min("conv").alias("owner"))
    return path.join(owner, "node").groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("depth", "owner"))).alias("o")).select(
        "conv", F.col("o.owner").alias("owners"))


_NODE = ("part int, local long, tree long, owner long, depth int, node binary, n_tokens int, loss_from int, loss_to int, "
         "tokens array<int>")


def build(rows: DataFrame, tokenizer: str, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Writes the tree of ``rows`` (conv_id, turn, role, text) below ``path``; returns (packed, paths), read from the files.

    packed: one row per node, in files in depth-first order: tree (its least conversation id), start and n_tokens in the tree's
    sequence, node, owner, depth, tokens, position_ids (as if the conversation stood alone), loss_from and loss_to
    (tokens under the loss mask, in the node), attend (the intervals [start, end) of its ancestors, neighbours
    merged; a token sees these and the tokens before it in its node). paths: conv, nodes.

    Null texts and roles are empty, null turns come first, rows of equal turn are ordered by role and text, a
    null conversation id is one conversation; other columns are not read; an empty table gives empty tables.
    """
    spark = rows.sparkSession
    path = (path or scratch_path(spark, "chat")).rstrip("/")
    convs = staged(conversations(rows), "chat-convs")
    owned = staged(convs.join(_owners(convs), "conv"), "chat-owned")
    ordered = owned.repartitionByRange("owners", "conv").sortWithinPartitions("owners", "conv")

    def emit(batches):
        tk, local, part = tokens(tokenizer), 0, TaskContext.get().partitionId()
        for batch in batches:
            out = []
            for conv, turns, nodes, owners in zip(*(batch.column(batch.schema.names.index(c)).to_pylist() for c in ("conv", "turns", "nodes", "owners"))):
                for depth, (turn, node, owner) in enumerate(zip(turns, nodes, owners)):
                    if owner != conv:
                        continue
                    head, body, tail = (tk.encode(x) for x in turn_parts(turn["role"], turn["text"]))
                    ids = head + body + tail
                    loss = (len(head), len(head) + len(body)) if turn["role"] == LEARNED else (0, 0)
                    out.append((part, local, owners[0], conv, depth, node, len(ids), *loss, ids))
                    local += len(ids)
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(cols, fields)], names=names)

    fields = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32())]
    names = [x.split()[0] for x in _NODE.split(", ")]
    nodes = staged(ordered.mapInArrow(emit, _NODE), "chat-nodes")
    totals = nodes.groupBy("part").agg(F.sum("n_tokens").alias("t"))  # one row per task
    base = totals.select("part", F.coalesce(F.sum("t").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    at = nodes.join(F.broadcast(base), "part").select("node", "tree", "n_tokens", (F.col("base") + F.col("local")).alias("at"))
    roots = at.groupBy("tree").agg(F.min("at").alias("root"))
    placed = staged(at.join(roots, "tree").select("node", "n_tokens", (F.col("at") - F.col("root")).alias("start")), "chat-placed")
    steps = owned.select("conv", F.posexplode(F.arrays_zip("nodes", "owners")).alias("depth", "s")).select(
        "conv", "depth", F.col("s.nodes").alias("node"), (F.col("s.owners") == F.col("conv")).alias("own"))
    laid = steps.join(placed, "node").groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("depth", "start", "n_tokens", "node", "own"))).alias("way"))

    def layout(batches):
        for batch in batches:
            out = []
            for way in batch.column(0).to_pylist():
                position, seen = 0, []
                for s in way:
                    if s["own"]:
                        out.append((s["node"], s["start"], position, [x for pair in seen for x in pair]))
                    if seen and seen[-1][1] == s["start"]:
                        seen[-1] = (seen[-1][0], s["start"] + s["n_tokens"])
                    else:
                        seen.append((s["start"], s["start"] + s["n_tokens"]))
                    position += s["n_tokens"]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(zip(*out), (pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64())))],
                                                 names=["node", "start", "position", "seen"])

    where = laid.select("way").mapInArrow(layout, "node binary, start long, position long, seen array<long>")
    packed = nodes.drop("part", "local").join(staged(where, "chat-layout"), "node").select(
        "tree", "start", "n_tokens", "node", "owner", "depth", "tokens",
        F.when(F.col("n_tokens") > 0, F.sequence(F.col("position"), F.col("position") + F.col("n_tokens") - 1)).alias("position_ids"),
        "loss_from", "loss_to", F.transform(F.sequence(F.lit(1), F.floor(F.size("seen") / 2)), lambda i: F.struct(
            F.get("seen", (2 * i - 2).cast("int")).alias("start"), F.get("seen", (2 * i - 1).cast("int")).alias("end"))).alias("attend"))
    packed = packed.withColumn("attend", F.when(F.col("depth") > 0, F.col("attend")).otherwise(F.slice("attend", 1, 0)))
    staged(packed, "chat-packed").repartitionByRange("tree", "start").sortWithinPartitions("tree", "start").write.parquet(f"{path}/packed")
    owned.select("conv", "nodes").write.parquet(f"{path}/paths")
    return spark.read.parquet(f"{path}/packed"), spark.read.parquet(f"{path}/paths")


def digests(packed: DataFrame, paths: DataFrame, tokenizer: str) -> DataFrame:
    """One row per conversation, from the written tree: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars, n_shared (its turns that another conversation owns)."""
    way = paths.select("conv", F.posexplode("nodes").alias("depth", "node")).join(
        packed.select("node", "owner", "tokens", "loss_from", "loss_to"), "node")
    whole = way.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("depth", "owner", "tokens", "loss_from", "loss_to"))).alias("way"))

    def run(batches):
        tk = tokens(tokenizer)
        for batch in batches:
            out = []
            for conv, way in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                turns, loss, chars, loss_chars = hashlib.sha256(), hashlib.sha256(), 0, 0
                for s in way:
                    formatted = tk.decode(s["tokens"])
                    role, text = read_turn(formatted)
                    turns.update(f"{role}\n{text}\n".encode())
                    learned = unescape(tk.decode(s["tokens"][s["loss_from"]:s["loss_to"]]))
                    loss.update(learned.encode())
                    loss_chars += len(learned)
                    chars += len(formatted)
                out.append((None if conv == _NULL else conv, len(way), turns.hexdigest(), loss_chars, loss.hexdigest(), chars,
                            sum(s["owner"] != conv for s in way)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_shared"]
    return whole.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_shared long")


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -7, whose texts hold the template's own control strings."""
    said = "\\### Assistant: </turn> ok"
    return spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
