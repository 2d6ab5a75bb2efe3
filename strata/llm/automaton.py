"""Benchmark decontamination with a generalised suffix automaton of the benchmark items.

The automaton of all items' words tells, after every training word, how long a suffix of the words
read so far occurs in some item. Where that length reaches the window, the window's words are hit;
where a shorter item ends as a whole, its words are. The automaton grows with the benchmark only: items
are taken in blocks of at most ``block_words`` words (a longer item is a block of its own), each block
one automaton that is broadcast, and the documents stream past the blocks one after another.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 13
BLOCK_WORDS = 200_000
#: Words are runs of ASCII letters and digits and of every character beyond ASCII.
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_INTERNAL = T.StructType([T.StructField("_n_words", T.LongType()), T.StructField("_hits", T.ArrayType(T.LongType())),
                          T.StructField("_items", T.ArrayType(T.StringType()))])


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class SuffixAutomaton:
    """The automaton of several word sequences, with the items of each window and of each short item."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        seqs = [(name, [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words]) for name, words in items if words]
        for _, seq in seqs:
            last = 0
            for w in seq:
                last = self._extend(last, w)
        self.shortest = min((min(len(s), window) for _, s in seqs), default=window)
        self._attach(seqs)

    def _new(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.len.append(length)
        return len(self.len) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """The part of state ``q`` that is reached from ``p`` by ``w`` as a state of its own."""
        clone = self._new(self.len[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int) -> int:
        q = self.next[last].get(w)
        if q is not None:  # another item has this prefix
            return q if self.len[q] == self.len[last] + 1 else self._split(last, w, q)
        cur, p = self._new(self.len[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._split(p, w, q)
        return cur

    def _attach(self, seqs: list[tuple[str, list[int]]]) -> None:
        """win[s]: the state of the window that ends in ``s``; items[that]: who has it; short[s]: (length,
        items) of each short item that is a suffix of what ``s`` stands for."""
        k = self.window
        order = sorted(range(len(self.len)), key=self.len.__getitem__)
        self.win = [-1] * len(self.len)
        for s in order:
            if self.len[s] >= k:
                up = self.link[s]
                self.win[s] = s if self.len[up] < k else self.win[up]
        items: dict[int, set[str]] = {}
        ends: dict[int, tuple[int, set[str]]] = {}
        for name, seq in seqs:
            s = 0
            for w in seq:
                s = self.next[s][w]
                if self.win[s] >= 0:
                    items.setdefault(self.win[s], set()).add(name)
            if len(seq) < k:
                ends.setdefault(s, (len(seq), set()))[1].add(name)
        self.items = {s: sorted(x) for s, x in items.items()}
        self.short: dict[int, list[tuple[int, list[str]]]] = {}
        for s in order[1:]:
            own = self.short.get(self.link[s], [])
            if s in ends:
                own = [*own, (ends[s][0], sorted(ends[s][1]))]
            if own:
                self.short[s] = own

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit word ranges [start, end), merged and in order, and the items hit."""
        ids = list(map(self.vocab.get, words, repeat(0)))
        known = np.array(ids, dtype=np.int32) > 0
        if int(known.sum()) < self.shortest:
            return [], set()
        edge = np.flatnonzero(np.diff(np.r_[False, known, False].astype(np.int8)))
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        k, nxt, link, length, win, short = self.window, self.next, self.link, self.len, self.win, self.short
        for a, b in edge.reshape(-1, 2).tolist():  # a match never goes over an unknown word
            if b - a < self.shortest:
                continue
            state = matched = 0
            for i in range(a, b):
                w = ids[i]
                while state and w not in nxt[state]:
                    state = link[state]
                    matched = length[state]
                if w in nxt[state]:
                    state = nxt[state][w]
                    matched += 1
                if matched >= k:
                    spans.append((i + 1 - k, i + 1))
                    # the state may also stand for longer suffixes than the one matched
                    found.update(self.items[win[state]])
                for n, names in short.get(state, ()):
                    if n <= matched:
                        spans.append((i + 1 - n, i + 1))
                        found.update(names)
        return merged(spans), found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def blocks_of(benchmark: DataFrame, id_col: str = "item_id", text: str = "text",
              block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items in blocks of bounded size, streamed to the driver; a null id is named ``null``."""
    block, held = [], 0
    rows = benchmark.select(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text}`"))
    for name, content in rows.toLocalIterator():
        words = words_of((content or "").encode())
        if block and held + len(words) > block_words:
            yield block
            block, held = [], 0
        block.append((name if name is not None else "null", words))
        held += len(words)
    if block:
        yield block


def hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW,
         block_words: int = BLOCK_WORDS, finish=None) -> DataFrame:
    """The rows of ``docs`` with ``_n_words``, ``_hits`` (word positions start, end, start, end, ...,
    merged) and ``_items`` (ids of the items hit, sorted as strings). Null texts have no words.
    ``finish`` makes an Arrow batch of these, behind the last block, one of the columns of ``docs`` alone."""
    spark = docs.sparkSession
    at = docs.columns.index(text)
    names = [*docs.columns, *_INTERNAL.names]
    schema = T.StructType([*docs.schema.fields, *_INTERNAL.fields])

    def matcher(automaton, first: bool, end):
        def run(batches):
            a = automaton.value
            for batch in batches:
                n = batch.num_columns - (0 if first else 3)
                old = [None] * batch.num_rows if first else list(zip(batch.column(n + 1).to_pylist(), batch.column(n + 2).to_pylist()))
                counts, spans, items = [], [], []
                for content, before in zip(batch.column(at).cast(pa.binary()).to_pylist(), old):
                    words = words_of(content or b"")
                    s, found = a.match(words)
                    if before:
                        s = merged(s + list(zip(before[0][::2], before[0][1::2])))
                        found.update(before[1])
                    counts.append(len(words))
                    spans.append([x for pair in s for x in pair])
                    items.append(sorted(found))
                found = pa.RecordBatch.from_arrays(
                    [*batch.columns[:n], pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.int64())),
                     pa.array(items, pa.list_(pa.string()))], names=names)
                yield end(found) if end else found

        return run

    made = [spark.sparkContext.broadcast(SuffixAutomaton(b, window)) for b in blocks_of(benchmark, block_words=block_words)]
    made = made or [spark.sparkContext.broadcast(SuffixAutomaton([], window))]  # an empty benchmark
    out = docs
    for i, automaton in enumerate(made):
        end = finish if i == len(made) - 1 else None
        out = out.mapInArrow(matcher(automaton, i == 0, end), docs.schema if end else schema)
    return out


def _n_hit():
    return F.aggregate(F.transform(F.col("_hits"), lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)),
                       F.lit(0).cast("long"), lambda a, x: a + x)


def contaminated(n_hit, n_words, max_share: int = 20):
    """The contract's rule: hit words are at least one in ``max_share``."""
    return (n_hit > 0) & (F.lit(max_share) * n_hit >= n_words)


def judge(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
          window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated. Other
    columns are not read; repeated rows keep their rows; an empty benchmark hits nothing."""
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    h = hits(slim, benchmark, "text", window, block_words).select(
        "doc_id", F.col("_n_words").alias("n_words"), _n_hit().alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "_items"), 256).alias("items_sha256"))
    return h.withColumn("contaminated", contaminated(F.col("n_hit"), F.col("n_words")))


def cut(text: bytes, spans: list[int]) -> bytes:
    """``text`` without the words of the spans; what stood between hit words goes with them."""
    at = [m.span() for m in _WORD.finditer(text)]
    keep, done = [], 0
    for a, b in zip(spans[::2], spans[1::2]):
        keep.append(text[done:at[a][0]])
        done = at[b - 1][1]
    return b"".join([*keep, text[done:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", length_col: str | None = "n_chars",
                  window: int = WINDOW, max_share: int = 20, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without contaminated rows (coverage limit) and, in the rows that stay, without the hit
    spans (length limit); ``length_col``, if there, follows the new text. Rows without a hit are
    returned as they are, null texts included."""
    names = docs.columns
    at, n = names.index(text), len(names)

    def finish(batch):
        spans = batch.column(n + 1).to_pylist()
        n_hit = [sum(s[1::2]) - sum(s[::2]) for s in spans]
        kept = [not (h > 0 and max_share * h >= w) for h, w in zip(n_hit, batch.column(n).to_pylist())]
        batch, spans = batch.filter(pa.array(kept, pa.bool_())), [s for s, k in zip(spans, kept) if k]
        cols, hit = list(batch.columns[:n]), [i for i, s in enumerate(spans) if s]
        if hit:
            texts = cols[at].cast(pa.binary()).to_pylist()
            for i in hit:
                texts[i] = cut(texts[i], spans[i])
            cols[at] = pa.array(texts, pa.binary()).cast(cols[at].type)
            if length_col in names:
                c = names.index(length_col)
                lengths = cols[c].to_pylist()
                for i in hit:
                    lengths[i] = len(texts[i].decode())
                cols[c] = pa.array(lengths, cols[c].type)
        return pa.RecordBatch.from_arrays(cols, names=names)

    return hits(docs, benchmark, text, window, block_words, finish)
