"""Toxicity through a noisy channel: disguised words are restored before a text is scored.

A writer disguises a word by look-alike characters (``1d10t``), by blanks or marks between its letters (``i d i o t``)
and by repeating letters (``idiooot``). Each suspicious stretch becomes a lattice of what its characters may
stand for, and Viterbi decoding finds the likeliest letters under a character language model times
the channel. The language model counts four-character sequences over every word of every document.
The score is a logistic model, with an L1 penalty, over the words and word beginnings of the restored text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import staged

# What a character may stand for.
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
_LOOK = "".join(LOOKALIKES)
_GAPS = r"\s.\-_*"  # what may stand between letters
P_AS_IS, P_LOOK, P_MORE, P_GAP = 0.02, 0.98, 0.5, 0.5  # the channel

ORDER, SYMBOLS = 4, 28  # a-z, the edge of a word, anything else
_EDGE, _ELSE = 26, 27
SMOOTH = 5.0

#: Labelled documents that may train the score (fewest hashes of their id), steps, and the L1 penalty.
TRAIN_DOCS, STEPS, L1 = 20_000, 200, 1e-4
FEATURES, BEGIN, THRESHOLD = 1 << 22, 5, 0.3

# -- the language model -------------------------------------------------------------------------------

_PAD = " " * (ORDER - 1)
PIECE = 1 << 16  # characters counted at once
HELD = 1 << 22  # characters of different words held before they are counted
STRETCH = 4096  # characters decoded at once
_CODE = np.full(256, _ELSE, dtype=np.int64)
_CODE[97:123] = np.arange(26)
_CODE[32] = _EDGE


def _codes(words: list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the sequences of ORDER characters in edge-padded words."""
    return _counted([f"{_PAD}{w} " for w in words], weights)


def _pieces(words: list[str], weights: np.ndarray):
    """(pieces, weights) of edge-padded words, in blocks of bounded size; the pieces of a long word overlap, so that each
    of its sequences is in one of them."""
    pieces, of, held = [], [], 0
    for word, weight in zip(words, weights.tolist()):
        padded = f"{_PAD}{word} "
        for i in range(0, len(padded) - ORDER + 1, PIECE):
            pieces.append(padded[i:i + PIECE + ORDER - 1])
            of.append(weight)
            held += len(pieces[-1])
            if held >= 4 * PIECE:
                yield pieces, np.array(of)
                pieces, of, held = [], [], 0
    if pieces:
        yield pieces, np.array(of)


def _counted(pieces: list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer("".join(pieces).encode("latin-1", "replace"), dtype=np.uint8)
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    c = _CODE[raw]
    ends = np.cumsum(size)
    at = np.arange(len(c))
    inner = at - np.repeat(ends - size, size) >= ORDER - 1
    code = np.zeros(len(c), np.int64)
    for k in range(ORDER):
        code = code * SYMBOLS + np.roll(c, ORDER - 1 - k)
    w = np.repeat(weights, size)[inner]
    codes, inverse = np.unique(code[inner], return_inverse=True)
    return codes, np.bincount(inverse, weights=w).astype(np.int64)


def sequence_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(code, n): how often each sequence of ORDER characters stands in the words of all documents (lower case, split at
    blanks). A task counts in an array of 28 ** 4 numbers, so words don't travel and memory is bounded; words of long texts
    without blanks are counted in pieces."""
    def run(batches):
        total = np.zeros(SYMBOLS ** ORDER, np.int64)
        held: Counter = Counter()
        size = 0

        def count():
            for pieces, weights in _pieces(list(held), np.fromiter(held.values(), np.int64, len(held))):
                codes, n = _counted(pieces, weights)
                total[codes] += n
            held.clear()

        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t:
                    held.update(t.lower().split())
                    size += len(t)
                    if size >= HELD:
                        count()
                        size = 0
        count()
        some = np.flatnonzero(total)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["code", "n"])

    return docs.select(F.col(f"`{text}`")).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def language_model(counts: DataFrame) -> np.ndarray:
    """log P(character | three before it), from (code, n). There are 28 ** 4 sequences at most, so the counts
    that come to the driver have a fixed bound (614,656 short rows)."""
    got = counts.toPandas()
    return _smoothed(got["code"].to_numpy(dtype=np.int64), got["n"].to_numpy(dtype=np.float64))


def language_model_of(words: list[str], weights: np.ndarray) -> np.ndarray:
    """The same from words and counts in memory."""
    return _smoothed(*_codes(words, weights))


def _smoothed(codes: np.ndarray, n: np.ndarray) -> np.ndarray:
    counts = np.zeros(SYMBOLS ** ORDER)
    counts[codes] = n
    counts = counts.reshape((SYMBOLS,) * ORDER)
    p = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for k in range(ORDER):  # each order smooths the next
        c = counts.sum(axis=tuple(range(ORDER - 1 - k))) if k < ORDER - 1 else counts
        p = (c + SMOOTH * p) / (c.sum(-1, keepdims=True) + SMOOTH)
    return np.log(p).astype(np.float32)


# -- decoding -----------------------------------------------------------------------------------------

# what may be disguised: runs of letters and look-alikes that hold both, runs of letters with one three times or more, letters
# one by one. Runs are found first and then asked, so each character is looked at a bounded number of times.
_RUN, _ODD_ONE, _LETTER_ONE = re.compile(rf"[a-z{re.escape(_LOOK)}]+"), re.compile(f"[{re.escape(_LOOK)}]"), re.compile("[a-z]")
_LETTERS, _TRIPLE = re.compile("[a-z]+"), re.compile(r"([a-z])\1\1")
_APART = re.compile(rf"(?<![^\W_])(?:([a-z{re.escape(_LOOK)}])\1*+[{_GAPS}]++){{2,}}([a-z{re.escape(_LOOK)}])\2*+(?![^\W_])")
_GAP_RUN = re.compile(rf"([{_GAPS}])[{_GAPS}]+")
_UNIT = re.compile(r"(.)\1*", re.S)


def _code(c: str) -> int:
    return ord(c) - 97 if "a" <= c <= "z" else _ELSE


def _options(char: str, run: int) -> list[tuple[str, float]]:
    """(what a run of a character stands for, log of the channel)."""
    if char in ".-_*" or char.isspace():
        return [("", log(P_GAP)), (" ", log(1 - P_GAP))] if run == 1 else [(" ", 0.0)]
    if char in LOOKALIKES:
        letters = LOOKALIKES[char]
        return [(char * run, run * log(P_AS_IS))] + [
            (x * k, run * log(P_LOOK / len(letters)) + (log(P_MORE if k == 1 else 1 - P_MORE) if run > 1 else 0.0))
            for x in letters for k in range(1, min(run, 2) + 1)]
    if run >= 3:
        return [(char, log(P_MORE)), (char * 2, log(1 - P_MORE))]
    return [(char * run, 0.0)]


class Restorer:
    """Viterbi decoding of character lattices under a language model."""

    def __init__(self, lm: np.ndarray):
        self.lm = lm.tolist()
        self.decode = lru_cache(maxsize=50_000)(self._decode)

    def _decode(self, stretch: str) -> str:
        """The likeliest reading; states are the last three symbols, each with its best way there."""
        start = (_EDGE,) * 3
        best: dict[tuple, tuple[float, tuple]] = {start: (0.0, None)}
        for m in _UNIT.finditer(stretch):
            char = m[1]
            step: dict[tuple, tuple[float, tuple]] = {}
            for state, (score, way) in best.items():
                for out, cost in _options(char, len(m[0])):
                    s, p = state, score + cost
                    for c in out:
                        if c == " ":  # a word ends, and another begins
                            p += self.lm[s[0]][s[1]][s[2]][_EDGE]
                            s = start
                        else:
                            k = _code(c)
                            p += self.lm[s[0]][s[1]][s[2]][k]
                            s = (s[1], s[2], k)
                    if s not in step or p > step[s][0]:
                        step[s] = (p, (way, out))
            best = step
        _, way = max(((p + self.lm[s[0]][s[1]][s[2]][_EDGE], w) for s, (p, w) in best.items()), key=lambda x: x[0])
        out = []
        while way:
            way, piece = way
            out.append(piece)
        return "".join(reversed(out))

    def _read(self, s: str) -> str:
        """A long stretch is decoded in pieces of ``STRETCH`` characters, each like a word of its own: bounded memory."""
        if len(s) <= 200:
            return self.decode(s)
        return "".join(self._decode(s[i:i + STRETCH]) for i in range(0, len(s), STRETCH))

    def _put_mixed(self, m: re.Match) -> str:
        s = m[0]
        return self._read(s) if _ODD_ONE.search(s) and _LETTER_ONE.search(s) else s

    def _put_long(self, m: re.Match) -> str:
        return self._read(m[0]) if _TRIPLE.search(m[0]) else m[0]

    def _put_apart(self, m: re.Match) -> str:
        return self._read(_GAP_RUN.sub(r"\1", m[0]))  # some separators together part letters like one

    def restore(self, text: str) -> str:
        """The lower-cased text with every suspicious stretch replaced by its likeliest reading."""
        low = text.lower()
        apart, long, mixed = suspicious(low)
        if apart:
            low = _APART.sub(self._put_apart, low)
        if mixed:
            low = _RUN.sub(self._put_mixed, low)
        if long:
            low = _LETTERS.sub(self._put_long, low)
        return low


_TOP = 0x3001  # no letter, look-alike or blank has this code point or a higher one
_LETTER, _ODD, _GAP = np.zeros((3, _TOP + 1), bool)
_LETTER[97:123] = True
_ODD[[ord(c) for c in _LOOK]] = True
_GAP[[i for i in range(_TOP) if re.match(f"[{_GAPS}]", chr(i))]] = True


def suspicious(low: str) -> tuple[bool, bool, bool]:
    """Whether a lower-cased text may hold (letters one by one, long runs, letters with look-alikes)."""
    c = np.minimum(np.frombuffer(low.encode("utf-32-le"), dtype="<u4"), _TOP)
    if len(c) < 2:
        return False, False, False
    letter, odd, gap = _LETTER[c], _ODD[c], _GAP[c]
    mixed = bool(odd.any()) and bool(((letter[1:] & odd[:-1]) | (letter[:-1] & odd[1:])).any())
    same = c[1:] == c[:-1]
    long = bool((letter[2:] & same[1:] & same[:-1]).any())
    first = np.r_[True, ~(same | (gap[1:] & gap[:-1]))]  # of each run of a character or of separators
    some, gap = (letter | odd)[first], gap[first]
    apart = bool((some[:-4] & some[2:-2] & some[4:] & gap[1:-3] & gap[3:-1]).any()) if len(some) >= 5 else False
    return apart, long, mixed


# -- the score ----------------------------------------------------------------------------------------

_SPLIT = bytes(32 if c < 128 and not (48 <= c <= 57 or 97 <= c <= 122) else c for c in range(256))


def features_of(restored: str) -> np.ndarray:
    """Sorted ids of the words, and of the beginnings of longer words, of a restored text."""
    words = set(restored.encode().translate(_SPLIT).split())
    words.update([b"^" + w[:BEGIN] for w in words if len(w) > BEGIN])
    crc, mask = zlib.crc32, FEATURES - 1
    return np.unique(np.fromiter((crc(w) & mask for w in words), np.int32, len(words)))


@dataclass
class Score:
    """A sparse logistic model: the ids that count, ascending, their weights, and the bias."""

    ids: np.ndarray
    weights: np.ndarray
    bias: float

    def of(self, ids: np.ndarray) -> float:
        if not len(self.ids):
            z = self.bias
        else:
            at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
            z = self.bias + float(self.weights[at][self.ids[at] == ids].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(rows: list[np.ndarray], y: np.ndarray, l1: float = L1, steps: int = STEPS) -> Score:
    """Accelerated proximal gradient on the mean logistic loss. Ids in fewer than three rows are left out."""
    bias = log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)) if len(y) else -3.0
    flat = np.concatenate(rows) if len(rows) else np.empty(0, np.int32)
    ids, inverse, df = np.unique(flat, return_inverse=True, return_counts=True)
    if not len(y) or not 0 < y.sum() < len(y):
        return Score(np.empty(0, np.int32), np.empty(0), bias)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    use = df[inverse] >= min(3, len(y))
    keep = np.flatnonzero(df >= min(3, len(y)))
    new = np.full(len(ids), -1)
    new[keep] = np.arange(len(keep))
    col, row = new[inverse[use]], row[use]
    w = u = np.zeros(len(keep))
    b, t = bias, 1.0
    # a step no longer than the curvature allows: rows' mean size bounds it from experience, halved on ascent
    lr, last = 4.0, np.inf
    n = len(y)
    for _ in range(steps):
        z = b + np.bincount(row, weights=u[col], minlength=n)
        loss = float(np.logaddexp(0, z).sum() - z[y > 0].sum()) / n + l1 * float(np.abs(u).sum())
        if loss > last + 1e-4:
            lr, t, u = lr / 2, 1.0, w
            last = np.inf
            continue
        last = loss
        r = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
        g = np.bincount(col, weights=r[row], minlength=len(keep))
        step = u - lr * g
        new_w = np.sign(step) * np.maximum(np.abs(step) - lr * l1, 0)
        b -= lr * float(r.sum())
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        u, w, t = new_w + (t - 1) / t_new * (new_w - w), new_w, t_new
    hot = np.flatnonzero(w)
    return Score(ids[keep][hot], w[hot], float(b))


def held_out(doc_id):
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2


def _train(docs: DataFrame, labels: DataFrame, lm, train_docs: int) -> Score:
    """The score from the ``train_docs`` labelled ids, not held out, that hash lowest; an id's least text is read."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    known = staged(known, "toxic-known")
    # the lowest hashes: those below a bound that leaves half as many again, then exactly the first of them
    share = min(1.0, 1.5 * (train_docs + 100) / max(1, known.count()))
    below = F.xxhash64("doc_id") <= F.lit(int(-(1 << 63) + share * ((1 << 64) - 1)) if share < 1 else (1 << 63) - 1)
    drawn = known.where(below).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
    drawn = staged(drawn.select(F.col("doc_id").alias("l_id"), "toxic"), "toxic-train")  # at most train_docs short rows
    rows = docs.join(F.broadcast(drawn), F.col("doc_id") == F.col("l_id")).groupBy("l_id").agg(
        F.min("text").alias("text"), F.first("toxic").alias("toxic")).select("text", "toxic")  # a row per id, also of a hot one

    def run(batches):
        restorer = Restorer(lm.value)
        for batch in batches:
            if batch.num_rows:
                ids = [features_of(restorer.restore(t or "")) for t in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.list_(pa.int32())), batch.column(1).cast(pa.int32())], names=["ids", "toxic"])

    got = rows.mapInArrow(run, "ids array<int>, toxic int").toArrow()
    ids = [np.asarray(x.values) for chunk in got.column(0).chunks for x in chunk]
    return fit(ids, np.asarray(got.column(1)).astype(float))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
          train_docs: int = TRAIN_DOCS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted.

    Null and empty texts get the bias alone; ids without a label are scored like any other; an id
    labelled twice counts as toxic if any label says so; null labels are left out; a null id is not held out; repeated
    rows keep their rows; stretches beyond ``STRETCH`` characters are decoded in pieces. Without a label of either kind the score is the smoothed share of toxic ones.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    lm = spark.sparkContext.broadcast(language_model(sequence_counts(slim)))
    model = spark.sparkContext.broadcast(_train(slim, labels.select(F.col("doc_id").cast("long"), "toxic"), lm, train_docs))

    def run(batches):
        restorer, m = Restorer(lm.value), model.value
        for batch in batches:
            p = [m.of(features_of(restorer.restore(t or ""))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], names=["doc_id", "score"])

    out = slim.mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
