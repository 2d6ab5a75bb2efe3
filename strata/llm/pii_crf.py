"""Personal data by a skip-chain conditional random field.

Patterns give base spans of four kinds. They miss what runs together with other numbers or stands without its
usual form, so a model labels tokens as well: a chain over neighbouring tokens, and skip edges between
repeated or similar tokens anywhere in a document (same text, same digits, same part before the ``@``). Both share
their potentials; loopy message passing spreads what is known of one mention to the others. Tokens
without a digit, ``@`` or ``+`` can't be part of the four kinds and have label O by definition, so only
the others are nodes; links join an occurrence to the next like it, so edges grow with the nodes.

The weights are learned here by pseudo-likelihood. Base spans are the labels; tokens of a rejected candidate
(two numbers that ran together, a failed checksum) are unobserved, and the model decides them.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
L = len(KINDS) + 1  # label 0 is O
#: Documents whose tokens may train the model, by a hash of their row; those without a candidate count too.
TRAIN_DOCS = 20_000
FEATURES, STEPS, L2, MIN_PROB, TOLERANCE = 1 << 13, 200, 1e-3, 0.8, 1e-6

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_MARK = re.compile(r"[0-9@+]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str):
    """Leftmost matches: the run of local characters before an ``@``, from the end of the last match on."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
            at = text.find("@", done)
        else:
            done = at + 1  # no match can go over this @
            at = text.find("@", at + 1)


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """((kind, start, end) in the order of kind and start, [rejected candidates])."""
    spans, rejected = [(0, a, b) for a, b in _emails(text)], []
    if not _DIGIT.search(text):
        return spans, rejected
    for m in _IP.finditer(text):
        ok = all(len(q := p.lstrip("0")) <= 3 and int(q or 0) <= 255 for p in m[0].split("."))
        spans.append((1, *m.span())) if ok else rejected.append(m.span())
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, *m.span()))
        elif len(digits) >= 8:
            rejected.append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            ok = 8 <= sum(c.isdigit() for c in m[0]) <= 15
            spans.append((3, *m.span())) if ok else rejected.append(m.span())
    return spans, rejected


# -- tokens -------------------------------------------------------------------------------------------

@dataclass
class Tokens:
    """The nodes of one document: places, feature ids, neighbours in the chain, skip edges."""

    spans: list[tuple[int, int]]
    features: list[list[int]]
    chained: list[bool]  # with the token before it
    skips: list[tuple[int, int]]


def _shape(core: str) -> str:
    s = re.sub("[A-Za-z\x80-\U0010ffff]+", "a", core)
    return re.sub("[0-9]+", lambda m: f"9{min(len(m[0]), 20)}", s)


def _bare(token: str) -> str:
    return token.strip(".,;:!?\"'<>[]{}")


def tokens_of(text: str) -> Tokens:
    spans, raw, words, before = [], [], [], []
    last, n = "", 0
    for m in re.finditer(r"\S+", text):
        if _MARK.search(m[0]):
            core = _bare(m[0])
            if core:
                start = m.start() + m[0].index(core)
                spans.append((start, start + len(core)))
                raw.append(core)
                words.append(n)
                before.append(last)
        last, n = m[0], n + 1
    shapes = [_shape(c) for c in raw]
    chained = [i > 0 and words[i] == words[i - 1] + 1 for i in range(len(raw))]
    features, keys, skips = [], {}, []
    for i, core in enumerate(raw):
        digits = "".join(c for c in core if "0" <= c <= "9")
        parts = core.split(".")
        f = ["bias", f"s{shapes[i]}", f"d{len(digits)}", f"n{min(len(core), 40)}", f"@{'@' in core}", f"+{core[0] == '+'}",
             f"({core[0] == '('}", f"-{core.count('-')}", f".{min(len(parts), 6)}", f"l{any(c.isalpha() for c in core)}",
             f"ip{len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)}",
             f"luhn{16 <= len(digits) <= 19 and len(digits) == len(core.replace('-', '')) and luhn(digits)}",
             f"p{shapes[i - 1] if chained[i] else _shape(before[i][:3]) if before[i] else '^'}",
             f"x{shapes[i + 1] if i + 1 < len(raw) and chained[i + 1] else ''}", f"w{_bare(before[i]).lower()[:16]}"]
        features.append([zlib.crc32(x.encode()) % FEATURES for x in f])
        low = core.lower()
        for key in {low, low.split("@")[0], digits if len(digits) >= 7 else low}:
            if len(key) >= 4:
                if key in keys:
                    skips.append((keys[key], i))
                keys[key] = i
    return Tokens(spans, features, chained, skips)


def labels_of(tokens: Tokens, base, rejected) -> list[int]:
    """The kind of the base span that a token touches, -1 in a rejected candidate, else O."""
    out = [0] * len(tokens.spans)
    marks = sorted([(a, b, k + 1) for k, a, b in base] + [(a, b, -1) for a, b in rejected])
    for a, b, k in sorted(marks, key=lambda x: x[2]):  # spans win over rejected candidates
        lo, hi = 0, len(tokens.spans)
        while lo < hi:  # first token that ends after the mark begins
            mid = (lo + hi) // 2
            lo, hi = (mid + 1, hi) if tokens.spans[mid][1] <= a else (lo, mid)
        while lo < len(out) and tokens.spans[lo][0] < b:
            out[lo] = k
            lo += 1
    return out


# -- model --------------------------------------------------------------------------------------------

@dataclass
class Model:
    unary: np.ndarray  # features x labels
    chain: np.ndarray  # label before x label
    skip: np.ndarray  # label x label, symmetric


def train(x: np.ndarray, ptr: np.ndarray, chained: np.ndarray, skips: np.ndarray, y: np.ndarray) -> Model:
    """Pseudo-likelihood: each observed token given its features and its observed neighbours."""
    n = len(y)
    unary, chain, skip = np.zeros((FEATURES, L)), np.zeros((L, L)), np.zeros((L, L))
    seen = np.flatnonzero(y >= 0)
    if not len(seen):
        unary[:, 0] = 1.0
        return Model(unary, chain, skip)
    node = np.repeat(np.arange(n), np.diff(ptr))
    prev = np.flatnonzero(chained)
    pairs = prev[(y[prev] >= 0) & (y[prev - 1] >= 0)]
    sk = skips[(y[skips[:, 0]] >= 0) & (y[skips[:, 1]] >= 0)] if len(skips) else np.empty((0, 2), np.int64)
    one = np.eye(L)
    m = [np.zeros_like(a) for a in (unary, chain, skip)]
    v = [np.zeros_like(a) for a in (unary, chain, skip)]
    for step in range(1, STEPS + 1):
        z = np.zeros((n, L))
        for k in range(L):
            z[:, k] = np.bincount(node, weights=unary[x, k], minlength=n)
        np.add.at(z, pairs, chain[y[pairs - 1]])
        np.add.at(z, pairs - 1, chain[:, y[pairs]].T)
        np.add.at(z, sk[:, 0], skip[y[sk[:, 1]]])
        np.add.at(z, sk[:, 1], skip[y[sk[:, 0]]])
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = np.zeros((n, L))
        g[seen] = (one[y[seen]] - p[seen]) / len(seen)
        gu = np.stack([np.bincount(x, weights=g[node, k], minlength=FEATURES) for k in range(L)], axis=1) - L2 * unary / 10
        gc, gs = -L2 * chain, -L2 * skip
        np.add.at(gc, y[pairs - 1], g[pairs])
        np.add.at(gc.T, y[pairs], g[pairs - 1])
        both = np.zeros((L, L))
        np.add.at(both, y[sk[:, 1]], g[sk[:, 0]])
        np.add.at(both, y[sk[:, 0]], g[sk[:, 1]])
        gs += (both + both.T) / 2
        for i, (a, grad) in enumerate(zip((unary, chain, skip), (gu, gc, gs))):
            m[i] = 0.9 * m[i] + 0.1 * grad
            v[i] = 0.99 * v[i] + 0.01 * grad * grad
            a += 0.1 * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.99 ** step)) + 1e-8)
    return Model(unary, chain, skip)


def marginals(model: Model, x: np.ndarray, ptr: np.ndarray, chained: np.ndarray, skips: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """Label probabilities of every node by loopy sum-product with damping, until no message changes by ``TOLERANCE``
    (or for ``rounds``). Messages rest while nothing beside them changes, and all are tried again at the end. Where
    loops keep them swinging after as many rounds as a message needs across its document, steps are halved."""
    n = len(ptr) - 1
    node = np.repeat(np.arange(n), np.diff(ptr))
    z = np.stack([np.bincount(node, weights=model.unary[x, k], minlength=n) for k in range(L)], axis=1)
    b = np.flatnonzero(chained)
    src, dst = np.r_[b - 1, skips[:, 0]], np.r_[b, skips[:, 1]]
    pot = np.concatenate([np.repeat(model.chain[None], len(b), 0), np.repeat(model.skip[None], len(skips), 0)])
    fwd, bwd = np.zeros((len(src), L)), np.zeros((len(src), L))  # log messages
    # nodes between which no edge passes are apart: the longest stretch bounds the way of a message
    over = np.cumsum(np.bincount(src, minlength=n) - np.bincount(dst, minlength=n)) if len(src) else np.zeros(n)
    apart = np.flatnonzero(over == 0)
    reach = int(np.diff(np.r_[-1, apart]).max()) if len(apart) else n
    belief, active, passed, step = z.copy(), np.arange(len(src)), 0, 0.5
    while len(active) and passed != rounds:
        s, d = src[active], dst[active]
        new_f = np.logaddexp.reduce((belief[s] - bwd[active])[:, :, None] + pot[active], axis=1)
        new_b = np.logaddexp.reduce((belief[d] - fwd[active])[:, None, :] + pot[active], axis=2)
        more_f = step * (new_f - new_f.max(1, keepdims=True) - fwd[active])
        more_b = step * (new_b - new_b.max(1, keepdims=True) - bwd[active])
        fwd[active] += more_f
        bwd[active] += more_b
        np.add.at(belief, d, more_f)
        np.add.at(belief, s, more_b)
        moving = np.maximum(np.abs(more_f).max(1), np.abs(more_b).max(1)) >= TOLERANCE / 2
        touched = np.zeros(n, bool)
        touched[s[moving]] = touched[d[moving]] = True
        passed += 1
        if passed % (reach + 64) == 0:
            step /= 2
        tried_all, active = len(active) == len(src), np.flatnonzero(touched[src] | touched[dst])
        if not len(active) and not tried_all:
            active = np.arange(len(src))
    np.add.at(z, dst, fwd)
    np.add.at(z, src, bwd)
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def _packed(docs: list[Tokens]):
    """The nodes and edges of several documents as one graph."""
    x = np.array([f for d in docs for t in d.features for f in t], dtype=np.int64)
    sizes = [len(t) for d in docs for t in d.features]
    chained = np.array([c for d in docs for c in d.chained], dtype=bool)
    base = np.cumsum([0] + [len(d.spans) for d in docs])
    skips = np.array([(a + o, b + o) for d, o in zip(docs, base) for a, b in d.skips], dtype=np.int64).reshape(-1, 2)
    return x, np.r_[0, np.cumsum(sizes)].astype(np.int64), chained, skips, base


def _trim(text: str, a: int, b: int, kind: int) -> tuple[int, int]:
    """The span without what its kind can't begin or end with."""
    ok = str.isalnum if kind == 0 else (lambda c: "0" <= c <= "9")
    while a < b and not (ok(text[a]) or kind == 3 and text[a] in "+("):
        a += 1
    while a < b and not ok(text[b - 1]):
        b -= 1
    return a, b


def added_spans(text: str, tokens: Tokens, p: np.ndarray, base, min_prob: float = MIN_PROB) -> list[tuple[int, int, int]]:
    """Spans that the model adds: tokens of one kind (neighbours together for cards and phones) off all base spans."""
    best = p.argmax(1)
    best[p.max(1) < min_prob] = 0
    taken = sorted((a, b) for _, a, b in base)
    out, i = [], 0
    while i < len(best):
        k, j = int(best[i]), i + 1
        while k in (3, 4) and j < len(best) and best[j] == k and tokens.chained[j]:
            if text[tokens.spans[j][0]] == "+" or k == 3 and tokens.spans[j][1] - tokens.spans[j][0] >= 12:
                break  # another number begins
            j += 1
        if k:
            a, b = _trim(text, tokens.spans[i][0], tokens.spans[j - 1][1], k - 1)
            lo = 0
            hi = len(taken)
            while lo < hi:
                mid = (lo + hi) // 2
                lo, hi = (mid + 1, hi) if taken[mid][1] <= a else (lo, mid)
            if a < b and not (lo < len(taken) and taken[lo][0] < b):
                out.append((k - 1, a, b))
        i = j
    return out


def fit(docs: DataFrame, text: str = "text", train_docs: int = TRAIN_DOCS) -> Model:
    """The model from a sample of ``train_docs`` documents in expectation, drawn by a hash of the text; only
    their tokens' feature ids and labels come to the driver."""
    n = docs.count()
    share = min(1.0, train_docs / max(1, n))
    drawn = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t")).where(
        F.pmod(F.xxhash64("t"), F.lit(1 << 30)) < share * (1 << 30))

    def run(batches):
        for batch in batches:
            out = []
            for t in batch.column(0).to_pylist():
                if _MARK.search(t):
                    tk = tokens_of(t)
                    base, rejected = base_spans(t)
                    out.append((tk.features, tk.chained, [x for s in tk.skips for x in s], labels_of(tk, base, rejected)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(zip(*out), types)], names=["f", "c", "s", "y"])

    types = [pa.list_(pa.list_(pa.int32())), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.list_(pa.int8())]
    rows = drawn.mapInArrow(run, "f array<array<int>>, c array<boolean>, s array<int>, y array<tinyint>").collect()
    packed = [Tokens([(0, 0)] * len(r["y"]), r["f"], r["c"], list(zip(r["s"][::2], r["s"][1::2]))) for r in rows]
    x, ptr, chained, skips, _ = _packed(packed)
    return train(x, ptr, chained, skips, np.array([y for r in rows for y in r["y"]], dtype=np.int64))


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find(docs: DataFrame, id_col: str = "doc_id", text: str = "text", train_docs: int = TRAIN_DOCS,
         min_prob: float = MIN_PROB) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (base
    and added, ``kind:start:end`` by kind and start, comma-joined; code points), n_added.

    Null and empty texts have no spans; repeated rows and null ids keep their rows; other columns are not
    read. On an empty table, or one without a candidate, the model adds nothing.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, text, train_docs))

    def run(batches):
        for batch in batches:
            out, asked = [], []
            for t in batch.column(1).to_pylist():
                t = t or ""
                if not _MARK.search(t):
                    out.append([[], []])
                    continue
                base, _ = base_spans(t)
                out.append([base, []])
                tk = tokens_of(t)
                if tk.spans:
                    asked.append((len(out) - 1, t, tk))
            if asked:
                x, ptr, chained, skips, at = _packed([tk for _, _, tk in asked])
                p = marginals(model.value, x, ptr, chained, skips)
                for (i, t, tk), lo, hi in zip(asked, at, at[1:]):
                    out[i][1] = added_spans(t, tk, p[lo:hi], out[i][0], min_prob)
            counts = [[sum(s[0] == k for s in base) for base, _ in out] for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in out], pa.string()),
                 pa.array([_joined(base + more) for base, more in out], pa.string()), pa.array([len(m) for _, m in out], pa.int64())],
                names=names)

    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
    return slim.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
