"""Quality rules by robust multivariate outliers: a minimum-covariance-determinant estimate per language
and source over transformed text statistics, and rejection by Mahalanobis distance. DataFrame functions only.

The estimate is that subset of ``SUBSET`` of a group's rows whose covariance has the least determinant that concentration
finds: from each of three starts (medians and quartile ranges; mean and covariance of all rows; those of the inner
half), keep the rows with the least distance, take their mean and covariance, and repeat while the determinant
falls. The least of the three is reweighted once. Statistics are whole thousandths, so sums are exact integers, and distances
are ranked on a bounded grid of values: the verdict doesn't depend on the order of rows or tasks. A step reads the rows once
and sums them by group and grid value before its shuffle; what is left is bounded by the grid.

Groups with fewer than ``MIN_ROWS`` rows are judged by an estimate over all rows of their language, and languages with fewer by one
over all rows of the table. Only a table that has fewer isn't judged.
"""

from __future__ import annotations

from math import exp, lgamma, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import let, staged

SPACE = r"[\x20\x09-\x0D]+"
_BLANKS, _SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
WINDOW, MIN_WORDS, MAX_REPEAT_PCT = 8, 20, 30
SUBSET, INNER, MIN_ROWS = 0.75, 0.5, 200
MAX_STEPS, FALL = 50, 1e-9  # steps of concentration, and by how much the determinant's logarithm has to fall for another
REWEIGHT, REJECT = 0.975, 1 - 1e-9  # quantiles of the chi-square law
SCALE = 1000  # statistics in whole thousandths
#: Least spread of a statistic, in its own unit: where most rows of a group have the same value, the
#: estimate would be singular and the smallest difference an outlier.
FLOORS = {"length": 0.25, "word_length": 0.06, "symbols": 0.04, "dup_lines": 0.1, "repeats": 0.1}
D = len(FLOORS)
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_X = [f"_x{i}" for i in range(D)]


def chi2_cdf(x: float, k: int) -> float:
    term = total = 1.0 / (k / 2)
    for i in range(1, 2000):
        term *= x / 2 / (k / 2 + i)
        total += term
        if term < total * 1e-17:
            break
    return total * exp(-x / 2 + k / 2 * log(x / 2) - lgamma(k / 2))


def chi2_quantile(p: float, k: int) -> float:
    lo, hi = 1e-9, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, k) < p else (lo, mid)
    return lo


def consistency(share: float, k: int) -> float:
    """What the covariance of the ``share`` of rows with the least distance lacks, for normal data."""
    return share / chi2_cdf(chi2_quantile(share, k), k + 2)


# -- statistics of one text ---------------------------------------------------------------------------

def _window_hashes(words: Column) -> Column:
    """A hash of each 8 consecutive words, by doubling: pairs, fours, eights. Windows are compared by
    64 bits of XXH64, whose chance of a collision in a text of a million windows is 3e-8."""
    def doubled(v, step):
        n = F.size(v) - step
        return F.zip_with(F.slice(v, 1, n), F.slice(v, step + 1, n), lambda a, b: F.xxhash64(a, b))

    h = F.transform(words, lambda w: F.xxhash64(w))
    h = let(h, lambda v: doubled(v, 1))
    h = let(h, lambda v: doubled(v, 2))
    return let(h, lambda v: doubled(v, 4))


def _covered(hashes: Column) -> Column:
    """Words under windows that occur twice or more: repeated windows in order of their place, each
    adding what the next doesn't cover."""
    def places(s):  # s: (hash, place), sorted
        flagged = F.transform(s, lambda x, i: F.when(
            ((i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)), x["p"]))
        return F.sort_array(F.filter(flagged, lambda p: p.isNotNull()))

    def total(p):
        gaps = F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda s, x: s + x)

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    return let(let(pairs, places), total)


def text_stats(text: Column) -> Column:
    """The base statistics of a text as a struct of longs; a null or blank text has none of anything."""
    body = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(body, SPACE), "")

    def of(w):
        repeats = F.when(F.size(w) <= WINDOW, F.lit(0).cast("long")).otherwise(let(_window_hashes(w), lambda h: F.when(
            F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(_covered(h))))
        return F.struct(F.size(w).cast("long").alias("n_words"), repeats.alias("n_repeat_words"))

    lines = let(F.filter(F.split(body, "\n"), lambda x: F.length(F.translate(x, _BLANKS, "")) > 0),
                lambda v: (F.size(v) - F.size(F.array_distinct(v))).cast("long"))
    return let(let(words, of), lambda s: F.struct(
        s["n_words"].alias("n_words"), F.length(F.translate(body, _BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("n_dup_lines"), s["n_repeat_words"].alias("n_repeat_words"),
        F.size(F.split(body, "\n")).cast("long").alias("n_lines")))


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))


def _vector() -> list[Column]:
    """The transformed statistics: logarithms of sizes, square roots of shares, in thousandths."""
    def share(a, b):
        return F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))

    raw = [F.log1p(F.col("n_words")), F.log1p(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))),
           share("n_symbols", "word_chars"), share("n_dup_lines", "_lines"), share("n_repeat_words", "n_words")]
    return [F.round(x * SCALE).cast("long").alias(n) for x, n in zip(raw, _X)]


# -- the estimate -------------------------------------------------------------------------------------

def _name(col: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{col}`").cast("string")), F.lit("~"))


def _groups(rows: DataFrame, min_rows: int) -> tuple[DataFrame, DataFrame]:
    """Two tables (_lang, _source, _group): whose estimate judges the rows of a language and source, and which
    estimates they count for: their own, their language's if a small source needs it, that of all rows if a small language does."""
    n = rows.groupBy("_lang", "_source").agg(F.count("*").alias("n"))
    by_lang = n.groupBy("_lang").agg(F.sum("n").alias("in_lang"), F.min("n").alias("least"))
    sized = staged(n.join(by_lang, "_lang"), "mcd-sized")
    small = sized.agg(F.min("in_lang")).first()[0]
    own, lang, all_ = F.concat_ws("\x1f", F.lit("s"), "_lang", "_source"), F.concat_ws("\x1f", F.lit("l"), "_lang"), F.lit("a")
    in_lang = F.col("in_lang") >= min_rows
    judge = F.when(F.col("n") >= min_rows, own).when(in_lang, lang).otherwise(all_)
    counts = F.array_compact(F.array(F.when(F.col("n") >= min_rows, own), F.when(in_lang & (F.col("least") < min_rows), lang),
                                     all_ if small is not None and small < min_rows else F.lit(None).cast("string")))
    return sized.select("_lang", "_source", judge.alias("_group")), sized.select("_lang", "_source", F.explode(counts).alias("_group"))


def _distance(x: list[Column]) -> Column:
    """Squared Mahalanobis distance from the group's ``_mean`` under its ``_prec``."""
    diff = [x[i] - F.col("_mean")[i] for i in range(D)]
    out = F.lit(0.0)
    for i in range(D):
        for j in range(i, D):
            out = out + (1.0 if i == j else 2.0) * F.col("_prec")[i * D + j] * diff[i] * diff[j]
    return out


def _bin(d2: Column) -> Column:
    """Squared distance on a bounded grid, for exact quantiles in bounded memory."""
    return F.least(F.round(F.log1p(F.greatest(d2, F.lit(0.0))) * 200), F.lit(20000.0)).cast("int")


def _swept(m: Column) -> Column:
    """(inverse, logarithm of the determinant) of a positive definite matrix (flat array), by sweeping each pivot."""
    def sweep(acc, k):
        a = acc["a"]
        piv = F.get(a, k * (D + 1))

        def cell(idx):
            i, j = F.floor(idx / D).cast("int"), (idx % D).cast("int")
            ik, kj, v = F.get(a, i * D + k), F.get(a, k * D + j), F.get(a, idx)
            return (F.when((i == k) & (j == k), -1.0 / piv).when(i == k, v / piv).when(j == k, v / piv)
                    .otherwise(v - ik * kj / piv))
        return F.struct(F.transform(F.sequence(F.lit(0), F.lit(D * D - 1)), cell).alias("a"), (acc["d"] + F.log(piv)).alias("d"))

    start = F.struct(m.alias("a"), F.lit(0.0).alias("d"))
    out = F.aggregate(F.sequence(F.lit(0), F.lit(D - 1)), start, sweep)
    return let(out, lambda v: F.struct(F.transform(v["a"], lambda x: -x).alias("inverse"), v["d"].alias("logdet")))


_PAIRS = [(i, j) for i in range(D) for j in range(i, D)]
_SUMS = ["_n", *[f"_s{i}" for i in range(D)], *[f"_p{i}_{j}" for i, j in _PAIRS]]


def _sums() -> list[Column]:
    """Count, sums and sums of products of rows, as exact integers."""
    return [F.count("*").alias("_n"), *[F.sum(_X[i]).alias(f"_s{i}") for i in range(D)],
            *[F.sum(F.col(_X[i]) * F.col(_X[j])).alias(f"_p{i}_{j}") for i, j in _PAIRS]]


def _moments(sums: DataFrame, by: list[str], factor: float) -> DataFrame:
    """``by`` with _mean, _prec and _logdet from rows of ``_sums``, the covariance made consistent and widened by the floors."""
    floor = [(f * SCALE) ** 2 for f in FLOORS.values()]
    all_ = sums.groupBy(*by).agg(*[F.sum(c).cast("double").alias(c) for c in _SUMS])

    def cov(i, j):
        a, b = min(i, j), max(i, j)
        c = (F.col(f"_p{a}_{b}") / F.col("_n") - F.col(f"_s{a}") / F.col("_n") * F.col(f"_s{b}") / F.col("_n")) * factor
        return c + floor[i] if i == j else c

    m = all_.select(*by, F.array(*[F.col(f"_s{i}") / F.col("_n") for i in range(D)]).alias("_mean"),
                    _swept(F.array(*[cov(i, j) for i in range(D) for j in range(D)])).alias("_m"))
    return m.select(*by, "_mean", F.col("_m.inverse").alias("_prec"), F.col("_m.logdet").alias("_logdet"))


def _medians(rows: DataFrame) -> DataFrame:
    """Medians, and quartile ranges as a diagonal."""
    q = rows.groupBy("_group").agg(*[F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{i}")
                                     for i, x in enumerate(_X)])
    floor = [f * SCALE for f in FLOORS.values()]
    var = [F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(floor[i])) for i in range(D)]
    return q.select("_group", F.array(*[F.col(f"q{i}")[1] for i in range(D)]).alias("_mean"),
                    F.array(*[1.0 / (var[i] * var[i]) if i == j else F.lit(0.0) for i in range(D) for j in range(D)]).alias("_prec"))


def _concentrated(rows: DataFrame, model: DataFrame, subset: float) -> DataFrame:
    """(_group, _start, _mean, _prec, _logdet) of the ``subset`` of each group's rows with the least distance from ``model``
    (with ``_group`` and ``_start``): the grid values up to that of the row of rank ``subset * (n - 1)``."""
    by = ["_group", "_start"]
    binned = rows.join(model.select(*by, "_mean", "_prec"), "_group").withColumn("_bin", _bin(_distance([F.col(x) for x in _X])))
    bins = staged(binned.groupBy(*by, "_bin").agg(*_sums()), "mcd-bins")  # bounded by groups and grid
    in_order = Window.partitionBy(*by).orderBy("_bin")
    before = F.coalesce(F.sum("_n").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("_n").over(Window.partitionBy(*by))
    inner = bins.withColumn("_before", before).withColumn("_all", total).where(F.col("_before") <= F.floor((F.col("_all") - 1) * subset))
    return _moments(inner, by, consistency(subset, D))


def estimate(rows: DataFrame, subset: float = SUBSET) -> DataFrame:
    """(_group, _mean, _prec) from rows with ``_group`` and the statistics, as a staged table with one row per group."""
    rows = rows.select("_group", *_X)
    medians = staged(_medians(rows).withColumn("_start", F.lit("medians")), "mcd-medians")
    whole = _moments(rows.groupBy("_group").agg(*_sums()), ["_group"], 1.0).withColumn("_start", F.lit("all"))
    inner = _concentrated(rows, medians, INNER).withColumn("_start", F.lit("inner"))
    cols = ["_group", "_start", "_mean", "_prec"]
    starts = staged(medians.select(*cols).unionByName(whole.select(*cols)).unionByName(inner.select(*cols)), "mcd-starts")
    model = staged(_concentrated(rows, starts, subset).withColumn("_fell", F.lit(True)), "mcd")
    for _ in range(MAX_STEPS):
        if not model.where("_fell").limit(1).count():
            break
        new = _concentrated(rows, model.where("_fell"), subset).select(
            F.col("_group").alias("n_group"), F.col("_start").alias("n_start"), *[F.col(c).alias(f"n{c}") for c in ("_mean", "_prec", "_logdet")])
        both = model.join(new, (F.col("_group") == F.col("n_group")) & (F.col("_start") == F.col("n_start")), "left")
        fell = F.coalesce(F.col("n_logdet") < F.col("_logdet") - FALL, F.lit(False))
        model = staged(both.select("_group", "_start", *[F.when(fell, F.col(f"n{c}")).otherwise(F.col(c)).alias(c) for c in ("_mean", "_prec", "_logdet")],
                                   fell.alias("_fell")), "mcd")
    best = model.groupBy("_group").agg(F.min_by(F.struct("_mean", "_prec"), F.struct("_logdet", "_start")).alias("_m"))
    best = staged(best.select("_group", "_m._mean", "_m._prec"), "mcd-best")
    near = rows.join(best, "_group").where(_distance([F.col(x) for x in _X]) <= chi2_quantile(REWEIGHT, D))
    return staged(_moments(near.groupBy("_group").agg(*_sums()), ["_group"], consistency(REWEIGHT, D)).drop("_logdet"), "mcd")


def measured(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
             keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns with the statistics, the base verdict and the transformed vector, staged."""
    keep = [F.col(f"`{c}`") for c in (keep or [])]
    one = docs.select(*keep, _name(lang).alias("_lang"), _name(source).alias("_source"), text_stats(F.col(f"`{text}`")).alias("_s"))
    flat = one.select(*keep, "_lang", "_source", *[F.col(f"_s.{s}").alias(s) for s in STATS],
                      F.col("_s.n_lines").alias("_lines"))
    return staged(flat.withColumn("base_failed", _base_failed()).select("*", *_vector()), "mcd-stats")


def verdicts(rows: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """``rows`` of ``measured`` with ``distance`` (squared) and ``kept``."""
    good = rows.where("not base_failed")
    groups, counted = (staged(x, "mcd-groups") for x in _groups(good, min_rows))
    members = good.join(counted, ["_lang", "_source"])
    model = estimate(members)
    enough = staged(members.groupBy("_group").agg(F.count("*").alias("_n")), "mcd-sizes")
    # staged, so that its size is known when the rows, with their texts, are joined to it
    judged = staged(groups.join(model, "_group").join(enough, "_group").where(F.col("_n") >= min_rows), "mcd-judged")
    out = rows.join(judged, ["_lang", "_source"], "left")
    d2 = _distance([F.col(x) for x in _X])
    return out.withColumn("distance", F.when(~F.col("base_failed"), d2)).withColumn(
        "kept", ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= chi2_quantile(REJECT, D)))


def judge(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
          min_rows: int = MIN_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, the base statistics, base_failed, kept, distance (null where
    the base failed or the table is too small for an estimate). Null and blank texts fail the base rule; a null language
    or source is a group of its own; repeated rows each count; extra columns are not read."""
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"),
                       F.col(f"`{lang}`").alias("lang"), F.col(f"`{source}`").alias("source"))
    return verdicts(measured(slim, keep=["doc_id"]), min_rows).select(
        "doc_id", *STATS, "base_failed", "kept", "distance")


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
              min_rows: int = MIN_ROWS) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns as they came."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("text"),
                        F.col(f"`{lang}`").alias("lang"), F.col(f"`{source}`").alias("source"))
    out = verdicts(measured(whole, keep=["_row"]), min_rows).where("kept")
    return out.select("_row.*")
