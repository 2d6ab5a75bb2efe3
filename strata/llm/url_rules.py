"""URL filters by association rules: FP-growth over the tokens of labelled urls, rules matched by an inverted index.

A page's url becomes a set of tokens (scheme, suffixes of the host, pieces of the path, query keys and values). The
pages labelled bad are transactions of their tokens; Spark's FP-growth mines the frequent sets of any size, and a
set whose share of bad pages is high enough becomes a rule, unless a smaller rule within it is as confident. Each rule is posted under its rarest token only, so a page meets just
the rules that could hold; the rest of a rule is compared there.
"""

from __future__ import annotations

from math import ceil

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower, let, staged

#: (host, path, verdict) of the fixed rules; the longest that fits decides.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]
MIN_SUPPORT, MIN_COUNT, MIN_CONFIDENCE = 0.0005, 10, 0.5
LONG = 200  # a longer part of a url stands in its token by the hash of the whole part


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(F.coalesce(rest, F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fixed_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fixed rule (host and path written together) that fits, else null."""
    out = F.lit(None).cast("string")
    for h, p, _ in sorted(rules, key=lambda r: len(r[0] + r[1])):
        out = F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), h + p).otherwise(out)
    return out


def tokens_of(host: Column, path: Column, url: Column) -> Column:
    """The distinct tokens of a url: the scheme; every suffix of the host; each piece of the path (the first two with
    their place, deeper ones without) and the last; each query key, and each key with its value. Digits
    count by their number only, so that ids don't make tokens of their own."""
    none = F.array().cast("array<string>")

    def whole(x: Column) -> Column:
        return F.when(F.length(x) > LONG, F.concat(F.lit("#"), F.sha2(x, 256))).otherwise(x)

    def shape(x: Column) -> Column:
        return whole(F.regexp_replace(F.regexp_replace(ascii_lower(x), "[0-9]{4,}", "0000"), "(?<![0-9])[0-9]{1,3}(?![0-9])", "0"))

    def of_host(labels: Column) -> Column:
        n = F.size(labels)
        return F.transform(F.sequence(F.lit(1), n), lambda k: F.concat(F.lit("h:"), whole(F.array_join(F.slice(labels, n - k + 1, k), "."))))

    def of_path(pieces: Column) -> Column:
        n = F.size(pieces)
        return F.when(n == 0, none).otherwise(F.concat(
            F.transform(pieces, lambda x, i: F.concat(F.lit("p"), F.when(i < 2, i.cast("string")).otherwise(""), F.lit(":"), shape(x))),
            F.array(F.concat(F.lit("z:"), shape(F.get(pieces, n - 1))))))

    text = F.coalesce(url, F.lit(""))
    keys = F.regexp_extract_all(text, F.lit("[?&]([^=&#]+)"), F.lit(1))
    values = F.regexp_extract_all(text, F.lit("[?&]([^=&#]+=[^&#]+)"), F.lit(1))
    scheme = F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1)
    return F.when((host == "") & (path == ""), none).otherwise(F.array_distinct(F.concat(
        F.array(F.concat(F.lit("s:"), whole(ascii_lower(scheme)))),
        F.when(host == "", none).otherwise(let(F.split(host, r"\."), of_host)),
        let(F.filter(F.split(path, "/"), lambda x: x != ""), of_path),
        F.transform(keys, lambda x: F.concat(F.lit("q:"), whole(ascii_lower(x)))),
        F.transform(values, lambda x: F.concat(F.lit("v:"), shape(x))))))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_count: int = MIN_COUNT,
         min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(tokens, n, n_bad, confidence) of the rules from ``labelled`` (tokens, bad).

    A rule holds for at least ``min_support`` of the bad pages and ``min_count`` of them, and at least ``min_confidence`` of
    its pages are bad. Sets of any size are mined among the bad pages, since the outcome must be frequent in
    them; how many pages a set has at all is then counted over every labelled page by the same index
    that applies rules.

    Three kinds of larger sets can't become rules, as a smaller set within them is as confident, and FP-growth doesn't see
    them: those with a token that only bad pages have, with a token that every labelled page has, and with two tokens of
    the same pages. Tokens of the same pages are mined as one and put back into the rules: each choice of one token of each
    such class is a row here. ``judge`` leaves the classes whole (``_mined``).
    """
    rules = _mined(labelled, min_support, min_count, min_confidence)
    start = F.array(F.array().cast("array<string>"))
    choices = F.aggregate("parts", start, lambda made, part: F.flatten(F.transform(made, lambda m: F.transform(part, lambda t: F.concat(m, F.array(t))))))
    made = rules.select("rule", F.explode(choices).alias("tokens")).withColumn("tokens", F.sort_array("tokens"))
    return staged(made.join(rules.drop("parts"), "rule").select("tokens", "n", "n_bad", "confidence"), "url-rules")


def _mined(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_count: int = MIN_COUNT,
           min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(rule, parts, n, n_bad, confidence): the rules of ``mine``; a page meets a rule if it has a token of each of its parts."""
    kinds = labelled.where(F.size("tokens") > 0).groupBy(F.sort_array("tokens").alias("tokens")).agg(
        F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("n_bad"))
    kinds = staged(kinds.withColumn("row", F.monotonically_increasing_id()), "url-kinds")
    n_all, n_bad = kinds.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("n_bad"), F.lit(0))).first()
    if n_bad < min_count:
        return labelled.sparkSession.createDataFrame([], "rule long, parts array<array<string>>, n long, n_bad long, confidence double")
    least = ceil(min(1.0, max(min_support, min_count / n_bad)) * n_bad)
    # tokens of the same pages by 128 bits over the kinds that have them
    marked = kinds.select(F.explode("tokens").alias("t"), "n", "n_bad", F.xxhash64("tokens").alias("x"), F.xxhash64(F.lit(1), "tokens").alias("y"))
    frequent = marked.groupBy("t").agg(F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    alike = frequent.where(F.col("n_bad") >= least).groupBy("n", "n_bad", "x", "y").agg(F.sort_array(F.collect_set("t")).alias("members"))
    alike = staged(alike.select("n", "n_bad", "members", F.col("members")[0].alias("first")), "url-tokens")
    single = alike.select(F.array("first").alias("tokens"), "n", "n_bad")
    several = alike.where((F.col("n") > F.col("n_bad")) & (F.col("n") < n_all)).select(F.col("first").alias("t"))
    bad = labelled.where("bad").select(F.monotonically_increasing_id().alias("row"), "tokens").select("row", F.explode("tokens").alias("t")).join(several, "t")
    bad = staged(bad.groupBy("row").agg(F.collect_set("t").alias("tokens")).select("tokens"), "url-bad")
    n = bad.count()
    sets = single
    if n:
        found = FPGrowth(itemsCol="tokens", minSupport=(least - 0.5) / n, minConfidence=1.0).fit(bad).freqItemsets
        larger = staged(found.where(F.size("items") > 1).select(F.sort_array("items").alias("tokens"), F.col("freq").alias("n_bad")), "url-sets")
        rare = _rarest(larger, labelled)
        counted = _matches(kinds, rare).join(kinds.select("row", "n"), "row").groupBy("rule").agg(F.sum("n").alias("n"))
        sets = single.unionByName(rare.join(counted, "rule").select("tokens", "n", "n_bad"))
    rules = sets.select("tokens", "n", "n_bad", (F.col("n_bad") / F.col("n")).alias("confidence")).where(F.col("confidence") >= min_confidence)
    rules = staged(rules, "url-rules")
    # a rule adds nothing to a smaller one within it that is as confident
    smaller = rules.select(F.col("tokens").alias("s_tokens"), F.col("confidence").alias("s_conf"))
    by_token = rules.select("tokens", "confidence", F.explode("tokens").alias("t"))
    within = by_token.join(smaller.withColumn("t", F.element_at("s_tokens", 1)), "t").where(
        (F.size("s_tokens") < F.size("tokens")) & (F.col("s_conf") >= F.col("confidence")) & (F.size(F.array_except("s_tokens", "tokens")) == 0))
    least_rules = staged(rules.join(within.select("tokens").distinct(), "tokens", "left_anti").withColumn("rule", F.monotonically_increasing_id()), "url-rules")
    parts = least_rules.select("rule", F.explode("tokens").alias("first")).join(alike.select("first", "members"), "first").groupBy("rule").agg(
        F.collect_list("members").alias("parts"))
    return staged(parts.join(least_rules.drop("tokens"), "rule").select("rule", "parts", "n", "n_bad", "confidence"), "url-rules")


def _rarest(rules: DataFrame, labelled: DataFrame) -> DataFrame:
    """``rules`` numbered and with the token that fewest labelled pages have."""
    df = labelled.select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count("*").alias("df"))
    used = rules.withColumn("rule", F.xxhash64("tokens"))
    post = used.select("rule", F.explode("tokens").alias("t")).join(df, "t", "left").groupBy("rule").agg(
        F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), F.col("t").alias("t")))["t"].alias("post"))
    return staged(used.join(post, "rule"), "url-index")


def _matches(pages: DataFrame, index: DataFrame) -> DataFrame:
    """(row, rule) for every rule whose tokens a page has; ``pages``: row, tokens."""
    posted = index.select("rule", "post", F.col("tokens").alias("r_tokens"))
    met = pages.select("row", "tokens", F.explode("tokens").alias("post")).join(posted, "post")
    return met.where((F.size("r_tokens") == 1) | (F.size(F.array_except("r_tokens", "tokens")) == 0)).select("row", "rule")


def judge(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url: str = "url", **params) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, confidence (of the best mined rule; null
    without one), mined (its tokens).

    ``labels`` (doc_id, quality, toxic) label the pages of the same id: quality 0 or toxic 1 is bad; an id
    labelled twice is bad if any label says so. A fixed rule decides first; else a page is blocked if a
    mined rule holds for it. Null urls, and urls without ``://``, have neither host nor path nor tokens
    and are allowed; repeated pages are judged alike; other columns are not read.
    """
    u = F.col("url")
    base = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url}`").alias("url")).select(
        "page_id", "url", host_of(u).alias("host"), path_of(u).alias("path"))
    base = base.select("page_id", "host", "path", fixed_rule(F.col("host"), F.col("path")).alias("rule"),
                       tokens_of(F.col("host"), F.col("path"), u).alias("tokens"))
    base = staged(base, "url-pages")
    known = labels.groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max(((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1))).alias("bad"))
    labelled = staged(base.select("page_id", "tokens").join(known, "page_id").select("tokens", "bad"), "url-labelled")
    rules = _mined(labelled, **params).withColumn("tokens", F.transform("parts", lambda p: F.array_min(p)))
    # a rule is posted under every token of its rarest part
    index = _rarest(rules, labelled).select("parts", "confidence", F.explode(F.filter("parts", lambda p: F.array_contains(p, F.col("post")))[0]).alias("post"))
    # pages of the same tokens are judged once; those that a fixed rule decides are left out of the join
    open_pages = base.where("rule IS NULL").withColumn("tokens", F.sort_array("tokens")).withColumn("row", F.xxhash64("tokens"))
    kinds = open_pages.where("size(tokens) > 0").select("row", "tokens").distinct().select("*", F.explode("tokens").alias("post"))
    hit = kinds.join(index, "post").where(F.forall("parts", lambda p: F.arrays_overlap(p, F.col("tokens"))))
    mined = F.sort_array(F.transform("parts", lambda p: F.array_max(F.array_intersect(p, F.col("tokens")))))
    best = staged(hit.select("row", "tokens", F.struct("confidence", mined.alias("mined")).alias("best")).groupBy("row", "tokens").agg(F.max("best").alias("best")), "url-best")
    ruled = base.where("rule IS NOT NULL").select("page_id", "host", "path", "rule", F.lit(None).cast(best.schema["best"].dataType).alias("best"))
    judged = open_pages.join(best, ["row", "tokens"], "left").select("page_id", "host", "path", "rule", "best").unionByName(ruled)
    verdict = F.lit(None).cast("string")
    for h, p, v in RULES:
        verdict = F.when(F.col("rule") == h + p, v).otherwise(verdict)
    return judged.select("page_id", "host", "path", "rule",
                         F.coalesce(verdict, F.when(F.col("best").isNotNull(), "block").otherwise("allow")).alias("verdict"),
                         F.col("best.confidence").alias("confidence"), F.col("best.mined").alias("mined"))
