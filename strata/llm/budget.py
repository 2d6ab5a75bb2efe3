"""Mixing sources to target weights: budgets down a domain-language-source tree, then a token prefix of each leaf.

A node's capacity is what its leaves hold over ``max_epochs`` epochs. From the root down, a parent's
budget is spread over its children in proportion to their weights, no child above its capacity; what
a short child leaves goes to its siblings, and only a parent that is short as a whole leaves anything
to its own siblings. Each leaf reads its documents in a seeded order, a new one each epoch, and takes
them from the front while its budget lasts. Everything is whole numbers, so engines and reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import staged

SPACE = r"[\x20\x09-\x0D]+"
LEVELS = ["domain", "lang", "source"]
#: Parts of a leaf's seeded order (leading hex digits of a hash) that are summed before anything is sorted.
PREFIX_HEX = 3

#: The production mix: relative weights of domains, of languages in each, of sources in each language.
DOMAINS = {"crawl": 5, "community": 3, "reference": 2}
LANGS = {"en": 6, "de": 2, "fr": 2, "es": 1}
BUDGET_PCT, MAX_EPOCHS, SEED = 80, 2, 42


def domain_of(source: str = "source") -> Column:
    """The domain of a source: ``src0`` is crawl, other one-digit sources community, the rest reference."""
    s = F.coalesce(F.col(source), F.lit(""))
    return F.when(s == "src0", "crawl").when(F.length(s) <= 4, "community").otherwise("reference")


def _weights(of: dict[str, int], col: str, default: int = 1) -> Column:
    out = F.lit(default).cast("long")
    for k, w in of.items():
        out = F.when(F.col(col) == k, F.lit(w).cast("long")).otherwise(out)
    return out


def spread(parents: DataFrame, children: DataFrame, on: list[str], name: str) -> DataFrame:
    """``children`` (``on`` + name, capacity, weight) with ``budget``: the parent's ``budget`` in proportion
    to weight, capped by capacity. Children are filled in ascending capacity per weight; the first
    that isn't filled up takes its share of what is left, and so do all behind it."""
    order = Window.partitionBy(*on).orderBy(F.col("capacity") / F.col("weight"), name)
    upto, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    kids = children.join(parents.select(*on, F.col("budget").alias("_of")), on)
    kids = kids.withColumn("_used", F.coalesce(F.sum("capacity").over(upto), F.lit(0)).cast("long")).withColumn(
        "_weights", F.sum("weight").over(rest).cast("long"))
    left = F.greatest(F.col("_of") - F.col("_used"), F.lit(0).cast("long"))
    # filled up: capacity / weight <= left / weights; it holds for a first part of the order only
    kids = kids.withColumn("_left", left).withColumn("_full", F.expr(
        "CAST(capacity AS DECIMAL(19,0)) * CAST(_weights AS DECIMAL(18,0)) <= CAST(_left AS DECIMAL(19,0)) * CAST(weight AS DECIMAL(18,0))"))
    # what is left for the children not filled up, and their weights: those of the first of them
    among = Window.partitionBy(*on)
    kids = (kids.withColumn("_pool", F.max(F.when(~F.col("_full"), F.col("_left"))).over(among))
            .withColumn("_pool_w", F.max(F.when(~F.col("_full"), F.col("_weights"))).over(among)))
    share = F.expr("CAST(_pool AS DECIMAL(19,0)) * CAST(weight AS DECIMAL(18,0)) div _pool_w")
    return kids.select(*on, name, "capacity", "weight",
                       F.when(F.col("_full"), F.col("capacity")).otherwise(share).cast("long").alias("budget"))


def allocate(leaves: DataFrame, total: Column, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(domain, lang, source, capacity, budget) from leaves with ``tokens`` and the three levels' weights."""
    base = leaves.withColumn("capacity", F.col("tokens") * max_epochs).withColumn("_root", F.lit(0))
    node, on = base.groupBy("_root").agg(total.cast("long").alias("budget")), ["_root"]
    for level in LEVELS:
        kids = base.groupBy(*on, level).agg(F.sum("capacity").cast("long").alias("capacity"), F.max(f"w_{level}").alias("weight"))
        node = spread(node, kids, on, level)
        on = [*on, level]
    return node.drop("_root")


def _rank(seed: int, epoch: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.col("_id")).cast("binary"))


def select_prefix(rows: DataFrame, budgets: DataFrame, seed: int = SEED, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(rows' columns, epoch): in every epoch but a leaf's last all its rows, in its last the rows of the
    seeded order whose predecessors hold fewer tokens than what the budget has left.

    ``rows`` has the three levels, ``_id`` (text of the key) and ``tokens``. The order of a leaf is cut
    into 4096 parts by its hash; part sums find the part where the budget ends, and only that part
    is sorted, so no leaf meets in one task.
    """
    leaf = budgets.select(*LEVELS, "budget", "capacity").withColumn("_tokens", F.expr(f"capacity div {max_epochs}"))
    epochs = leaf.where("budget > 0").select(
        *LEVELS, F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))).alias("epoch"),
        "budget", "_tokens").withColumn("_left", F.col("budget") - F.col("epoch") * F.col("_tokens")).where("_left > 0")
    whole = epochs.where("_left >= _tokens").select(*LEVELS, "epoch")
    partial = epochs.where("_left < _tokens").select(*LEVELS, "epoch", "_left")
    full = rows.join(whole, LEVELS)
    mixed = rows.join(partial, LEVELS).withColumn("_rank", _rank(seed, F.col("epoch"))).withColumn(
        "_part", F.substring("_rank", 1, PREFIX_HEX))
    sums = mixed.groupBy(*LEVELS, "epoch", "_left", "_part").agg(F.sum("tokens").alias("_sum"))
    before = Window.partitionBy(*LEVELS, "epoch").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    reached = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)).cast("long")).where("_before < _left")
    cut = staged(reached.groupBy(*LEVELS, "epoch").agg(F.max(F.struct("_part", "_before")).alias("_cut")), "mix-cuts")  # a row per leaf and epoch
    took = mixed.join(cut, [*LEVELS, "epoch"])
    inside = Window.partitionBy(*LEVELS, "epoch").orderBy("_rank", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    edge = took.where("_part = _cut._part").withColumn("_prior", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    cols = [*rows.columns, "epoch"]
    return (full.select(*cols).unionByName(took.where("_part < _cut._part").select(*cols))
            .unionByName(edge.where("_cut._before + _prior < _left").select(*cols)))


def token_count(text: Column) -> Column:
    """Tokens for budgeting: words between blanks; none in a null text."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
        domains: dict[str, int] | None = None, langs: dict[str, int] | None = None, budget_pct: int = BUDGET_PCT,
        max_epochs: int = MAX_EPOCHS, seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """One row per document and epoch taken: ``keep`` columns, domain, lang, source, tokens, epoch.

    The total is ``budget_pct`` percent of all tokens. Null languages and sources are leaves of their own
    (named as the empty text); null ids rank as the text ``null``; rows of one id share a rank, and
    repeated rows are taken like any other; an empty table, or one without a word, gives no rows.
    """
    keep = keep or []
    rows = staged(docs.select(
        *[F.col(f"`{c}`").alias(f"k_{c}") for c in keep],
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")).alias("_id"),
        domain_of(source).alias("domain"), F.coalesce(F.col(f"`{lang}`"), F.lit("")).alias("lang"),
        F.coalesce(F.col(f"`{source}`"), F.lit("")).alias("source"), token_count(F.col(f"`{text}`")).alias("tokens")), "mix-rows")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")).select(
        "*", _weights(domains or DOMAINS, "domain").alias("w_domain"), _weights(langs or LANGS, "lang").alias("w_lang"),
        F.lit(1).cast("long").alias("w_source"))
    total = F.expr(f"coalesce(sum(tokens), 0) * {budget_pct} div 100")
    budgets = staged(allocate(leaves, total, max_epochs), "mix-budgets")
    out = select_prefix(rows, budgets, seed, max_epochs)
    return out.select(*[F.col(f"k_{c}").alias(c) for c in keep if c not in (*LEVELS, "tokens", "epoch")], *LEVELS, "tokens", "epoch")


def mixed_rows(docs: DataFrame, **params) -> DataFrame:
    """The rows of ``docs`` that the mix takes, columns as they came; a row taken in two epochs comes twice."""
    inner = docs.withColumn("_whole", F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    return mix(inner, keep=["_whole"], **params).select("_whole.*")


def mix_sql(seed: int = SEED, max_epochs: int = MAX_EPOCHS, budget_pct: int = BUDGET_PCT) -> str:
    """The same mix of ``documents`` in DuckDB SQL."""
    def case(of: dict[str, int], col: str) -> str:
        return f"CASE {' '.join(f'WHEN {col} = {k!r} THEN {w}' for k, w in of.items())} ELSE 1 END"

    sql = f"""WITH rows_ AS (SELECT doc_id, CASE WHEN source = 'src0' THEN 'crawl' WHEN length(coalesce(source, '')) <= 4
      THEN 'community' ELSE 'reference' END AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
      len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens FROM documents),
    leaf AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens FROM rows_ GROUP BY ALL),
    lvl0 AS (SELECT (sum(tokens) * {budget_pct} // 100)::BIGINT AS budget FROM leaf)"""
    for i, level in enumerate(LEVELS, 1):
        on = LEVELS[:i - 1]
        keys, by = ", ".join([*on, level]), f"PARTITION BY {', '.join(on)}" if on else ""
        weight = {"domain": case(DOMAINS, "domain"), "lang": case(LANGS, "lang"), "source": "1"}[level]
        parent = f"(SELECT {', '.join([*on, 'budget AS of_'])} FROM lvl{i - 1}) p"
        join = f"JOIN {parent} USING ({', '.join(on)})" if on else f"CROSS JOIN {parent}"
        sql += f""",
    kid{i} AS (SELECT {keys}, (sum(tokens) * {max_epochs})::BIGINT AS capacity, ({weight})::BIGINT AS weight FROM leaf GROUP BY {keys}),
    a{i} AS (SELECT *, coalesce(sum(capacity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
      sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM kid{i} {join}
      WINDOW w AS ({by} ORDER BY capacity / weight, {level})),
    b{i} AS (SELECT *, greatest(of_ - used, 0) AS left_, capacity::HUGEINT * ws <= greatest(of_ - used, 0)::HUGEINT * weight AS full_ FROM a{i}),
    lvl{i} AS (SELECT {keys}, capacity, CASE WHEN full_ THEN capacity ELSE
      (max(left_) FILTER (NOT full_) OVER ({by}))::HUGEINT * weight // (max(ws) FILTER (NOT full_) OVER ({by})) END::BIGINT AS budget FROM b{i})"""
    return sql + f""",
    ep AS (SELECT lvl3.*, e AS epoch, budget - e * (capacity // {max_epochs}) AS left_ FROM lvl3, range({max_epochs}) t(e)),
    ranked AS (SELECT rows_.*, epoch, left_, md5('{seed}:' || epoch || ':' || coalesce(doc_id::VARCHAR, 'null')) AS rank_
      FROM rows_ JOIN ep USING (domain, lang, source) WHERE left_ > 0),
    run AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source, epoch ORDER BY rank_, tokens
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior, sum(tokens) OVER (PARTITION BY domain, lang, source, epoch) AS held FROM ranked)
    SELECT doc_id, domain, lang, source, tokens, epoch::INTEGER AS epoch FROM run WHERE prior < left_ OR left_ >= held"""
