"""O-46: declared constraints, one scan per table.

``validate`` returns one row per (table, rule, column) with the number of violations; a load can
``assert_valid`` before it publishes. Rules follow the source database: primary keys are unique and
not NULL; a UNIQUE natural key ignores rows with a NULL part (NULLs are distinct there); a foreign key
may be NULL but otherwise must exist; VARCHAR(n) columns hold at most n characters.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.contracts import Contract
from strata.operators.relational import checked_broadcast

RESULT_COLUMNS = ["table_name", "rule", "column_name", "violations"]
REF_BROADCAST_MAX_ROWS = 100_000


def _rows(df: DataFrame, table: str, names: list[tuple[str, str]]) -> DataFrame:
    """``df``, one row with a count per column in the order of ``names`` (rule, column), as a row per count."""
    counts = ", ".join(f"'{rule}', '{col}', `{c}`" for (rule, col), c in zip(names, df.columns))
    return df.select(F.lit(table).alias("table_name"), F.expr(f"stack({len(names)}, {counts}) AS (rule, column_name, violations)"))


def validate_rows(df: DataFrame, name: str, c: Contract) -> DataFrame | None:
    """NOT NULL and length rules of one table as conditional counts in one aggregate, a row per rule; None
    if it has no such rule."""
    rules = _row_rules(c)
    if not rules:
        return None
    return _rows(df.agg(*[F.count_if(test).alias(f"c{i}") for i, (_, test) in enumerate(rules)]), name, [r for r, _ in rules])


def _row_rules(c: Contract) -> list[tuple[tuple[str, str], Column]]:
    """((rule, column), violated) of each NOT NULL and length rule."""
    rules = [(("not_null", col), F.col(col).isNull()) for col in c.not_null]
    return rules + [(("max_length", col), F.length(col) > n) for col, n in c.max_length.items()]


def _one_scan(df: DataFrame, name: str, c: Contract, refs: dict[str, DataFrame]) -> DataFrame | None:
    """All rules of one table from one scan: its keys are grouped side by side by GROUPING SETS, and the empty set counts
    what single rows violate. A foreign key is looked up in ``refs`` (column -> its different values as ``__ref``) by a left
    join, which adds no rows."""
    rules = _row_rules(c)
    d = df.select(*dict.fromkeys([*c.key, *c.natural_key, *c.foreign_keys, *c.not_null, *c.max_length]))
    for i, (col, ref) in enumerate(refs.items()):
        d = d.join(ref.withColumnRenamed("__ref", f"__ref{i}"), F.col(col) == F.col(f"__ref{i}"), "left")
        rules.append((("foreign_key", col), F.col(col).isNotNull() & F.col(f"__ref{i}").isNull()))
    keys = [("primary_key_unique", list(c.key))] if c.key else []
    keys += [("unique", list(c.natural_key))] if c.natural_key else []
    if not keys and not rules:
        return None
    by = list(dict.fromkeys(col for _, cols in keys for col in cols))
    # grouping columns are copies: the rules look at the rows' own values
    d = d.select("*", *[F.col(col).alias(f"__k_{col}") for col in by])
    one = [F.coalesce(F.sum(F.when(test, 1)), F.lit(0)).alias(f"__c{i}") for i, (_, test) in enumerate(rules)]
    sets = [[f"__k_{col}" for col in cols] for _, cols in keys] + [[]]
    many = d.groupingSets(sets, *[f"__k_{col}" for col in by]).agg(F.count(F.lit(1)).alias("__n"), F.grouping_id().alias("__set"), *one)

    def set_of(cols: list[str]) -> int:
        return int("".join("0" if col in cols else "1" for col in by) or "0", 2)

    none = set_of([])
    out = []
    for i, (rule, _) in enumerate(rules):
        out.append((rule, F.coalesce(F.max(F.when(F.col("__set") == none, F.col(f"__c{i}"))), F.lit(0))))
    for rule, cols in keys:
        hit = (F.col("__set") == set_of(cols)) & (F.col("__n") > 1)
        if rule == "unique":  # NULLs are distinct there
            hit = hit & reduce(lambda a, b: a & b, [F.col(f"__k_{col}").isNotNull() for col in cols])
        out.append(((rule, ",".join(cols)), F.count_if(hit)))
    return _rows(many.agg(*[v.cast("long").alias(f"c{i}") for i, (_, v) in enumerate(out)]), name, [r for r, _ in out])


def validate(tables: dict[str, tuple[DataFrame, Contract]]) -> DataFrame:
    """Check every table against its contract, each in one scan; foreign keys resolve against the other ``tables``."""
    parts: list[DataFrame] = []
    for name, (df, c) in tables.items():
        refs = {}
        for col, (ref_table, ref_col) in c.foreign_keys.items():
            if ref_table in tables:
                ref = tables[ref_table][0].select(F.col(ref_col).alias("__ref")).distinct()
                refs[col] = checked_broadcast(ref, REF_BROADCAST_MAX_ROWS)
        found = _one_scan(df, name, c, refs)
        if found is not None:
            parts.append(found)
    return reduce(DataFrame.unionByName, parts)


def assert_valid(report: DataFrame) -> None:
    """Fail the load when any rule has violations (only the failing rows reach the driver)."""
    bad = report.where(F.col("violations") > 0).collect()  # at most a row per rule
    if bad:
        raise ValueError("constraint violations: " + "; ".join(
            f"{r.table_name}.{r.rule}({r.column_name})={r.violations}" for r in bad))
