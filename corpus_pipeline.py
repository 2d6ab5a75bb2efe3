"""A training corpus from ``documents``: quality rules, near duplicates, decontamination, mixing, token records."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strata.llm import automaton, budget, mcd, records, simhash
from strata.llm.common import prepare, staged, table

TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    prepare(spark)
    return mcd.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the least id; of rows that share an id
    the least by text, language, source. Rows without an id are kept."""
    prepare(spark)
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated, without what they share with the benchmark."""
    prepare(spark)
    return automaton.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the target weights take; one taken in two epochs comes twice."""
    prepare(spark)
    return budget.mixed_rows(docs)


def token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus as record files; one row per record, read back from them."""
    prepare(spark)
    return records.digest(spark, docs, public_tokenizers.path(TOKENIZER))


STAGES = [("quality rules", quality), ("SimHash near-dedup", near_duplicates), ("benchmark decontamination", decontaminated),
          ("mixing sources to target weights", mixed), ("token-ID / binary output", token_records)]

#: Tokenizers, XXH64 and components over it have no SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read by the next."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "stage-" + name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
