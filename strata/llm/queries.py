"""The registered query of each operator, over its whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strata.llm import (
    automaton, budget, chat_trie, mcd, parity_join, pii_crf, prefix_trie, records, simhash, splitters, toxicity, url_rules, vector_codes,
)
from strata.llm.common import prepare, table


def op1_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return records.digest(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pii_crf.find(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mcd.judge(table(spark, sf_dir, "documents"))


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return url_rules.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return budget.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(chat_trie.probe(spark))
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return chat_trie.digests(*chat_trie.build(rows, tokenizer), tokenizer)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return splitters.shard(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return automaton.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return vector_codes.encode(table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return prefix_trie.prefixes(table(spark, sf_dir, "conversations"))


def op13_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return parity_join.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_records, op2_pii, op3_quality, op4_urls, op5_mix, op6_chat, op7_toxicity,
                                   op8_simhash, op9_shards, op10_decontaminate, op11_vector_codes, op12_prefix_trie,
                                   op13_parity_join)}
#: DuckDB SQL of the operators that SQL can express.
ORACLE = {"op5_mix": budget.mix_sql(), "op11_vector_codes": vector_codes.encode_sql(), "op12_prefix_trie": prefix_trie.prefixes_sql(),
          "op13_parity_join": parity_join.near_duplicates_sql()}
