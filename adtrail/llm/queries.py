"""Registered queries of the operators: one ``opN_<name>`` each, over the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtrail.llm import (
    bit_mixing, conversation_repair, conversation_trie, disclosure, id_codec, importance, language_id, licenses, mixing, pivot_search, quality_rules, shingle_join,
    token_automaton)
from adtrail.staging import session_scope

TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.quality_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), session_scope(spark))


def op2_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_codec.write_and_read(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID, session_scope(spark))


def op3_token_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_automaton.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op5_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.link_components(table(spark, sf_dir, "documents"), session_scope(spark))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"), session_scope(spark))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), session_scope(spark))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", *quality_rules.RULES)


def op9_bit_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = lambda d: F.coalesce(language_id.fold(d["doc_id"], 5) == 1, F.lit(False))
    out = bit_mixing.score(docs, lambda d: ~held(d), session_scope(spark))
    return out.withColumn("held_out", held(out))


def op10_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.top_k(table(spark, sf_dir, "embeddings"), session_scope(spark))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.damaged_and_repaired(table(spark, sf_dir, "conversations"), session_scope(spark))


def op12_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.personal_data(table(spark, sf_dir, "documents"), session_scope(spark))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.rebuilt_trie(table(spark, sf_dir, "conversations"), session_scope(spark))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_importance_resampling, op2_id_files, op3_token_automaton, op4_language_id, op5_shingle_join, op6_source_mix,
    op7_license_scan, op8_quality_rules, op9_bit_mixing, op10_pivot_search,
    op11_conversation_repair, op12_disclosure, op13_conversation_trie)}
