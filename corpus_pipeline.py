"""The corpus pipeline: five operators of ``adtrail.llm``, each on what its predecessor kept.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; between stages the rows
are written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adtrail.llm import language_id, mixing, quality_rules, shingle_join, token_automaton
from adtrail.llm.queries import table, tokenizer_path
from adtrail.staging import session_scope

NEAR = {"size": 5, "num": 80, "den": 100}       # shingles of five words, Jaccard 0.8 or more
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough confidence stay."""
    return language_id.keep_known(docs).select(*COLUMNS)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the risk-controlled rules keep stay."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"), session_scope(spark)).select(*COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays."""
    return shingle_join.one_of_each(docs, session_scope(spark), **NEAR).select(*COLUMNS)


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_documents(docs, session_scope(spark)).select(*COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and the decoded text."""
    return token_automaton.encode_decode(docs, tokenizer_path())


STAGES = [
    ("language_id", known_language),
    ("quality_rules", good_quality),
    ("shingle_join", without_near_copies),
    ("source_mix", to_target_weights),
    ("token_automaton", token_ids),
]

# The classifier, the knapsack and the tokenizer are not expressible in SQL;
# tests/llm compares the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    staging = session_scope(spark)
    for name, stage in STAGES[:-1]:
        docs = staging.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
