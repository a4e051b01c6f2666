"""A corpus pipeline: toxicity, near-duplicates, decontamination, personal data, tokens.

``run`` applies the stages in order, each to what the one before kept.

In every stage a null text counts as empty and stays null in its row, rows with a null doc_id are judged
by their texts like any other, repeated rows are judged alike (of rows with one doc_id the
near-duplicate stage keeps one), an empty table gives an empty table, and further columns, whatever
their names, pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontaminate, pseudonyms, simhash, toxicity
from tessera.llm.common import staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar, fitted on the training folds of the labels, accepts."""
    grammar = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, grammar)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints, the one of the smallest id."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with pseudonyms for personal data; n_chars follows the text."""
    hidden = pseudonyms.pseudonymise(docs)
    return hidden.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("bigint"))).select(*docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the decoded bytes, and the ids."""
    return bpe.round_trip(docs, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pseudonyms", hide_personal_data),
    ("byte_bpe", tokenise),
]

#: SQL can't fit the grammar or apply the merges; tests/llm/test_pipeline.py has a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what each stage keeps is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
