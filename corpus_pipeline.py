"""A cleaning pipeline over ``documents``; each stage works on all that the one before kept.

Language identification, quality classifier, SimHash near-duplicates, benchmark decontamination, best-fit packing. What a
stage rejects is gone; all but the last return the columns of ``documents``.

No stage fails on null or repeated ids, null, empty or very long texts, repeated rows, an empty table, or other columns of any
name; each says what becomes of such rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stellate.llm import decontaminate, language, packing, quality, simhash
from stellate.sources.workspace import store


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is accepted. Texts that are null, empty or without a letter go; repeated rows stay or go each."""
    return language.keep_identified(docs)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted good. Null and empty texts are scored like texts without tokens, repeated rows each."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints (3-word shingles) are connected by at most 3 differing bits: that with the
    least id, null last. Texts without words are one group."""
    return simhash.deduplicate(docs, shingle=3, max_bits=3)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lie in windows of benchmark items. Null and empty texts stay; an
    empty benchmark removes nothing."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 2048 tokens. A text without tokens is one piece, the end id."""
    return packing.pack_documents(docs)


STAGES = [
    ("language identification", identify_language),
    ("quality classifier", keep_quality),
    ("SimHash near-duplicates", drop_near_duplicates),
    ("benchmark decontamination", decontaminate_benchmark),
    ("best-fit packing", pack),
]

#: Stages train models and compare fingerprints, which SQL can't express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each one's result written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
