"""Small tables with everything that an operator has to bear."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, shard string, _fp string, _row int, items string, host string"

LONG = "The quick brown fox jumps over the lazy dog near the river bank. " * 4000
TEXTS = [
    None, "", "   \n\t ", "a", "A.", "12345 678", "!!! ***", "Hello, world", "hello world", "Hello, world", "é́ ﬁ Å 漢字 한국어 \U0001f600",
    "<|endoftext|> inside <|startoftext|>", "it's they're we'll don't", "\x01 control \x1f marks", "x" * 5000, LONG, LONG, "word " * 300,
    "The quick brown fox jumps over the lazy dog near the river bank today", "the quick brown fox",
]


def rows() -> list[tuple]:
    out = []
    for i, text in enumerate(TEXTS):
        out.append((i, text, ("en", None, "xx")[i % 3], (None, "hot", "hot")[i % 3], None if text is None else len(text), 1.5, "s", "f", 7, "i", "h"))
    out.append((None, "no id at all", "en", "hot", 12, None, None, None, None, None, None))
    out.append((None, None, None, None, None, None, None, None, None, None, None))
    out += [(3, "repeated row", "en", "hot", 12, 0.5, "s", "f", 7, "i", "h")] * 3
    out += [(50 + k, "a copy that is there many times over", "en", "hot", 36, 0.5, "s", "f", 7, "i", "h") for k in range(12)]
    return out


def odd_documents(spark: SparkSession) -> DataFrame:
    """Null ids and texts, empty and very long texts, ties, repeated rows, clashing column names."""
    return spark.createDataFrame(rows(), SCHEMA)


def no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def documents(spark: SparkSession) -> DataFrame:
    return spark.read.parquet(f"{SF}/documents.parquet")


def labels(spark: SparkSession) -> DataFrame:
    return spark.read.parquet(f"{SF}/labels.parquet")


def no_labels(spark: SparkSession) -> DataFrame:
    return labels(spark).where(F.lit(False))


def collect(df: DataFrame) -> list[dict]:
    return [r.asDict() for r in df.collect()]
