"""Scans."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import BLANKS, parse_number, strip_blanks

# Format by file extension. The last two need a third-party data source on the cluster.
FORMATS = {
    "csv": "csv",
    "txt": "text",
    "parquet": "parquet",
    "sas7bdat": "com.github.saurfang.sas.spark",
    "xlsx": "com.crealytics.spark.excel",
}


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
    infer: bool = False,
    **options,
) -> DataFrame:
    """Delimited text under a declared schema. Without one, columns are text; ``infer`` costs a second pass."""
    reader = spark.read.options(header=header, sep=sep, **options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", infer)
    return reader.csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines in a column ``value``; big files are split between tasks."""
    return spark.read.text(path)


def read_table(
    spark: SparkSession, path: str, base_path: str | None = None, schema: StructType | None = None
) -> DataFrame:
    """Parquet table. Give ``base_path`` when the path lies below the table's root, or partition columns are lost; give
    the ``schema`` when their types matter, as Spark takes a directory ``01`` for the number 1 otherwise."""
    reader = spark.read.option("basePath", base_path) if base_path else spark.read
    return (reader.schema(schema) if schema is not None else reader).parquet(path)


def _format_of(path: str, fmt: str | None) -> str:
    ext = fmt or os.path.splitext(path.rstrip("/"))[1].lstrip(".").lower()
    if ext not in FORMATS:
        raise ValueError(f"unknown file format {ext!r}: expected one of {sorted(FORMATS)}")
    return ext


def read_any(spark: SparkSession, path: str, fmt: str | None = None, **options) -> DataFrame:
    """Scan in the given format, or in the one that the file extension stands for."""
    ext = _format_of(path, fmt)
    if ext == "csv":
        return read_delimited(spark, path, **options)
    if ext == "txt":
        return read_lines(spark, path)
    return spark.read.format(FORMATS[ext]).options(**options).load(path)


def read_files(spark: SparkSession, paths: Sequence[str], fmt: str | None = None, **options) -> DataFrame:
    """One scan over many files of one format. Delimited files must have the same header, Parquet schemas are merged."""
    ext = _format_of(paths[0], fmt)
    if ext == "csv":
        return read_delimited(spark, list(paths), enforceSchema=False, **options)
    if ext == "parquet":
        options = {"mergeSchema": True} | options
    return spark.read.format(FORMATS[ext]).options(**options).load(list(paths))


def parse_dictionary(
    lines: DataFrame,
    key: str = "code",
    label: str = "label",
    key_type: str = "string",
    strip_label: bool = True,
    line_col: str = "value",
) -> DataFrame:
    """``'KEY' = 'LABEL'`` lines -> (key, label), split at the first ``=``; blank lines are skipped.

    Keys lose quotes and outer blanks; labels too, unless ``strip_label`` is off.
    """
    parts = F.split(line_col, "=", 2)
    bare = lambda c: strip_blanks(F.translate(c, "'", ""))
    code, raw_label = bare(F.get(parts, F.lit(0))), F.get(parts, F.lit(1))
    return lines.where(F.btrim(line_col, F.lit(BLANKS)) != "").select(
        (code if key_type == "string" else parse_number(code, key_type)).alias(key),
        (bare(raw_label) if strip_label else raw_label).alias(label),
    )
