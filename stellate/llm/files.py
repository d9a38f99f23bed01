"""Files that tasks write into the shared folder and read from it, on any file system that pyarrow knows by its URI."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

#: Tasks that read a list of files at most; each takes its files one after the other.
MOST_READERS = 20_000


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; a plain path is a local (mounted) one."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder's whole URI, as Spark understands it: a path without a scheme belongs to the cluster's default file system,
    which need not be the local one that ``open_fs`` takes it for."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def readers(files: DataFrame) -> DataFrame:
    """A list of files dealt to tasks: one each, or several if there are more than ``MOST_READERS``."""
    return files.repartition(min(max(1, files.count()), MOST_READERS))


def join(folder: str, *parts: str) -> str:
    return "/".join([folder.rstrip("/"), *parts])


def attempt_name(final: str) -> str:
    """A name that no other attempt of the same task uses."""
    return f"{final}.{uuid.uuid4().hex}.tmp"


def commit(folder: str, temporary: str, final: str) -> None:
    """Give a finished file its final name. Repeating it changes nothing."""
    store, path = open_fs(folder)
    done = store.get_file_info(join(path, final))
    if done.type == fs.FileType.File and store.get_file_info(join(path, temporary)).type == fs.FileType.NotFound:
        return
    store.move(join(path, temporary), join(path, final))


def publish(listed: DataFrame, folder: str) -> DataFrame:
    """Give the files of a written list (``temporary``, ``final``) their final names, then write it as the manifest."""

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                commit(folder, row["temporary"], row["final"])
            yield batch

    path = join(folder, "manifest.parquet")
    listed.mapInArrow(rename, listed.schema).write.parquet(path)
    return listed.sparkSession.read.schema(listed.schema).parquet(path)
