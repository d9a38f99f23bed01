"""Several tables published together, version by version.

Files are never replaced. Each run writes the partitions that it changes into directories of its own, for one table after
the other; nothing reads them yet. Then one small file, the next version, names for every table the directory that holds
each of its partitions: the new ones for what was written, the earlier ones for the rest. It gets its final name by a
rename, so all tables change at once or not at all: a run that dies before leaves directories that no version names, which
``clean`` removes, and it can simply be run again. Readers stay on the version that they have opened.

There is to be one writer at a time; a second one that commits the same number is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..sources.sinks import publish
from .incremental import merged

FOLDER = "_versions"


@dataclass(frozen=True)
class Piece:
    """What a run adds to a table: whole partitions, or with a ``key`` rows that are merged with what its partitions hold
    (one row per key, the first in ``order_by``; see ``merge_with_published``). ``df`` is read twice."""

    df: DataFrame
    partition_by: Sequence[str]
    key: Sequence[str] | None = None
    order_by: Sequence[Column | str] | None = None


def _store(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def _listed(spark: SparkSession, pattern: str) -> list[str]:
    store, path = _store(spark, pattern)
    return sorted(s.getPath().toString() for s in store.globStatus(path) or [])


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed versions, ascending."""
    names = [p.rpartition("/")[2] for p in _listed(spark, f"{root}/{FOLDER}/*.json")]
    return sorted(int(n.removesuffix(".json")) for n in names)


def tables_of(spark: SparkSession, root: str, version: int | None = None) -> dict[str, dict]:
    """For each table of a version (the latest one): ``schema`` (JSON), ``partition_by``, and ``partitions``, which maps a
    partition to the directory below the root that holds it."""
    known = versions(spark, root)
    if not known or version is not None and version not in known:
        if version is None:
            return {}
        raise ValueError(f"there is no version {version}, only {known}")
    path = f"{root}/{FOLDER}/{version or known[-1]:08d}.json"
    return json.loads(spark.read.option("wholetext", True).text(path).first()[0])


def read_version(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame:
    """A table as of a version, the latest one by default."""
    tables = tables_of(spark, root, version)
    if table not in tables:
        raise ValueError(f"no version holds a table {table!r}")
    return _read(spark, root, table, tables[table])


def _read(spark: SparkSession, root: str, table: str, held: dict) -> DataFrame:
    schema = StructType.fromJson(json.loads(held["schema"]))
    if not held["partitions"]:
        return spark.createDataFrame([], schema)
    paths = [f"{root}/{where}/{part}".rstrip("/") for part, where in held["partitions"].items()]
    rows = spark.read.schema(schema).option("basePath", f"{root}/{table}").parquet(*paths)
    return rows.select(*schema.names)


def stage(spark: SparkSession, root: str, table: str, piece: Piece, held: dict | None) -> dict:
    """Write a piece, merged with the partitions that ``held`` has, into a directory of its own; returns what the next
    version says of the table."""
    df = piece.df
    if piece.key:
        order = piece.order_by or [c for c in df.columns if c not in piece.key] or list(piece.key)
        df = merged(df, _read(spark, root, table, held) if held else None, piece.partition_by, piece.key, order)
    where = f"{table}/run={uuid.uuid4().hex}"
    publish(df, f"{root}/{where}", partition_by=piece.partition_by)
    depth = "/*=*" * len(piece.partition_by)
    written = [p.rpartition(f"{where}")[2].strip("/") for p in _listed(spark, f"{root}/{where}{depth}")]
    return {
        "schema": piece.df.schema.json(),
        "partition_by": list(piece.partition_by),
        "partitions": (held["partitions"] if held and piece.partition_by else {}) | {part: where for part in written},
    }


def commit(spark: SparkSession, root: str, tables: Mapping[str, dict], after: int) -> int:
    """Make a version of all tables visible by one rename; ``after`` is the version that it was made from."""
    number = after + 1
    if number in versions(spark, root):
        raise RuntimeError(f"version {number} is there already: another run has committed it")
    store, final = _store(spark, f"{root}/{FOLDER}/{number:08d}.json")
    _, temporary = _store(spark, f"{root}/{FOLDER}/.{uuid.uuid4().hex}.tmp")
    out = store.create(temporary, False)
    out.write(bytearray(json.dumps(tables).encode()))
    out.close()
    if not store.rename(temporary, final):
        raise RuntimeError(f"version {number} could not be committed")
    return number


def publish_version(spark: SparkSession, root: str, pieces: Mapping[str, Piece]) -> int:
    """Add pieces to several tables and make them visible together. Publishing the same pieces again changes no row.

    Tables without a piece stay as they are. A table without partitions is replaced, unless its piece has a key.
    """
    known = versions(spark, root)
    now = tables_of(spark, root)
    staged = {table: stage(spark, root, table, piece, now.get(table)) for table, piece in pieces.items()}
    return commit(spark, root, now | staged, known[-1] if known else 0)


def clean(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove versions but for the last ``keep``, and the partitions that none of these names; returns what was removed.

    Not to be run beside a writer, whose directories no version names yet.
    """
    known = versions(spark, root)
    used, tables = set(), set()
    for number in known[-keep:]:
        for table, held in tables_of(spark, root, number).items():
            used |= {f"{where}/{part}".rstrip("/") for part, where in held["partitions"].items()}
            tables.add((table, len(held["partition_by"])))
    old = [f"{root}/{FOLDER}/{n:08d}.json" for n in known[:-keep]]
    for table, depth in sorted(tables):
        for path in _listed(spark, f"{root}/{table}/run=*" + "/*=*" * depth):
            if path[path.index(f"/{table}/run=") + 1 :] not in used:
                old.append(path)
    for path in old:
        store, hadoop = _store(spark, path)
        store.delete(hadoop, True)
    return old
