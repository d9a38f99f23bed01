"""Where jobs keep intermediate tables and stream checkpoints."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster: ``spark.checkpoint.dir``, or a folder below the session's warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or spark.conf.get("spark.sql.warehouse.dir") + "/_work").rstrip("/")


def new_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/stellate/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that is not read any more."""
    store = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(store, True)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table below the shared folder and read it back: later steps neither repeat its work nor
    depend on the executors that did it."""
    path = new_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
