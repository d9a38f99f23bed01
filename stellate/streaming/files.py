"""Incremental publishing with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.incremental import publish_incremental


def stream_files(
    spark: SparkSession,
    schema: StructType | str,
    src: str,
    dst: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    key: Sequence[str] | None = None,
    order_by: Sequence[Column | str] | None = None,
    max_files: int | None = None,
    **options,
) -> None:
    """Publish the files that arrived in ``src`` since the last run, then stop.

    The checkpoint remembers finished files, so a run without new files adds nothing and a run that died is resumed.
    Without ``key`` rows are appended by the file sink, exactly once, and ``transform`` must treat each row by itself.
    With it, each batch is transformed as an ordinary table (duplicate removal and lookups included) and merged into the
    published partitions (see ``publish_incremental``), so records that arrive again replace their earlier version.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    transform = transform or (lambda df: df)
    rows = reader.load(src) if key else transform(reader.load(src))
    writer = rows.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
    if key:
        merge = lambda batch, _: publish_incremental(transform(batch), dst, partition_by, key, order_by)
        query = writer.foreachBatch(merge).start()
    else:
        writer = writer.format("parquet").outputMode("append").option("path", dst)
        query = (writer.partitionBy(*partition_by) if partition_by else writer).start()
    query.awaitTermination()
