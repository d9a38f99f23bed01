"""Sums of arrays over many tasks under a fixed number of keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Groups of tasks whose arrays are added up before the groups are.
GROUPS = 1024
KIND = "part int, data binary"


def part(number: int, values: np.ndarray) -> pa.RecordBatch:
    """One row: a part's number and its values."""
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([np.ascontiguousarray(values).tobytes()], pa.binary())], ["part", "data"])


def added(parts: DataFrame, kind: type, groups: int = GROUPS) -> DataFrame:
    """Sum of the arrays (of ``kind``) of each part, one row a part. ``parts`` has any number of rows a part in each task.

    Tasks are added up in ``groups`` groups first, so that the last step gets at most one array a part from each task of the
    step before, and that step a ``groups``-th of what all tasks give for a part. Sums are taken in 64 bits within a task.
    """
    wide = np.float64 if np.issubdtype(kind, np.floating) else np.int64

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, data in zip(batch.column("part"), batch.column("data")):
                values = np.frombuffer(data.as_buffer(), dtype=kind)
                if (own := sums.get(number.as_py())) is None:
                    sums[number.as_py()] = values.astype(wide)
                else:
                    own += values
        for number, values in sums.items():
            yield part(number, values.astype(kind))

    by_group = parts.withColumn("task", F.pmod(F.spark_partition_id(), F.lit(groups))).repartition("part", "task").select("part", "data")
    return by_group.mapInArrow(add, KIND).repartition("part").mapInArrow(add, KIND)
