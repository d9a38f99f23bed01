"""Arrays of many tasks, added up under few keys."""

import numpy as np
import pytest

from stellate.llm import sums


@pytest.mark.parametrize("kind", [np.int64, np.float32])
@pytest.mark.parametrize("groups", [1, 3, 1024])
def test_sums_of_all_tasks(spark, kind, groups):
    def give(batches):
        for batch in batches:
            for i in batch.column("id").to_pylist():
                yield sums.part(i % 3, np.array([i, 1], dtype=kind))

    out = sums.added(spark.range(0, 1000, 1, 40).mapInArrow(give, sums.KIND), kind, groups).collect()
    found = {r["part"]: np.frombuffer(r["data"], dtype=kind).tolist() for r in out}
    assert len(out) == 3 and found == {p: [sum(range(p, 1000, 3)), len(range(p, 1000, 3))] for p in range(3)}


def test_no_rows(spark):
    assert sums.added(spark.createDataFrame([], sums.KIND), np.int64).count() == 0
