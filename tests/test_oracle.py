"""Every registered query against its SQL twin."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from stellate.queries import registry

from .compare import connect, differences

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    with connect(SF) as c:
        yield c


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    assert differences(df, con, entry.oracle_sql()[name]) == []


def test_comparison_sees_differences(spark, con):
    df = entry.queries()["drop_null_any"](spark, SF)
    assert differences(df, con, entry.oracle_sql()["drop_null_subset"])


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_import_needs_no_session():
    root = Path(__file__).parent.parent
    subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert e.queries()"], check=True, cwd=root)
