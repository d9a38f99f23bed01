"""The pipeline's stages against brute force, each on its own input, and what remains without the package."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline

from . import cases
from .test_decontaminate import _brute
from .test_packing import _check
from .test_simhash import _groups, _print

ROOT = Path(__file__).parent.parent.parent


@pytest.fixture(scope="module")
def stages(spark):
    """Rows of every stage over the test documents and odd ones, which come without labels."""
    documents = cases.documents(spark)
    odd = cases.odd_documents(spark).selectExpr("doc_id + 5000 AS doc_id", "text", "lang", "source", "n_chars")
    docs = documents.unionByName(odd).withColumnRenamed("n_chars", "n_chars")
    out = [("documents", docs.columns, docs.collect())]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.store(stage(spark, docs, cases.SF), "stage")
        out.append((name, docs.columns, docs.collect()))
    return out


def _rows(stage):
    return sorted(((r["doc_id"], r["text"]) for r in stage[2]), key=str)


def test_all_but_the_last_return_documents(stages):
    for name, columns, rows in stages[:-1]:
        assert columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    assert [len(s[2]) for s in stages[:-1]] == sorted((len(s[2]) for s in stages[:-1]), reverse=True)


def test_language_keeps_all_that_has_words(stages):
    kept = set(_rows(stages[1]))
    assert all((r in kept) == any(c.isalpha() for c in r[1] or "") for r in _rows(stages[0]) if r[0] is not None and r[0] < 5000)


def test_quality_drops_what_is_labelled_bad(spark, stages):
    label = {r["doc_id"]: r["quality"] for r in cases.labels(spark).collect()}
    kept = {r["doc_id"] for r in stages[2][2]}
    judged = [(r["doc_id"] in kept, label[r["doc_id"]]) for r in stages[1][2] if r["doc_id"] in label]
    assert sum(k == bool(q) for k, q in judged) >= 0.97 * len(judged)


def test_one_document_of_each_group_stays(stages):
    before, after = _rows(stages[2]), _rows(stages[3])
    roots = _groups(sorted({_print(t) for _, t in before}))
    least = {}
    for doc, text in before:
        root = roots[_print(text)]
        least[root] = min(least.get(root, (True, 0)), (doc is None, doc or 0))
    assert sorted((doc is None, doc or 0) for doc, _ in after) == sorted(least.values())


def test_contaminated_documents_go(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{cases.SF}/benchmark.parquet").collect()]
    before = _rows(stages[3])
    clean = [row for row, found in zip(before, _brute(before, items)) if not found[-1]]
    assert len(clean) < len(before) and _rows(stages[4]) == clean


def test_every_piece_of_what_is_left_is_packed(stages):
    _check([r.asDict() for r in stages[5][2]], _rows(stages[4]))


def test_run_is_its_stages(spark):
    docs = cases.documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.store(stage(spark, docs, cases.SF), "stage")
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    run = entry.queries()["pipeline"](spark, cases.SF)
    assert sorted(map(tuple, run.select(key).collect())) == sorted(map(tuple, docs.select(key).collect()))


def test_an_empty_table_passes_all_stages(spark):
    docs = cases.documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.store(stage(spark, docs, cases.SF), "stage")
        assert docs.count() == 0


def test_the_rest_works_without_the_package(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py", "spark-warehouse"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 70 and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=copy)


def test_every_operator_is_registered():
    names = entry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14)) and "pipeline" in names
