import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stellate.llm import merkle, queries

from ..compare import connect, differences
from . import cases


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(hashes):
    """Levels of a tree over some leaves."""
    levels = [list(hashes)]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def steps(levels, at):
    """Siblings left and right of a leaf's way up."""
    out = []
    for level in levels[:-1]:
        first = at - at % 3
        out.append((level[first:at], level[at + 1 : first + 3]))
        at //= 3
    return out


def manifest(rows, tampered):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of each (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0], leaf(*r), leaf(*tampered(r))))
    low = lambda v: (v is not None, v if v is not None else 0)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda x: (low(x[0]), x[1]))
        trees[s] = climb([x[1] for x in groups[s]])
    crown = climb([trees[s][-1][0] for s in order])
    out = []
    for i, s in enumerate(order):
        for at, (doc_id, own, copy) in enumerate(groups[s]):
            way, folded = steps(trees[s], at) + steps(crown, i), copy
            for left, right in way:
                folded = h(*left, folded, *right)
            proof = h(*[x for left, right in way for x in left + right])
            out.append((doc_id, own, trees[s][-1][0], crown[-1][0], proof, folded, folded == crown[-1][0]))
    return Counter(out)


def without_breaks(r):
    even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
    return (*r[:4], r[4].replace("\n", "") if even and r[4] is not None else r[4])


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def got(df):
    return Counter(tuple(r[c] for c in COLUMNS) for r in cases.collect(df))


def taken(df):
    return [tuple(r) for r in df.select(*merkle.DOCUMENT_FIELDS).collect()]


def test_query_against_sql(spark):
    assert differences(queries.QUERIES["op12_merkle_windows"](spark, cases.SF), connect(cases.SF), queries.SQL["op12_merkle_windows"]) == []


def test_query_against_definition(spark):
    out = got(queries.QUERIES["op12_merkle_windows"](spark, cases.SF))
    assert out == manifest(taken(cases.documents(spark)), without_breaks)
    assert 0 < sum(n for r, n in out.items() if not r[-1]) < sum(out.values())


@pytest.mark.parametrize("sizes", [[1], [2, 1, 4, 3], [9, 10, 28, 1, 81, 82, 2188, 5], [1] * 40])
def test_groups_of_any_size(spark, sizes):
    """Also groups of more than one block, and more groups than one run."""
    rows = [(1000 * k + i, f"s{k}" if k else None, "en", i, f"text\n{i}") for k, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert got(merkle.document_manifest(df, merkle.without_breaks)) == manifest(rows, without_breaks)


def test_several_rounds(spark, monkeypatch):
    """Blocks of one level: as many rounds as levels, for groups and for the tree over them."""
    monkeypatch.setattr(merkle, "LEVELS", 1)
    rows = [(i, f"s{i % 11}", None, None, str(i)) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert got(merkle.document_manifest(df)) == manifest(rows, lambda r: r)


def test_any_change_is_found(spark):
    docs = cases.documents(spark).limit(60)
    for change in (lambda d: d.withColumn("text", F.concat(F.coalesce("text", F.lit("")), F.lit(" "))), lambda d: d.withColumn("lang", F.lit(None).cast("string")), lambda d: d.withColumn("n_chars", F.col("n_chars") + 1)):
        assert merkle.document_manifest(docs, change).where("verified").count() == 0
    assert merkle.document_manifest(docs).where("not verified").count() == 0


def test_same_tree_in_any_layout(spark):
    docs = cases.documents(spark)
    assert got(merkle.document_manifest(docs)) == got(merkle.document_manifest(docs.repartition(13, "text")))


def test_odd_and_empty_tables(spark):
    odd = cases.odd_documents(spark).withColumns({"leaf": F.lit("clash"), "root": F.lit(1), "_g": F.lit("x"), "path": F.lit(2)})
    assert got(merkle.document_manifest(odd, merkle.without_breaks)) == manifest(taken(odd), without_breaks)
    assert merkle.document_manifest(cases.no_documents(spark)).count() == 0
