"""Archives written and read back."""

import gzip
import hashlib
import io
import random

from pyspark.sql import functions as F

from stellate.llm import files, queries, warc
from stellate.sources.workspace import new_dir

from ..compare import connect, differences
from . import cases

SCHEMA = "page_id long, url string, html string, shard int, digest string"
BIG, OTHER = "<p>" + "long enough to be revisited " * 60, "é" * 700


def _rows():
    rows = [
        (1, "http://a.example/", BIG), (9, "http://b.example/", BIG), (4, None, BIG), (4, None, BIG), (5, "u", "short"), (6, "u", "short"), (7, "u", None),
        (8, "u", ""), (None, "u", BIG), (None, None, None), (10, "http://x/\r\nEvil: 1 é", OTHER), (11, "u", OTHER), (11, "u", OTHER), (11, "v", OTHER),
        (12, "u", "a" * 999), (13, "u", "a" * 999), (14, "u", "b" * 1000), (15, "u", "b" * 1000), (None, "w", "c" * 1000), (None, "w", "c" * 1000),
        (16, "u", "WARC/1.1\r\n\r\n" * 200),
    ]
    return rows + [(100 + i, "http://hot.example/", "hot " * 500) for i in range(40)]


def _want(rows):
    """Counter-like list of (page_id, bytes, digest, type, refers_to)."""
    out, groups = [], {}
    for page, _, html in rows:
        data = (html or "").encode()
        groups.setdefault(hashlib.sha1(data).hexdigest(), (len(data), []))[1].append(page)
    for digest, (size, pages) in groups.items():
        if size < 1000 or len(pages) == 1:
            out += [(p, size, digest, "response", None) for p in pages]
        else:
            pages.sort(key=lambda p: (p is not None, p or 0))
            head = pages.pop()
            out += [(head, size, digest, "response", None)] + [(p, size, digest, "revisit", head) for p in pages]
    return sorted(out, key=str)


def _got(df):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in cases.collect(df)), key=str)


def test_query_is_its_sql(spark):
    with connect(cases.SF) as con:
        assert differences(queries.QUERIES["op5_warc_archives"](spark, cases.SF), con, queries.SQL["op5_warc_archives"]) == []


def test_odd_and_empty_tables(spark):
    frame = spark.createDataFrame([(*r, 1, "x") for r in _rows()], SCHEMA)
    assert _got(warc.round_trip(frame)) == _want(_rows())
    assert warc.round_trip(frame.limit(0)).count() == 0


def _pages(spark):
    return spark.read.parquet(f"{cases.SF}/pages.parquet")


def test_files_roll_and_are_whole(spark):
    folder = new_dir(spark, "warc")
    manifest = warc.write(_pages(spark), folder, roll_bytes=4000).collect()
    assert len(manifest) > 70 and any(m["number"] > 0 for m in manifest)
    store, place = files.open_fs(folder)
    names = {f.base_name for f in store.get_file_info(files.fs.FileSelector(place)) if f.base_name.endswith(".gz")}
    assert names == {m["final"] for m in manifest}
    for m in manifest[:10]:
        with store.open_input_stream(files.join(place, m["final"]), compression=None) as source:
            data = source.read()
        assert len(data) == m["bytes"] and data.count(b"\x1f\x8b\x08") >= m["records"] + 1
        text = gzip.decompress(data)
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and text.count(b"WARC/1.1\r\nWARC-Type: response") == m["records"]
    assert sum(m["records"] for m in manifest) == 250


def test_the_same_archives_each_time(spark):
    def written(pages):
        folder = new_dir(spark, "warc")
        out = {}
        store, place = files.open_fs(folder)
        for m in warc.write(pages, folder).collect():
            with store.open_input_stream(files.join(place, m["final"]), compression=None) as source:
                out[m["final"]] = hashlib.sha1(source.read()).hexdigest()
        return out

    assert written(_pages(spark)) == written(_pages(spark).repartition(5).orderBy(F.rand(3)))


def test_records_are_sorted_by_page_within_and_across_shards(spark):
    rows = warc.round_trip(_pages(spark)).orderBy("file", "position").select("page_id").collect()
    ids = [r[0] for r in rows]
    assert ids == sorted(ids)


def test_members_of_a_stream_in_small_reads():
    rng = random.Random(1)
    parts = [rng.randbytes(rng.randint(0, 3000)) for _ in range(30)]
    data = b"".join(warc.member(p) for p in parts)
    for step in (1, 7, 1000, 1 << 20):
        assert [p for _, p in warc.members(io.BytesIO(data), step)] == parts


def test_renaming_twice_changes_nothing(tmp_path):
    folder = f"file://{tmp_path}"
    (tmp_path / "x.tmp").write_bytes(b"1")
    files.commit(folder, "x.tmp", "x")
    files.commit(folder, "x.tmp", "x")
    assert (tmp_path / "x").read_bytes() == b"1"
