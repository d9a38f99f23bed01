"""Grammars round trip, random access, and files read back."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from stellate.llm import files, queries
from stellate.llm.repair import Shard, compress, expansion_lengths, expand, read, token_files, write
from stellate.llm.tokens import default_vocabulary
from stellate.sources.workspace import new_dir

from . import cases


def _shard(documents, base):
    counts = np.array([len(d) for d in documents], dtype=np.int64)
    ids = np.concatenate([np.array(d, dtype=np.uint32) for d in documents]) if len(documents) else np.zeros(0, np.uint32)
    symbols, own, rules = compress(ids, counts, base)
    return Shard(base, list(range(len(documents))), own, rules, expansion_lengths(rules, base), symbols)


@pytest.mark.parametrize("seed", range(4))
def test_round_trip_and_random_access(seed):
    rng = np.random.default_rng(seed)
    documents = [rng.integers(0, 6, rng.integers(0, 400)).tolist() for _ in range(60)] + [[5] * 301, [], [1, 2] * 200]
    shard = Shard.from_bytes(_shard(documents, 10).to_bytes())
    assert len(shard.symbols) < 0.6 * sum(map(len, documents)) and len(shard.rules)
    ids, counts = shard.all_tokens()
    assert counts.tolist() == [len(d) for d in documents] and ids.tolist() == [i for d in documents for i in d]
    for k, own in enumerate(documents):
        assert shard.document(k).tolist() == own
        for start, stop in ((0, len(own)), (3, 9), (len(own) // 2, len(own) // 2 + 5)):
            if stop <= len(own):
                assert shard.tokens(k, start, stop).tolist() == own[start:stop]
    for rule, length in zip(range(len(shard.rules)), shard.lengths):
        assert len(expand(np.array([10 + rule], dtype=np.uint16), shard.rules, 10)) == length


def test_damaged_files_are_refused():
    data = bytearray(_shard([[1, 2, 3] * 50], 10).to_bytes())
    data[-1] ^= 1
    with pytest.raises(ValueError):
        Shard.from_bytes(bytes(data))


def _want(rows):
    library, start, out = Tokenizer.from_file(default_vocabulary()), 0, []
    for doc, text in rows:
        ids = (library.encode(text, add_special_tokens=False).ids if text else []) + [1]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_query_over_all_documents(spark):
    rows = sorted(tuple(r) for r in cases.documents(spark).select("doc_id", "text").collect())
    out = cases.collect(queries.QUERIES["op10_repair_token_files"](spark, cases.SF))
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in out) == _want(rows)


def test_odd_and_empty_tables(spark):
    out = cases.collect(token_files(cases.odd_documents(spark)))
    out.sort(key=lambda r: r["start"])
    ids = [r["doc_id"] for r in out]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [r["start"] for r in out] == np.append(0, np.cumsum([r["n_tokens"] for r in out])[:-1]).tolist()
    want = sorted((-1 if d is None else d, n, c) for d, _, n, c in _want([(r[0], r[1]) for r in cases.rows()]))
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in out) == want
    assert token_files(cases.no_documents(spark)).count() == 0


def test_small_shards_and_manifest(spark):
    folder = new_dir(spark, "ids")
    manifest = write(cases.documents(spark), folder, shard_tokens=20_000)
    assert manifest.count() > 20
    out = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in cases.collect(read(manifest, folder)))
    assert out == _want(sorted(tuple(r) for r in cases.documents(spark).select("doc_id", "text").collect()))


@pytest.mark.parametrize("base", [60_000, 65_000, 65_536, 100_000, 3_000_000_000])
def test_large_ids(base):
    """Ids that 16 bits can't hold, or that leave them no room for rules."""
    rng = np.random.default_rng(base)
    some = rng.integers(base - 9, base, 8).tolist()
    documents = [[some[i] for i in rng.integers(0, 8, 300)] for _ in range(30)] + [[base - 1, 0, base - 1], []]
    shard = _shard(documents, base)
    assert shard.symbols.dtype.itemsize == (2 if base <= (1 << 16) - 4096 else 4) and len(shard.rules)
    back = Shard.from_bytes(shard.to_bytes())
    ids, counts = back.all_tokens()
    assert ids.tolist() == [i for d in documents for i in d] and counts.tolist() == [len(d) for d in documents]
    assert back.document(3).tolist() == documents[3] and back.tokens(4, 7, 60).tolist() == documents[4][7:60]


def test_ids_beyond_the_vocabulary_are_refused():
    with pytest.raises(ValueError):
        _shard([[1, 2, 10]], 10)


def test_files_of_a_large_vocabulary(spark, tmp_path):
    """100,000 words, read back id by id."""
    from tokenizers import models, pre_tokenizers

    own = Tokenizer(models.WordLevel({f"w{i}": i for i in range(100_000)}, unk_token="w0"))
    own.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    path = str(tmp_path / "large.json")
    own.save(path)
    texts = [" ".join(f"w{(i * 7 + k) % 50 * 1999}" for k in range(200)) for i in range(20)]
    out = cases.collect(token_files(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), vocabulary=path))
    for r in out:
        ids = own.encode(texts[r["doc_id"]]).ids + [1]
        assert max(ids) > 1 << 16 and (r["n_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))


def test_folders_belong_to_spark_s_file_system(spark, monkeypatch):
    """A path without scheme is one of the cluster's default file system, for Spark and for the tasks alike."""
    assert files.qualified(spark, "/some/where") == "file:/some/where"
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    before = settings.get("fs.defaultFS")
    settings.set("fs.defaultFS", "viewfs://store/")
    settings.set("fs.viewfs.mounttable.store.link./in", "file:///tmp")
    try:
        assert files.qualified(spark, "/in/x") == "viewfs://store/in/x"
    finally:
        settings.set("fs.defaultFS", before)


def test_many_files_have_bounded_readers(spark, monkeypatch):
    monkeypatch.setattr(files, "MOST_READERS", 3)
    folder = new_dir(spark, "ids")
    manifest = write(cases.documents(spark), folder, shard_tokens=50_000)
    out = read(manifest, folder)
    assert manifest.count() > 3 and out.rdd.getNumPartitions() == 3 and out.count() == cases.documents(spark).count()
