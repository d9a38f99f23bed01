"""Quality, toxicity and language on labelled rows that the models have not seen, and on odd tables."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stellate.llm import language, quality, queries, toxicity

from . import cases


def _auc(score, label):
    score, label = np.array(score), np.array(label)
    rank = np.empty(len(score))
    rank[np.argsort(score, kind="stable")] = np.arange(1, len(score) + 1)
    ones = label.sum()
    return (rank[label == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(label) - ones))


# ---- quality -----------------------------------------------------------------------------------------------------


def test_quality_of_held_out_documents(spark):
    out = queries.QUERIES["op8_random_indexing"](spark, cases.SF)
    assert dict(out.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    rows = cases.collect(out.join(cases.labels(spark), "doc_id", "left"))
    assert len(rows) == 1000
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    held = [r for r in rows if r["held_out"] and r["quality"] is not None]
    assert _auc([r["score"] for r in held], [r["quality"] for r in held]) > 0.97


def test_quality_learns_nothing_from_held_out_labels(spark):
    docs, labels = cases.documents(spark), cases.labels(spark)
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    first = {r["doc_id"]: r["score"] for r in cases.collect(quality.quality_scores(docs, labels))}
    assert first == pytest.approx({r["doc_id"]: r["score"] for r in cases.collect(quality.quality_scores(docs, turned))}, abs=1e-6)


def test_contexts_are_the_neighbours_of_all_texts(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "b a"), (3, None), (4, "c")], "doc_id long, text string").repartition(3)
    place, sign = quality.index_vectors()
    import pyarrow as pa

    bucket = dict(zip("abc", quality.tokens(pa.array(["a b c"]))[0].tolist()))
    vector = lambda t: np.bincount(place[bucket[t]], weights=sign[bucket[t]], minlength=quality.SIZE)
    found = quality.contexts(docs)
    assert np.allclose(found[bucket["a"]], 2 * vector("b") + vector("c"))
    assert np.allclose(found[bucket["b"]], 2 * vector("a") + vector("c"))
    assert np.allclose(found[bucket["c"]], vector("a") + vector("b")) and np.count_nonzero(np.abs(found).sum(axis=1)) == 3


def test_temperature_makes_scores_honest():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 6))
    y = (rng.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(int)
    p = quality.train(x[:3000], y[:3000]).probability(x[3000:])
    for low in (0.0, 0.25, 0.5, 0.75):
        own = (p >= low) & (p < low + 0.25)
        assert abs(y[3000:][own].mean() - p[own].mean()) < 0.1


def test_quality_of_odd_and_empty_tables(spark):
    odd, labels = cases.odd_documents(spark), cases.labels(spark).limit(5)
    out = cases.collect(quality.quality_scores(odd, labels))
    assert len(out) == len(cases.rows()) and all(0 <= r["score"] <= 1 for r in out)
    assert {r["held_out"] for r in out if r["doc_id"] is None} == {True}
    kept = quality.keep_good(odd, labels)
    assert kept.schema == odd.schema
    assert quality.quality_scores(cases.no_documents(spark), labels).count() == 0
    assert {r["score"] for r in cases.collect(quality.quality_scores(odd, cases.no_labels(spark)))} == {0.5}


# ---- toxicity ----------------------------------------------------------------------------------------------------


def test_toxicity_of_documents_not_learned_from(spark):
    docs, labels = cases.documents(spark), cases.labels(spark)
    unseen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 1
    out = toxicity.toxicity(docs, labels.where(~unseen))
    rows = cases.collect(out.join(labels.where(unseen), "doc_id").select("doc_id", "is_toxic", F.col("toxic_label") if "toxic_label" in out.columns else out["toxic"], labels["toxic"].alias("label"), "quality"))
    good = [r for r in rows if r["quality"] == 1]
    caught = [r["is_toxic"] for r in good if r["label"] == 1]
    false = [r["is_toxic"] for r in good if r["label"] == 0]
    assert np.mean(caught) >= 0.7 and np.mean(false) <= 0.05


def test_later_models_see_out_of_fold_predictions():
    rng = np.random.default_rng(1)
    n, width = 600, 40
    features = [np.flatnonzero(rng.random(width) < 0.1) for _ in range(n)]
    at = np.append(0, np.cumsum([len(f) for f in features]))
    rows = toxicity.Rows(np.concatenate(features), at, width)
    labels = [rng.integers(0, 2, n), rng.integers(0, 2, n)]  # noise: in-sample predictions would look informative
    chain = toxicity.train_chain(rows, np.ones(n, dtype=int), labels, np.arange(n) % 5)
    assert len(chain.models) == 2 and len(chain.models[1].dense) == len(chain.models[0].dense) + 1
    assert rows.take(np.array([3, 1])).features.tolist() == [*features[3], *features[1]]


def test_labels_that_mean_nothing_are_not_predicted_out_of_fold(spark):
    rng = np.random.default_rng(4)
    texts = [(i, " ".join(f"w{k:05d}x" for k in rng.integers(0, 80000, 400))) for i in range(800)]  # rare words, each in few documents
    noise = spark.createDataFrame([(i, int(x)) for i, x in enumerate(rng.random(800) < 0.15)], "doc_id long, toxic int")
    known = toxicity.gather(spark.createDataFrame(texts, "doc_id long, text string"), noise)
    _, outside = toxicity.train_models(known.rows, known.words, known.labels(), known.folds, known.sets)
    assert 0.4 < _auc(outside[:, -1], known.toxic) < 0.6
    # features chosen with the labels of the predicted fold would look informative
    widest = np.repeat(known.sets[-1:], toxicity.FOLDS + 1, axis=0)
    words = np.repeat(known.words[:, -1:], toxicity.FOLDS + 1, axis=1)
    _, leaking = toxicity.train_models(known.rows, words, [known.labels()[-1]], known.folds, widest)
    assert _auc(leaking[:, -1], known.toxic) > 0.65


def test_a_fold_is_predicted_without_its_labels(spark):
    docs, labels = cases.documents(spark), cases.labels(spark)
    first = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(toxicity.FOLDS)) == 0
    turned = labels.withColumn("toxic", F.when(first, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    out = []
    for given in (labels, turned):
        known = toxicity.gather(docs, given)
        models, outside = toxicity.train_models(known.rows, known.words, known.labels()[:1], known.folds, known.sets)
        out.append(outside[known.folds == 0, 0])
    assert len(out[0]) > 50 and np.allclose(out[0], out[1], atol=1e-9)


def test_narrow_categories_are_never_likelier(spark):
    out = toxicity.toxicity(cases.documents(spark), cases.labels(spark))
    assert out.where("severe > repeated or repeated > toxic").count() == 0 and out.where("repeated > 0.5").count() > 0


def test_toxicity_of_odd_and_empty_tables(spark):
    odd, labels = cases.odd_documents(spark), cases.labels(spark).limit(30)
    out = cases.collect(toxicity.toxicity(odd, labels))
    assert len(out) == len(cases.rows()) and all(0 <= r[c] <= 1 for r in out for c in toxicity.CATEGORIES)
    assert toxicity.keep_clean(odd, labels).schema == odd.schema
    assert toxicity.toxicity(cases.no_documents(spark), labels).count() == 0
    assert not any(r["is_toxic"] for r in cases.collect(toxicity.toxicity(odd, cases.no_labels(spark))))


def test_toxicity_query(spark):
    out = queries.QUERIES["op1_toxicity_chain"](spark, cases.SF)
    rows = cases.collect(out.join(cases.labels(spark).select("doc_id", F.col("toxic").alias("label")), "doc_id"))
    assert out.count() == 1000 and np.mean([r["is_toxic"] == (r["label"] == 1) for r in rows]) > 0.95


# ---- language ----------------------------------------------------------------------------------------------------


def test_language_of_pages(spark):
    out = cases.collect(queries.QUERIES["op2_language_fusion"](spark, cases.SF))
    assert len(out) == 250 and np.mean([r["language"] == r["declared"] for r in out]) > 0.97 and all(r["accepted"] for r in out)


def test_evidence_beside_the_text_decides_short_pages(spark):
    rows = [(i, f"http://h{i % 3}.deutsch.de/", "<html lang='de'><p>der die das und nicht ein schöner Tag im Garten</p>") for i in range(30)]
    rows += [(100 + i, "http://x.english.com/", "<html lang=en><p>the and of a nice day in the garden with friends</p>") for i in range(30)]
    rows += [(200, "http://h1.deutsch.de/", "<html lang=de>ab"), (201, "http://y.english.com/", "<html lang='en'>ab"), (202, "http://h1.deutsch.de/", "ab")]
    labelled = spark.createDataFrame([("der die das und nicht ein schöner Tag im Garten", "de"), ("the and of a nice day in the garden with friends", "en")], "text string, lang string")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["language"] for r in cases.collect(language.identify_pages(pages, labelled, ("de", "en")))}
    assert found[200] == found[202] == "de" and found[201] == "en" and found[5] == "de" and found[110] == "en"


def test_languages_are_those_of_the_labelled_rows(spark):
    said = {
        "de": "der die das und nicht ein schöner Tag im Garten", "en": "the and of a nice day in the garden with friends",
        "es": "el la los y de un buen día en el jardín con amigos", "fr": "le la les et de une belle journée au jardin avec des amis",
        "it": "il lo gli e di una bella giornata nel giardino con gli amici che sono qui", "NL-be": "de het een en van mooie dag in de tuin met vrienden die hier zijn",
    }
    rows = [(text, lang) for lang, text in said.items() for _ in range(40)] + [("kort", "sv")] * 2 + [("?", "und")] * 50 + [("x", None), (None, ""), ("y", "123")]
    labelled = spark.createDataFrame(rows, "text string, lang string")
    assert language.languages_of(labelled) == ("de", "en", "es", "fr", "it", "nl")
    assert language.languages_of(labelled.limit(0)) == language.LANGUAGES
    # nothing but the text tells the language of these pages
    pages = spark.createDataFrame([(i, "http://h.example/", f"<p>{text}</p>") for i, text in enumerate(said.values())], "page_id long, url string, html string")
    found = {r["page_id"]: r["language"] for r in cases.collect(language.identify_pages(pages, labelled))}
    assert found == dict(enumerate(["de", "en", "es", "fr", "it", "nl"]))


def test_many_languages(spark):
    rng = np.random.default_rng(5)
    words = [["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(30)] for _ in range(60)]
    codes = [a + b for a in "abcdef" for b in "ghijklmnop"]
    text = lambda k: " ".join(rng.choice(words[k], 20))
    labelled = spark.createDataFrame([(text(k), codes[k]) for k in range(60) for _ in range(5)], "text string, lang string")
    pages = spark.createDataFrame([(k, f"http://h{k % 7}.a.example/", text(k)) for k in range(60)], "page_id long, url string, html string")
    found = {r["page_id"]: r["language"] for r in cases.collect(language.identify_pages(pages, labelled))}
    assert np.mean([found[k] == codes[k] for k in range(60)]) > 0.95


def test_visible_text():
    page = b"a<b>c</b><script>var x='<p>no</p>';</script>d<style>p{}</style><p title='q'>e &eacute;"
    assert language.visible(page).split() == ["a", "c", "d", "e", "é"] or [w.decode() for w in language.visible(page).split()] == ["a", "c", "d", "e", "é"]
    assert language.visible(None) == b"" and language.visible(b"<") == b" " or language.visible(b"<") == b""


def test_language_of_odd_and_empty_tables(spark):
    odd, docs = cases.odd_documents(spark), cases.documents(spark)
    kept = language.keep_identified(odd.unionByName(docs, allowMissingColumns=True))
    assert kept.columns == odd.columns
    texts = [r["text"] for r in cases.collect(kept.where("host = 'h'"))]
    assert "hello world" in texts and None not in texts and "" not in texts and "12345 678" not in texts
    assert kept.where("score is null and doc_id is not null").count() == 1000
    assert language.keep_identified(cases.no_documents(spark)).count() == 0
    pages = spark.createDataFrame([(None, None, None), (1, "", ""), (1, "no address", "<html lang=>"), (2, "http://", "<html lang='zz'>le la les"), (2, "http://a", "x")], "page_id long, url string, html string")
    out = cases.collect(language.identify_pages(pages, docs.select("text", "lang")))
    assert len(out) == 5 and sum(r["accepted"] for r in out) <= 2
    assert language.identify_pages(pages.limit(0), docs.select("text", "lang")).count() == 0
