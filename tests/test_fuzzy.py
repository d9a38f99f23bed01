"""Fuzzy lookup against brute force, on both ways of scanning the reference list."""

import random

import pytest
from pyspark.sql import functions as F

from stellate.operators import fuzzy
from stellate.operators.fuzzy import fuzzy_lookup

WORDS = "north south east west new old island islands republic saint united land of the isle bay port cape".split()


def norm(s):
    out = "".join(ch if ch.isalnum() else " " for ch in s.lower())
    return " ".join(out.split())


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def brute_force(label, refs, min_score, stop_words=()):
    best = None
    seen = {}
    for r in sorted(refs):
        seen.setdefault(norm(r), r)
    seen.pop("", None)
    a, wa = norm(label), set(norm(label).split()) - set(stop_words)
    for b, value in seen.items():
        m = max(len(a), len(b))
        edit = 100 * (m - levenshtein(a, b)) // m if m else 0
        wb = set(b.split()) - set(stop_words)
        s = min(len(wa), len(wb))
        token = 90 * len(wa & wb) // s if s else 0
        key = (-max(edit, token), -edit, value)
        best = min(best, key) if best else key
    if best is None or (min_score is not None and -best[0] < min_score):
        return None, None
    return best[2], -best[0]


def names(rng, n):
    out = set()
    while len(out) < n:
        out.add(" ".join(rng.sample(WORDS, rng.randint(1, 4))).title())
    return sorted(out)


def damage(rng, s):
    s = list(s)
    for _ in range(rng.randint(0, 4)):
        i = rng.randrange(len(s) + 1)
        kind = rng.randrange(4)
        if kind == 0:
            s.insert(i, rng.choice("abcxyz -'"))
        elif kind == 1 and len(s) > 1:
            s.pop(min(i, len(s) - 1))
        elif kind == 2 and s:
            s[min(i, len(s) - 1)] = rng.choice("abcxyz")
        else:
            s = list(rng.choice(WORDS) + " " + "".join(s))
    return "".join(s)


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(5)
    refs = names(rng, 120)
    labels = [damage(rng, rng.choice(refs)) for _ in range(250)] + ["", "!!", "a", "zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzz"]
    return labels, refs


@pytest.mark.parametrize("min_score", [1, 70, 95, None])
@pytest.mark.parametrize("way", ["short", "blocks", "salted"])
def test_equals_brute_force(spark, cases, monkeypatch, min_score, way):
    labels, refs = cases
    max_packed = 2_000 if way == "short" else 0
    if way == "salted":
        monkeypatch.setattr(fuzzy, "BROADCAST_ROWS", 10)
        monkeypatch.setattr(fuzzy, "BLOCK_ROWS", 20)
        monkeypatch.setattr(fuzzy, "LABEL_SALTS", 3)
    df = spark.createDataFrame([(l,) for l in labels + labels[:50]], "label string")
    ref = spark.createDataFrame([(r,) for r in refs] + [("  ",), (None,)], "name string")
    out = fuzzy_lookup(df, "label", ref, "name", min_score, on_miss=None, max_packed=max_packed).collect()
    assert len(out) == len(labels) + 50
    got = {r.label: (r.match, r.score) for r in out}
    assert got == {l: brute_force(l, refs, min_score) for l in labels}


def test_stop_words(spark, cases):
    labels, refs = cases
    stop = ("island", "of", "the")
    df = spark.createDataFrame([(l,) for l in labels], "label string")
    ref = spark.createDataFrame([(r,) for r in refs], "name string")
    for packed in (2_000, 0):
        out = fuzzy_lookup(df, "label", ref, "name", 70, on_miss=None, stop_words=stop, max_packed=packed).collect()
        assert {r.label: (r.match, r.score) for r in out} == {l: brute_force(l, refs, 70, stop) for l in labels}


def test_miss_text_and_null_label(spark):
    df = spark.createDataFrame([("Chile",), ("qqq",), (None,)], "label string")
    ref = spark.createDataFrame([("CHILE",)], "name string")
    rows = {r.label: (r.match, r.score) for r in fuzzy_lookup(df, "label", ref, "name").collect()}
    assert rows == {"Chile": ("CHILE", 100), "qqq": ("No match found", None), None: (None, None)}


def test_threshold_is_checked(spark):
    df = spark.createDataFrame([("a",)], "label string")
    with pytest.raises(ValueError):
        fuzzy_lookup(df, "label", df, "label", min_score=101)


@pytest.mark.parametrize("name", ["norm", "block", "words", "best", "len"])
def test_any_column_name_will_do(spark, name):
    df = spark.createDataFrame([("Chile", 1)], f"{name} string, row int")
    ref = spark.createDataFrame([("CHILE",)], "name string")
    for packed in (2_000, 0):
        assert fuzzy_lookup(df, name, ref, "name", max_packed=packed).collect() == [("Chile", 1, "CHILE", 100)]


def _norms(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "norm string").withColumns({"value": F.col("norm"), "words": F.array_distinct(F.split("norm", " "))})
    return fuzzy._signed(df).withColumn("grams", F.coalesce(fuzzy._numbered_bigrams(F.col("norm")), F.array().cast("array<string>")))


def _edit(a, b):
    return 100 * (max(len(a), len(b)) - levenshtein(a, b)) // max(len(a), len(b))


def test_bigrams_bring_together_few_pairs_and_all_that_are_near(spark):
    """And the tally of shared bigrams leaves fewer to measure."""
    rng = random.Random(8)
    refs = sorted({"".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 14))) for _ in range(400)})
    labels = sorted({norm(damage(rng, rng.choice(refs))) for _ in range(200)} - {""})
    mine, theirs = _norms(spark, labels), _norms(spark, refs)
    pairs = fuzzy._bigram_pairs(mine, theirs, 70)
    full = pairs.join(fuzzy._side(mine, "l_"), "l_norm").join(fuzzy._side(theirs, "r_"), "r_norm")
    tallied = {(r.l_norm, r.r_norm) for r in fuzzy._tallied(full, 70).collect()}
    near = {(a, b) for a in labels for b in refs if a != b and _edit(a, b) >= 70}
    assert near <= tallied and len(tallied) < pairs.count() < 0.02 * len(labels) * len(refs)


@pytest.mark.parametrize("alphabet", ["ab", "abcdefghij klm", "é漢\U0001f600 xyz"])
def test_bounds_hold(spark, alphabet):
    rng = random.Random(3)
    some = sorted({norm("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40)))) for _ in range(120)} - {""})
    l, r = fuzzy._side(_norms(spark, some), "l_"), fuzzy._side(_norms(spark, some), "r_")
    rows = l.join(r, F.col("l_len") >= F.col("r_len")).select("l_norm", "r_norm", fuzzy._edit_bound().alias("edit"), fuzzy._word_bound().alias("word")).collect()
    for row in rows:
        a, b = set(row.l_norm.split()), set(row.r_norm.split())
        assert row.edit >= _edit(row.l_norm, row.r_norm)
        assert row.word >= 90 * len(a & b) // min(len(a), len(b))
    assert sum(row.edit < 70 for row in rows) > (0 if alphabet == "ab" else len(rows) // 2)


@pytest.mark.parametrize(("min_score", "share"), [(70, 0.01), (None, 0.15)])
def test_few_pairs_are_measured(spark, min_score, share):
    """Of all pairs of 300 misspelt names and 3,000 names, exact against brute force on some of the labels."""
    rng = random.Random(6)
    syllables = [a + b for a in "bdfglmnprst" for b in ("a", "e", "i", "o", "an", "er", "on", "ing")]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(2, 5)))
    refs = sorted({" ".join(word() for _ in range(rng.randint(1, 3))).title() for _ in range(3000)})
    labels = sorted({damage(rng, rng.choice(refs)) for _ in range(300)})
    df = spark.createDataFrame([(x,) for x in labels], "label string")
    ref = spark.createDataFrame([(x,) for x in refs], "name string")
    out = fuzzy.match_labels(df, "label", ref, "name", min_score, max_packed=100, compared="n").collect()
    assert sum(r.n for r in out) < share * len(labels) * len(refs)
    got = {r.label: (r.match, r.score) for r in out}
    assert all(got[x] == brute_force(x, refs, min_score) for x in labels[::20])


def test_no_aggregate_in_a_lambda(spark):
    """A bound that an optimizer rule copied into a function over an array would be worked out for each entry."""
    df = spark.createDataFrame([("Chille",), ("Perru",)], "label string")
    ref = spark.createDataFrame([("CHILE",), ("PERU",)], "name string")
    for packed, min_score in ((2_000, 70), (2_000, None), (0, 70), (0, None), (0, 40)):
        plan = fuzzy.match_labels(df, "label", ref, "name", min_score, max_packed=packed)._jdf.queryExecution().optimizedPlan().toString()
        if packed:
            assert plan.count("array_max(") == 1  # the score that words alone reach
        else:
            assert not [line for line in plan.splitlines() if "lambdafunction" in line and "levenshtein" in line]


def test_where_bigrams_suffice():
    assert fuzzy._bigrams_suffice(70) and fuzzy._bigrams_suffice(90) and not fuzzy._bigrams_suffice(50) and not fuzzy._bigrams_suffice(55)
