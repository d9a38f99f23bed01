import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stellate.llm import queries, rules

from ..compare import connect, differences
from . import cases

SPACE = r"[\x20\x09-\x0D]"


def counts(text):
    """The contract's counts, by their definition."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(grams)
    hit = {p for i, g in enumerate(grams) if often[g] > 1 for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in cases.collect(rules.measure(rows))}


def floor_of(v):
    low = max(v.bit_length() - rules.BITS, 0)
    return v >> low << low


def quartiles(values):
    """By the definition: least bucket with at least that share of all values in it or below."""
    buckets = sorted(map(floor_of, values))
    return [next(b for i, b in enumerate(buckets, 1) if 100 * sum(x <= b for x in buckets) >= p * len(buckets)) for p in (25, 75)]


def verdicts(rows, min_rows):
    """(kept, level) by row; rows: (lang, source, text)."""
    every = []
    for lang, source, text in rows:
        n, chars, sym, dup, rep = counts(text)
        lines = (text or "").count("\n") + 1
        every.append((lang, source, n < 20 or 100 * rep > 30 * n, {"symbol_share": 10000 * sym // max(chars, 1) if chars else 0, "word_length": 100 * chars // n if n else 0, "dup_line_share": 10000 * dup // lines}))
    out = []
    for lang, source, failed, m in every:
        if failed:
            out.append((False, None))
            continue
        fine = [x for x in every if not x[2]]
        groups = [[x for x in fine if x[:2] == (lang, source)], [x for x in fine if x[0] == lang], fine]
        level = next(k for k, g in enumerate(groups) if k == 2 or len(g) >= min_rows)
        kept = True
        for name, least in rules.LEAST_SPREAD.items():
            q25, q75 = quartiles([x[3][name] for x in groups[level]])
            spread = rules.FENCE * max(q75 - q25, least)
            kept &= m[name] <= q75 + spread and (name not in rules.TWO_SIDED or m[name] >= q25 - spread)
        out.append((kept, level))
    return out


def test_query_against_sql(spark):
    assert differences(queries.QUERIES["op11_adaptive_rules"](spark, cases.SF), connect(cases.SF), queries.SQL["op11_adaptive_rules"]) == []


def test_counts_of_all_documents(spark):
    docs = {r["doc_id"]: r["text"] for r in cases.collect(cases.documents(spark).select("doc_id", "text"))}
    out = cases.collect(queries.QUERIES["op11_adaptive_rules"](spark, cases.SF))
    assert {r["doc_id"]: tuple(r[c] for c in NAMES) for r in out} == {i: counts(t) for i, t in docs.items()}


WORDS = st.lists(st.sampled_from(["a", "b", "#x", "é漢", "\U0001f600"]), max_size=60)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(WORDS.map(" ".join), max_size=4).map("\n".join), min_size=1, max_size=20))
def test_counts_of_any_text(spark, texts):
    got = measured(spark, texts)
    assert [tuple(got[i][c] for c in NAMES) for i in range(len(texts))] == [counts(t) for t in texts]


@pytest.mark.parametrize("text", ["x y " * 40, "one two three four five six seven eight " * 2, " ".join(map(str, range(30))), "a\x0bb\x0cc\rd\te", "\n\n \n", "w " * 100_000])
def test_counts_of_some_texts(spark, text):
    assert tuple(measured(spark, [text])[0][c] for c in NAMES) == counts(text)


def test_verdicts_by_source_language_and_all(spark):
    """Against the definition, with groups that fall back to their language and to all documents."""
    rows = [(r["lang"], r["source"], r["text"]) for r in cases.collect(cases.documents(spark))][:300] + [(None, None if i < 35 else "s", " ".join(f"w{i}{k}" for k in range(25))) for i in range(40)]
    rows += [("xx", "s", " ".join(f"w{i}{k}" for k in range(25))) for i in range(5)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, source string, text string")
    got = {r["doc_id"]: (r["kept"], r["level"]) for r in cases.collect(rules.adaptive_rules(df, min_rows=15))}
    assert [got[i] for i in range(len(rows))] == verdicts(rows, 15)
    assert {level for _, level in got.values()} == {None, 0, 1, 2}


def test_thresholds_adapt(spark):
    """What is normal in one source is an outlier in another."""
    plain = [" ".join(f"word{i}{k}" for k in range(30)) for i in range(120)]
    tables = [t.replace(" ", " | ") for t in plain]
    rows = [("en", "prose", t) for t in plain] + [("en", "tables", t) for t in tables] + [("en", "prose", tables[0].replace("word", "w"))]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, source string, text string")
    kept = {r["doc_id"]: r["kept"] for r in cases.collect(rules.adaptive_rules(df))}
    assert [i for i, k in kept.items() if not k] == [len(rows) - 1]


def test_sketches_merge(spark):
    """Sketches of parts add up to the sketch of the whole, and quartiles are within a bucket of the exact ones."""
    rows = spark.range(5000).select(F.pmod(F.xxhash64("id"), F.lit(100_000)).alias("v"), (F.col("id") % 7).alias("part"))
    whole = rules.sketch(rows, [], ["v"])
    merged = rules.merge(rules.sketch(rows, ["part"], ["v"]), [])
    assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, merged.collect()))
    counts_, n = whole.agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("c"), F.sum("n").alias("n")).select("c", "n"), 5000
    got = counts_.select(*[rules.quantile(F.col("c"), F.col("n"), p) for p in (1, 25, 50, 75, 100)]).first()
    exact = sorted(r.v for r in rows.collect())
    for q, p in zip(got, (1, 25, 50, 75, 100)):
        true = exact[max(-(-p * n // 100) - 1, 0)]
        assert q <= true < q + max(1, q >> rules.BITS - 1) + 1


def test_odd_and_empty_tables(spark):
    odd = cases.odd_documents(spark).withColumns({"n_words": F.lit("clash"), "kept": F.lit(3), "_lang": F.lit(1), "level": F.lit("x")})
    out = rules.adaptive_rules(odd)
    got = Counter((r["doc_id"], *(r[c] for c in NAMES)) for r in cases.collect(out))
    assert got == Counter((r[0], *counts(r[1])) for r in cases.rows())
    assert {"score", "shard", "_fp", "items"} <= set(out.columns) and "text" not in out.columns
    assert all(r["base_failed"] or r["kept"] is not None for r in cases.collect(out))
    assert rules.adaptive_rules(cases.no_documents(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = rules.adaptive_rules(cases.documents(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
