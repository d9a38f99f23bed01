"""Quality rules with adaptive thresholds: a document is an outlier if a measure lies far outside its language and source.

Three measures are taken of each text, as whole numbers: symbols per 10,000 characters of words, mean word length in
hundredths of a character, and repeated lines per 10,000 lines. Their distribution in each (language, source) is kept as a quantile sketch: counts by buckets of ``value`` whose width is at most 1/128 of it.
Sketches merge by adding counts, so those of the sources give the one of the language, and these the one of all documents;
tasks count before anything is shuffled, and a sketch has some thousands of buckets at most however many rows it holds.

A measure is too high above ``q75 + FENCE * spread`` and, for the word length, too low below ``q25 - FENCE * spread``. The
spread is the distance of the quartiles, or the measure's least spread where copies or a constant make that small. Sources
with fewer than ``MIN_ROWS`` documents use the thresholds of their language, and small languages those of all documents.

Spark has sketches of its own (``kll_sketch_agg_bigint``); they draw random numbers, so the same documents would be
kept in one run and dropped in the next. These buckets give the same thresholds each time, and in any order.

All of it is built-in expressions: no Python runs in the tasks. Texts are read once; the measures are stored, and both the
sketches and the joined filter work on these few numbers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from ..sources.workspace import store

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MOST_REPEATED = 30
#: Distance of the fences in spreads, and the least spread of each measure (in its own unit).
FENCE = 3
LEAST_SPREAD = {"symbol_share": 200, "word_length": 50, "dup_line_share": 1200}
#: Measures that can also be too low.
TWO_SIDED = ("word_length",)
MIN_ROWS = 100
#: Values below 2 ** BITS have a bucket each; larger ones share one with those of the same leading BITS bits.
BITS = 8


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, whatever the optimizer merges or copies."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+", -1), "")


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def lines_of(text: Column) -> Column:
    """Struct: lines, and lines with a word that equal an earlier line."""
    filled = lambda lines: F.filter(lines, lambda line: _without(line, SPACES) != "")
    repeated = lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")
    both = lambda lines: F.struct(F.size(lines).cast("long").alias("n_lines"), _let(filled(lines), repeated).alias("n_dup_lines"))
    return _let(F.split(text, "\n", -1), both)


def _window_starts(words: Column, window: int) -> Column:
    """Places 0, 1, ... of the windows, if there are at least two."""
    return F.when(F.size(words) > window, F.sequence(F.lit(0), F.size(words) - window)).otherwise(F.array().cast("array<int>"))


def _window(words: Column, start: Column, window: int) -> list[Column]:
    """The entries of a window one by one: ``slice`` copies all of the array each time."""
    return [F.get(words, start + k) for k in range(window)]


def _covered(starts: Column, window: int) -> Column:
    """Positions that windows at some ascending starts cover."""
    steps = F.transform(starts, lambda p, k: F.least(F.lit(window), F.coalesce(F.get(starts, k + 1) - p, F.lit(window))))
    return F.aggregate(steps, F.lit(0), lambda a, x: a + x)


def _repeated_starts(words: Column, window: int) -> Column:
    """Ascending starts of the windows that occur again. Sorting puts equal windows side by side."""
    entry = lambda i: F.struct(F.xxhash64(*_window(words, i, window)).alias("h"), F.struct(*_window(words, i, window)).alias("w"), i.alias("i"))
    pairs = F.sort_array(F.transform(_window_starts(words, window), entry))

    def again(s: Column) -> Column:
        same = lambda x, y: F.coalesce((x["h"] == y["h"]) & (x["w"] == y["w"]), F.lit(False))
        hits = F.filter(s, lambda x, k: same(x, F.get(s, k - 1)) | same(x, F.get(s, k + 1)))
        return F.sort_array(F.transform(hits, lambda x: x["i"]))

    return _let(pairs, again)


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` words that the text has twice or more, the first occurrence included.

    The windows' hashes show whether any occurs again, which is rare; only then are the windows sorted and compared, word
    by word.
    """

    def joined(h: Column, apart: int) -> Column:
        """Hash of each entry with the one ``apart`` places on."""
        return _let(h, lambda x: F.zip_with(x, F.slice(x, F.lit(apart + 1), F.size(x)), lambda a, b: F.xxhash64(a, b)))

    def any_again(w: Column) -> Column:
        hashes, have = F.transform(w, lambda x: F.xxhash64(x)), 1
        while have < window:  # windows of 1, 2, 4, ... words, the last step as wide as is left
            hashes, have = joined(hashes, min(have, window - have)), have + min(have, window - have)
        whole = F.slice(hashes, F.lit(1), F.greatest(F.size(w) - (window - 1), F.lit(0)))
        return (F.size(w) > window) & _let(whole, lambda h: F.size(F.array_distinct(h)) < F.size(h))

    count = lambda w: F.when(any_again(w), _let(_repeated_starts(w, window), lambda s: _covered(s, window))).otherwise(F.lit(0))
    return _let(words, count).cast("long")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed and the measures
    instead of the text. A null text has no words. Measures of a text without words are 0."""
    body = F.coalesce(F.col(text), F.lit(""))
    words = _let(words_of(body), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words")))
    chars = F.struct(
        F.length(_without(body, SPACES)).cast("long").alias("word_chars"),
        (F.length(body) - F.length(_without(body, SYMBOLS))).cast("long").alias("n_symbols"),
    )
    others = [c for c in docs.columns if c != text]
    # inline works its structs out once for each row, whatever is read from them later
    taken = docs.select(*others, F.inline(F.array(F.struct(words.alias("w"), chars.alias("c"), lines_of(body).alias("l")))))
    both = taken.select(*others, "w.*", "c.*", F.col("l.n_dup_lines"), F.col("l.n_lines").alias("_lines"))
    share = lambda part, whole, unit: F.when(F.col(whole) > 0, F.expr(f"({unit} * {part}) div {whole}")).otherwise(0).cast("long")
    return both.withColumns(
        {
            "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
            "symbol_share": share("n_symbols", "word_chars", 10_000),
            "word_length": share("word_chars", "n_words", 100),
            "dup_line_share": share("n_dup_lines", "_lines", 10_000),
        }
    ).drop("_lines")


# ---- sketches ----------------------------------------------------------------------------------------------------


def bucket_floor(value: Column, bits: int = BITS) -> Column:
    """Least value of the bucket of a whole number that is not negative."""
    low = F.greatest(F.length(F.bin(value)) - bits, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, low), low)


def sketch(rows: DataFrame, groups: list[str], measures: list[str]) -> DataFrame:
    """Counts by (groups, measure, bucket): one mergeable sketch for each group and measure."""
    entries = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bucket_floor(F.col(m)).alias("bucket")) for m in measures]))
    return rows.select(*groups, entries.alias("_e")).groupBy(*groups, "_e.measure", "_e.bucket").agg(F.count("*").alias("n"))


def merge(sketches: DataFrame, groups: list[str]) -> DataFrame:
    """The sketches of coarser groups, by adding counts."""
    return sketches.groupBy(*groups, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantile(counts: Column, total: Column, percent: int) -> Column:
    """Least bucket up to which at least ``percent`` of all values lie; ``counts``: (bucket, n) in order."""
    step = lambda a, x: F.struct((a["seen"] + x["n"]).alias("seen"), F.when(a["at"].isNotNull() | (100 * (a["seen"] + x["n"]) < percent * total), a["at"]).otherwise(x["bucket"]).alias("at"))
    return F.aggregate(counts, F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("at")), step)["at"]


def thresholds(sketches: DataFrame, groups: list[str]) -> DataFrame:
    """One row per group: documents, and ``<measure>_low`` and ``_high`` for each measure."""
    whole = sketches.groupBy(*groups, "measure").agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("counts"), F.sum("n").alias("rows"))
    q25, q75 = quantile(F.col("counts"), F.col("rows"), 25), quantile(F.col("counts"), F.col("rows"), 75)
    fences = whole.select(*groups, "measure", "rows", q25.alias("q25"), q75.alias("q75"))
    of = lambda m, c: F.max(F.when(F.col("measure") == m, F.col(c)))
    out = fences.groupBy(*groups).agg(F.max("rows").alias("rows"), *[of(m, q).alias(f"{m}_{q}") for m in LEAST_SPREAD for q in ("q25", "q75")])
    spread = {m: F.greatest(F.col(f"{m}_q75") - F.col(f"{m}_q25"), F.lit(least)) for m, least in LEAST_SPREAD.items()}
    ends = [(F.col(f"{m}_q75") + FENCE * spread[m]).alias(f"{m}_high") for m in LEAST_SPREAD]
    ends += [(F.col(f"{m}_q25") - FENCE * spread[m]).alias(f"{m}_low") for m in TWO_SIDED]
    return out.select(*groups, "rows", *ends)


# ---- filter ------------------------------------------------------------------------------------------------------

_ENDS = [f"{m}_high" for m in LEAST_SPREAD] + [f"{m}_low" for m in TWO_SIDED]


def adaptive_rules(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_rows: int = MIN_ROWS) -> DataFrame:
    """Every row of ``docs`` without its text, with the counts and measures of ``measure``, ``kept`` and ``level`` (whose
    thresholds it met: 0 its source, 1 its language, 2 all documents; null if it failed the base rules).

    Sketches hold the documents that pass the base rules. A null language or source is a value of its own. A null or empty
    text has no words and fails. Repeated rows count each time. An empty table gives an empty result. Columns of ``docs``
    that have a name of the result are replaced; none of them is read but the three named ones.
    """
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", *LEAST_SPREAD]
    others = [c for c in docs.columns if c not in (*made, text, lang, source, "kept", "level", "_words", "_lines", "_lang", "_source")]
    # keys that are never null, so that plain equi-joins find them
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    told = docs.select(*[F.col(f"`{c}`") for c in others], lang, source, key(lang).alias("_lang"), key(source).alias("_source"), F.col(text).alias("_text"))
    measured = store(measure(told, "_text"), "rules")
    fine = store(sketch(measured.where(~F.col("base_failed")), ["_lang", "_source"], list(LEAST_SPREAD)), "rule-sketches")
    by_source = thresholds(fine, ["_lang", "_source"])
    coarse = merge(fine, ["_lang"])
    by_lang = thresholds(coarse, ["_lang"])
    everything = thresholds(merge(coarse, []).withColumn("_all", F.lit(0)), ["_all"]).first()  # one row, or none
    overall = {c: F.lit(everything[c] if everything else None).cast("long") for c in _ENDS}
    lang_ends = by_lang.select("_lang", F.when(F.col("rows") >= min_rows, F.struct(*_ENDS)).alias("of_lang"))
    own_ends = by_source.select("_lang", "_source", F.when(F.col("rows") >= min_rows, F.struct(*_ENDS)).alias("of_source"))
    chosen = own_ends.join(lang_ends, "_lang").select(
        "_lang", "_source",
        F.when(F.col("of_source").isNotNull(), 0).when(F.col("of_lang").isNotNull(), 1).otherwise(2).alias("level"),
        *[F.coalesce(f"of_source.{c}", f"of_lang.{c}", overall[c]).alias(f"_{c}") for c in _ENDS],
    )
    limits = store(chosen, "rule-thresholds")  # its size is known then: Spark sends a small one to the tasks
    met = lookup_join(measured, limits, ["_lang", "_source"])
    inside = ~F.col("base_failed")
    for m in LEAST_SPREAD:
        inside = inside & (F.col(m) <= F.col(f"_{m}_high"))
    for m in TWO_SIDED:
        inside = inside & (F.col(m) >= F.col(f"_{m}_low"))
    level = F.when(~F.col("base_failed"), F.col("level"))
    return met.withColumns({"kept": F.coalesce(inside, F.lit(False)), "level": level}).select(*others, lang, source, *made, "kept", "level")
