"""Nearest reference label (scores in ``functions.similarity``).

The best reference value has the highest score, then the highest edit score, then comes first in order.

How it runs: labels are made distinct, equal normalised labels are settled by an equi-join, and the rest are compared
with the references. No pair is measured that can't win: the characters and words of each text are hashed into a few bits,
and the bits that two texts share bound both scores from above (``_upper_bound``). The bound is a join condition, so pairs
below it never leave the join, and the distance search of the others gives up where the score to beat is out of reach.

* A short list (the normal case: a few hundred names) is one array in each task, scanned for each label.
* Tiles, for a longer list where a low threshold, or none, lets strings without a common bigram pass: blocks of labels meet
  parts of the list, and all pairs of the two are bounded, or measured, at once (``nearest``).
* Blocks, for labels too long for that: references are cut by their length, and into parts of some hundred. A label visits the
  blocks whose lengths are near enough for the score to beat and, as the word score does not depend on lengths, those that
  hold one of its words.
* Pairs, for a longer list with a threshold: equi-joins on the rarest bigrams (strings within d edits share all but 2d of
  their bigrams, so one of the 2d + 1 rarest is common) and on the rarest words bring together the pairs that can reach it.
  Of these only those that share the guaranteed number of bigrams are measured (``_tallied``).
* Without a threshold, labels that have a near reference are settled first (score 75, by shared trigrams), and the tiles
  compare the others. A label too long for them first visits one block of its own length for a score to beat.

All ways are exact. Where even the best references are far off, as for random strings, the bounds keep few of them away.

The finished label mapping is stored in the shared folder before it meets the long table: it is computed once, its size is
then known, and a small one is broadcast, so the long table is not shuffled for it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import TOKEN_WEIGHT, edit_score, normalise, token_score, tokens
from ..sources.workspace import store
from .joins import BROADCAST_BYTES, BROADCAST_ROWS, lookup_join, measure
from .nearest import LONGEST, nearest

MAX_PACKED = 2_000
BLOCK_ROWS = 500
LENGTH_STEP = 4
#: 64-bit words of the characters' bits; a text's words share one.
CHAR_WORDS = 8
LABEL_SALTS = 64
#: Thresholds of the first search where none is given; the second one for tiles: texts that score it share trigrams.
LIKELY = 70
NEAR = 75


def _reference(ref: DataFrame, ref_col: str, stop_words: Sequence[str]) -> DataFrame:
    """One row per normalised reference value: the smallest spelling, its norm and its words."""
    return (
        ref.select(F.col(ref_col).alias("value"), normalise(ref_col).alias("norm"))
        .where(F.col("norm") != "")
        .groupBy("norm").agg(F.min("value").alias("value"))
        .withColumn("words", tokens("norm", stop_words))
    )


def _spread(df: DataFrame, *keys: str) -> DataFrame:
    """Even out over ``spark.sql.shuffle.partitions`` tasks. The rows are few but each costs much work, so partitions must
    not be merged by size as Spark would do after an ordinary shuffle."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, whatever the optimizer merges or copies."""
    return F.transform(F.array(value), body)[0]


def _numbered(items: Column) -> Column:
    """Entries of an array with a number that tells the second occurrence of one from its first."""
    earlier = lambda x, i: F.size(F.filter(F.slice(items, F.lit(1), i), lambda y: y == x))
    return F.transform(items, lambda x, i: F.concat(x, earlier(x, i).cast("string")))


def _bits(items: Column, words: int) -> Column:
    """Array of ``words`` longs in which each entry sets a bit."""
    place = lambda x: F.pmod(F.xxhash64(x), F.lit(64 * words)).cast("int")

    def long_of(places: Column, k: int) -> Column:
        mark = lambda p: F.when(F.floor(p / 64) == k, F.call_function("shiftleft", F.lit(1).cast("long"), p % 64)).otherwise(F.lit(0).cast("long"))
        return F.aggregate(places, F.lit(0).cast("long"), lambda a, p: a.bitwiseOR(mark(p)))

    return _let(F.transform(items, place), lambda p: F.array(*[long_of(p, k) for k in range(words)]))


_CHARS = [f"c{k}" for k in range(CHAR_WORDS)]


def _signed(df: DataFrame) -> DataFrame:
    """Add ``len``, the bits of ``norm``'s characters and of ``words``, and how many entries share a bit with another."""
    n = F.length("norm")
    chars = F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(F.col("norm"), i, F.lit(1))))
    chars = F.coalesce(chars, F.array().cast("array<string>"))
    both = F.struct(_let(chars, lambda c: _bits(_numbered(c), CHAR_WORDS)).alias("chars"), _bits(F.col("words"), 1)[0].alias("bag"))
    # inline works its struct out once for each row, whatever is read from it later
    marked = df.select("*", F.inline(F.array(both)))
    out = marked.select(*df.columns, n.alias("len"), "bag", *[F.col("chars")[k].alias(c) for k, c in enumerate(_CHARS)])
    ones = sum((F.bit_count(c) for c in _CHARS[1:]), F.bit_count(_CHARS[0]))
    return out.withColumns({"slack": F.col("len") - ones, "bag_slack": F.size("words") - F.bit_count("bag")})


def _side(df: DataFrame, mark: str) -> DataFrame:
    return df.select(*[F.col(c).alias(mark + c) for c in df.columns])


def _candidate(edit: Column, word: Column, value: Column) -> Column:
    """Sortable candidate: the smallest struct is the best one."""
    return F.struct((-F.greatest(edit, word)).alias("neg_score"), (-edit).alias("neg_edit"), value.alias("value"))


def _common(l: Sequence[str], r: Sequence[str], slack: str) -> Column:
    """At most so many entries have two texts in common: as many as bits, and as entries of either that share a bit."""
    bits = [F.bit_count(F.col(f"l_{a}").bitwiseAND(F.col(f"r_{b}"))) for a, b in zip(l, r)]
    return sum(bits[1:], bits[0]) + F.least(f"l_{slack}", f"r_{slack}")


def _longest() -> Column:
    return F.greatest("l_len", "r_len")


def _edit_bound() -> Column:
    """An edit score that the pair of ``l_`` and ``r_`` columns can't exceed: texts are at least as far apart as the longer
    one has other characters."""
    most = F.least(_common(_CHARS, _CHARS, "slack"), "l_len", "r_len")
    return F.when(_longest() > 0, F.floor(most * 100 / _longest())).otherwise(0).cast("int")


def _word_bound() -> Column:
    smaller = F.least(F.size("l_words"), F.size("r_words"))
    most = F.least(_common(["bag"], ["bag"], "bag_slack"), smaller)
    return F.when(smaller > 0, F.floor(most * TOKEN_WEIGHT / smaller)).otherwise(0).cast("int")


def _upper_bound() -> Column:
    return F.greatest(_edit_bound(), _word_bound())


def _bounded_edit(floor: Column) -> Column:
    """The edit score, or -1 where it is below ``floor``: the search stops where that can't be reached any more."""
    allowed = F.floor(_longest() * (100 - floor) / 100).cast("int")
    distance = F.call_function("levenshtein", F.col("l_norm"), F.col("r_norm"), allowed)
    return F.when(distance < 0, -1).when(_longest() > 0, F.floor((_longest() - distance) * 100 / _longest())).otherwise(0).cast("int")


def _measured(pairs: DataFrame, floor: Column) -> DataFrame:
    """(norm, best) of each pair; ``best`` is null below ``floor``. The edit score is only exact where it matters."""
    words = pairs.withColumn("word", F.when(_word_bound() > 0, token_score(F.col("l_words"), F.col("r_words"))).otherwise(0))
    edit = F.when(F.col("word") >= floor, edit_score(F.col("l_norm"), F.col("r_norm"))).otherwise(_bounded_edit(floor))
    scored = words.withColumns({"edit": edit, "floor": floor})
    best = F.when(F.greatest("edit", "word") >= F.col("floor"), _candidate(F.col("edit"), F.col("word"), F.col("r_value")))
    return scored.select(F.col("l_norm").alias("norm"), best.alias("best"))


def _scan_short_list(labels: DataFrame, refs: DataFrame, min_score: int | None) -> DataFrame:
    """(norm, best, compared) against the whole list, which every task holds as one array (a scalar subquery).

    A cheap pass first finds what the words alone score. Only references that can equal that (or the threshold) by edit
    score are measured in full.
    """
    packed = refs.agg(F.collect_list(F.struct("value", "norm", "words", F.length("norm").alias("len")))).scalar()
    rows = _spread(labels, "norm").withColumns({"len": F.length("norm"), "block": packed})
    word = lambda r: token_score(F.col("words"), r["words"])

    def reaches(r: Column, floor: Column) -> Column:
        longest = F.greatest(F.col("len"), r["len"])
        allowed = F.floor(longest * (100 - floor) / 100).cast("int")
        close = F.call_function("levenshtein", F.col("norm"), r["norm"], allowed) >= 0
        return (r["word"] >= floor) | ((F.abs(F.col("len") - r["len"]) <= allowed) & close)

    def best_of(block: Column) -> Column:
        floor = F.greatest(F.array_max(F.transform(block, lambda r: r["word"])), F.lit(min_score or 0))
        kept = _let(floor, lambda f: F.filter(block, lambda r: reaches(r, f)))
        scored = lambda r: _candidate(edit_score(F.col("norm"), r["norm"]), r["word"], r["value"])
        return _let(kept, lambda k: F.struct(F.array_min(F.transform(k, scored)).alias("best"), F.size(k).cast("long").alias("compared")))

    found = _let(F.transform("block", lambda r: r.withField("word", word(r))), best_of)
    return rows.select("norm", F.inline(F.array(found)))


def _cut(refs: DataFrame, n_refs: int) -> tuple[DataFrame, int]:
    """References with the block (band of lengths, part) that each belongs to, and the number of parts."""
    parts = max(1, -(-n_refs // BLOCK_ROWS))
    band = F.floor(F.col("len") / LENGTH_STEP).cast("int")
    return refs.withColumns({"band": band, "part": F.pmod(F.xxhash64("norm"), F.lit(parts)).cast("int")}), parts


def _met(visits: DataFrame, blocks: DataFrame, small: bool) -> DataFrame:
    """Pairs of a visit and a reference of its block whose bound reaches the visit's floor. Few references are broadcast;
    others meet the visits by shuffle, spread by salts."""
    near = _upper_bound() >= F.col("l_floor")
    l, r = _side(visits, "l_"), _side(blocks, "r_")
    keys = ["band", "part"]
    if small:
        l, r = _spread(l, "l_norm", "l_band", "l_part"), F.broadcast(r)
    else:
        l = l.withColumn("l_salt", F.pmod(F.xxhash64("l_norm"), F.lit(LABEL_SALTS)).cast("int"))
        r = r.withColumn("r_salt", F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALTS - 1))))
        keys.append("salt")
        l, r = _spread(l, *[f"l_{k}" for k in keys]), _spread(r, *[f"r_{k}" for k in keys])
    same = reduce(Column.__and__, [F.col(f"l_{k}") == F.col(f"r_{k}") for k in keys])
    return l.join(r, same & near)


def _visits(labels: DataFrame, blocks: DataFrame) -> DataFrame:
    """Labels (with ``floor``) by the blocks in which a reference can reach their floor, with ``band`` and ``part``."""
    # one short row per block: references / BLOCK_ROWS rows per length band at most
    catalogue = blocks.select("band", "part").distinct()
    last = blocks.agg(F.max("band")).first()[0] or 0
    lowest = F.floor(F.ceil(F.col("len") * F.col("floor") / 100) / LENGTH_STEP).cast("int")
    highest = F.when(F.col("floor") > 0, F.floor(F.floor(F.col("len") * 100 / F.greatest("floor", F.lit(1))) / LENGTH_STEP).cast("int"))
    bounded = labels.withColumns({"lowest": lowest, "highest": F.least(F.coalesce(highest, F.lit(last)), F.lit(last))})
    by_length = bounded.withColumn("band", F.explode(F.when(F.col("lowest") <= F.col("highest"), F.sequence("lowest", "highest"))))
    visits = lookup_join(by_length, catalogue, ["band"], "inner").drop("lowest", "highest")
    words = blocks.select("band", "part", F.explode("words").alias("word")).distinct()
    mine = bounded.where(F.col("floor") <= TOKEN_WEIGHT).select("norm", "lowest", "highest", F.explode("words").alias("word"))
    elsewhere = mine.join(words, "word").where(~F.col("band").between(F.col("lowest"), F.col("highest")))
    places = elsewhere.select("norm", "band", "part").distinct()
    return visits.unionByName(labels.join(places, "norm"))


def _scan_tiles(mine: DataFrame, refs: DataFrame, n_refs: int, min_score: int | None, counted: bool) -> DataFrame:
    """(norm, best, compared) of the labels, which are of ordinary length. Without a threshold, a first pass with one that few
    pairs reach settles the labels that have a near reference, and the second compares the others."""
    met = lambda some, least: _reduced(nearest(some.withColumn("floor", F.lit(least)).select("norm", "words", "len", "floor"), refs, n_refs), counted)
    if min_score is not None:
        return met(mine, min_score)
    likely = store(met(mine, NEAR), "likely-matches")
    others = store(mine.join(likely.where(F.col("best").isNotNull()), "norm", "left_anti"), "other-labels")
    return likely.unionByName(met(others, 0))


def _scan_blocks(mine: DataFrame, refs: DataFrame, n_refs: int, min_score: int | None, small: bool, counted: bool) -> DataFrame:
    """(norm, best, compared) of the labels that find a reference.

    With a threshold that is the score to beat. Without one, a first visit to one block of its own length gives each label
    one.
    """
    blocks, parts = _cut(refs, n_refs)
    searched = lambda visits: _reduced(_measured(_met(visits, blocks, small), F.col("l_floor")), counted)
    if min_score is not None:
        return searched(_visits(mine.withColumn("floor", F.lit(min_score)), blocks))
    home = {"band": F.floor(F.col("len") / LENGTH_STEP).cast("int"), "part": F.pmod(F.xxhash64("norm"), F.lit(parts)).cast("int"), "floor": F.lit(0)}
    first = store(searched(mine.withColumns(home)), "first-visits")
    beat = first.select("norm", (-F.col("best.neg_score")).alias("floor"))
    floors = lookup_join(mine, beat, ["norm"]).withColumn("floor", F.coalesce("floor", F.lit(0)))
    return searched(_visits(floors, blocks)).unionByName(first)


def _word_frequencies(refs: DataFrame) -> DataFrame:
    return refs.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("freq"))


def _rare_first(rows: DataFrame, freq: DataFrame, key: str, min_score: int) -> DataFrame:
    """Words of each row with their place in rare-first order, the number of words, and whether the word belongs to the
    prefix that any partner with enough common words must hit.

    If the smaller side has s words, a score of ``min_score`` needs c = ceil(min_score * s / 90) common ones, so one of
    its s - c + 1 rarest words must be among the partner's words.
    """
    words = rows.select(key, F.explode("words").alias("word"))
    ranked = (
        lookup_join(words, freq, ["word"])
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "word"))).alias("w"))
    )
    size = F.size("w")
    need = F.ceil(size * min_score / TOKEN_WEIGHT)
    return ranked.select(
        key, size.alias(f"{key}_size"), (size - need + 1).alias(f"{key}_prefix"), F.posexplode("w").alias("pos", "e")
    ).select(key, f"{key}_size", (F.col("pos") < F.col(f"{key}_prefix")).alias(f"{key}_rare"), F.col("e.word").alias("word"))


def _shared_bigrams(longest: int, min_score: int) -> int:
    """Bigrams that two strings share at least if the longer one has that length and their edit score is high enough."""
    return longest - 1 - 2 * ((100 - min_score) * longest // 100)


def _bigrams_suffice(min_score: int) -> bool:
    """True if all pairs with this edit score share a bigram (but for equal ones, which are settled before)."""
    return min_score > 50 and all(_shared_bigrams(m, min_score) >= 1 for m in range(2, 200))


def _numbered_bigrams(norm: Column) -> Column:
    """Bigrams of a text; the second occurrence of one differs from its first."""
    n = F.length(norm)
    pairs = F.when(n >= 2, F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substring(norm, i, F.lit(2))))
    return _let(pairs, _numbered)


def _bigram_prefix(rows: DataFrame, freq: DataFrame, min_score: int) -> DataFrame:
    """``rows`` by the rarest bigrams (``gram``) of each, of which a partner must have one among its own."""
    n = F.col("len")
    grams = rows.select("norm", F.explode("grams").alias("gram"))
    ranked = (
        lookup_join(grams, freq, ["gram"])
        .groupBy("norm")
        .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "gram"))).alias("g"))
    )
    upto = F.sequence(n, F.floor(n * 100 / min_score).cast("int"))
    shared = F.array_min(F.transform(upto, lambda m: m - 1 - 2 * F.floor((100 - min_score) * m / 100)))
    prefix = F.slice("g", F.lit(1), (F.size("g") - shared + 1).cast("int"))
    return rows.drop("grams").join(ranked, "norm").withColumn("gram", F.explode(F.transform(prefix, lambda e: e["gram"]))).drop("g")


def _bigram_pairs(mine: DataFrame, theirs: DataFrame, min_score: int) -> DataFrame:
    """(l_norm, r_norm) for all pairs that can reach the threshold by their edit score, of two signed frames with ``grams``."""
    freq = theirs.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("freq"))
    needed = ["norm", "len", "slack", *_CHARS, "grams"]
    l, r = (_side(_bigram_prefix(side.select(*needed), freq, min_score), mark) for side, mark in ((mine, "l_"), (theirs, "r_")))
    lengths = 100 * F.least("l_len", "r_len") >= min_score * _longest()
    return _spread(l, "l_gram").join(r, (F.col("l_gram") == F.col("r_gram")) & lengths & (_edit_bound() >= min_score)).select("l_norm", "r_norm").distinct()


def _word_pairs(mine: DataFrame, theirs: DataFrame, min_score: int) -> DataFrame:
    """(l_norm, r_norm) for pairs that can reach the threshold by their words."""
    freq = _word_frequencies(theirs)
    l, r = (_side(_rare_first(side.select("norm", "words"), freq, "norm", min_score), mark) for side, mark in ((mine, "l_"), (theirs, "r_")))
    same = F.col("l_word") == F.col("r_word")
    # Each join has a rare-word side, so a word that a third of all labels share does not pair them all.
    label_smaller = l.where("l_norm_rare").join(r, same & (F.col("l_norm_size") <= F.col("r_norm_size")))
    other_smaller = l.join(r.where("r_norm_rare"), same & (F.col("r_norm_size") <= F.col("l_norm_size")))
    return label_smaller.select("l_norm", "r_norm").union(other_smaller.select("l_norm", "r_norm"))


def _tallied(pairs: DataFrame, min_score: int) -> DataFrame:
    """The pairs that can reach the threshold: their shared bigrams are tallied, and those with fewer than the guaranteed
    number go, unless their words may reach it."""
    least = _longest() - 1 - 2 * F.floor((100 - min_score) * _longest() / 100)
    by_edit = (least <= 0) | (F.size(F.array_intersect("l_grams", "r_grams")) >= least)
    return pairs.where((_word_bound() >= min_score) | F.coalesce(by_edit, F.lit(False)))


def _scan_pairs(mine: DataFrame, theirs: DataFrame, min_score: int) -> DataFrame:
    """(norm, best) of all pairs measured: those that share enough words, or enough bigrams."""
    pairs = _bigram_pairs(mine, theirs, min_score)
    if min_score <= TOKEN_WEIGHT:  # else words alone don't reach it
        pairs = pairs.union(_word_pairs(mine, theirs, min_score)).distinct()
    full = _spread(pairs, "l_norm", "r_norm").join(_side(mine, "l_"), "l_norm").join(_side(theirs, "r_"), "r_norm")
    return _measured(_tallied(full, min_score), F.lit(min_score))


def _reduced(measured: DataFrame, counted: bool) -> DataFrame:
    """The best of each label, and on request the number of its pairs that were measured."""
    found = measured if counted else measured.where(F.col("best").isNotNull())
    return found.groupBy("norm").agg(F.min("best").alias("best"), F.count("*").alias("compared"))


def _open(labels: DataFrame) -> DataFrame:
    """Distinct texts of the labels without an equal reference."""
    return labels.where(F.col("exact").isNull()).select("norm", "words").distinct()


def _scan_long_list(labels: DataFrame, refs: DataFrame, n_refs: int, min_score: int | None, small: bool, counted: bool) -> DataFrame:
    """(norm, best, compared) of the labels that find a reference."""
    grams = F.coalesce(_numbered_bigrams(F.col("norm")), F.array().cast("array<string>"))
    signed = lambda df, name: store(_signed(_spread(df, "norm")).withColumn("grams", grams), name)
    if min_score is not None and _bigrams_suffice(min_score):
        return _reduced(_scan_pairs(signed(labels, "open-labels"), signed(refs, "references"), min_score), counted)
    mine = store(_spread(labels, "norm").withColumn("len", F.length("norm")), "open-labels")
    found = _scan_tiles(mine.where(F.col("len") <= LONGEST), refs.withColumn("len", F.length("norm")), n_refs, min_score, counted)
    long = mine.where(F.col("len") > LONGEST)
    if not long.isEmpty():
        long, theirs = signed(long.drop("len"), "long-labels"), signed(refs, "references")
        long_only, theirs_only = long.drop("grams"), theirs.drop("grams")
        if min_score is None:
            likely = store(_reduced(_scan_pairs(long, theirs, LIKELY), counted), "likely-matches")
            long_only = long_only.join(likely.where(F.col("best").isNotNull()), "norm", "left_anti")
            found = found.unionByName(likely)
        found = found.unionByName(_scan_blocks(long_only, theirs_only, n_refs, min_score, small, counted))
    return found.groupBy("norm").agg(F.min("best").alias("best"), F.sum("compared").alias("compared"))


def match_labels(
    labels: DataFrame,
    col: str,
    ref: DataFrame,
    ref_col: str,
    min_score: int | None = 70,
    stop_words: Sequence[str] = (),
    match: str = "match",
    score: str = "score",
    max_packed: int = MAX_PACKED,
    compared: str | None = None,
) -> DataFrame:
    """Add the nearest reference value and its score to a frame of distinct labels.

    Both are null below the threshold and for a null label. Use ``fuzzy_lookup`` on a table in which labels repeat.
    ``compared`` names a column for the number of references that a label was measured against, to see what a list costs.
    """
    if min_score is not None and not 0 < min_score <= 100:
        raise ValueError("min_score must lie in 1..100, or be None for the best match at any score")
    refs = _reference(ref, ref_col, stop_words)
    n_refs, n_bytes = measure(refs)
    small = n_refs <= BROADCAST_ROWS and n_bytes <= BROADCAST_BYTES
    short = small and n_refs <= max_packed
    if not short:
        refs = store(refs, "references")  # read several times below
    prepared = labels.select(F.struct("*").alias("row"), normalise(col).alias("norm")).withColumn(
        "words", tokens("norm", stop_words)
    )
    settled = lookup_join(prepared, refs.select("norm", F.col("value").alias("exact")), ["norm"], small=small)
    if short:
        best = _scan_short_list(_open(settled), refs, min_score)
    else:
        best = _scan_long_list(_open(settled), refs, n_refs, min_score, small, bool(compared))
    scanned = settled.join(best, "norm", "left")
    points = F.when(F.col("exact").isNotNull(), F.lit(100)).otherwise(-F.col("best.neg_score"))
    hit = (points >= F.lit(min_score or 0)) & F.col("row")[col].isNotNull()
    return scanned.select(
        "row.*",
        F.when(hit, F.coalesce("exact", "best.value")).alias(match),
        F.when(hit, points).alias(score),
        *([F.coalesce("compared", F.lit(0)).alias(compared)] if compared else []),
    )


def fuzzy_lookup(
    df: DataFrame,
    col: str,
    ref: DataFrame,
    ref_col: str,
    min_score: int | None = 70,
    on_miss: str | None = "No match found",
    stop_words: Sequence[str] = (),
    match: str = "match",
    score: str = "score",
    max_packed: int = MAX_PACKED,
) -> DataFrame:
    """Add the nearest reference value and its score. Below ``min_score`` the match is ``on_miss`` and the score null;
    ``min_score=None`` takes the best value at any score. A null label gets a null match."""
    labels = df.select(col).where(F.col(col).isNotNull()).distinct()
    found = match_labels(labels, col, ref, ref_col, min_score, stop_words, match, score, max_packed)
    mapping = store(found.withColumn(match, F.coalesce(match, F.lit(on_miss))), "labels")
    return lookup_join(df, mapping, [col]).select(*df.columns, match, score)


def resolve_former(df: DataFrame, col: str, former: DataFrame, out: str | None = None) -> DataFrame:
    """Replace a retired name by its current one; names that are not retired stay.

    ``former`` has the columns (retired name, current name); names are compared in normalised form.
    """
    retired, current = former.columns[:2]
    names = (
        former.select(normalise(retired).alias("__norm"), F.col(current).alias("__current"))
        .where(F.col("__norm") != "")
        .groupBy("__norm").agg(F.min("__current").alias("__current"))
    )
    joined = lookup_join(df.withColumn("__norm", normalise(col)), names, ["__norm"])
    return joined.withColumn(out or col, F.coalesce("__current", col)).drop("__norm", "__current")


def former_candidates(df: DataFrame, col: str, former: DataFrame, out: str) -> DataFrame:
    """``df`` with one row per name that ``col`` may have now: ``out``, and its ``<out>_place`` in the order of preference.

    A name that is not retired stands for itself. ``former`` has the columns (retired name, current name) and, where a
    retired name has several successors, an array ``successors`` cut at commas. As a name may hold a comma itself, every run
    of consecutive pieces is a candidate: those that start earlier first, the shorter ones of these first.
    """
    retired, current = former.columns[:2]
    pieces = F.col("successors") if "successors" in former.columns else F.array(current)
    names = (
        former.select(normalise(retired).alias("__norm"), F.struct(F.col(current).alias("current"), pieces.alias("pieces")).alias("__now"))
        .where(F.col("__norm") != "")
        .groupBy("__norm").agg(F.min("__now").alias("__now"))
    )
    runs_from = lambda i, p: F.transform(F.sequence(F.lit(1), F.size(p) - i + 1), lambda n: F.array_join(F.slice(p, i, n), ", "))
    runs = _let(F.col("__now.pieces"), lambda p: F.flatten(F.transform(F.sequence(F.lit(1), F.size(p)), lambda i: runs_from(i, p))))
    own = F.array(F.col(col).cast("string"))
    joined = lookup_join(df.withColumn("__norm", normalise(col)), names, ["__norm"])
    listed = F.when(F.size("__now.pieces") > 0, runs).otherwise(own)
    return joined.select(*df.columns, F.posexplode(listed).alias(f"{out}_place", out))
