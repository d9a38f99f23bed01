"""Conforming of country and place labels, as table operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import normalise, tokens
from ..functions.text import clean_label, override_by_keyword, part_at, remove_tokens, replace_all, strip_blanks, title_case
from ..plans import fixed_values as fixed
from ..sources.workspace import store
from .fuzzy import former_candidates, match_labels
from .joins import lookup_join


def country_label(c: Column | str) -> Column:
    """Raw country label -> display name, before any lookup."""
    return override_by_keyword(
        clean_label(
            c,
            shortcuts=fixed.COUNTRY_SHORTCUTS,
            cut_at=fixed.COUNTRY_CUT_AT,
            replacements=fixed.COUNTRY_REPLACEMENTS,
        ),
        fixed.COUNTRY_KEYWORDS,
    )


def standardise_labels(
    df: DataFrame,
    col: str,
    out: str,
    names: DataFrame,
    name_col: str,
    former: DataFrame,
    clean: Callable[[Column], Column] = country_label,
    min_score: int | None = fixed.MIN_SCORE,
    on_miss: str | None = fixed.NO_MATCH,
    stop_words: Sequence[str] = (),
    guard_words: Sequence[str] = fixed.GUARD_WORDS,
) -> DataFrame:
    """Clean a label, replace a retired name by its current one, then take the nearest reference name.

    Of a retired name with several successors each is compared, and the one with the highest score is taken; the first
    in the list, if several have it (``fuzzy.former_candidates``).
    A match counts as a miss if both have guard words, but not the same: NORTH KOREA is not South Korea, however near the
    spelling. All work is done once per distinct label; the long table only takes part in the
    final join with the stored mapping.
    """
    labels = df.select(col).where(F.col(col).isNotNull()).distinct()
    cleaned = labels.withColumn("__name", clean(F.col(col)))
    candidates = former_candidates(cleaned, "__name", former, "__now").drop("__name")
    scored = match_labels(candidates, "__now", names, name_col, min_score, stop_words, match="__match", score="__score")
    best = F.min_by(F.struct("__now", "__match"), F.struct(-F.coalesce("__score", F.lit(-1)), "__now_place"))
    matched = scored.groupBy(col).agg(best.alias("__best")).select(col, F.col("__best.__now").alias("__name"), F.col("__best.__match").alias(out))
    guards = F.array(*map(F.lit, guard_words)) if guard_words else F.array().cast("array<string>")
    held = lambda c: F.array_sort(F.array_intersect(tokens(normalise(c)), guards))
    apart = (F.size(held("__name")) > 0) & (F.size(held(out)) > 0) & (held("__name") != held(out))
    found = matched.select(col, F.coalesce(F.when(~F.coalesce(apart, F.lit(False)), F.col(out)), F.lit(on_miss)).alias(out))
    return lookup_join(df, store(found, "labels"), [col]).select(*df.columns, out)


def format_location(
    df: DataFrame, col: str, names: DataFrame, name_col: str, former: DataFrame, out: str = "reference_port_loc"
) -> DataFrame:
    """Raw port label -> ``City, ST`` or ``City, Country``.

    Noise words go first, then the shape of the label decides: without a comma it stays as it is; a last part of two
    characters is a state code; a longer one is a country, which becomes the nearest reference name; a shorter one
    makes the result null.
    """
    text = replace_all(remove_tokens(col, fixed.PORT_NOISE), fixed.PORT_REPLACEMENTS)
    last = part_at(F.col("__text"), ", ", -1)
    is_list = F.col("__text").contains(",")
    shaped = df.withColumn("__text", text).withColumn("__country", F.when(is_list & (F.length(last) > 2), last))
    named = standardise_labels(
        shaped, "__country", "__match", names, name_col, former, clean=lambda c: c, min_score=None, on_miss=None
    )
    t = F.col("__text")
    place = (
        F.when(~is_list, t)
        .when(F.length(last) > 2, F.concat(strip_blanks(title_case(part_at(t, ", ", 0))), F.lit(", "), F.col("__match")))
        .when(F.length(last) == 2, F.concat(title_case(part_at(t, ",", 0)), F.lit(","), part_at(t, ",", -1)))
    )
    return named.withColumn(out, place).select(*df.columns, out)

