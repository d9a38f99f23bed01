"""Label similarity: an integer from 0 to 100.

* ``normalise``: lower case, each run of characters other than letters and digits becomes one blank, ends trimmed.
* ``edit_score(a, b)`` = floor(100 * (m - levenshtein(a, b)) / m), m the longer length; 0 when both are empty.
* ``token_score(a, b)`` = floor(90 * common / smaller), over distinct words less the stop words; 0 when a side has none.
* ``similarity`` is the greater of the two. It is 100 exactly when both sides normalise to the same non-empty text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col

TOKEN_WEIGHT = 90


def normalise(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(F.lower(as_col(c)), r"[^\p{L}\p{N}]+", " "))


def tokens(norm: Column | str, stop_words: Sequence[str] = ()) -> Column:
    """Distinct words of a normalised label, without the stop words."""
    words = F.array_distinct(F.split(as_col(norm), " "))
    return F.array_except(words, F.array(*[F.lit(w) for w in ("", *stop_words)]))


def edit_score(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return (
        F.when(longest > 0, F.floor((longest - F.levenshtein(a, b)) * 100 / longest)).otherwise(F.lit(0)).cast("int")
    )


def token_score(a: Column, b: Column) -> Column:
    """Takes two arrays of distinct words."""
    smaller = F.least(F.size(a), F.size(b))
    return (
        F.when(smaller > 0, F.floor(F.size(F.array_intersect(a, b)) * TOKEN_WEIGHT / smaller))
        .otherwise(F.lit(0))
        .cast("int")
    )
