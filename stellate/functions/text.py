"""Text expressions. Each takes a Column (or a column name) and returns a Column."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\r\f\v"
WHOLE = ("tinyint", "smallint", "int", "integer", "bigint", "long")


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_blanks(c: Column | str) -> Column:
    """Remove blanks, tabs and line breaks from both ends."""
    return F.btrim(as_col(c), F.lit(BLANKS))


def parse_number(c: Column | str, type_: str = "double") -> Column:
    """Text -> number; null where the text is no number. A whole number may have a fraction of zeros or an exponent
    (``5748517.0``, ``5.748517E6``).

    ``try_cast`` throws and catches an exception per bad value, which costs many times the parsing; texts that cannot be
    numbers are therefore sorted out by pattern first.
    """
    c = as_col(c)
    if type_ in WHOLE:
        plain = c.rlike(r"^[\s\p{Cntrl}]*[+-]?\d+(\.0*)?[\s\p{Cntrl}]*$")
        exponent = c.rlike(r"^\s*[+-]?\d+(\.\d+)?[eE][+]?\d+\s*$")
        wide = c.try_cast("double")
        whole = F.when(exponent & (wide == F.floor(wide)), wide.try_cast(type_))
        return F.when(plain, F.substring_index(c, ".", 1).try_cast(type_)).otherwise(whole)
    return F.when(c.rlike(r"^[\s\p{Cntrl}]*[+-]?(\d|\.\d|[iInN])"), c.try_cast(type_))


def strip_chars(c: Column | str, chars: str = ' "') -> Column:
    """Remove every occurrence of the given characters, wherever they stand."""
    return F.translate(as_col(c), chars, "")


def title_case(c: Column | str) -> Column:
    """Upper-case each letter that follows a non-letter, lower-case the others.

    ``initcap`` only starts a word after a blank; here ``ANTIGUA-BARBUDA`` becomes ``Antigua-Barbuda``.
    """
    runs = F.regexp_extract_all(as_col(c), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def replace_all(c: Column | str, pairs: Sequence[tuple[str, str]]) -> Column:
    """Literal replacements, applied in the given order."""
    return reduce(lambda acc, p: F.replace(acc, F.lit(p[0]), F.lit(p[1])), pairs, as_col(c))


def remove_tokens(c: Column | str, tokens: Sequence[str]) -> Column:
    """Strip the ends and drop a literal token, once per token in the given order.

    Blanks left behind by the last token are kept.
    """
    return reduce(lambda acc, t: F.replace(strip_blanks(acc), F.lit(t), F.lit("")), tokens, as_col(c))


def label_is(c: Column | str, prefixes: Sequence[str]) -> Column:
    """True where the label starts with any of the prefixes; null for a null label."""
    return reduce(lambda a, b: a | b, [as_col(c).startswith(p) for p in prefixes])


def part_at(c: Column | str, sep: str, i: int) -> Column:
    """Element ``i`` (from 0) of the text split on a literal separator; null beyond the end.

    A negative ``i`` counts from the end.
    """
    parts = F.split(as_col(c), rf"\Q{sep}\E")
    return F.element_at(parts, i) if i < 0 else F.get(parts, F.lit(i))


def clean_label(
    c: Column | str,
    shortcuts: Sequence[tuple[str, str]] = (),
    cut_at: str | None = None,
    replacements: Sequence[tuple[str, str]] = (),
) -> Column:
    """Turn a raw dictionary label into a display name.

    A label holding a shortcut keyword is replaced by the shortcut's value. The result is stripped, title-cased,
    cut at the first ``cut_at`` and rewritten by the ordered literal replacements.
    """
    c = as_col(c)
    name = title_case(strip_blanks(override_by_keyword(c, shortcuts)))
    if cut_at is not None:
        name = F.substring_index(name, cut_at, 1)
    return replace_all(name, replacements)


def override_by_keyword(c: Column | str, overrides: Sequence[tuple[str, str]]) -> Column:
    """Replace the whole label by the value of the first keyword it contains."""
    c = as_col(c)
    if not overrides:
        return c
    (first, value), *rest = overrides
    chain = F.when(c.contains(first), F.lit(value))
    for keyword, value in rest:
        chain = chain.when(c.contains(keyword), F.lit(value))
    return chain.otherwise(c)


def split_code_label(c: Column | str, start: int = 3, length: int = 3, sep: str = ": ") -> tuple[Column, Column]:
    """``USAVO: Avoca, NY`` -> code ``AVO`` (by position, from 1) and label ``Avoca, NY`` (after the separator)."""
    c = as_col(c)
    return F.substring(c, start, length), part_at(c, sep, 1)
