"""Column shaping: names, types, choices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from ..functions.text import parse_number, strip_chars

NUMERIC = ("tinyint", "smallint", "int", "integer", "bigint", "long", "float", "double")

# Characters that a stored column name may not hold.
DROPPED_FROM_NAMES = ",;{}()\n\t="


def sanitise_name(name: str) -> str:
    """Blanks become underscores, letters lower case, forbidden characters vanish; hyphens and dots stay."""
    return name.replace(" ", "_").lower().translate(dict.fromkeys(map(ord, DROPPED_FROM_NAMES)))


def sanitise_columns(df: DataFrame) -> DataFrame:
    """Sanitise all column names; two names that become equal are an error."""
    names = [sanitise_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names collide after sanitising: {clashes}")
    return df.toDF(*names)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; columns that are not in the map keep their names."""
    return df.withColumnsRenamed(dict(mapping))


def select_renamed(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep the mapped columns only, in map order, under their new names."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in mapping.items()])


def cast_columns(df: DataFrame, names: Sequence[str], type_: DataType | str, on_error: str = "null") -> DataFrame:
    """Cast many columns to one type. ``on_error``: ``null`` for a null in place of bad values, ``fail`` to raise."""
    if on_error not in ("null", "fail"):
        raise ValueError(f"on_error must be 'null' or 'fail', not {on_error!r}")
    return df.withColumns({n: _cast(df, n, type_, on_error) for n in names})


def _cast(df: DataFrame, name: str, type_: DataType | str, on_error: str = "null") -> Column:
    c = F.col(f"`{name}`")
    if on_error == "fail":
        return c.cast(type_)
    numeric = type_ if isinstance(type_, str) else type_.simpleString()
    is_text = isinstance(df.schema[name].dataType, StringType)
    return parse_number(c, numeric) if is_text and numeric in NUMERIC else c.try_cast(type_)


def conform(df: DataFrame, types: Mapping[str, str], rejects: str | None = None) -> DataFrame:
    """Bring named columns to declared types; a bad value becomes null, columns that are not there are passed over.

    ``rejects`` names a new column that lists the cells lost that way as (column, text); a blank text is no loss. ``rejected``
    turns it into a table.
    """
    typed = {c: _cast(df, c, t) for c, t in types.items() if c in df.columns}
    if rejects:
        raw = {c: F.col(f"`{c}`").cast("string") for c in typed}
        lost = [F.when((F.btrim(raw[c]) != "") & typed[c].isNull(), F.struct(F.lit(c).alias("column"), raw[c].alias("text"))) for c in typed]
        listed = F.array_compact(F.array(*lost)) if lost else F.array()
        typed[rejects] = listed.cast("array<struct<column:string,text:string>>")
    return df.withColumns(typed)


def rejected(df: DataFrame, rejects: str, *keep: str) -> DataFrame:
    """One row for each cell that ``conform`` has listed: ``keep``, column, text. Of a stored table only these columns are
    read."""
    return df.where(F.size(rejects) > 0).select(*keep, F.inline(rejects))


def strip_and_cast(df: DataFrame, names: Sequence[str], chars: str = ' "', type_: str | None = None) -> DataFrame:
    """Remove stray characters from text columns; with a numeric type, turn what is left into numbers."""
    stripped = {n: strip_chars(F.col(f"`{n}`"), chars) for n in names}
    return df.withColumns({n: parse_number(c, type_) if type_ else c for n, c in stripped.items()})


def first_non_null(*cols: Column | str) -> Column:
    """Value of the first column that has one."""
    return F.coalesce(*cols)
