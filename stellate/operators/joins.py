"""Lookup joins.

``lookup_join`` is the one way in which the library joins a long table to a reference table. It is an ordinary equi-join:
Spark broadcasts the reference if that turns out small enough at run time, else both sides meet by shuffle and adaptive
execution splits the partitions of hot keys. Nothing is counted beforehand.

Where that does not help (adaptive execution is off, or a hot key's rows have to be spread before a later step), the keys
that hold very many rows can be found in one pass over the long table, and their rows dealt to several tasks by a salt; the
few reference rows of those keys are copied to each salt. The join stays one join, so chains of joins stay linear.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WHOLE, parse_number
from .aggregates import dedupe_by_key

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
#: A key is hot if it has this share of all rows, so that there are 1,000 such keys at most, and so many rows.
HOT_SHARE = 0.001
HOT_ROWS = 2_000_000
SALTS = 64


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes of content) of a table, from one distributed pass."""
    widths = [
        F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0))
        for c, t in df.dtypes
        if t.startswith(("string", "binary", "array", "struct", "map"))
    ]
    width = reduce(lambda a, b: a + b, widths, F.lit(16 * len(df.columns))).cast("long")
    row = df.agg(F.count(F.lit(1)), F.sum(width)).first()
    return row[0], row[1] or 0


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when the measured table is within the limits for a broadcast."""
    rows, size = measure(df)
    return rows <= max_rows and size <= max_bytes


def _hashed_as(df: DataFrame, on: Sequence[str]) -> list[str]:
    """Types under which equal keys are equal: numbers of all types are doubles."""
    types = dict(df.dtypes)
    return ["double" if types[c].startswith((*WHOLE, "float", "double", "decimal")) else types[c] for c in on]


def _key_hash(df: DataFrame, on: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`").cast(t) for c, t in zip(on, _hashed_as(df, on))])


def hot_keys(df: DataFrame, keys: Sequence[Sequence[str]], hot_rows: int = HOT_ROWS, share: float = HOT_SHARE) -> list[list[int]]:
    """For each of several keys, the hashes of its values that hold at least ``hot_rows`` rows and ``share`` of all.

    One pass over the key columns, counted in the tasks first; null is a value. There are ``1 / share`` hot values of a key
    at most, whatever the table.
    """
    entries = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), _key_hash(df, k).alias("h")) for i, k in enumerate(keys)]))
    counts = df.select(entries.alias("e")).groupBy("e.i", "e.h").agg(F.count(F.lit(1)).alias("n"))
    often = F.when(F.col("n") >= hot_rows, F.struct("n", "h"))
    # a value with hot_rows rows or more: at most rows / hot_rows of them
    found = {r.i: r for r in counts.groupBy("i").agg(F.sum("n").alias("all"), F.collect_list(often).alias("often")).collect()}
    hot = lambda r: [x.h for x in r.often if x.n >= share * r["all"]]
    return [hot(found[i]) if i in found else [] for i in range(len(keys))]


def _salted(left: DataFrame, right: DataFrame, on: Sequence[str], hot: Sequence[int], salts: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``__salt``: rows of hot keys are dealt to all salts on the left and copied to each on the right."""
    hot_left, hot_right = _key_hash(left, on).isin(list(hot)), _key_hash(right, on).isin(list(hot))
    dealt = left.withColumn("__salt", F.when(hot_left, F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")).otherwise(0))
    last = F.when(hot_right, salts - 1).otherwise(0)
    return dealt, right.withColumn("__salt", F.explode(F.sequence(F.lit(0), last)))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    small: bool | None = None,
    hot: Sequence[int] | int | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Join a long table to a reference table on equally named columns (``left``, ``inner``, ``left_semi`` or
    ``left_anti``).

    ``small`` says that the right side has a known bound and is to be broadcast (true) or that both sides are to be
    shuffled (false). ``hot``: hashes from ``hot_keys`` whose rows are salted, or from how many rows on a key counts as hot.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    on = list(on)
    if small:
        return left.join(F.broadcast(right), on, how)
    if _hashed_as(left, on) != _hashed_as(right, on):
        hot = None  # text against numbers: equal keys may hash differently
    if isinstance(hot, int):
        hot = hot_keys(left, [on], hot)[0]
    if hot:
        left, right = _salted(left, right, on, hot, salts)
        on = [*on, "__salt"]
    joined = left.join(right.hint("merge") if small is False else right, on, how)
    return joined.drop("__salt") if hot else joined


def _renamed_key(right: DataFrame, pairs: Mapping[str, str], keep: Mapping[str, str]) -> DataFrame:
    """Right side with its keys under the left side's names and only the wanted columns."""
    return right.select(
        *[F.col(f"`{r}`").alias(l) for l, r in pairs.items()],
        *[F.col(f"`{c}`").alias(new) for c, new in keep.items()],
    )


def apply_fanout(right: DataFrame, key: Sequence[str], fanout: str, order_by: Sequence[Column | str] = ()) -> DataFrame:
    """What to do with repeated keys on the reference side: ``allow`` them to multiply rows, keep the ``first`` in
    order, or raise an ``error``."""
    if fanout == "allow":
        return right
    if fanout == "first":
        return dedupe_by_key(right, key, list(order_by) or sorted(set(right.columns) - set(key)) or list(key))
    if fanout == "error":
        repeated = right.groupBy(*key).count().where("count > 1").limit(5).collect()
        if repeated:
            raise ValueError(f"reference keys repeat: {[tuple(r)[:-1] for r in repeated]}")
        return right
    raise ValueError(f"fanout must be 'allow', 'first' or 'error', not {fanout!r}")


def enrich(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    prefer: Mapping[str, tuple[str, str]] | None = None,
    fanout: str = "allow",
    order_by: Sequence[Column | str] = (),
) -> DataFrame:
    """Left join on ``{left key: right key}``, all columns of both sides kept.

    ``prefer`` adds ``{new: (looked-up column, fallback column)}``: the looked-up value where there is one.
    """
    right = apply_fanout(right, list(on.values()), fanout, order_by)
    keyed = right.withColumns({f"__k{i}": F.col(f"`{r}`") for i, r in enumerate(on.values())})
    left_keyed = left.withColumns({f"__k{i}": F.col(f"`{l}`") for i, l in enumerate(on)})
    keys = [f"__k{i}" for i in range(len(on))]
    joined = lookup_join(left_keyed, keyed, keys).drop(*keys)
    return joined.withColumns({new: F.coalesce(a, b) for new, (a, b) in (prefer or {}).items()})


def attach_reference(
    df: DataFrame,
    ref: DataFrame,
    key: Mapping[str, str],
    cols: Mapping[str, str],
    fanout: str = "allow",
    order_by: Sequence[Column | str] = (),
    **options,
) -> DataFrame:
    """Add reference columns ``{column: new name}`` by a left join on ``{df key: reference key}``. Options as in
    ``lookup_join``."""
    ref = apply_fanout(ref, list(key.values()), fanout, order_by)
    return lookup_join(df, _renamed_key(ref, key, cols), list(key), **options)


def lookup_chain(
    df: DataFrame, key: str, sources: Sequence[tuple[DataFrame, str, str]], out: str, keep_sources: bool = False
) -> DataFrame:
    """First value found for the key in several sources ``(table, key column, value column)``, in the given order.

    Each source is first reduced to one value per key (the smallest), so no source can multiply rows.
    """
    found = []
    for i, (table, k, v) in enumerate(sources):
        name = f"{out}_{i + 1}"
        one_each = (
            table.select(F.col(k).alias(key), F.col(v).alias(name))
            .where(F.col(key).isNotNull() & F.col(name).isNotNull())
            .groupBy(key).agg(F.min(name).alias(name))
        )
        df = lookup_join(df, one_each, [key])
        found.append(name)
    df = df.withColumn(out, F.coalesce(*found))
    return df if keep_sources else df.drop(*found)


def _whole(c: Column, type_: str) -> Column:
    """A code as bigint; null where it is no whole number."""
    if type_ == "string":
        return parse_number(c, "bigint")
    return F.when(c == F.floor(c), c.try_cast("bigint")) if type_ not in WHOLE else c.cast("bigint")


def map_codes(
    df: DataFrame, col: str, mapping: Mapping[Any, str] | DataFrame, new_col: str, fanout: str = "first", **options
) -> DataFrame:
    """Code -> label by a join; a missing code gives null.

    ``mapping`` is a dict of any size or a (code, label) frame. A code with several labels gets the smallest, unless
    ``fanout`` is ``allow`` or ``error``. Codes are compared as whole numbers, or as texts if both sides are.
    """
    if not isinstance(mapping, DataFrame):
        texts = all(isinstance(k, str) for k in mapping)
        kind = f"code {'string' if texts else 'bigint'}, label string"
        mapping = df.sparkSession.createDataFrame(list(mapping.items()), kind)
    code, label = mapping.columns
    mine, theirs = df.schema[col].dataType.simpleString(), mapping.schema[code].dataType.simpleString()
    if mine == theirs == "string":
        left, right = F.col(f"`{col}`"), F.col(f"`{code}`")
    else:
        left, right = _whole(F.col(f"`{col}`"), mine), _whole(F.col(f"`{code}`"), theirs)
    pairs = mapping.select(right.alias("__code"), F.col(f"`{label}`").alias(new_col)).where(F.col("__code").isNotNull())
    pairs = apply_fanout(pairs, ["__code"], fanout, [F.col(new_col).asc_nulls_last()])
    return lookup_join(df.withColumn("__code", left), pairs, ["__code"], **options).select(*[f"`{c}`" for c in df.columns], new_col)


def star(
    fact: DataFrame,
    dims: Sequence[tuple[DataFrame, Mapping[str, str], Mapping[str, str]]],
    small: bool | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Fact with attributes from its dimensions: ``(dimension, {fact key: dimension key}, {column: new name})``.

    A dimension may hang on a key that an earlier one added (a snowflake). With ``hot_rows`` the hot values of all keys that
    the fact itself has are found in one pass over it. The fact is read once, or twice with ``hot_rows``, however many
    dimensions there are.
    """
    own = [i for i, (_, key, _) in enumerate(dims) if set(key) <= set(fact.columns)]
    hot = dict(zip(own, hot_keys(fact, [list(dims[i][1]) for i in own], hot_rows))) if hot_rows and own else {}
    for i, (dim, key, cols) in enumerate(dims):
        fact = attach_reference(fact, dim, key, cols, small=small, hot=hot.get(i))
    return fact
