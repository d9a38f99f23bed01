"""Merkle manifest of a table: a tree of hashes over each group, and one over the groups' roots.

Every row is a leaf. In a group the leaves stand in the order of a key; while several nodes remain, each run of ``ARITY``
consecutive ones (the last may be shorter, even one) becomes the hash of its members. What remains is the group's subroot,
and the subroots, in the order of their groups, give the root in the same way.

Places come first: the rows are sorted once over all tasks and numbered without gaps. A node then lives in the row of its
first leaf, so on level L its neighbours are ``ARITY ** L`` rows away: window columns that lag and lead by this fixed offset,
masked by the node's slot in its run and by the run's length, give the siblings, and the row of the first child hashes the
parent. A run never crosses a block of ``ARITY ** LEVELS`` places, so the windows are cut into such blocks: a group with a
third of all rows is spread over all tasks, and ``LEVELS`` levels cost one shuffle. The blocks' tops are the next round's
leaves, a table that is ``ARITY ** LEVELS`` times smaller; each row finally joins the path of its block's top.

A proof is the list of (slot, siblings) from the leaf to the root. It holds whatever leaf it is folded with, so a changed
row is found out by folding its new leaf.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.workspace import store
from .sharding import numbered

ARITY = 3
LEVELS = 7
HEX = 64
PATH = "array<struct<slot:int,siblings:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts' text one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value; numbers are decimal."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(values: Sequence[Column]) -> Column:
    return digest(*[encoded(v) for v in values])


def fold(path: Column, leaf: Column) -> Column:
    """The root that a proof gives for a leaf."""
    left = lambda s: F.substr(s["siblings"], F.lit(1), s["slot"] * HEX)
    right = lambda s: F.substr(s["siblings"], s["slot"] * HEX + 1)
    return F.aggregate(path, leaf, lambda own, s: digest(left(s), own, right(s)))


def proof_digest(path: Column) -> Column:
    """Hash of all siblings of a proof, from the leaf's to those next to the root."""
    return digest(F.array_join(F.transform(path, lambda s: s["siblings"]), ""))


def _levels(nodes: DataFrame) -> DataFrame:
    """``LEVELS`` levels up from ``nodes`` (_g, _pos, _h, _total): each row's ``_path``, and ``_top`` in the row that holds its
    block's top node."""
    block = F.expr(f"_pos div {ARITY**LEVELS}")
    order = Window.partitionBy("_g", "_block").orderBy("_pos")
    rows = nodes.withColumn("_block", block)
    for level in range(LEVELS):
        step = ARITY**level
        place, nodes_here = f"(_pos div {step})", f"((_total + {step - 1}) div {step})"
        slot = F.expr(f"int({place} % {ARITY})")
        run = F.expr(f"least({ARITY}, {nodes_here} - {place} + {place} % {ARITY})")
        held = F.expr(f"_pos % {step} = 0")  # rows that hold a node of this level
        joins = F.expr(f"{nodes_here} > 1")  # else the one node left is the group's top
        offsets = [o for o in range(1 - ARITY, ARITY) if o]
        near = {o: (F.lag("_h", -o * step) if o < 0 else F.lead("_h", o * step)).over(order) for o in offsets}
        rows = rows.withColumns({f"_near{o}": c for o, c in near.items()})
        there = lambda o: (slot + o >= 0) & (slot + o < run)
        siblings = F.concat(*[F.when(there(o), F.col(f"_near{o}")).otherwise("") for o in offsets])
        rows = rows.withColumn(f"_s{level}", F.when(held & joins, siblings)).drop(*[f"_near{o}" for o in offsets])
        parent = F.when(slot == 0, digest(F.col("_h"), F.col(f"_s{level}")))
        rows = rows.withColumn("_h", F.when(held, F.when(joins, parent).otherwise(F.col("_h"))))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    entries = []
    for level in range(LEVELS):
        step = ARITY**level
        # the node above a row is held by the last holder at or before it
        siblings = F.last(f"_s{level}", ignorenulls=True).over(upto)
        slot = F.expr(f"int((_pos div {step}) % {ARITY})")
        entries.append(F.when(F.expr(f"(_total + {step - 1}) div {step} > 1"), F.struct(slot.alias("slot"), siblings.alias("siblings"))))
    path = F.array_compact(F.array(*entries)).cast(PATH)
    return rows.withColumns({"_path": path, "_top": F.col("_h")}).drop("_h", *[f"_s{k}" for k in range(LEVELS)])


def _tree(nodes: DataFrame, most: int, crown: Callable[[DataFrame], DataFrame], given: Sequence[str]) -> DataFrame:
    """``nodes`` with the whole ``_path`` and the columns ``given``, which ``crown`` adds to the groups' top nodes.

    ``most``: nodes of the largest group; it shrinks by ``ARITY ** LEVELS`` each round.
    """
    if most <= 1:
        return crown(nodes)
    rows = store(_levels(nodes), "merkle-levels")
    width = ARITY**LEVELS
    tops = rows.where(F.col("_top").isNotNull()).select(
        "_g", F.col("_block").alias("_pos"), F.col("_top").alias("_h"), F.expr(f"(_total + {width - 1}) div {width}").alias("_total")
    )
    above = _tree(tops, -(-most // width), crown, given)
    above = above.select("_g", F.col("_pos").alias("_block"), F.col("_path").alias("_above"), *given)
    return rows.join(above, ["_g", "_block"]).withColumn("_path", F.concat("_path", "_above")).drop("_above", "_block", "_top")


def _over_groups(tops: DataFrame) -> DataFrame:
    """The groups' top nodes with their path to the root, ``_subroot`` and ``_root``."""
    named = numbered(tops.select(F.col("_g").alias("_name"), F.col("_h").alias("_subroot")), "_name", name="_pos")
    groups = named.count()
    nodes = named.select("_name", "_subroot", "_pos", F.lit(0).alias("_g"), F.col("_subroot").alias("_h"), F.lit(groups).cast("long").alias("_total"))
    end = lambda df: df.withColumns({"_path": F.array().cast(PATH), "_root": F.col("_h")})
    done = store(_tree(nodes, groups, end, ["_root"]), "merkle-groups")
    return done.select(F.col("_name").alias("_g"), F.lit(0).cast("long").alias("_pos"), "_path", "_subroot", "_root")


def merkle_tree(leaves: DataFrame, group: str, order: str, leaf: str = "leaf") -> DataFrame:
    """``leaves`` with ``subroot``, ``root`` and ``path``, the proof as an array of (slot, siblings).

    Leaves of a group ascend by ``order``, null first, then by their hash; groups ascend bytewise, the null group first.
    Equal rows are leaves of their own. A lone leaf is its own subroot, a lone group's subroot the root. An empty table
    stays empty. ``leaves`` should be narrow: it is sorted, numbered and written. Its columns must not be called like the
    new ones or start with ``_``.
    """
    keyed = leaves.withColumn("_g", F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")))
    placed = numbered(keyed, "_g", order, leaf, name="_number")
    sizes = store(placed.groupBy("_g").agg(F.min("_number").alias("_first"), F.count("*").alias("_total")), "merkle-groups")
    most = sizes.agg(F.max("_total")).first()[0] or 0
    if not most:
        return leaves.withColumns({"subroot": F.lit(""), "root": F.lit(""), "path": F.array().cast(PATH)})
    nodes = placed.join(sizes, "_g").withColumns({"_pos": F.col("_number") - F.col("_first"), "_h": F.col(leaf)}).drop("_number", "_first")
    done = _tree(nodes, max(most, 2), _over_groups, ["_subroot", "_root"])
    return done.select(*leaves.columns, F.col("_subroot").alias("subroot"), F.col("_root").alias("root"), F.col("_path").alias("path"))


DOCUMENT_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def without_breaks(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents as a faulty copy job leaves them: those whose id has an even crc32 lose their line breaks."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return docs.withColumn(text, F.when(F.coalesce(even, F.lit(False)), F.replace(F.col(text), F.lit("\n"), F.lit(""))).otherwise(F.col(text)))


def document_manifest(docs: DataFrame, changed: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, path, proof_sha256, folded_root, verified.

    A leaf covers doc_id, source, lang, n_chars and text; nulls in any of them count as such, very long texts are hashed
    whole, other columns are left alone. ``changed`` is applied to the documents (row by row) before they are verified;
    ``folded_root`` comes from the leaf of what it makes of the row and the original proof. Texts are read once and not
    shuffled.
    """
    copies = (changed or (lambda d: d))(docs.select(*[F.col(c).alias(c) for c in DOCUMENT_FIELDS], *[F.col(c).alias(f"_{c}") for c in DOCUMENT_FIELDS]))
    leaves = copies.select(
        F.col("_doc_id").alias("doc_id"), F.col("_source").alias("source"),
        leaf_of([F.col(f"_{c}") for c in DOCUMENT_FIELDS]).alias("leaf"), leaf_of([F.col(c) for c in DOCUMENT_FIELDS]).alias("copy_leaf"),
    )
    proved = merkle_tree(leaves, "source", "doc_id")
    out = proved.withColumns({"proof_sha256": proof_digest(F.col("path")), "folded_root": fold(F.col("path"), F.col("copy_leaf"))})
    return out.select("doc_id", "leaf", "subroot", "root", "path", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
