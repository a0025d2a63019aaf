"""Merkle manifest of a dataset, built and proved by sibling-shift self-joins.

A row's leaf is the SHA-256 of its framed fields. The rows of a group are ordered by
identifier, and every ``arity`` neighbours become a parent, until one node is left: the
group's subroot. The subroots, ordered by group, become the root in the same way.

1. Leaves get their place by one range-partitioned sort over (group, identifier, leaf): a
   group that holds a third of all rows is dealt over many ranges. A place within a group is
   the place in the whole order less that of the group's first row.
2. At each level a node meets its siblings by equijoins on computed places: the place with its
   last bit flipped for binary trees, else the place of each other slot of the run. Rows of
   slot zero then emit the parents. All groups rise together; a group whose subroot is found
   drops out. A level is written as a table before the next reads it; the small ones at the
   top, up to a fixed number of nodes, are one task each.
3. Proofs come down the same way: a node joins the siblings of its parent's way to the root.
   Each parent has at most ``arity`` children, so no key of any join is hot.

Only the height of the trees, the number of groups and the root itself reach the driver.

Defined results:

* A null field is framed as ``-``, an empty one as ``0:``, so the two differ. A null group is
  first. Null identifiers come first in their group.
* Rows that repeat an identifier are leaves of their own, ordered by their leaf; rows alike in
  every field have the same leaf, and the place of each is settled by its place in the input.
* A group of one row has its leaf for subroot, and one group's subroot is the root.
* Whole texts are hashed whatever their length. An empty table gives an empty manifest. Only
  the named columns are read; others, whatever their names, make no difference.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthtide.operators.features import rank_rows
from monthtide.shared import Workspace

ARITY = 3
#: Levels of so many nodes at most are joined in one task, without a shuffle.
SMALL = 20_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenation."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(fields: Sequence[Column]) -> Column:
    """The leaf of a row: ``-`` for a null field, else its length in bytes, ``:``, the value."""
    texts = [c.cast("string") for c in fields]
    return digest(
        *[
            F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
            for t in texts
        ]
    )


def _hex(raw: Column) -> Column:
    return F.lower(F.hex(raw))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf (hex) leads to along a path."""
    return F.aggregate(
        path, leaf, lambda node, level: digest(_hex(level["left"]), node, _hex(level["right"]))
    )


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path, level by level, left to right."""
    return F.sha2(
        F.array_join(F.transform(path, lambda x: _hex(F.concat(x["left"], x["right"]))), ""), 256
    )


@dataclass
class Manifest:
    """``rows``: id, the carried columns, leaf, subroot (hex), path; ``root``, None if empty.

    ``path`` is an array of (left, right), the siblings before and after a node at each level.
    ``work`` holds the tables; nothing that reads ``rows`` may run after ``work.remove()``.
    """

    rows: DataFrame
    root: str | None
    work: Workspace


def build_manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "source",
    fields: Sequence[str] = FIELDS,
    arity: int = ARITY,
    carry: Mapping[str, Column] | None = None,
) -> Manifest:
    """A leaf, subroot and path for every row. ``carry`` are columns to take along."""
    if arity < 2:
        raise ValueError("a run has at least two nodes")
    work = Workspace(docs.sparkSession)
    carry = dict(carry or {})
    group = F.col(group_col).cast("string")
    carried = F.struct(F.col(id_col).alias("id"), *[c.alias(name) for name, c in carry.items()])
    leaves = work.settle(
        docs.select(
            F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("group"),
            carried.alias("of"),
            F.unhex(leaf_digest([F.col(c) for c in fields])).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    order = [F.asc("group"), F.asc_nulls_first("of.id"), F.asc("digest"), F.asc("row")]
    placed = rank_rows(leaves, order, "position", work)
    groups = work.settle(
        placed.groupBy("group").agg(
            F.min("position").alias("start"), F.count(F.lit(1)).alias("width")
        )
    )
    numbered = work.settle(rank_rows(groups, [F.asc("group")], "number", work))
    sizes = numbered.agg(F.count(F.lit(1)), F.max("width"), F.sum("width"))
    n_groups, widest, n_rows = sizes.first()
    taken = ["of.id", *[f"of.{name}" for name in carry]]
    if not n_groups:
        empty = leaves.select(
            *taken, F.lit("").alias("leaf"), F.lit("").alias("subroot"), _empty_path().alias("path")
        )
        return Manifest(empty, None, work)

    bottom = placed.join(numbered, "group").select(
        "number", (F.col("position") - F.col("start")).alias("index"), "width", "digest", "of"
    )
    levels, tops = _rise(work, bottom, widest, arity, n_rows, n_groups)
    crown = tops.select(
        F.lit(0).cast("long").alias("number"),
        F.col("number").alias("index"),
        F.lit(n_groups).cast("long").alias("width"),
        F.col("digest"),
        F.struct("number", "level", "digest").alias("of"),
    )
    upper, top = _rise(work, crown, n_groups, arity, n_groups, 1)
    root = top.select(_hex(F.col("digest"))).first()[0]
    above = top.select("number", "level", F.col("digest").alias("subroot"), _empty_path().alias("path"))
    crowned = _descend(work, upper, above, arity)
    starts = work.settle(
        crowned.select("of.number", "of.level", F.col("of.digest").alias("subroot"), "path")
    )
    rows = _descend(work, levels, starts, arity)
    return Manifest(
        rows.select(
            *taken, _hex(F.col("digest")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), "path"
        ),
        root,
        work,
    )


@dataclass(frozen=True)
class _Level:
    frame: DataFrame
    small: bool


def _empty_path() -> Column:
    return F.array().cast("array<struct<left: binary, right: binary>>")


def _rise(
    work: Workspace, bottom: DataFrame, widest: int, arity: int, rows: int, trees: int
) -> tuple[list[_Level], DataFrame]:
    """The levels of all trees, lowest first, and each tree's top: number, level, digest.

    ``bottom`` has number (of the tree), index, width (of the tree's level), digest, of. A level
    adds ``left`` and ``right``, the siblings' digests; lone nodes have none. Small levels have
    a single partition.
    """
    nodes, levels = bottom, []
    while True:
        small = rows <= SMALL
        nodes = nodes.coalesce(1) if small else nodes
        level = work.settle(_with_siblings(nodes, arity) if widest > 1 else _alone(nodes))
        level = level.coalesce(1) if small else level
        levels.append(_Level(level, small))
        if widest <= 1:
            break
        rows = rows // arity + trees
        nodes = level.where((F.col("width") > 1) & (F.col("index") % arity == 0)).select(
            "number",
            F.expr(f"index div {arity}").alias("index"),
            F.expr(f"(width + {arity - 1}) div {arity}").alias("width"),
            F.unhex(digest(_hex(F.col("digest")), _hex(F.col("right")))).alias("digest"),
        )
        widest = -(-widest // arity)
    tops = [
        x.frame.where("width = 1").select("number", F.lit(k).alias("level"), "digest")
        for k, x in enumerate(levels)
    ]
    return levels, work.settle(reduce(DataFrame.union, tops))


def _alone(nodes: DataFrame) -> DataFrame:
    none = F.lit(b"")
    return nodes.withColumns({"left": none, "right": none})


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Each node with its siblings' digests, joined one shift of the slot after the other."""
    slot = F.col("index") % arity
    others = nodes.select("number", F.col("index").alias("at"), F.col("digest").alias("sibling"))
    met = nodes.withColumns({"left": F.lit(b""), "right": F.lit(b"")})
    kept = met.columns
    for shift in range(1, arity):
        if arity == 2:
            at = F.col("index").bitwiseXOR(F.lit(1).cast("long"))
        else:
            at = F.col("index") - slot + (slot + shift) % arity
        sibling = F.coalesce("sibling", F.lit(b""))
        after = slot + shift < arity
        met = (
            met.withColumn("at", at)
            .join(others, ["number", "at"], "left")
            .withColumns(
                {
                    "left": F.when(after, F.col("left")).otherwise(F.concat("left", sibling)),
                    "right": F.when(after, F.concat("right", sibling)).otherwise(F.col("right")),
                }
            )
            .select(*kept)
        )
    return met


def _descend(work: Workspace, levels: list[_Level], tops: DataFrame, arity: int) -> DataFrame:
    """The lowest level's nodes with subroot and path.

    ``tops`` has number, level, subroot, path: what leads on from each tree's top.
    """
    above = None
    for k in reversed(range(len(levels))):
        level, small = levels[k].frame, levels[k].small
        ended = tops.where(F.col("level") == k).select("number", "subroot", "path")
        ends = level.where("width = 1").join(ended.coalesce(1) if small else ended, "number")
        here = ends.select(*level.columns, "subroot", "path")
        if above is not None:
            parents = above.select(
                "number", F.col("index").alias("parent"), "subroot", F.col("path").alias("onward")
            )
            own = F.array(F.struct("left", "right"))
            here = here.unionByName(
                level.where("width > 1")
                .withColumn("parent", F.expr(f"index div {arity}"))
                .join(parents, ["number", "parent"])
                .select(*level.columns, "subroot", F.concat(own, "onward").alias("path"))
            )
        if not k:
            return here
        above = work.settle(here.select("number", "index", "subroot", "path"))
        above = above.coalesce(1) if small else above
    raise ValueError("a tree has at least one level")


def manifest_audit(docs: DataFrame) -> DataFrame:
    """Proofs of all rows of a documents table, and what they show after tampering.

    Rows whose identifier's CRC-32 is even lose the line ends of their text. Returns doc_id,
    leaf, subroot, root, proof_sha256 of the untouched table, then folded_root, which follows
    from the tampered row and the untouched siblings, and verified, whether it is the root.
    """
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.translate("text", "\n", "")
    touched = even & F.contains(F.col("text"), F.lit("\n"))
    changed = [tampered if c == "text" else F.col(c) for c in FIELDS]
    claimed = F.when(touched, F.unhex(leaf_digest(changed)))
    made = build_manifest(docs, carry={"claimed": claimed})
    root = F.lit(made.root or "")
    return (
        made.rows.withColumn(
            "folded_root", fold(F.coalesce(_hex(F.col("claimed")), F.col("leaf")), F.col("path"))
        )
        .select(
            F.col("id").alias("doc_id"),
            "leaf",
            "subroot",
            root.alias("root"),
            proof_digest(F.col("path")).alias("proof_sha256"),
            "folded_root",
            (F.col("folded_root") == root).alias("verified"),
        )
    )
