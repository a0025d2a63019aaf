"""Regression trees and forests over any number of categories, grown in DataFrames.

A tree grows one level at a time, all nodes and all trees of a forest together. For each node
and feature the rows' weights, labels and squared labels are summed for each value; the month
numbers in order, the categories ordered by their mean in the node, give every split its left
side by prefix sums. The categories that go left are rows of a table that the next level joins;
no list of them is ever held by a task or the driver. In trees that are not deep a row stays
whole, with its place in all trees in an array, and the rows of a category stay side by side.

The splits are those of Spark's trees with a bin for every value: variance as impurity, month
thresholds half way between neighbours of the whole training set, categories without rows in a
node to the right; on equal gains the month number first, then the earlier cut.

A forest's rows are weighted by hash: the weight of a row in a tree is a Poisson number drawn
from the hash of (seed, tree, category, month number). It depends on nothing else, so that the
same rows give the same forest however they are partitioned, and a lost task draws the same.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, Window
from pyspark.sql import functions as F

from monthtide.operators.models import SEED, check_depth
from monthtide.operators.moments import LABEL
from monthtide.shared import Workspace

# With more values than this, prefix sums are taken over ranges of them.
RANGED_FROM = 200_000
# So many levels are routed anew from the last written rows.
REROUTED = 3
# Rows that one task holds, with their places in all trees.
ROWS_PER_PARTITION = 50_000
# Trees up to this depth and with so many nodes are walked by arrays: a level that splits has at
# most as many nodes as a number has bits.
PACKED_DEPTH, PACKED_NODES = 7, 2048

MONTH, CATEGORY = 1, 2
NODE = ["tree", "node"]
GROUP = [*NODE, "feature"]


def uniform(*parts: Column) -> Column:
    """From 0 up to 1, by the first 32 bits of the MD5 of the parts, joined by colons."""
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / float(1 << 32)


def poisson_steps() -> list[float]:
    """Where a Poisson number of mean 1 goes up: its distribution function at 0, 1, 2, ..."""
    steps, total = [], 0.0
    while total < 1 - 2.0**-33:
        total += math.exp(-1) / math.factorial(len(steps))
        steps.append(total)
    return steps


def poisson_weight(chance: Column) -> Column:
    return reduce(
        lambda a, b: a + b, [(chance >= F.lit(s)).cast("double") for s in poisson_steps()]
    )


@dataclass(frozen=True)
class WideForest:
    """The nodes of one or more trees as tables; predictions are the mean over the trees.

    ``nodes``: tree, node (1 is the root, the children of k are 2k and 2k + 1), mean, feature
    (null for a leaf), threshold. ``lefts``: tree, node, category_idx that goes left.
    """

    nodes: DataFrame
    lefts: DataFrame
    trees: int
    depth: int
    work: Workspace

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` and ``prediction``."""
        if not in_arrays(self.trees, self.depth):
            return self._joined(df)
        total = F.aggregate("means_0", F.lit(0.0), lambda sum_, mean: sum_ + mean)
        return self.walked(df, [self.depth]).select("of.*", (total / self.trees).alias("prediction"))

    def walked(
        self, df: DataFrame, depths: Sequence[int], through: Column | None = None
    ) -> DataFrame:
        """``of``, the row; ``means_0``, ...: each tree's prediction if it were that deep.

        Each row has its category's lefts by its side and walks down all trees in place, or
        those whose numbers are in the array ``through``.
        """
        by_category = "category_idx" in df.columns
        rows = df.select(
            F.struct(*[F.col(c) for c in df.columns]).alias("of"),
            F.col("id").cast("double").alias("month_id"),
            (F.col("category_idx") if by_category else F.lit(0)).cast("long").alias("key"),
            F.transform(
                F.sequence(F.lit(0), F.lit(self.trees - 1)) if through is None else through,
                lambda tree: F.struct(
                    tree.alias("tree"),
                    F.lit(1).cast("long").alias("node"),
                    F.lit(None).cast("double").alias("mean"),
                ),
            ).alias("at"),
        )
        if by_category:
            rows = rows.join(_bits(self.lefts, self.trees, 0, self.depth).hint("merge"), "key", "left")
        else:
            rows = rows.withColumn("bits", F.lit(None).cast("array<bigint>"))
        nodes = self.nodes.collect()
        kept = ["of", "month_id", "bits"]
        for level in range(self.depth + 1):
            known = _LevelNodes.of(nodes, self.trees, level)
            rows = rows.select(
                *kept,
                F.transform(
                    "at",
                    lambda a: F.struct(
                        a["tree"].alias("tree"),
                        known.child(
                            a["node"], a["tree"], F.col("month_id"), F.col("bits"), level * self.trees
                        ).alias("node"),
                        F.coalesce(known.mean(a["node"], a["tree"]), a["mean"]).alias("mean"),
                    ),
                ).alias("at"),
            )
            for i, depth in enumerate(depths):
                if level == min(depth, self.depth):
                    rows = rows.withColumn(f"means_{i}", F.transform("at", lambda a: a["mean"]))
                    kept.append(f"means_{i}")
        return rows.select("of", *[f"means_{i}" for i in range(len(depths))])

    def one(self, tree: int, max_depth: int) -> WideForest:
        """One of the trees, as if grown to ``max_depth``."""
        own = F.col("tree") == tree
        inner = F.col("node") < 1 << max_depth
        nodes = self.nodes.where(own & (F.col("node") < 2 << max_depth)).select(
            F.lit(0).alias("tree"), "node", "mean", F.when(inner, F.col("feature")).alias("feature"), "threshold"
        )
        lefts = self.lefts.where(own & inner).withColumn("tree", F.lit(0))
        return WideForest(nodes, lefts, 1, min(self.depth, max_depth), self.work)

    def _joined(self, df: DataFrame) -> DataFrame:
        """As ``transform``, for trees of any depth: a join for each level."""
        index = F.col("category_idx") if "category_idx" in df.columns else F.lit(0.0)
        named = df.select(
            F.struct(*[F.col(c) for c in df.columns]).alias("of"),
            F.monotonically_increasing_id().alias("row"),
            F.col("id").cast("double").alias("month_id"),
            index.cast("double").alias("category_idx"),
        )
        rows = named.select(
            "*",
            F.explode(F.sequence(F.lit(0), F.lit(self.trees - 1))).alias("tree"),
            F.lit(1).cast("long").alias("node"),
            F.lit(None).cast("double").alias("mean"),
        )
        for _ in range(self.depth + 1):
            rows = _routed(rows, self.nodes, self.lefts)
        if self.trees > 1:
            rows = rows.groupBy("row").agg(F.first("of").alias("of"), F.avg("mean").alias("mean"))
        return rows.select("of.*", F.col("mean").alias("prediction"))


def wide_tree(training: DataFrame, max_depth: int = 5, work: Workspace | None = None) -> WideForest:
    """One tree of all rows and features."""
    return grow(training, max_depth, F.array(F.lit(1.0)), 1, True, SEED, work)


def wide_forest(
    training: DataFrame,
    num_trees: int,
    max_depth: int = 5,
    bootstrap: bool = True,
    feature_subset: str = "auto",
    seed: int = SEED,
    work: Workspace | None = None,
) -> WideForest:
    """Trees on rows weighted by hash (``bootstrap``).

    ``feature_subset``: "all", or "auto" for a third of the features at each node, which is one
    of them by the hash of (seed, tree, node).
    """
    if feature_subset not in ("auto", "all"):
        raise ValueError("feature_subset is 'auto' or 'all'")
    if num_trees < 1:
        raise ValueError("a forest has at least one tree")
    weights = F.array_repeat(F.lit(1.0), num_trees)
    if bootstrap:
        category = F.col("category") if "category_idx" in training.columns else F.lit("")
        month = F.col("id").cast("double").cast("long")
        chances = F.transform(
            F.sequence(F.lit(0), F.lit(num_trees - 1)),
            lambda tree: uniform(F.lit(seed), tree, category, month),
        )
        weights = F.transform(chances, poisson_weight)
    return grow(training, max_depth, weights, num_trees, feature_subset == "all", seed, work)


def wide_folds(training: DataFrame, max_depth: int, folds: int, work: Workspace | None = None) -> WideForest:
    """A tree without the rows of each ``fold``, and one of all rows, grown together."""
    inside = [F.col("fold") != k for k in range(folds)] + [F.lit(True)]
    weights = F.array(*[c.cast("double") for c in inside])
    return grow(training, max_depth, weights, folds + 1, True, SEED, work, inside)


def in_arrays(trees: int, depth: int) -> bool:
    """Whether all nodes fit arrays, and a level's that split the bits of a number."""
    return depth <= PACKED_DEPTH and trees << (depth + 1) <= PACKED_NODES


def grow(
    training: DataFrame,
    max_depth: int,
    weights: Column,
    trees: int,
    all_features: bool,
    seed: int,
    work: Workspace | None = None,
    inside: Sequence[Column] = (),
) -> WideForest:
    """``training`` has id, n, perhaps category_idx, and what ``weights`` needs.

    ``weights``: an array of each row's weight in each tree. ``inside``: for each tree, which
    rows it is trained on, where these differ.
    """
    check_depth(max_depth)
    work = work or Workspace(training.sparkSession)
    by_category = "category_idx" in training.columns
    # a number for each month, and some
    ids = F.col("id").cast("double")
    n_categories = F.approx_count_distinct("category_idx") if by_category else F.lit(1)
    size, n_values, *months = training.agg(
        F.count(F.lit(1)),
        n_categories,
        *[F.sort_array(F.collect_set(F.when(c, ids))).alias(f"m{i}") for i, c in enumerate(inside or [F.lit(True)])],
    ).first()
    if not size:
        raise ValueError("no rows to fit")
    ranged = n_values > RANGED_FROM
    parts = 1 + size // ROWS_PER_PARTITION
    rows = _planted(training, weights, by_category, parts).persist()
    packed, above = True, None
    nodes: list[DataFrame] = []
    lefts: list[DataFrame] = []
    held: list[DataFrame] = [rows]
    try:
        for level in range(max_depth + 1):
            if not packed and level % REROUTED == 0:
                rows = work.settle(rows)
            flat = _flat(rows) if packed else rows
            values = work.settle(_values(flat, by_category, all_features, seed))
            found, grown = Observation(), _best(_running(values, ranged, work), level < max_depth)
            grown = work.settle(
                grown.withColumn("threshold", _threshold(months))
                .select(*NODE, "mean", "feature", "threshold", "place", "tie")
                .observe(found, F.count("feature").alias("splits"))
            )
            if above is not None:
                # nothing reads these any more, as those below are in memory now
                above.unpersist()
                above = None
            nodes.append(grown)
            if not found.get["splits"]:
                break
            cuts = grown.where(F.col("feature") == CATEGORY).select(
                *NODE, F.col("place").alias("cut"), F.col("tie").alias("cut_tie")
            )
            before = (F.col("place") < F.col("cut")) | (
                (F.col("place") == F.col("cut")) & (F.col("tie") <= F.col("cut_tie"))
            )
            left = values.where(F.col("feature") == CATEGORY).join(cuts, NODE).where(before)
            # written, so that the plans of the rows do not double with each level
            lefts.append(work.settle(left.select(*NODE, F.col("value").alias("category_idx"))))
            if packed and in_arrays(trees, level + 1):
                known = _LevelNodes.of(grown.collect(), trees, level)
                below = _sent(rows, known, lefts[-1] if by_category else None, trees, parts).persist()
                held.append(below)
                above, rows = rows, below
            else:
                packed = False
                rows = _routed(flat.withColumn("mean", F.lit(None).cast("double")), grown, lefts[-1])
                rows = rows.where("node is not null").drop("mean")
        none = nodes[0].where("false").select(*NODE, F.lit(0.0).alias("category_idx"))
        return WideForest(
            reduce(DataFrame.union, nodes).select(*NODE, "mean", "feature", "threshold"),
            reduce(DataFrame.union, lefts, none),
            trees,
            len(nodes) - 1,
            work,
        )
    finally:
        for frame in held:
            frame.unpersist()


def _planted(training: DataFrame, weights: Column, by_category: bool, parts: int) -> DataFrame:
    """The rows with their place in every tree, the root's; a category's rows side by side.

    So a task sums a category's rows before the shuffle, and the lefts come to the rows.
    """
    if by_category:
        key = F.col("category_idx").cast("long").alias("key")
        training = training.select("*", key).repartition(parts, "key").sortWithinPartitions("key", "id")
    else:
        training = training.withColumn("key", F.lit(0).cast("long"))
    root = F.lit(1).cast("long").alias("node")
    return training.select(
        "key",
        (F.col("category_idx") if by_category else F.lit(0.0)).cast("double").alias("category_idx"),
        F.col("id").cast("double").alias("month_id"),
        F.col(LABEL).cast("double").alias("y"),
        F.transform(weights, lambda w: F.struct(root, w.alias("w"))).alias("at"),
    )


def _flat(rows: DataFrame) -> DataFrame:
    """A row for each tree that draws it."""
    return (
        rows.select("category_idx", "month_id", "y", F.posexplode("at").alias("tree", "a"))
        .where("a.w > 0 and a.node is not null")
        .select("tree", "a.node", "month_id", "category_idx", "y", "a.w")
    )


@dataclass(frozen=True)
class _LevelNodes:
    """The nodes of a level as arrays: tree after tree, node after node."""

    level: int
    means: Column
    features: Column
    thresholds: Column

    @classmethod
    def of(cls, nodes: Sequence[Row], trees: int, level: int) -> _LevelNodes:
        width = 1 << level
        found = {r["tree"] * width + r["node"] - width: r for r in nodes if width <= r["node"] < 2 * width}

        def values(name: str, kind: str) -> Column:
            every = [found[i][name] if i in found else None for i in range(trees * width)]
            text = ",".join("null" if v is None else repr(v) for v in every)
            return F.from_json(F.lit(f"[{text}]"), f"array<{kind}>")

        return cls(level, values("mean", "double"), values("feature", "int"), values("threshold", "double"))

    def _place(self, node: Column, tree: Column) -> Column:
        return (tree * (1 << self.level) + node - (1 << self.level)).cast("int")

    def mean(self, node: Column, tree: Column) -> Column:
        return F.get(self.means, self._place(node, tree))

    def child(self, node: Column, tree: Column, month: Column, bits: Column, first: int = 0) -> Column:
        """Where a row goes on from ``node``; null below a leaf. ``bits`` begin at a slot for each tree."""
        place = self._place(node, tree)
        feature = F.get(self.features, place)
        bit = F.getbit(F.get(bits, tree + first), (node - (1 << self.level)).cast("int")) == 1
        left = F.when(feature == MONTH, month <= F.get(self.thresholds, place)).otherwise(
            F.coalesce(bit, F.lit(False))
        )
        return F.when(feature.isNotNull(), 2 * node + F.when(left, 0).otherwise(1))


def _sent(
    rows: DataFrame, known: _LevelNodes, lefts: DataFrame | None, trees: int, parts: int
) -> DataFrame:
    """The rows, one level further down in every tree."""
    kept = ["key", "category_idx", "month_id", "y"]
    if lefts is None:
        rows = rows.withColumn("bits", F.lit(None).cast("array<bigint>"))
    else:
        # the rows are dealt and sorted by their key already, and stay where they are
        bits = _bits(lefts, trees, known.level, known.level).repartition(parts, "key")
        rows = rows.join(bits.hint("merge"), "key", "left")
    return rows.select(
        *kept,
        F.transform(
            "at",
            lambda a, tree: F.struct(
                known.child(a["node"], tree, F.col("month_id"), F.col("bits")).alias("node"),
                a["w"].alias("w"),
            ),
        ).alias("at"),
    )


def _bits(lefts: DataFrame, trees: int, first: int, last: int) -> DataFrame:
    """For each category (``key``) its ``bits``: level after level, tree after tree, where it goes left.

    A bit for each node of the level, the lowest for the first.
    """
    one = F.lit(1).cast("long")
    level = F.length(F.bin("node")) - 1
    in_level = F.col("node") - F.call_function("shiftleft", one, level)
    slots = (last - first + 1) * trees
    found = (
        lefts.select(
            F.col("category_idx").cast("long").alias("key"),
            ((level - first) * trees + F.col("tree")).alias("slot"),
            F.call_function("shiftleft", one, in_level.cast("int")).alias("bit"),
        )
        .groupBy("key", "slot")
        .agg(F.bit_or("bit").alias("bits"))
        .groupBy("key")
        .agg(F.map_from_entries(F.collect_list(F.struct("slot", "bits"))).alias("by_slot"))
    )
    every = F.transform(
        F.sequence(F.lit(0), F.lit(slots - 1)),
        lambda slot: F.coalesce(F.element_at("by_slot", slot), F.lit(0).cast("long")),
    )
    return found.select("key", every.alias("bits"))


def _threshold(months: list[list[float]]) -> Column:
    """Half way from the month number of a cut to the next one of the tree's training set."""

    def middle(own: list[float]) -> Column:
        middles = F.array(*[F.lit((a + b) / 2) for a, b in zip(own, [*own[1:], *own[-1:]])])
        place = F.array_position(F.array(*[F.lit(m) for m in own]), F.col("value"))
        return F.get(middles, (place - 1).cast("int"))

    value = middle(months[0])
    if any(own != months[0] for own in months):
        for tree, own in enumerate(months):
            value = F.when(F.col("tree") == tree, middle(own)).otherwise(value)
    return F.when(F.col("feature") == MONTH, value)


def _values(rows: DataFrame, by_category: bool, all_features: bool, seed: int) -> DataFrame:
    """The sums of each node, feature and value, and the value's place in the feature's order."""
    month = F.struct(F.lit(MONTH).alias("feature"), F.col("month_id").alias("value"))
    category = F.struct(F.lit(CATEGORY).alias("feature"), F.col("category_idx").alias("value"))
    if not by_category:
        features = F.array(month)
    elif all_features:
        features = F.array(month, category)
    else:
        first = uniform(F.lit(seed), F.col("tree"), F.col("node"), F.lit("feature")) < 0.5
        features = F.array(F.when(first, month).otherwise(category))
    summed = (
        rows.select(*NODE, "w", "y", F.explode(features).alias("f"))
        .groupBy(*NODE, F.col("f.feature").alias("feature"), F.col("f.value").alias("value"))
        .agg(
            F.sum("w").alias("c"),
            F.sum(F.col("w") * F.col("y")).alias("s"),
            F.sum(F.col("w") * F.col("y") * F.col("y")).alias("q"),
        )
    )
    is_month = F.col("feature") == MONTH
    return summed.withColumns(
        {
            "place": F.when(is_month, F.col("value")).otherwise(F.col("s") / F.col("c")),
            "tie": F.when(is_month, 0.0).otherwise(F.col("value")),
        }
    )


def _running(values: DataFrame, ranged: bool, work: Workspace) -> DataFrame:
    """``values`` with the sums up to each (lc, ls, lq) and of the whole node (tc, ts, tq).

    ``ranged``: a node's values are dealt by range over many tasks, each of which sums its own;
    what the ranges before it hold is added.
    """
    sums = {"c": "c", "s": "s", "q": "q"}
    if not ranged:
        group = Window.partitionBy(*GROUP)
        ahead = group.orderBy("place", "tie").rowsBetween(Window.unboundedPreceding, 0)
        return values.withColumns(
            {f"l{x}": F.sum(x).over(ahead) for x in sums}
            | {f"t{x}": F.sum(x).over(group) for x in sums}
        )
    dealt = work.settle(
        values.repartitionByRange(*GROUP, "place", "tie").withColumn("part", F.spark_partition_id())
    )
    chunk = Window.partitionBy("part", *GROUP).orderBy("place", "tie")
    inside = dealt.withColumns(
        {f"l{x}": F.sum(x).over(chunk.rowsBetween(Window.unboundedPreceding, 0)) for x in sums}
    )
    group = Window.partitionBy(*GROUP)
    earlier = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    chunks = dealt.groupBy("part", *GROUP).agg(*[F.sum(x).alias(x) for x in sums])
    chunks = chunks.select(
        "part",
        *GROUP,
        *[F.coalesce(F.sum(x).over(earlier), F.lit(0.0)).alias(f"b{x}") for x in sums],
        *[F.sum(x).over(group).alias(f"t{x}") for x in sums],
    )
    return inside.join(chunks, ["part", *GROUP]).withColumns(
        {f"l{x}": F.col(f"l{x}") + F.col(f"b{x}") for x in sums}
    )


def _best(running: DataFrame, split: bool) -> DataFrame:
    """Each node with its mean and, where ``split`` and a cut gains, its best cut."""

    def variance(c: Column, s: Column, q: Column) -> Column:
        return (q - s * s / c) / c

    c, s, q = F.col("tc"), F.col("ts"), F.col("tq")
    lc, ls, lq = F.col("lc"), F.col("ls"), F.col("lq")
    rc = c - lc
    gain = (
        variance(c, s, q) - lc / c * variance(lc, ls, lq)
        - rc / c * variance(rc, s - ls, q - lq)
    )
    if not split:
        gain = F.lit(None).cast("double")
    # of equal gains the least feature, place and tie
    rank = F.struct(
        F.col("gain"), -F.col("feature"), -F.col("place"), -F.col("tie")
    )
    cut = F.struct("feature", "value", "place", "tie")
    return (
        running.withColumn("gain", F.when(lc < c, gain))
        .groupBy(*NODE)
        .agg(
            F.max(F.col("ts") / F.col("tc")).alias("mean"),
            F.max_by(cut, F.when(F.col("gain") > 0, rank)).alias("best"),
        )
        .select(*NODE, "mean", "best.*")
    )


def _routed(rows: DataFrame, nodes: DataFrame, lefts: DataFrame) -> DataFrame:
    """The rows with their node's mean, one level further down; ``node`` is null below a leaf."""
    known = nodes.select(*NODE, F.col("mean").alias("own"), "feature", "threshold")
    sent = lefts.select(*NODE, "category_idx", F.lit(True).alias("is_left"))
    left = F.when(F.col("feature") == MONTH, F.col("month_id") <= F.col("threshold")).otherwise(
        F.coalesce("is_left", F.lit(False))
    )
    further = 2 * F.col("node") + F.when(left, 0).otherwise(1)
    return (
        rows.join(known, NODE, "left")
        .join(sent, [*NODE, "category_idx"], "left")
        .withColumn("mean", F.coalesce("own", "mean"))
        .withColumn("node", F.when(F.col("feature").isNotNull(), further))
        .select(*rows.columns)
    )
