"""One tree that holds the trees of every smaller depth.

A tree grows level by level, and a node's split does not depend on how deep the tree may
become. So the tree of depth d is the deepest one cut off at depth d, each cut node
predicting the mean it already has. Fitting the deepest one fits them all.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.ml.regression import DecisionTreeRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAF = "_leaf"


@dataclass(frozen=True)
class Node:
    mean: float
    children: tuple[Node, Node] | None = None


def nodes_of(model: DecisionTreeRegressionModel) -> Node:
    """The tree's nodes, of which there are at most twice as many as training rows."""

    def read(node) -> Node:
        if node.subtreeDepth() == 0:
            return Node(node.prediction())
        return Node(node.prediction(), (read(node.leftChild()), read(node.rightChild())))

    return read(model._java_obj.rootNode())


@dataclass(frozen=True)
class NestedTree:
    """The tree of depth ``max_depth`` out of a deeper one; it predicts as if fitted alone."""

    model: DecisionTreeRegressionModel
    root: Node
    max_depth: int

    @classmethod
    def of(cls, model: DecisionTreeRegressionModel) -> NestedTree:
        return cls(model, nodes_of(model), model.getMaxDepth())

    def cut(self, max_depth: int) -> NestedTree:
        if max_depth > self.max_depth:
            raise ValueError(f"the tree was grown to depth {self.max_depth}, not {max_depth}")
        return NestedTree(self.model, self.root, max_depth)

    def leaf_means(self) -> list[float]:
        """For each leaf of the deepest tree, left to right, the mean of this tree's leaf."""

        def walk(node: Node, depth: int, mean: float | None) -> Iterator[float]:
            if mean is None and (depth == self.max_depth or not node.children):
                mean = node.mean
            if not node.children:
                yield mean
                return
            for child in node.children:
                yield from walk(child, depth + 1, mean)

        return list(walk(self.root, 0, None))

    @property
    def depth(self) -> int:
        """Levels below the root. Leaves of one mean count as the node they come from."""

        def height(node: Node, left: int) -> int:
            if not left or not node.children:
                return 0
            heights = [height(child, left - 1) for child in node.children]
            one_mean = node.children[0].mean == node.children[1].mean
            return 0 if one_mean and not any(heights) else 1 + max(heights)

        return height(self.root, self.max_depth)

    def prediction(self) -> Column:
        """From the column that ``with_leaf`` adds."""
        means = F.array(*[F.lit(m) for m in self.leaf_means()])
        return F.element_at(means, F.col(LEAF).cast("int") + 1)

    def with_leaf(self, df: DataFrame) -> DataFrame:
        kept = df.columns
        return self.model.copy().setLeafCol(LEAF).transform(df).select(*kept, LEAF)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` and ``prediction``."""
        return self.with_leaf(df).withColumn("prediction", self.prediction()).drop(LEAF)


def score_cuts(tree: NestedTree, df: DataFrame, depths: Sequence[int]) -> DataFrame:
    """``df`` and ``prediction_0``, ``prediction_1``, ...: by the tree cut at each depth."""
    cuts = {f"prediction_{i}": tree.cut(d).prediction() for i, d in enumerate(depths)}
    return tree.with_leaf(df).withColumns(cuts).drop(LEAF)
