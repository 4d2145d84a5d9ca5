"""Grids of tree models without a fit for every cell.

A tree of depth 10 holds that of depth 5: nodes are split level by level, and a split depends on its node's rows
only. The first five trees of a boosted model are those of one with five iterations, and any trees of a forest
are a forest. So of the cells that differ in such parameters only the largest is fitted; the others are read off
it. For single trees and boosted ones these are the very models that a fit of the cell gives; a forest's are drawn
from the same distribution, as from another seed. The ``fit`` of single trees and forests is Spark's own; boosted trees
are fitted column by column (``boosting``).
"""

from __future__ import annotations

import threading
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    GBTClassificationModel,
    GBTClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from postlens.learning.boosting import Dealt, boost, fits
from postlens.session import scratch_path

LEAF = "_leaf"


def cut_tree(nodes: Mapping[int, Row], depth: int) -> list[Row]:
    """For each leaf of a tree, from left to right, the node that is its leaf in the tree of ``depth``. As Spark does,
    two leaves of one prediction are folded."""

    def cut(at: int, left: int) -> tuple[list[Row], bool]:
        node = nodes[at]
        if node.leftChild < 0:
            return [node], True
        (one, one_leaf), (two, two_leaf) = cut(node.leftChild, left - 1), cut(node.rightChild, left - 1)
        if left <= 0 or (one_leaf and two_leaf and one[0].prediction == two[0].prediction):
            return [node] * (len(one) + len(two)), True
        return one + two, False

    return cut(0, depth)[0]


def tree_nodes(model: Model, df: DataFrame) -> list[dict[int, Row]]:
    """The nodes of each tree by their number, as a saved model lists them."""
    path = scratch_path(df.sparkSession, "grown")
    model.write().save(path)
    saved = df.sparkSession.read.parquet(f"{path}/data")
    single = isinstance(model, DecisionTreeClassificationModel)
    listed = saved.select(F.lit(0).alias("tree"), F.struct("*").alias("node")) if single else saved.toDF("tree", "node")
    trees: dict[int, dict[int, Row]] = {}
    for tree, node in listed.select("tree", F.col("node").dropFields("split").alias("node")).collect():
        trees.setdefault(tree, {})[node.id] = node
    return [trees[tree] for tree in sorted(trees)]


def leaf_votes(model: Model, trees: Sequence[Mapping[int, Row]], depth: int) -> list[np.ndarray]:
    """``votes[tree][leaf, class]`` of the model's trees, cut at ``depth``."""
    if isinstance(model, GBTClassificationModel):
        sums = [
            np.array([node.prediction * weight for node in cut_tree(nodes, depth)])
            for nodes, weight in zip(trees, model.treeWeights)
        ]
        return [np.stack([-one, one], axis=1) for one in sums]
    counts = [np.array([node.impurityStats for node in cut_tree(nodes, depth)]) for nodes in trees]
    return [one / np.maximum(one.sum(axis=1, keepdims=True), np.finfo(float).tiny) for one in counts]


class CellModel(Model):
    """A cell's predictions by the leaves that a larger cell's trees lead to."""

    def __init__(self, grown: Model, votes: list[np.ndarray], prediction: str):
        super().__init__()
        self.grown, self.votes, self.prediction = grown, votes, prediction

    def _transform(self, dataset: DataFrame) -> DataFrame:
        votes = self.votes

        @F.pandas_udf("double")
        def likeliest(leaves: pd.Series) -> pd.Series:
            at = np.stack(leaves.to_list()).astype(np.int64) if len(leaves) else np.zeros((0, len(votes)), np.int64)
            total = np.zeros((len(at), votes[0].shape[1]))
            for tree, by_leaf in enumerate(votes):
                total += by_leaf[at[:, tree]]
            return pd.Series(total.argmax(axis=1).astype(float))

        single = isinstance(self.grown, DecisionTreeClassificationModel)
        leaves = F.array(LEAF) if single else vector_to_array(F.col(LEAF))
        return self.grown.transform(dataset).withColumn(self.prediction, likeliest(leaves)).drop(LEAF)


class Cells:
    """The models of a grid's cells, as ``fitMultiple`` gives them. Cells of different kinds come first, so that
    threads asking at once fit different models."""

    def __init__(self, estimator: Estimator, df: DataFrame, cells: Sequence[Mapping], sizes: Sequence[str]):
        self.estimator, self.df, self.cells = estimator, df, cells
        self.sizes = [estimator.getParam(name) for name in sizes]
        self.grown: dict[tuple, tuple[Model, list]] = {}
        kinds = [self.kind(cell) for cell in cells]
        self.turn = iter(sorted(range(len(cells)), key=lambda index: kinds[:index].count(kinds[index])))
        self.lock = threading.Lock()
        self.fitting = {kind: threading.Lock() for kind in kinds}

    def __iter__(self) -> Iterator[tuple[int, Model]]:
        return self

    def kind(self, cell: Mapping) -> tuple:
        """What a cell has besides its sizes; equal ones share a fit."""
        return tuple(sorted((param.name, value) for param, value in cell.items() if param not in self.sizes))

    def size(self, cell: Mapping, name: str) -> int:
        param = self.estimator.getParam(name)
        return cell.get(param, self.estimator.getOrDefault(param))

    def grow(self, kind: tuple) -> tuple[Model, list]:
        alike = [cell for cell in self.cells if self.kind(cell) == kind]
        largest = {param: max(self.size(cell, param.name) for cell in alike) for param in self.sizes}
        model = self.estimator.fit(self.df, {**alike[0], **largest})
        trees = tree_nodes(model, self.df)
        # Only the leaves are asked for.
        return model.setLeafCol(LEAF).setPredictionCol("").setRawPredictionCol("").setProbabilityCol(""), trees

    def __next__(self) -> tuple[int, Model]:
        with self.lock:
            index = next(self.turn)
        cell = self.cells[index]
        kind = self.kind(cell)
        with self.fitting[kind]:
            if kind not in self.grown:
                self.grown[kind] = self.grow(kind)
            model, trees = self.grown[kind]
        count = next((self.size(cell, param.name) for param in self.sizes if param.name != "maxDepth"), len(trees))
        votes = leaf_votes(model, trees[:count], self.size(cell, "maxDepth"))
        return index, CellModel(model, votes, self.estimator.getPredictionCol())


class NestedTree(DecisionTreeClassifier):
    def fitMultiple(self, dataset: DataFrame, paramMaps: Sequence[Mapping]) -> Cells:
        return Cells(self, dataset, paramMaps, ["maxDepth"])


class NestedForest(RandomForestClassifier):
    def fitMultiple(self, dataset: DataFrame, paramMaps: Sequence[Mapping]) -> Cells:
        return Cells(self, dataset, paramMaps, ["numTrees", "maxDepth"])


class SharedColumns:
    """The columns of one frame, made by the first fit that asks and dropped behind the last."""

    def __init__(self, df: DataFrame):
        self.df, self.dealt, self.lock = df, None, threading.Lock()

    def of(self, df: DataFrame, *key) -> Dealt:
        if df is not self.df:
            return Dealt(df, *key)
        with self.lock:
            if self.dealt is None or self.dealt.key != key:
                self.dealt = Dealt(df, *key)
            return self.dealt

    def close(self) -> None:
        if self.dealt is not None:
            self.dealt.close()


class BoostedCells(Cells):
    def grow(self, kind: tuple) -> tuple[Model, list]:
        grown = super().grow(kind)
        if len(self.grown) + 1 == len(self.fitting):
            self.estimator.columns.close()
        return grown


class NestedBoosting(GBTClassifier):
    """Boosted trees, fitted on columns; weighted, sampled or categorical rows go to Spark's own fit."""

    columns: SharedColumns | None = None

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        if not fits(self, dataset):
            return super()._fit(dataset)
        shared = self.columns is not None and self.columns.df is dataset
        key = self.getLabelCol(), self.getFeaturesCol(), self.getMaxBins()
        dealt = self.columns.of(dataset, *key) if shared else Dealt(dataset, *key)
        try:
            # Labels that are no classes are Spark's to refuse.
            return self._copyValues(boost(self, dealt)) if dealt.usable() else super()._fit(dataset)
        finally:
            if not shared:
                dealt.close()

    def fitMultiple(self, dataset: DataFrame, paramMaps: Sequence[Mapping]) -> Cells:
        estimator = self.copy()
        estimator.columns = SharedColumns(dataset)
        return BoostedCells(estimator, dataset, paramMaps, ["maxIter"])
