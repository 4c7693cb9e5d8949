"""Tree ensembles as expressions: nodes in one array, walked inside a fold.

A fitted ensemble becomes an array of nodes, the roots of its trees and their weights.  All three are constants of the
plan, so scoring, and a recursion that feeds predictions back, is one JVM expression per row: no ``transform``, no
join, no shuffle and no checkpoint between steps.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from demandloom.session import scratch_path

_NODES = "array<struct<feature:int,cut:double,left:int,right:int,value:double>>"


@dataclass(frozen=True)
class Node:
    """A split (``feature`` at most ``cut`` goes left) or, with a negative feature, a leaf."""

    feature: int
    cut: float
    left: int
    right: int
    value: float


@dataclass(frozen=True)
class Forest:
    """``base`` plus the weighted sum of the trees; ``roots`` are places in ``nodes``."""

    features: tuple[str, ...]
    nodes: tuple[Node, ...]
    roots: tuple[int, ...]
    weights: tuple[float, ...]
    base: float = 0.0

    @property
    def depth(self) -> int:
        """Splits on the longest path."""
        level, deepest = list(self.roots), 0
        while level := [c for n in level if self.nodes[n].feature >= 0
                        for c in (self.nodes[n].left, self.nodes[n].right)]:
            deepest += 1
        return deepest

    def predict(self, values: Mapping[str, Column]) -> Column:
        """The prediction for features given as columns; a null or NaN feature goes right, as NaN does in Spark's trees."""
        nodes = F.from_json(F.lit(json.dumps([vars(n) for n in self.nodes])), _NODES)
        trees = F.from_json(F.lit(json.dumps([{"root": r, "weight": w} for r, w in zip(self.roots, self.weights)])),
                            "array<struct<root:int,weight:double>>")
        row = F.array(*[F.coalesce(values[f].cast("double"), F.lit(float("nan"))) for f in self.features])
        levels = F.sequence(F.lit(1), F.lit(max(1, self.depth)))

        def leaf(x: Column, root: Column) -> Column:
            def step(at: Column, _: Column) -> Column:
                node = F.get(nodes, at)
                return F.when(node["feature"] < 0, at).when(
                    F.get(x, node["feature"]) <= node["cut"], node["left"]).otherwise(node["right"])

            return F.aggregate(levels, root, step)

        def total(x: Column) -> Column:
            return F.aggregate(trees, F.lit(float(self.base)), lambda sum_, tree: sum_ + tree["weight"] * F.get(
                nodes, leaf(x, tree["root"]))["value"])

        # The features are worked out once, as the only element of an array.
        return F.get(F.transform(F.array(row), total), F.lit(0))


def from_model(model: PipelineModel, features: Sequence[str]) -> Forest:
    """The trees of a fitted ensemble (boosted or forest) on continuous features.

    They are read from the ensemble's stored form, one row per node; their number is set by the model's settings,
    whatever data it was fitted on.
    """
    spark = SparkSession.active()
    ensemble = model.stages[-1]
    path = scratch_path(spark, "trees")
    ensemble.save(path)
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    first, nodes, roots = {}, [], []
    for r in rows:
        if r["treeID"] not in first:
            first[r["treeID"]] = len(nodes)
            roots.append(len(nodes))
        at, leaf = first[r["treeID"]], r["leftChild"] < 0
        if not leaf and r["split"]["numCategories"] >= 0:
            raise ValueError("trees with categorical splits have no expression")
        nodes.append(Node(-1, 0.0, -1, -1, r["prediction"]) if leaf else Node(
            r["split"]["featureIndex"], r["split"]["leftCategoriesOrThreshold"][0], at + r["leftChild"],
            at + r["rightChild"], r["prediction"]))
    boosted = type(ensemble).__name__.startswith("GBT")
    weights = ensemble.treeWeights if boosted else [1 / len(roots)] * len(roots)
    return Forest(tuple(features), tuple(nodes), tuple(roots), tuple(map(float, weights)))
