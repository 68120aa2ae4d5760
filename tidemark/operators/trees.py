"""Scores of tree ensembles, walked in the JVM.

An ensemble is a list of trees, each a few arrays: the feature and threshold of each inner node, its children, and the
values of the leaves. A child below zero is leaf -child - 1, as in the text files that LightGBM writes. A row walks
all trees by one expression on arrays: no Python worker, no join, no copy of the rows. The ensemble is one literal of the
model's size.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Tree:
    """A row goes left where its feature is at most the threshold. A tree of one leaf has no inner node."""

    feature: list[int]
    threshold: list[float]
    left: list[int]
    right: list[int]
    leaf: list[float]

    def depth(self) -> int:
        """Inner nodes on the longest path, walked without recursion."""
        deepest, todo = 0, [(0, 1)] if self.feature else []
        while todo:
            node, at = todo.pop()
            deepest = max(deepest, at)
            todo += [(child, at + 1) for child in (self.left[node], self.right[node]) if child >= 0]
        return deepest


@dataclass(frozen=True)
class Ensemble:
    features: list[str]
    trees: list[Tree]
    weights: list[float] = field(default_factory=list)
    base: float = 0.0
    center: list[float] = field(default_factory=list)
    scale: list[float] = field(default_factory=list)


def read_text(model: str, features: list[str], scaler: list[tuple[float, float]] | None = None) -> Ensemble:
    """A regression model in LightGBM's text format. scaler: (center, scale) of each feature, as trained with.

    Only numerical splits are read; inputs have no missing values, so defaults for these play no part, but zeros that count
    as missing do and are refused.
    """
    trees, known = [], {}
    for block in model.replace("\r\n", "\n").split("\n\n"):
        entries = dict(line.split("=", 1) for line in block.strip().splitlines() if "=" in line)
        if "max_feature_idx" in entries:
            known = entries
        if "Tree" not in entries:
            continue
        numbers = lambda key, kind, e=entries: [kind(x) for x in e.get(key, "").split()]
        kinds = numbers("decision_type", int)
        if any(kind & 1 for kind in kinds):
            raise ValueError("categorical splits are not read")
        if any(kind >> 2 & 3 == 1 for kind in kinds):
            raise ValueError("zeros that count as missing are not read")
        trees.append(Tree(numbers("split_feature", int), numbers("threshold", float), numbers("left_child", int), numbers("right_child", int), numbers("leaf_value", float)))
    if not known or int(known["max_feature_idx"]) + 1 != len(features):
        raise ValueError(f"the model expects {int(known.get('max_feature_idx', -1)) + 1} features, not {len(features)}")
    if scaler is not None and len(scaler) != len(features):
        raise ValueError("a scale for each feature is needed")
    scaler = scaler or [(0.0, 1.0)] * len(features)
    return Ensemble(features, trees, [1.0] * len(trees), 0.0, [c for c, _ in scaler], [s for _, s in scaler])


def of_fitted(model, features: list[str]) -> Ensemble:
    """The ensemble of a fitted pyspark.ml regression tree model (decision tree, forest or boosted trees)."""
    from pyspark.ml.regression import DecisionTreeRegressionModel, RandomForestRegressionModel

    if isinstance(model, DecisionTreeRegressionModel):
        fitted, weights = [model], [1.0]
    else:
        fitted, weights = model.trees, list(model.treeWeights)
    if isinstance(model, RandomForestRegressionModel):
        weights = [1.0 / len(fitted)] * len(fitted)
    trees = []
    for one in fitted:
        tree, todo = Tree([], [], [], [], []), [(one._call_java("rootNode"), None, None)]
        while todo:
            node, parent, side = todo.pop()
            inner = node.getClass().getSimpleName() == "InternalNode"
            number = len(tree.feature) if inner else -len(tree.leaf) - 1
            if inner:
                tree.feature.append(node.split().featureIndex())
                tree.threshold.append(node.split().threshold())
                tree.left.append(0)
                tree.right.append(0)
                todo += [(node.leftChild(), number, tree.left), (node.rightChild(), number, tree.right)]
            else:
                tree.leaf.append(node.prediction())
            if side is not None:
                side[parent] = number
        trees.append(tree)
    return Ensemble(features, trees, weights)


def _inputs(own: Ensemble) -> Column:
    """The features as they were trained on: nulls, NaN and infinities count as 0 before scaling, a scale of 0 as 1."""
    out = []
    for i, name in enumerate(own.features):
        x = F.col(name).cast("double")
        x = F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), 0.0).otherwise(x)
        if own.center:
            x = (x - own.center[i]) / (own.scale[i] or 1.0)
        out.append(x)
    return F.array(*out)


def score(rows: DataFrame, own: Ensemble, name: str = "score") -> DataFrame:
    """rows with the sum of the ensemble's trees. Each feature must be a column."""
    lacking = [f for f in own.features if f not in rows.columns]
    if lacking:
        raise ValueError(f"rows have no {', '.join(lacking)}")
    weights = own.weights or [1.0] * len(own.trees)
    written = json.dumps([
        {"w": w, "d": t.depth(), "nodes": [{"f": f, "t": c, "a": a, "b": b} for f, c, a, b in zip(t.feature, t.threshold, t.left, t.right, strict=True)], "leaf": t.leaf} for t, w in zip(own.trees, weights, strict=True)
    ])
    # One constant, folded before the query runs, however many trees there are.
    ensemble = F.from_json(F.lit(written), "array<struct<w:double,d:int,nodes:array<struct<f:int,t:double,a:int,b:int>>,leaf:array<double>>>")

    def leaf(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            node = F.get(tree["nodes"], at)
            return F.when(at < 0, at).when(F.get("__x", node["f"]) <= node["t"], node["a"]).otherwise(node["b"])

        end = F.aggregate(F.sequence(F.lit(1), F.greatest(tree["d"], F.lit(1))), F.when(tree["d"] == 0, -1).otherwise(0), step)
        return F.get(tree["leaf"], -end - 1)

    total = F.aggregate(ensemble, F.lit(own.base), lambda s, tree: s + tree["w"] * leaf(tree))
    return rows.withColumn("__x", _inputs(own)).withColumn(name, total).drop("__x")
