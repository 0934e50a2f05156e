"""Gradient-boosted trees from their text form, scored in Arrow batches.

Features are 32-bit floats compared to 64-bit thresholds; leaves are summed in
tree order. Missing values take the node's default side; a node of missing type
1 also counts zero as missing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

FIELDS = {"split_feature": np.int64, "threshold": np.float64, "decision_type": np.int64, "left_child": np.int64, "right_child": np.int64, "leaf_value": np.float64}


@dataclass
class Tree:
    split_feature: np.ndarray
    threshold: np.ndarray
    decision_type: np.ndarray
    left_child: np.ndarray
    right_child: np.ndarray
    leaf_value: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf values of the rows of x (float32), all rows a level at a time."""
        node = np.zeros(len(x), dtype=np.int64)
        if not len(self.split_feature):
            return np.full(len(x), self.leaf_value[0])
        while (open_ := np.flatnonzero(node >= 0)).size:
            at = node[open_]
            value = x[open_, self.split_feature[at]]
            kind = self.decision_type[at]
            missing = np.isnan(value) | ((kind >> 2 == 1) & (value == 0))
            left = np.where(missing, kind & 2 != 0, value.astype(np.float64) <= self.threshold[at])
            node[open_] = np.where(left, self.left_child[at], self.right_child[at])
        return self.leaf_value[-node - 1]


@dataclass
class Model:
    trees: list[Tree]
    n_features: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for t in self.trees:
            total += t.leaves(x)
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(np.asarray(x, dtype=np.float32))))


def parse_model(text: str, n_features: int = 27, n_trees: int | None = 400) -> Model:
    """The model of a text dump. n_trees: what it must hold; None for any number."""
    trees = []
    for block in text.split("\nTree=")[1:]:
        lines = dict(line.split("=", 1) for line in block.splitlines() if "=" in line)
        if "split_feature" not in lines:
            break
        missing = [k for k in FIELDS if k not in lines]
        if missing:
            raise ValueError(f"tree {len(trees)}: no field {missing[0]}")
        tree = Tree(**{k: np.array(lines[k].split(), dtype=kind) for k, kind in FIELDS.items()})
        n = len(tree.split_feature)
        if any(len(getattr(tree, k)) != n for k in list(FIELDS)[1:5]) or len(tree.leaf_value) != n + 1:
            raise ValueError(f"tree {len(trees)}: arrays of unequal length")
        if n and tree.split_feature.max() >= n_features:
            raise ValueError(f"tree {len(trees)}: a feature beyond {n_features}")
        trees.append(tree)
    if n_trees is not None and len(trees) != n_trees:
        raise ValueError(f"expected {n_trees} trees, found {len(trees)}")
    return Model(trees, n_features)


def load_model(spark: SparkSession, path: str, **kinds) -> Model:
    """From any store that Spark reads."""
    return parse_model(spark.read.text(path, wholetext=True).first()[0], **kinds)


def score_col(features: Column, model: Model) -> Column:
    """features: array<float>. The model is a few hundred small arrays, sent with the task."""

    def f(s: pd.Series) -> pd.Series:
        if not len(s):
            return pd.Series([], dtype="float64")
        return pd.Series(model.score(np.array([[np.nan if v is None else v for v in row] for row in s], dtype=np.float32)))

    return F.pandas_udf(f, "double")(features)
