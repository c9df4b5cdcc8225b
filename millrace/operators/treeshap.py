"""Shapley contributions of forest models, from the saved node table.

For one leaf, the value of a feature coalition is a product over the features on the
path: 1 or 0 (does the row follow the path) for known features, the share of training
rows that follow it for unknown ones. The Shapley value of such a product game is a
short polynomial sum. A tree is descended once per Arrow batch: each node multiplies the
polynomial of the path above it by its own factor (or replaces the factor of a feature that
is on the path already), vectorised over the rows, so leaves share the work of their paths.

Spark writes the trees as a table of nodes and reads it again as arrays; no node is asked
for one by one on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import scratch_path

# 40 bytes each, on the driver and in every task.
MAX_NODES = 4_000_000


@dataclass(frozen=True)
class Tree:
    """Arrays by node, the root first. Leaves have left = -1 and a `value`; `share` is the part of
    the parent's training weight that reached the node."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    share: np.ndarray


def saved_trees(fitted, spark, positive: int = 1) -> tuple[list[Tree], float]:
    """The trees of a forest from its node table, and the mean prediction. Forests of more than
    `MAX_NODES` nodes are refused: at unlimited depth nodes grow with the data."""
    path = scratch_path(spark, "forest")
    fitted.write().overwrite().save(path)
    node = F.col("nodeData")
    stats = node["impurityStats"]
    weight = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    table = spark.read.parquet(f"{path}/data").select(
        "treeID", node["id"].alias("id"), weight.alias("weight"), (F.get(stats, F.lit(positive)) / weight).alias("value"),
        node["leftChild"].alias("left"), node["rightChild"].alias("right"), node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("cut"), (node["split"]["numCategories"] >= 0).alias("categories"),
    )
    size = table.agg(F.count("*").alias("n"), F.count_if("categories").alias("categories")).first()
    if size["n"] > MAX_NODES:
        raise ValueError(f"the forest has {size['n']} nodes; contributions take up to {MAX_NODES}, train with a smaller depth")
    if size["categories"]:
        raise ValueError("contributions take numeric features only")
    nodes = table.toPandas().sort_values(["treeID", "id"])
    trees, base = [], 0.0
    for _, own in nodes.groupby("treeID"):
        ids, weight = own["id"].to_numpy(), own["weight"].to_numpy()
        left, right = (np.where(own[c] >= 0, np.searchsorted(ids, own[c]), -1) for c in ("left", "right"))
        share = np.ones(len(ids))
        inner = np.flatnonzero(left >= 0)
        for child in (left, right):
            share[child[inner]] = weight[child[inner]] / weight[inner]
        value = own["value"].to_numpy()
        trees.append(Tree(own["feature"].to_numpy(), own["cut"].to_numpy(), left, right, value, share))
        leaves = left < 0
        base += float((value[leaves] * weight[leaves]).sum() / weight[0])
    return trees, base / len(trees)


def _times(poly: list[np.ndarray], unknown: float, known: np.ndarray) -> list[np.ndarray]:
    """The polynomial times (unknown + known t), per row."""
    zero = np.zeros_like(known)
    return [(p * unknown) + (q * known) for p, q in zip([*poly, zero], [zero, *poly])]


def _without(poly: list[np.ndarray], unknown: float, known: np.ndarray) -> list[np.ndarray]:
    """The polynomial divided by (unknown + known t); known is 0 or 1, unknown over 0."""
    quotient: list[np.ndarray] = []
    for p in reversed(poly[1:]):  # known is 1: from the highest power down
        quotient.insert(0, p - unknown * quotient[0] if quotient else p)
    return [np.where(known > 0, q, p / unknown) for q, p in zip(quotient, poly)]


def _descend(x: np.ndarray, tree: Tree, phi: np.ndarray) -> None:
    """Add the contributions of one tree: depth first, holding one path at a time."""
    todo: list[tuple[int, dict, list[np.ndarray]]] = [(0, {}, [np.ones(len(x))])]
    while todo:
        node, path, poly = todo.pop()
        if tree.left[node] < 0:
            d, value = len(path), tree.value[node]
            weights = [factorial(k) * factorial(d - 1 - k) / factorial(d) for k in range(d)]
            for f, (unknown, known) in path.items():
                others = _without(poly, unknown, known)
                phi[:, f] += value * (known - unknown) * sum(w * p for w, p in zip(weights, others))
            continue
        f = int(tree.feature[node])
        unknown, known = path.get(f, (1.0, None))
        above = poly if known is None else _without(poly, unknown, known)
        low = (x[:, f] <= tree.cut[node]).astype(float)
        for child, goes in ((int(tree.left[node]), low), (int(tree.right[node]), 1.0 - low)):
            own = (unknown * tree.share[child], goes if known is None else goes * known)
            todo.append((child, {**path, f: own}, _times(above, *own)))


def contributions(x: np.ndarray, trees: Sequence[Tree]) -> np.ndarray:
    """Contribution of every feature to the positive probability of every row of `x`."""
    phi = np.zeros_like(x)
    for tree in trees:
        _descend(x, tree, phi)
    return phi / len(trees)


def explain_forest(
    model, df: DataFrame, names: Sequence[str], key: str = "id", features: str = "features", positive: int = 1
) -> DataFrame:
    """Rows (key, base_value, contributions) in the form the explanation operators read."""
    fitted = model.stages[-1] if isinstance(model, PipelineModel) else model
    trees, base = saved_trees(fitted, df.sparkSession, positive)
    shared = df.sparkSession.sparkContext.broadcast(trees)

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = np.stack(batch[features].to_numpy()).astype(float)
                yield pd.DataFrame({key: batch[key], "shap_values": list(contributions(x, shared.value)), features: batch[features]})

    key_type = df.schema[key].dataType.simpleString()
    rows = df.select(key, features).mapInPandas(explain, f"{key} {key_type}, shap_values array<double>, {features} array<double>")
    named = F.transform(
        F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("feature"), F.col(features).alias("value"), F.col("shap_values").alias("shap_value")),
        lambda c: F.struct(c["feature"].alias("feature"), c["value"].alias("value"), c["shap_value"].alias("shap_value")),
    )
    return rows.select(key, F.lit(base).alias("base_value"), named.alias("contributions"))
