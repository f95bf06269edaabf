"""Exact attribution of tree ensembles: path-dependent Shapley values of every row."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenwell.session import own_folder


@dataclass
class Leaf:
    """A leaf: the features on its path with the condition of each, what a row's pattern of met
    conditions gives to each of them (per unit of the leaf's value), the value and its share."""

    features: list[int]
    conditions: list[tuple]
    parts: np.ndarray
    value: np.ndarray
    share: float


def exported(model: Model, df: DataFrame) -> pd.DataFrame:
    """The nodes of a fitted ensemble, which are its parameters: at most trees x 2^(depth + 1) rows."""
    spark = df.sparkSession
    path = f"{own_folder(spark)}/trees-{uuid.uuid4().hex}"
    model.write().save(path)
    return spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").toPandas()


def shapley_parts(shares: np.ndarray) -> np.ndarray:
    """For a leaf whose features' conditions hold with ``shares`` of the training rows: entry
    (pattern, i) is the Shapley value of feature i where bit j of the pattern says that j's
    condition is met.

    The game of a leaf is a product over its features, so a value is a sum over the coefficients of
    the product of (share + met t) over the other features.
    """
    k = len(shares)
    met = (np.arange(1 << k)[:, None] >> np.arange(k)) & 1
    weight = np.array([factorial(s) * factorial(k - 1 - s) / factorial(k) for s in range(k)])
    out = np.zeros((1 << k, k))
    for i in range(k):
        poly = np.zeros((1 << k, k))
        poly[:, 0] = 1.0
        for j in range(k):
            if j != i:
                grown = poly * shares[j]
                grown[:, 1:] += poly[:, :-1] * met[:, j:j + 1]
                poly = grown
        out[:, i] = (met[:, i] - shares[i]) * (poly @ weight)
    return out


def leaves_of(nodes: pd.DataFrame, weights: list[float], classes: bool) -> Iterator[Leaf]:
    """All leaves of an ensemble; values are class shares or predictions times the tree's weight.

    A condition is ("between", low, high) for low < x <= high, or ("among", values). A feature that
    is split again on the path keeps one condition, the product of its shares with it.
    """
    for tree, own in nodes.groupby("treeID"):
        by_id = {r.id: r for r in own.itertuples()}
        waiting = [(by_id[0], {})]
        while waiting:
            node, path = waiting.pop()
            if node.leftChild < 0:
                stats = np.asarray(node.impurityStats, float)
                value = stats / stats.sum() if classes else np.array([node.prediction])
                shares = np.array([p[1] for p in path.values()])
                yield Leaf(list(path), [p[0] for p in path.values()], shapley_parts(shares) if path else np.zeros((1, 0)),
                           value * weights[tree], float(np.prod(shares)))
                continue
            split = node.split
            f, held, n_values = split["featureIndex"], list(split["leftCategoriesOrThreshold"]), split["numCategories"]
            old, share = path.get(f, (None, 1.0))
            for side, child in ((0, by_id[node.leftChild]), (1, by_id[node.rightChild])):
                if n_values < 0:
                    _, low, high = old or ("between", -np.inf, np.inf)
                    now = ("between", low, min(high, held[0])) if side == 0 else ("between", max(low, held[0]), high)
                else:
                    among = set(old[1]) if old else set(range(n_values))
                    now = ("among", sorted(among & {int(v) for v in held} if side == 0 else among - {int(v) for v in held}))
                waiting.append((child, path | {f: (now, share * child.rawCount / node.rawCount)}))


def attributed(x: np.ndarray, leaves: list[Leaf], width: int) -> np.ndarray:
    """(rows, features, outputs): the parts of every row's prediction."""
    out = np.zeros((len(x), width, len(leaves[0].value)))
    for leaf in leaves:
        pattern = np.zeros(len(x), np.int64)
        for j, (f, (kind, *limits)) in enumerate(zip(leaf.features, leaf.conditions, strict=True)):
            met = (x[:, f] > limits[0]) & (x[:, f] <= limits[1]) if kind == "between" else np.isin(x[:, f], limits[0])
            pattern |= met.astype(np.int64) << j
        for i, f in enumerate(leaf.features):
            out[:, f] += leaf.parts[pattern, i][:, None] * leaf.value
    return out


def tree_attribution(model: Model, df: DataFrame, key: str, features: str = "features") -> DataFrame:
    """(key, attribution, expected) for every row: ``attribution[f][c]`` is feature f's part of output
    c, ``expected[c]`` the mean output over the training rows' paths; parts and mean sum to the output.

    Outputs are the class shares of a classification forest, or the margin of boosted trees. The
    work is exact, path-dependent tree attribution; a leaf with k different features on its path has
    2^k patterns, worked out once, and a row looks its pattern up.
    """
    classes = model.numClasses if hasattr(model, "numClasses") and not hasattr(model, "getMaxIter") else None
    nodes = exported(model, df)
    n = int(nodes["treeID"].max()) + 1
    weights = [1.0 / n] * n if classes else list(model.treeWeights)
    leaves = list(leaves_of(nodes, weights, bool(classes)))
    expected = [float(v) for v in sum(leaf.value * leaf.share for leaf in leaves)]

    def run(batches):
        for batch in batches:
            if len(batch):
                x = np.vstack(batch["x"].to_list())
                parts = attributed(x, leaves, x.shape[1])
                yield pd.DataFrame({key: batch[key], "attribution": [list(p) for p in parts], "expected": [expected] * len(batch)})

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, vector_to_array(F.col(features)).alias("x")).mapInPandas(
        run, f"{key} {kind}, attribution array<array<double>>, expected array<double>")
