"""Tree attribution against Shapley values by enumeration."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from screenwell.learning.attribution import exported, tree_attribution


def outcome(nodes, node, x, known, classes):
    """Expected output of a tree when only the ``known`` features are looked at."""
    if node.leftChild < 0:
        stats = np.asarray(node.impurityStats, float)
        return stats / stats.sum() if classes else np.array([node.prediction])
    left, right = nodes[node.leftChild], nodes[node.rightChild]
    f, held, n = node.split["featureIndex"], list(node.split["leftCategoriesOrThreshold"]), node.split["numCategories"]
    if f in known:
        return outcome(nodes, left if (x[f] <= held[0] if n < 0 else x[f] in held) else right, x, known, classes)
    return sum(outcome(nodes, c, x, known, classes) * c.rawCount for c in (left, right)) / node.rawCount


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_parts_equal_enumeration(spark, kind):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 6, (300, 3)).astype(float)
    y = ((x[:, 0] > 2).astype(int) + (x[:, 1] * x[:, 2] > 8) + (rng.random(300) < 0.1)).clip(0, 2)
    y = y if kind == "forest" else (y > 0).astype(int)
    raw = spark.createDataFrame([(i, *map(float, r), float(c)) for i, (r, c) in enumerate(zip(x, y, strict=True))], "id long, a double, b double, c double, y double")
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(raw).cache()
    fit = RandomForestClassifier(labelCol="y", numTrees=4, maxDepth=4, seed=3) if kind == "forest" else GBTClassifier(labelCol="y", maxIter=3, maxDepth=3)
    model = fit.fit(df)
    got = {r.id: r for r in tree_attribution(model, df.filter("id < 40"), "id").collect()}
    table = exported(model, df)
    trees = [{r.id: r for r in own.itertuples()} for _, own in table.groupby("treeID")]
    weights = [1 / len(trees)] * len(trees) if kind == "forest" else model.treeWeights
    for i in range(40):
        value = {s: sum(w * outcome(t, t[0], x[i], s, kind == "forest") for t, w in zip(trees, weights, strict=True))
                 for k in range(4) for s in combinations(range(3), k)}
        for f in range(3):
            want = sum(factorial(len(s)) * factorial(2 - len(s)) / 6 * (value[tuple(sorted((*s, f)))] - value[s]) for s in value if f not in s)
            assert np.allclose(got[i].attribution[f], want, atol=1e-12)
        assert np.allclose(np.sum(got[i].attribution, axis=0) + got[i].expected, value[0, 1, 2], atol=1e-12)
    out = model.transform(df.filter("id < 40")).select("id", "probability" if kind == "forest" else "rawPrediction").collect()
    for r in out:
        said = np.sum(got[r.id].attribution, axis=0) + got[r.id].expected
        assert np.allclose(said, r[1].toArray() if kind == "forest" else [r[1][1]], atol=1e-9)
    assert tree_attribution(model, df.filter(F.lit(False)), "id").count() == 0
