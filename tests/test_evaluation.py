import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenwell.operators import evaluation as ev
from screenwell.operators.features import apply_scaler, fit_scaler, one_hot


def table(spark, n=400, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = rng.choice([0, 0, 1, 2])
        p = y if rng.random() < 0.7 else rng.choice([0, 1, 2])
        w = [rng.randint(1, 6) + (6 if c == p else 0) for c in range(3)]
        rows.append((i, y, p, [x / sum(w) for x in w], rng.choice(["female", "male"]),
                     rng.randint(18, 80)))
    return rows, spark.createDataFrame(
        rows, "id long, y int, prediction int, probability array<double>, gender string, age int")


def kappa(y, p):
    classes = sorted(set(y) | set(p))
    at = {c: i for i, c in enumerate(classes)}
    k = len(classes)
    seen = np.zeros((k, k))
    for a, b in zip(y, p, strict=True):
        seen[at[a], at[b]] += 1
    w = (np.arange(k)[:, None] - np.arange(k)[None, :]) ** 2
    want = np.outer(seen.sum(1), seen.sum(0)) / len(y)
    return 1 - (w * seen).sum() / (w * want).sum()


def test_kappa_uses_class_positions(spark):
    rows, df = table(spark)
    got = ev.quadratic_kappa(ev.confusion(df)).first().quadratic_kappa
    assert got == pytest.approx(kappa([r[1] for r in rows], [r[2] for r in rows]))
    gap = df.withColumns({"y": F.col("y") * 5, "prediction": F.col("prediction") * 5})
    assert ev.quadratic_kappa(ev.confusion(gap)).first().quadratic_kappa == pytest.approx(got)


def test_auc_equals_pair_counting(spark):
    rows, df = table(spark)
    got = {r.cls: r.auc for r in ev.auc_by_class(df).collect()}
    for c in range(3):
        pos = [r[3][c] for r in rows if r[1] == c]
        neg = [r[3][c] for r in rows if r[1] != c]
        wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
        assert got[c] == pytest.approx(wins / len(pos) / len(neg))


def test_auc_with_a_missing_class_is_null(spark):
    _, df = table(spark)
    per_class = ev.auc_by_class(df.filter("y < 2"))
    assert ev.macro_auc(per_class).first()[0] is None
    one = df.filter("y = 0").withColumn("s", F.col("probability")[0])
    assert ev.binary_auc(one, "y", "s").first().roc_auc == 0.0


def test_calibration_edges_belong_to_the_bin_below(spark):
    df = spark.createDataFrame([(0, [0.1]), (0, [0.10001]), (0, [0.0]), (0, [1.0])],
                               "y int, probability array<double>")
    assert {r.bin: r.n for r in ev.calibration(df).collect()} == {0: 2, 1: 1, 9: 1}


def test_small_and_one_class_slices(spark):
    rows = ([(0, 0, "nine", 20)] * 9 + [(0, 0, "ten", 35)] * 9 + [(0, 1, "ten", 35)]
            + [(1, 1, "mixed", 70)] * 6 + [(0, 1, "mixed", 70)] * 6)
    df = spark.createDataFrame(rows, "y int, prediction int, gender string, age int")
    got = {(r.slice_col, r.slice_val): r for r in ev.fairness_slices(df, min_rows=10).collect()}
    assert ("gender", "nine") not in got and got["gender", "ten"].n == 10
    assert got["gender", "ten"].quadratic_kappa is None
    assert got["gender", "mixed"].quadratic_kappa is not None
    listed = ev.fairness_slices(df, min_rows=10, values={"gender": ["ten"], "age_band": ["60+"]})
    assert listed.count() == 2


def test_class_weight(spark):
    df = lambda labels: spark.createDataFrame([(x,) for x in labels], "si_label int")
    weight = lambda labels: ev.positive_weight(df(labels)).first().positive_weight
    assert weight([0, 0, 0]) == 1.0
    assert weight([1, 0, 0, 0]) == 6.0
    assert weight([1] + [0] * 99) == 20.0


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    out = apply_scaler(df, fit_scaler(df, ["a", "b"]), ["a", "b"]).orderBy("a").collect()
    assert [tuple(r) for r in out] == [(-1.0, 0.0), (1.0, 0.0)]
    hot = one_hot(spark.createDataFrame([("x",), (None,), ("z",)], "c string"), "c", ["x", "y"])
    assert [tuple(r)[1:] for r in hot.collect()] == [(1, 0), (0, 0), (0, 0)]
