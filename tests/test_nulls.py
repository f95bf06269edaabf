"""Rows, groups and columns without a value, and the ridge penalty in closed form."""

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from screenwell.learning.severity import ordinal_ridge
from screenwell.operators.care_plan import parse_suggestions
from screenwell.operators.drift import drift_table
from screenwell.operators.cohort import first_copy
from screenwell.operators.evaluation import recall_check
from screenwell.operators.limits import admitted_requests, trailing_requests
from screenwell.operators.running import mid_ranks
from screenwell.operators.safety import parse_verifier
from screenwell.functions.numeric import chi_square_tail
from screenwell.retrieval.hybrid import merge_hits
from screenwell.session import fits


def test_ridge_equals_the_closed_form(spark):
    r = np.random.default_rng(1)
    x, y = r.normal(size=(30, 2)), r.integers(0, 5, 30).astype(float)
    rows = [(float(a), float(b), float(c)) for (a, b), c in zip(x, y, strict=True)]
    df = spark.createDataFrame(rows, "a double, b double, y_ordinal double").withColumn(
        "features", array_to_vector(F.array("a", "b")))
    got = ordinal_ridge(df, alpha=10.0).coefficients.toArray()
    c = x - x.mean(axis=0)
    assert np.allclose(got, np.linalg.solve(c.T @ c + 10 * np.eye(2), c.T @ (y - y.mean())), atol=1e-6)


def test_a_reply_with_odd_flags_still_escalates(spark):
    df = spark.createDataFrame([('{"flags": "one", "verdict_recommendation": "escalate"}',),
                                ('{"flags": ["a"], "verdict_recommendation": "monitor"}',)], "r string")
    got = [r.v for r in df.select(parse_verifier(F.col("r")).alias("v")).collect()]
    assert [(v.flags, v.recommendation) for v in got] == [([], "escalate"), (["a"], "monitor")]


def test_requests_without_a_time_stay(spark):
    df = spark.sql("SELECT 1 AS k, timestamp'2024-01-01 00:00:00' AS t UNION ALL SELECT 1, NULL")
    got = {r.t is None: (r.recent, r.over_limit) for r in trailing_requests(df, "k", "t").collect()}
    assert got == {False: (0, False), True: (None, None)}


def test_null_groups_have_ranks(spark):
    df = spark.createDataFrame([("g", 1.0), (None, 2.0), (None, 5.0)], "g string, s double")
    assert sorted((str(r.g), r.s, r.mid_rank) for r in mid_ranks(df, ["g"], "s").collect()) == [
        ("None", 2.0, 1.0), ("None", 5.0, 2.0), ("g", 1.0, 1.0)]


def test_a_column_without_reference_values_does_not_stop_the_table(spark):
    ref = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    cur = spark.createDataFrame([(1.0, 3.0), (2.0, 4.0)], "a double, b double")
    for large in (0, 1 << 60):
        got = {r.column: r.rows_ref for r in drift_table(ref, cur, ["a", "b"], [], large=large).collect()}
        assert got == {"a": 2, "b": 0}


def test_nothing_is_cut_by_default(spark):
    reply = "\n".join(f"Consider: {i}" for i in range(8))
    got = spark.createDataFrame([(reply,)], "r string").select(parse_suggestions(F.col("r")).alias("s")).first()
    assert len(got.s) == 8
    chunks = spark.createDataFrame([(1, "a", "x" * 90), (2, "a", "x" * 85 + "yy")], "chunk_id long, source string, text string")
    hit = "query_id long, source string, chunk_id long, score double, rank int"
    merged = merge_hits(spark.createDataFrame([(0, "a", 2, 1.0, 1)], hit), spark.createDataFrame([(0, "a", 1, 0.9, 1)], hit), chunks)
    assert merged.count() == 2


def test_first_copy_keeps_map_columns(spark):
    df = spark.sql("""SELECT * FROM VALUES ('a', 2, map('x', 1)), ('a', 1, map('y', 2)),
                      ('b', 1, map('z', 3)), ('b', 1, map('k', 0)), ('c', 1, NULL) AS t(k, t, m)""")
    got = {r.k: (r.t, r.m) for r in first_copy(df, ["k"], [F.col("t")]).collect()}
    assert got == {"a": (1, {"y": 2}), "b": (1, {"k": 0}), "c": (1, None)}


def test_requests_without_key_or_time_are_not_judged(spark):
    df = spark.sql("""SELECT id, k, timestamp_seconds(s) AS t FROM VALUES (1, 'a', 0), (2, 'a', 1),
                      (3, 'a', CAST(NULL AS INT)), (4, NULL, 1) AS t(id, k, s)""")
    got = {r.id: r.admitted for r in admitted_requests(df, "k", "t", "id", limit=1).collect()}
    assert got == {1: True, 2: False, 3: None, 4: None}


def test_size_check_counts_bytes(spark):
    df = spark.range(10).select(F.repeat(F.lit("x"), 100).alias("text"), F.array("id").alias("a.b"))
    assert fits(df, 10) and not fits(df, 10, max_bytes=500) and fits(df.limit(0), 0)


def test_chi_square_with_many_degrees_of_freedom(spark):
    rows = spark.createDataFrame([(100000.0, 100000), (200.0, 4), (3.841458820694124, 1), (1e12, 5)],
                                 "x double, k int")
    got = [r.p for r in rows.select(chi_square_tail(F.col("x"), F.col("k")).alias("p")).collect()]
    # the median of many degrees lies 2/3 below their number
    assert abs(got[0] - (0.5 - 2 / 3 / np.sqrt(4e5 * np.pi))) < 1e-5
    assert got[1] < 1e-12 and abs(got[2] - 0.05) < 1e-9 and got[3] == 0


def test_recall_check(spark):
    df = spark.createDataFrame([(0.95,), (0.5,), (None,)], "recall double")
    assert [r.meets_target for r in recall_check(df).collect()] == [True, False, None]
