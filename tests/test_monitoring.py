import random
from collections import deque
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenwell.functions import numeric
from screenwell.operators import drift
from screenwell.operators.audit import last_records, verdict_summary
from screenwell.operators.limits import admitted_requests, trailing_requests
from screenwell.operators.running import running_sums
from screenwell.sources.audit_log import append_log, log_schema, read_log
from screenwell.streaming.audit import stream_log, with_event_time, without_replays
from screenwell.streaming.rate_limit import admit_stream
from screenwell.streaming.audit import verdicts_per_period
from screenwell.streaming.run import drain, drain_updates

START = datetime(2024, 1, 1)


def requests(seed=5, n=900):
    """One key holds most rows; times repeat; some keys pause for long."""
    rng = random.Random(seed)
    rows, now = [], 0.0
    for i in range(n):
        now += rng.choice([0, 0, 0.5, 2, 7, 90 if i % 50 == 0 else 1])
        key = "hot" if rng.random() < 0.7 else f"k{rng.randint(0, 4)}"
        rows.append((i, key, START + timedelta(seconds=now)))
    return rows


def brute_admit(rows, limit, window):
    state, out = {}, {}
    for i, key, at in sorted(rows, key=lambda r: (r[2], r[0])):
        recent = state.setdefault(key, deque())
        while recent and (at - recent[0]).total_seconds() >= window:
            recent.popleft()
        out[i] = len(recent) < limit
        if out[i]:
            recent.append(at)
    return out


SCHEMA = "id long, key string, at timestamp"


@pytest.mark.parametrize("limit,window", [(10, 60), (3, 60), (2, 5)])
def test_admission_equals_brute_force(spark, limit, window):
    rows = requests()
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute_admit(rows, limit, window)
    for parts in (1, 6):
        out = admitted_requests(df.repartition(parts), "key", "at", "id", limit, window)
        assert {r.id: r.admitted for r in out.collect()} == want


def test_trailing_count_equals_brute_force(spark):
    rows = requests()
    out = trailing_requests(spark.createDataFrame(rows, SCHEMA), "key", "at", 10, 60, 120)
    got = {r.id: r.recent for r in out.collect()}
    assert len(got) == len(rows)
    for i, key, at in rows:
        assert got[i] == sum(1 for j, k, t in rows if k == key and j != i and t <= at
                             and (at - t).total_seconds() < 60)


def test_admission_stream_over_micro_batches(spark, tmp_path):
    rows = requests()
    rows = sorted(rows, key=lambda r: (r[2], r[0]))
    for part in range(5):
        chunk = [r for r in rows if r[2] >= rows[part * 180][2]
                 and (part == 4 or r[2] < rows[(part + 1) * 180][2])]
        spark.createDataFrame(chunk, SCHEMA).coalesce(1).write.mode("append").parquet(
            str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(
        str(tmp_path / "in"))
    out = drain(admit_stream(stream, "key", "at", "id", 3, 60))
    assert {r.id: r.admitted for r in out.collect()} == brute_admit(rows, 3, 60)


def test_log_lines(spark, tmp_path):
    path = str(tmp_path / "log")
    append_log(spark.createDataFrame([("a", 5)], "log_id string, age int"), path)
    (tmp_path / "log" / "extra.json").write_text(
        '\n{"log_id": "b", "timestamp": "2024-01-02T00:00:00+00:00"}\n\n'
        '{"log_id": "b", "timestamp": "2024-01-02T00:00:00+00:00"}\n')
    log = read_log(spark, path)
    rows = {r.log_id: r for r in log.collect()}
    assert log.count() == 3 and log.schema == log_schema()
    assert (rows["a"].gender, rows["a"].phq9_total, rows["a"].age) == ("unknown", 0, 5)
    assert rows["b"].phq9_total is None
    assert [r.log_id for r in read_log(spark, path, 1).collect()] == ["a"]
    assert without_replays(log).count() == 2
    stream = without_replays(with_event_time(stream_log(spark, path)))
    assert drain(stream.select("log_id")).count() == 2


def test_summary_of_nothing_has_null_shares(spark):
    empty = spark.createDataFrame([], log_schema())
    row = verdict_summary(empty).first()
    assert row.n_records == 0 and row.share_escalate is None
    assert last_records(empty, 5).count() == 0


@pytest.mark.parametrize("statistic,freedom,want", [
    (3.841459, 1, 0.05), (5.991465, 2, 0.05), (18.307038, 10, 0.05), (0.0, 3, 1.0),
    (37.56623, 20, 0.01), (6.634897, 1, 0.01), (5000.0, 4, 0.0), (124.342113, 100, 0.05)])
def test_chi_square_tail(spark, statistic, freedom, want):
    p = spark.range(1).select(numeric.chi_square_tail(F.lit(statistic), F.lit(freedom))).first()[0]
    assert p == pytest.approx(want, abs=1e-6)


def test_normal_and_kolmogorov_tails(spark):
    row = spark.range(1).select(
        numeric.normal_two_sided(F.lit(1.959964)).alias("z"),
        numeric.kolmogorov_tail(F.lit(1.358099 / np.sqrt(50)), F.lit(100), F.lit(100)).alias("k"),
        numeric.kolmogorov_tail(F.lit(0.0), F.lit(100), F.lit(100)).alias("zero")).first()
    assert row.z == pytest.approx(0.05, abs=1e-6)
    assert row.k == pytest.approx(0.05, abs=1e-4) and row.zero == 1.0


@pytest.mark.parametrize("slices", [2, 64])
def test_running_sums_do_not_depend_on_slices(spark, slices):
    rng = random.Random(1)
    values = sorted({round(rng.gauss(0, 1) ** 3, 4) for _ in range(500)})
    df = spark.createDataFrame([("g", v, 1 + i % 3) for i, v in enumerate(values)],
                               "g string, v double, n long")
    got = running_sums(df, ["g"], "v", ["n"], slices).orderBy("v").collect()
    before = 0
    for i, row in enumerate(got):
        assert row.before_n == before
        assert row.next_value == (values[i + 1] if i + 1 < len(values) else None)
        before += row.n
    assert got[0].total_n == before


def test_drift_of_shifted_and_equal_columns(spark):
    ref = spark.range(2000).select((F.col("id") % 40).alias("age"), F.lit("a").alias("gender"))
    cur = ref.select((F.col("age") + 20).alias("age"), F.lit("b").alias("gender"))
    table = {r.column: r for r in drift.drift_table(ref, cur).collect()}
    sd = np.std([i % 40 for i in range(2000)])
    assert table["age"].score == pytest.approx(20 / sd) and table["age"].drifted
    assert table["gender"].score == pytest.approx(1.0)
    same = {r.column: r for r in drift.drift_table(ref, ref).collect()}
    assert not any(r.drifted for r in same.values())
    small = {r.column: r for r in drift.drift_table(ref.limit(500), cur.limit(500)).collect()}
    assert small["age"].test == "ks" and small["age"].drifted and small["gender"].test == "z"
    whole = drift.dataset_drift(drift.drift_table(ref, cur)).first()
    assert whole.dataset_drift and whole.drift_share == 1.0


def test_running_sums_place_rows_by_range(spark):
    """One group over many tasks; no list of cut points in the plan of a row."""
    df = spark.range(4000).select(F.lit("g").alias("g"), (F.col("id") * 7919 % 4001).alias("v"), F.lit(1).cast("long").alias("n"))
    out = running_sums(df, ["g"], "v", ["n"], 16)
    plan = out._jdf.queryExecution().toString()
    assert "_cuts" not in plan and "filter(" not in plan.lower().replace("filter (", "")
    rows = out.orderBy("v").collect()
    assert [r.before_n for r in rows] == list(range(4000)) and {r.total_n for r in rows} == {4000}


def test_trailing_counts_of_one_key_and_long_lines(spark):
    rng = random.Random(2)
    times = sorted(rng.randrange(3000) for _ in range(800))
    rows = [("hot", t) for t in times] + [(None, 5), (None, 20), ("x", None)]
    df = spark.createDataFrame(rows, "k string, s long").select("k", F.timestamp_seconds("s").alias("t"), "s")
    for slices in (1, 16):
        out = trailing_requests(df, "k", "t", 10, 60, slices)
        for r in out.collect():
            want = None if r.s is None else sum(1 for k, s in rows if k == r.k and s is not None and r.s - 60 < s <= r.s) - 1
            assert (r.recent, r.over_limit) == (want, None if want is None else want >= 10)


def test_periods_in_update_mode_over_triggers(spark, tmp_path):
    """Each trigger changes some periods; the newest row of each is that of a batch run."""
    rows = [(f"{i}", 1_700_000_000 + i * 40_000, "routine") for i in range(60)]
    kind = "log_id string, s long, safety_verdict string"
    for part in range(3):
        spark.createDataFrame(rows[part * 20:part * 20 + 20], kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def periods(df):
        log = df.select("log_id", "safety_verdict", F.timestamp_seconds("s").alias("t"), F.lit(False).alias("deterministic_escalation"))
        return verdicts_per_period(log, "t", "1 week", "1 day")

    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = drain_updates(periods(stream), ["period_start", "period_end"])
    want = periods(spark.createDataFrame(rows, kind))
    assert got.select(want.columns).exceptAll(want).isEmpty() and got.count() == want.count() > 20
    none = spark.readStream.schema(kind).parquet(str(tmp_path / "none" if (tmp_path / "none").mkdir() is None else ""))
    assert drain_updates(periods(none), ["period_start", "period_end"]).count() == 0
