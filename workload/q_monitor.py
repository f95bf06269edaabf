"""Audit log, drift, request limits and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenwell import fixed_values as V
from screenwell.operators import audit, drift, limits
from screenwell.operators.triage import score_record
from screenwell.sources import audit_log as log_files
from screenwell.sources.files import write_csv
from screenwell.streaming import audit as streams
from screenwell.streaming.rate_limit import admit_stream
from screenwell.streaming.run import drain, drain_updates
from workload import adapters as A
from workload.q_records import VERDICT
from workload.registry import query

SHARES = ", ".join(f"round(n_{v} / nullif(n_records, 0)::DOUBLE, 6) AS share_{v}"
                   for v in V.VERDICTS)
COUNTS = ", ".join(f"count(*) FILTER (safety_verdict = '{v}') AS n_{v}" for v in V.VERDICTS)


def rounded_shares(df):
    return df.withColumns({f"share_{v}": F.round(f"share_{v}", 6) for v in V.VERDICTS})


# --- audit -------------------------------------------------------------------------------------

@query("a07_verdict_summary", f"""WITH {A.LOG}, s AS (
  SELECT count(*) AS n_records, {COUNTS},
    count(*) FILTER (deterministic_escalation) AS n_deterministic FROM log)
SELECT *, {SHARES} FROM s""")
def _(spark, sf):
    return rounded_shares(audit.verdict_summary(A.audit_log(spark, sf)))


@query("p08_verdict_filter", f"""WITH {A.LOG}
SELECT log_id, phq9_total FROM log WHERE safety_verdict = 'escalate'""")
def _(spark, sf):
    return audit.of_verdict(A.audit_log(spark, sf), "escalate").select("log_id", "phq9_total")


@query("a26_rule_agreement", f"""WITH {A.LOG}
SELECT deterministic_escalation, safety_verdict, count(*) AS n FROM log GROUP BY 1, 2""")
def _(spark, sf):
    return audit.rule_agreement(A.audit_log(spark, sf))


@query("l07_last_records", f"""WITH {A.LOG}
SELECT log_id, "timestamp", safety_verdict FROM log
ORDER BY "timestamp" DESC, log_id DESC LIMIT 500""")
def _(spark, sf):
    return audit.last_records(A.audit_log(spark, sf), 500).select("log_id", "timestamp",
                                                                  "safety_verdict")


@query("s15_log_lines", f"""WITH {A.LOG}
SELECT log_id, printf('  %s  PHQ-9=%2d  GAD-7=%2d  band=%-18s  verdict=%s%s',
  replace(substr("timestamp", 1, 19), 'T', ' '), phq9_total, gad7_total, phq9_band,
  upper(safety_verdict), CASE WHEN deterministic_escalation THEN '  ← ESCALATED' ELSE '' END)
  AS line FROM log""")
def _(spark, sf):
    return audit.log_lines(A.audit_log(spark, sf)).select("log_id", "line")


@query("s15_review_rows", f"""WITH {A.LOG}
SELECT log_id, replace(substr("timestamp", 1, 19), 'T', ' ') AS time, phq9_total, gad7_total,
  phq9_band, safety_verdict, printf('%.3f', suicidal_ideation_prob) AS si_prob,
  CASE WHEN deterministic_escalation THEN 'YES' ELSE 'no' END AS deterministic
FROM log WHERE safety_verdict IN ('escalate', 'monitor')""")
def _(spark, sf):
    return audit.review_rows(A.audit_log(spark, sf))


LOGGED = f"""WITH {A.LOG}
SELECT log_id, "timestamp", model_version, {', '.join(V.ALL_ITEMS[:3])}, age, gender, phq9_total,
  phq9_band, severity_score, suicidal_ideation_prob, safety_verdict, deterministic_escalation
FROM log"""
LOGGED_COLUMNS = ["log_id", "timestamp", "model_version", *V.ALL_ITEMS[:3], "age", "gender",
                  "phq9_total", "phq9_band", "severity_score", "suicidal_ideation_prob",
                  "safety_verdict", "deterministic_escalation"]


def written_log(spark, sf) -> str:
    """The log appended as JSON lines in two steps."""
    path = A.fresh_folder(spark, "log")
    log = A.audit_log(spark, sf)
    even = F.col("record_id") % 2 == 0
    log_files.append_log(log.filter(even), path)
    log_files.append_log(log.filter(~even), path)
    return path


@query("s08_s09_p12_log_round_trip", LOGGED)
def _(spark, sf):
    return log_files.read_log(spark, written_log(spark, sf)).select(*LOGGED_COLUMNS)


@query("s11_csv_export", f"""WITH {A.LOG}
SELECT log_id, phq9_total, phq9_band, safety_verdict FROM log WHERE safety_verdict = 'monitor'""")
def _(spark, sf):
    path = A.fresh_folder(spark, "export")
    kept = log_files.log_records(audit.of_verdict(A.audit_log(spark, sf), "monitor"))
    write_csv(kept, path)
    back = spark.read.schema(kept.schema).option("header", True).csv(path)
    return back.select("log_id", "phq9_total", "phq9_band", "safety_verdict")


@query("f12_json_lines", f"""WITH {A.LOG}
SELECT log_id, phq9_total::VARCHAR AS phq9_total, safety_verdict FROM log""")
def _(spark, sf):
    lines = log_files.json_line(log_files.log_records(A.audit_log(spark, sf)))
    return lines.select(*[F.get_json_object("line", f"$.{c}").alias(c) for c in (
        "log_id", "phq9_total", "safety_verdict")])


# --- drift -------------------------------------------------------------------------------------
CUT = "2024-01-15"


def halves(spark, sf):
    df = A.scored(spark, sf)
    early = F.col("ts") < F.lit(CUT).cast("timestamp")
    return df.filter(early), df.filter(~early)


def long_sql(columns: list[str], kind: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c}::{kind} AS value, ts < '{CUT}' AS ref FROM sco"
        for c in columns)


def shares_sql(name: str, columns: list[str], kind: str) -> str:
    return f"""{name}_c AS (
  SELECT "column", value, count(*) FILTER (ref) AS r, count(*) FILTER (NOT ref) AS c
  FROM ({long_sql(columns, kind)}) GROUP BY 1, 2), {name}_p AS (
  SELECT *, sum(r) OVER w AS tr, sum(c) OVER w AS tc,
    r::DOUBLE / sum(r) OVER w AS p, c::DOUBLE / sum(c) OVER w AS q
  FROM {name}_c WINDOW w AS (PARTITION BY "column"))"""


NUM = shares_sql("num", V.DRIFT_NUMERIC, "DOUBLE")
CAT = shares_sql("cat", V.DRIFT_CATEGORICAL, "VARCHAR")
JS = """{name}_js AS (
  SELECT "column", any_value(tr)::BIGINT AS rows_ref, any_value(tc)::BIGINT AS rows_cur,
    count(*) FILTER (r > 0) AS values_ref, count(*) AS values_all,
    sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
      + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS js,
    sum(CASE WHEN r > 0 THEN (c - r * tc / tr) ** 2 / (r * tc / tr) END) AS chi,
    count(*) FILTER (r = 0 AND c > 0) AS unseen FROM {name}_p GROUP BY 1)"""
CURVE = """cdf AS (
  SELECT *, sum(p) OVER w AS fr, sum(q) OVER w AS fc, lead(value) OVER w AS nx,
    sum(value * p) OVER (PARTITION BY "column") AS mean FROM num_p
  WINDOW w AS (PARTITION BY "column" ORDER BY value)), crv AS (
  SELECT "column", sum(abs(fr - fc) * coalesce(nx - value, 0))
      / greatest(sqrt(sum(p * (value - mean) ** 2)), 0.001) AS wd, max(abs(fr - fc)) AS ks
  FROM cdf GROUP BY 1)"""
DRIFT = f"""{A.SCO}, {NUM}, {CAT}, {JS.format(name='num')}, {JS.format(name='cat')}, {CURVE}, al AS (
  SELECT *, true AS numeric FROM num_js LEFT JOIN crv USING ("column") UNION ALL
  SELECT *, NULL, NULL, false FROM cat_js)"""
LARGE = f"""{DRIFT}, sco2 AS (
  SELECT "column", CASE WHEN numeric AND values_ref > 5 THEN 'wasserstein' ELSE 'jensen_shannon'
    END AS test, CASE WHEN numeric AND values_ref > 5 THEN wd ELSE js END AS score,
    rows_ref, rows_cur FROM al)"""


@query("a22_w06_drift_large", f"""WITH {LARGE}
SELECT "column", test, round(score, 6) AS score, score >= 0.1 AS drifted, rows_ref, rows_cur
FROM sco2""")
def _(spark, sf):
    out = drift.drift_table(*halves(spark, sf), large=0)
    return out.withColumn("score", F.round("score", 6))


# Upper tail of the chi-square distribution as a Poisson-like series.
GAMMA = """list_sum(list_transform(range(0, 4000), lambda n: exp((k / 2.0 + n) * ln(chi / 2.0)
  - chi / 2.0 - lgamma(k / 2.0 + n + 1))))"""
SMALL = f"""{DRIFT}, kk AS (SELECT *, greatest(values_all - 1, 1) AS k,
    ks * ks * rows_ref * rows_cur / (rows_ref + rows_cur)::DOUBLE AS l2 FROM al), sco3 AS (
  SELECT "column", CASE WHEN numeric AND values_ref > 5 THEN 'ks' ELSE 'chi_square' END AS test,
    CASE WHEN numeric AND values_ref > 5 THEN CASE WHEN l2 < 0.04 THEN 1.0 ELSE least(1, greatest(0,
      2 * list_sum(list_transform(range(1, 101), lambda i: CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END
        * exp(-2.0 * i * i * l2))))) END
    WHEN unseen > 0 THEN 0.0 WHEN chi <= 0 THEN 1.0
    ELSE greatest(0, least(1, 1 - {GAMMA})) END AS score, rows_ref, rows_cur FROM kk)"""


@query("a23_drift_small", f"""WITH {SMALL}
SELECT "column", test, round(score, 6) AS score, score < 0.05 AS drifted, rows_ref, rows_cur
FROM sco3""")
def _(spark, sf):
    """The tests meant for small references, on the whole table."""
    out = drift.drift_table(*halves(spark, sf), large=1 << 60)
    return out.withColumn("score", F.round("score", 6))


@query("a24_p10_dataset_drift", f"""WITH {LARGE}
SELECT count(*) AS n_columns, count(*) FILTER (score >= 0.1) AS n_drifted,
  round(avg((score >= 0.1)::INT), 6) AS drift_share, avg((score >= 0.1)::INT) >= 0.5
  AS dataset_drift FROM sco2 WHERE "column" NOT IN ('age', 'gender')""")
def _(spark, sf):
    """The current side lacks two columns; only shared ones are compared."""
    ref, cur = halves(spark, sf)
    out = drift.dataset_drift(drift.drift_table(ref, cur.drop("age", "gender"), large=0))
    return out.withColumn("drift_share", F.round("drift_share", 6))


@query("j07_aligned_distributions", f"""SELECT event_type AS value,
  count(*) FILTER (ts < '{CUT}') AS n_ref, count(*) FILTER (ts >= '{CUT}') AS n_cur
FROM events GROUP BY 1""")
def _(spark, sf):
    return drift.value_counts_by_join(*halves(spark, sf), "event_type")


@query("w06_continuous_curves", f"""WITH c AS (
  SELECT 'value' AS "column", value, count(*) FILTER (ts < '{CUT}') AS r,
    count(*) FILTER (ts >= '{CUT}') AS c FROM events GROUP BY ALL), num_p AS (
  SELECT *, r::DOUBLE / sum(r) OVER () AS p, c::DOUBLE / sum(c) OVER () AS q FROM c), {CURVE}
SELECT "column", round(wd, 6) AS wasserstein, round(ks, 6) AS ks FROM crv""")
def _(spark, sf):
    events = A.table(spark, sf, "events")
    early = F.col("ts") < F.lit(CUT).cast("timestamp")
    counts, _ = drift.value_counts(events.filter(early), events.filter(~early), ["value"], [])
    return drift.curve_distances(counts).select(
        "column", F.round("wasserstein", 6).alias("wasserstein"), F.round("ks", 6).alias("ks"))


# --- request limits ----------------------------------------------------------------------------
WINDOW, LIMIT = 86400, 2


def requests(spark, sf):
    return A.table(spark, sf, "events").select("event_id", "user_id",
                                               F.col("ts").cast("timestamp").alias("ts"))


@query("w04_trailing_requests", f"""SELECT event_id, user_id, recent, recent >= {LIMIT}
  AS over_limit FROM (SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id
    ORDER BY epoch_us(ts) RANGE BETWEEN {WINDOW * 1_000_000 - 1} PRECEDING AND CURRENT ROW) - 1
    AS recent FROM events)""")
def _(spark, sf):
    out = limits.trailing_requests(requests(spark, sf), "user_id", "ts", LIMIT, WINDOW)
    return out.drop("ts")


ADMIT = f"""WITH RECURSIVE ev AS (
  SELECT user_id, event_id, epoch_us(ts) AS tm,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events), st AS (
  SELECT user_id, event_id, rn, [tm] AS recent, true AS admitted FROM ev WHERE rn = 1 UNION ALL
  SELECT user_id, event_id, rn, CASE WHEN len(kept) < {LIMIT} THEN list_append(kept, tm)
    ELSE kept END, len(kept) < {LIMIT}
  FROM (SELECT e.*, list_filter(s.recent, lambda x: e.tm - x < {WINDOW * 1_000_000}) AS kept
    FROM st s JOIN ev e ON e.user_id = s.user_id AND e.rn = s.rn + 1))
SELECT event_id, user_id, admitted FROM st"""


@query("st3_admitted_requests", ADMIT)
def _(spark, sf):
    out = limits.admitted_requests(requests(spark, sf), "user_id", "ts", "event_id", LIMIT, WINDOW)
    return out.drop("ts")


# --- streams -----------------------------------------------------------------------------------

def event_stream(spark, sf):
    schema = A.table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


@query("st3_admit_stream", ADMIT)
def _(spark, sf):
    rows = event_stream(spark, sf).select("event_id", "user_id",
                                          F.col("ts").cast("timestamp").alias("ts"))
    return drain(admit_stream(rows, "user_id", "ts", "event_id", LIMIT, WINDOW)).drop("ts")


@query("st1_log_stream", LOGGED)
def _(spark, sf):
    out = A.fresh_folder(spark, "log-stream")
    query_ = streams.append_stream(streams.stream_log(spark, written_log(spark, sf)),
                                   f"{out}/log", f"{out}/state")
    query_.awaitTermination()
    return log_files.read_log(spark, f"{out}/log").select(*LOGGED_COLUMNS)


@query("st2_verdicts_per_week", f"""WITH {A.LOG}, w AS (
  SELECT time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS b, * FROM log), s AS (
  SELECT strftime(b, '%Y-%m-%d') AS period_start, count(*) AS n_records, {COUNTS},
    count(*) FILTER (deterministic_escalation) AS n_deterministic FROM w GROUP BY 1)
SELECT *, {SHARES} FROM s""")
def _(spark, sf):
    log = A.add_log_columns(score_record(A.add_record_columns(event_stream(spark, sf))))
    table = drain(streams.verdicts_per_period(log, "ts"), "complete")
    return rounded_shares(table).drop("period_end").withColumn(
        "period_start", F.date_format("period_start", "yyyy-MM-dd"))


@query("st2_sliding_periods", f"""WITH {A.LOG}, w AS (
  SELECT time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') - INTERVAL (g) DAY AS b, log.*
  FROM log, range(7) AS r(g)), s AS (
  SELECT strftime(b, '%Y-%m-%d') AS period_start, count(*) AS n_records, {COUNTS} FROM w
  GROUP BY 1) SELECT * FROM s""")
def _(spark, sf):
    table = streams.verdicts_per_period(A.audit_log(spark, sf), "ts", slide="1 day")
    return table.select(F.date_format("period_start", "yyyy-MM-dd").alias("period_start"),
                        "n_records", *[f"n_{v}" for v in V.VERDICTS])


@query("st2_sliding_periods_stream", f"""WITH {A.LOG}, w AS (
  SELECT time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') - INTERVAL (g) DAY AS b, log.*
  FROM log, range(7) AS r(g)), s AS (
  SELECT strftime(b, '%Y-%m-%d') AS period_start, count(*) AS n_records, {COUNTS} FROM w
  GROUP BY 1) SELECT * FROM s""")
def _(spark, sf):
    """The same periods from a stream in update mode."""
    log = A.add_log_columns(score_record(A.add_record_columns(event_stream(spark, sf))))
    table = drain_updates(streams.verdicts_per_period(log, "ts", slide="1 day"), ["period_start", "period_end"])
    return table.select(F.date_format("period_start", "yyyy-MM-dd").alias("period_start"),
                        "n_records", *[f"n_{v}" for v in V.VERDICTS])


@query("st4_triage_stream", f"""WITH {VERDICT}
SELECT record_id, phq9_band, safety_verdict FROM ver""")
def _(spark, sf):
    judged = streams.triage_stream(A.add_record_columns(event_stream(spark, sf)))
    return drain(judged.select("record_id", "phq9_band", "safety_verdict"))


@query("st5_without_replays", """SELECT event_id AS record_id, event_type FROM events""")
def _(spark, sf):
    """Every event arrives twice."""
    rows = event_stream(spark, sf).select(
        F.col("event_id").alias("record_id"), "event_type",
        F.col("ts").cast("timestamp").alias("event_time"))
    return drain(streams.without_replays(rows.unionByName(rows), "record_id")).drop("event_time")
