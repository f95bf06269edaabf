"""Evaluation of predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenwell.operators import evaluation as ev
from screenwell.operators import running
from workload import adapters as A
from workload.registry import query

CONF = f"""{A.PRED}, conf AS (
  SELECT y, prediction AS p, count(*) AS n FROM pred GROUP BY 1, 2)"""


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("a08_w03_confusion_shares", f"""WITH {CONF}
SELECT y, p, n, round(n / sum(n) OVER (PARTITION BY y), 6) AS share FROM conf""")
def _(spark, sf):
    return rounded(ev.confusion_shares(ev.confusion(A.predictions(spark, sf))), "share")


REPORT = """rep AS (
  SELECT {by} cls, coalesce(sum(tp) / nullif(sum(pr), 0), 0) AS precision,
    coalesce(sum(tp) / nullif(sum(su), 0), 0) AS recall,
    coalesce(2 * sum(tp) / nullif(sum(su) + sum(pr), 0), 0) AS f1, sum(su) AS support,
    sum(tp) AS tp
  FROM (SELECT {by} y AS cls, n AS su, 0 AS pr, CASE WHEN y = p THEN n ELSE 0 END AS tp FROM {conf}
        UNION ALL SELECT {by} p, 0, n, 0 FROM {conf}) GROUP BY {by} cls)"""


@query("a09_class_report", f"""WITH {CONF}, {REPORT.format(by='', conf='conf')}
SELECT cls, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  support::BIGINT AS support, tp::BIGINT AS tp FROM rep""")
def _(spark, sf):
    return rounded(ev.class_report(ev.confusion(A.predictions(spark, sf))), "precision", "recall",
                   "f1")


@query("a09_report_summary", f"""WITH {CONF}, {REPORT.format(by='', conf='conf')}
SELECT sum(support)::BIGINT AS n, round(sum(tp) / sum(support), 6) AS accuracy,
  {', '.join(f'round(avg({c}), 6) AS macro_{c}' for c in ('precision', 'recall', 'f1'))},
  {', '.join(f'round(sum({c} * support) / sum(support), 6) AS weighted_{c}'
             for c in ('precision', 'recall', 'f1'))} FROM rep""")
def _(spark, sf):
    out = ev.report_summary(ev.class_report(ev.confusion(A.predictions(spark, sf))))
    return rounded(out, *out.columns[1:])


@query("a10_quadratic_kappa", f"""WITH {CONF}, r AS (SELECT y AS i, sum(n) AS r FROM conf GROUP BY 1),
c AS (SELECT p AS j, sum(n) AS c FROM conf GROUP BY 1), t AS (SELECT sum(n) AS t FROM conf)
SELECT (SELECT t FROM t)::BIGINT AS n, (SELECT count(*) FROM r) AS true_classes,
  round(1 - (SELECT sum(n * (y - p) ** 2) FROM conf)
    / (SELECT sum(r * c * (i - j) ** 2) / any_value(t) FROM r, c, t), 6) AS quadratic_kappa""")
def _(spark, sf):
    return rounded(ev.quadratic_kappa(ev.confusion(A.predictions(spark, sf))), "quadratic_kappa")


AUC = f"""{A.PRED}, lng AS (
  SELECT c AS cls, probability[c + 1] AS score, (y = c)::INT AS hit
  FROM pred, range(5) AS r(c)), cnt AS (
  SELECT cls, score, sum(hit) AS pos, sum(1 - hit) AS neg FROM lng GROUP BY 1, 2), cum AS (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY cls ORDER BY score
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM cnt), auc AS (
  SELECT cls, sum(pos) AS n_pos, sum(neg) AS n_neg,
    sum(pos * (before + neg / 2.0::DOUBLE)) / nullif(sum(pos) * sum(neg), 0) AS auc
  FROM cum GROUP BY 1)"""


@query("a11_w05_auc_by_class", f"""WITH {AUC}
SELECT cls, n_pos::BIGINT AS n_pos, n_neg::BIGINT AS n_neg, round(auc, 6) AS auc FROM auc""")
def _(spark, sf):
    return rounded(ev.auc_by_class(A.predictions(spark, sf)), "auc")


@query("a11_macro_auc", f"""WITH {AUC}
SELECT round(CASE WHEN min(n_pos) > 0 THEN avg(auc) END, 6) AS roc_auc_ovr_macro FROM auc""")
def _(spark, sf):
    return rounded(ev.macro_auc(ev.auc_by_class(A.predictions(spark, sf))), "roc_auc_ovr_macro")


BIN = """bin AS (SELECT toxic AS y, (n_chars % 1000) / 1000.0::DOUBLE AS p
  FROM labels JOIN documents USING (doc_id))"""


def binary_scores(spark, sf):
    docs = A.table(spark, sf, "documents").select("doc_id", "n_chars")
    return A.table(spark, sf, "labels").join(docs, "doc_id").select(
        F.col("toxic").alias("y"), ((F.col("n_chars") % 1000) / F.lit(1000.0)).alias("p"))


@query("a11_binary_auc", f"""WITH {BIN}, cnt AS (
  SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM bin GROUP BY 1), cum AS (
  SELECT *, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING
    AND 1 PRECEDING), 0) AS before FROM cnt)
SELECT round(coalesce(sum(pos * (before + neg / 2.0::DOUBLE))
  / nullif(sum(pos) * sum(neg), 0), 0), 6) AS roc_auc FROM cum""")
def _(spark, sf):
    return rounded(ev.binary_auc(binary_scores(spark, sf), "y", "p"), "roc_auc")


@query("a18_binary_metrics", f"""WITH {BIN}, c AS (
  SELECT count(*) AS n, count(*) FILTER (p > 0.4 AND y = 1) AS tp,
    count(*) FILTER (p > 0.4 AND y = 0) AS fp, count(*) FILTER (p <= 0.4 AND y = 1) AS fn FROM bin)
SELECT *, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
  round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM c""")
def _(spark, sf):
    return rounded(ev.binary_metrics(binary_scores(spark, sf), "y", "p"), "recall", "precision",
                   "f1")


@query("a12_ordinal_error", f"""WITH {A.PRED}, e AS (
  SELECT y, prediction + (record_id % 9 - 4) / 8.0::DOUBLE * 3 AS p FROM pred)
SELECT count(*) AS n, round(avg(abs(y - greatest(0, least((SELECT max(y) FROM e),
  round_even(p, 0))))), 6) AS mae FROM e""")
def _(spark, sf):
    df = A.predictions(spark, sf).withColumn(
        "p", F.col("prediction") + (F.col("record_id") % 9 - 4) / F.lit(8.0) * 3)
    return rounded(ev.ordinal_error(df, "y", "p"), "mae")


EDGES = " + ".join(f"(prob > {i * 0.1!r}::DOUBLE)::INT" for i in range(1, 10))


@query("a13_calibration", f"""WITH {A.PRED}, lng AS (
  SELECT c AS cls, probability[c + 1] AS prob, (y = c)::INT AS hit FROM pred, range(5) AS r(c))
SELECT cls, {EDGES} AS bin, count(*) AS n, round(avg(prob), 6) AS mean_predicted,
  round(avg(hit), 6) AS positive_share FROM lng GROUP BY 1, 2""")
def _(spark, sf):
    return rounded(ev.calibration(A.predictions(spark, sf)), "mean_predicted", "positive_share")


SLICED = f"""{A.PRED}, cf AS (
  SELECT 'gender' AS slice_col, gender AS slice_val, y, prediction AS p, count(*) AS n
  FROM pred GROUP BY ALL UNION ALL
  SELECT 'age_band', {A.band_sql('age', [(0, 29, '18-29'), (30, 44, '30-44'), (45, 59, '45-59'),
                                         (60, 200, '60+')])}, y, prediction, count(*)
  FROM pred GROUP BY ALL), {REPORT.format(by='slice_col, slice_val,', conf='cf')}, wf AS (
  SELECT slice_col, slice_val, sum(support)::BIGINT AS n,
    sum(f1 * support) / sum(support) AS weighted_f1 FROM rep GROUP BY 1, 2), cls AS (
  SELECT slice_col, slice_val, c, row_number() OVER (PARTITION BY slice_col, slice_val ORDER BY c)
    AS pos FROM (SELECT slice_col, slice_val, y AS c FROM cf UNION SELECT slice_col, slice_val, p
    FROM cf)), pos AS (
  SELECT cf.slice_col, cf.slice_val, cf.y, cf.n, a.pos AS i, b.pos AS j FROM cf
  JOIN cls a ON (a.slice_col, a.slice_val, a.c) = (cf.slice_col, cf.slice_val, cf.y)
  JOIN cls b ON (b.slice_col, b.slice_val, b.c) = (cf.slice_col, cf.slice_val, cf.p)), kap AS (
  SELECT slice_col, slice_val, CASE WHEN count(DISTINCT y) > 1 THEN 1 - sum(n * (i - j) ** 2)
    / nullif((sum(n) * (sum(n * i * i) + sum(n * j * j)) - 2 * sum(n * i) * sum(n * j))
      / sum(n), 0) END AS k FROM pos GROUP BY 1, 2)"""


@query("a14_fairness_slices", f"""WITH {SLICED}
SELECT slice_col, slice_val, n, round(weighted_f1, 6) AS weighted_f1,
  round(k, 6) AS quadratic_kappa FROM wf JOIN kap USING (slice_col, slice_val) WHERE n >= 10""")
def _(spark, sf):
    return rounded(ev.fairness_slices(A.predictions(spark, sf), min_rows=10), "weighted_f1", "quadratic_kappa")


@query("a15_s12_fairness_disparity", f"""WITH {SLICED}
SELECT slice_col, round(max(weighted_f1) - min(weighted_f1), 4) AS f1_disparity
FROM wf WHERE n >= 10 GROUP BY 1""")
def _(spark, sf):
    """The slice table goes through its CSV export."""
    from screenwell.sources.files import write_csv

    path = A.fresh_folder(spark, "fairness")
    slices = ev.fairness_slices(A.predictions(spark, sf), min_rows=10)
    write_csv(slices, path)
    back = spark.read.schema(slices.schema).option("header", True).csv(path)
    return ev.fairness_disparity(back)


@query("a14_fairness_all_slices", f"""WITH {SLICED}
SELECT slice_col, slice_val, n, round(weighted_f1, 6) AS weighted_f1,
  round(k, 6) AS quadratic_kappa FROM wf JOIN kap USING (slice_col, slice_val)""")
def _(spark, sf):
    return rounded(ev.fairness_slices(A.predictions(spark, sf)), "weighted_f1", "quadratic_kappa")


@query("a15_fairness_disparity_all_slices", f"""WITH {SLICED}
SELECT slice_col, round(max(weighted_f1) - min(weighted_f1), 4) AS f1_disparity
FROM wf GROUP BY 1""")
def _(spark, sf):
    """The slice table goes through its CSV export."""
    from screenwell.sources.files import write_csv

    path = A.fresh_folder(spark, "fairness")
    slices = ev.fairness_slices(A.predictions(spark, sf))
    write_csv(slices, path)
    back = spark.read.schema(slices.schema).option("header", True).csv(path)
    return ev.fairness_disparity(back)


@query("a16_positive_weight", """SELECT count(*) AS n, sum(toxic)::BIGINT AS n_pos,
  round(CASE WHEN sum(toxic) > 0 THEN least(20, 2 * (count(*) - sum(toxic)) / sum(toxic))
    ELSE 1 END, 6) AS positive_weight FROM labels""")
def _(spark, sf):
    return rounded(ev.positive_weight(A.table(spark, sf, "labels"), "toxic"), "positive_weight")


NAMES = ["red", "green", "blue", "white"]
BITS = f"""{A.PRED}, bits AS (SELECT
  {', '.join(f'(y + {i}) % {i + 2} AS t{i}, (prediction + {i}) % {i + 2} AS p{i}'
             for i in range(4))} FROM pred), cn AS (
  {' UNION ALL '.join(f'''SELECT '{n}' AS label, count(*) FILTER (t{i} = 1 AND p{i} = 1) AS tp,
    count(*) FILTER (t{i} <> 1 AND p{i} = 1) AS fp, count(*) FILTER (t{i} = 1 AND p{i} <> 1) AS fn
    FROM bits''' for i, n in enumerate(NAMES))}), f AS (
  SELECT *, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
    coalesce(tp / nullif(tp + fn, 0), 0) AS recall FROM cn)"""


@query("a17_multilabel_metrics", f"""WITH {BITS}
SELECT label, tp, fp, fn, round(f1, 6) AS f1, round(recall, 6) AS recall FROM f UNION ALL
SELECT 'micro', sum(tp)::BIGINT, sum(fp)::BIGINT, sum(fn)::BIGINT,
  round(2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)), 6),
  round(sum(tp) / (sum(tp) + sum(fn)), 6) FROM f UNION ALL
SELECT 'macro', sum(tp)::BIGINT, sum(fp)::BIGINT, sum(fn)::BIGINT, round(avg(f1), 6),
  round(avg(recall), 6) FROM f""")
def _(spark, sf):
    bits = lambda c: F.array(*[(F.col(c) + i) % (i + 2) for i in range(4)])
    df = A.predictions(spark, sf).select(bits("y").alias("labels"),
                                         bits("prediction").alias("predicted"))
    return rounded(ev.multilabel_metrics(df, NAMES), "f1", "recall")


@query("w05_mid_ranks", """SELECT l_returnflag, l_extendedprice, n,
  before + (n + 1) / 2.0::DOUBLE AS mid_rank FROM (
  SELECT *, coalesce(sum(n) OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM (SELECT l_returnflag, l_extendedprice, count(*) AS n FROM lineitem GROUP BY 1, 2))""")
def _(spark, sf):
    return running.mid_ranks(A.table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice")
