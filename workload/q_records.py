"""Scoring, triage, validation, features and lookups on screening records."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenwell import fixed_values as V
from screenwell.functions import hashing, numeric, text
from screenwell.functions.bands import age_band, band_score
from screenwell.operators import care_plan, cohort, features, lookup, safety, summary, triage, validate
from screenwell.plans.triage_plan import add_literature, triage as triage_records
from workload import adapters as A
from workload.registry import query

TEXT = A.text_sql


def joined(arr: str) -> F.Column:
    return F.array_join(arr, " | ").alias(arr)


# --- totals, bands, summaries ------------------------------------------------------------------

@query("t01_t02_totals_and_bands", f"""WITH {A.SCO}
SELECT record_id, phq9_total, gad7_total, phq9_band, gad7_band, severity_score FROM sco""")
def _(spark, sf):
    return A.scored(spark, sf).select("record_id", "phq9_total", "gad7_total", "phq9_band",
                                      "gad7_band", "severity_score")


@query("a01_l01_band_distribution", f"""WITH {A.SCO}
SELECT phq9_band, count(*) AS n FROM sco GROUP BY 1""")
def _(spark, sf):
    return summary.band_distribution(A.scored(spark, sf))


@query("a02_ideation_by_band", f"""WITH {A.SCO}
SELECT phq9_band, round(avg((phq9_suicidal_ideation > 0)::INT), 6) AS si_rate, count(*) AS n
FROM sco GROUP BY 1""")
def _(spark, sf):
    return summary.ideation_by_band(A.scored(spark, sf)).withColumn("si_rate",
                                                                    F.round("si_rate", 6))


@query("a03_split_sizes", f"WITH {A.REC} SELECT split, count(*) AS n FROM rec GROUP BY 1")
def _(spark, sf):
    return summary.split_sizes(A.records(spark, sf))


@query("a04_split_and_label", f"""WITH {A.SCO}
SELECT split, phq9_band AS label, count(*) AS n FROM sco GROUP BY ROLLUP (split, phq9_band)
HAVING split IS NOT NULL""")
def _(spark, sf):
    labelled = A.scored(spark, sf).withColumnRenamed("phq9_band", "label")
    return summary.split_and_label_totals(labelled)


@query("a04_label_by_split", f"""WITH {A.SCO}
SELECT split, phq9_band AS label, count(*) AS n FROM sco GROUP BY 1, 2""")
def _(spark, sf):
    return summary.label_by_split(A.scored(spark, sf).withColumnRenamed("phq9_band", "label"))


@query("a04_segment_status_rollup", """
SELECT c_mktsegment AS split, o_orderstatus AS label, count(*) AS n
FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ROLLUP (c_mktsegment, o_orderstatus)
HAVING c_mktsegment IS NOT NULL""")
def _(spark, sf):
    both = A.table(spark, sf, "orders").join(
        A.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return summary.split_and_label_totals(both.select(
        F.col("c_mktsegment").alias("split"), F.col("o_orderstatus").alias("label")))


@query("a05_ideation_flag", f"""WITH {A.REC}
SELECT count(*) AS n, count(*) FILTER (phq9_suicidal_ideation > 0) AS n_flagged,
  round(avg((phq9_suicidal_ideation > 0)::INT), 6) AS flag_rate FROM rec""")
def _(spark, sf):
    return summary.ideation_flag(A.records(spark, sf)).withColumn("flag_rate",
                                                                  F.round("flag_rate", 6))


@query("a21_population_checks", f"""WITH {A.SCO}
SELECT round(corr(phq9_total, gad7_total), 6) AS total_correlation,
  round(avg((phq9_total >= 10)::INT), 6) AS prevalence_10,
  round(avg((phq9_suicidal_ideation > 0)::INT) FILTER (phq9_band = 'none'), 6) AS si_rate_none,
  round(avg((phq9_suicidal_ideation > 0)::INT) FILTER (phq9_band = 'severe'), 6)
    AS si_rate_severe FROM sco""")
def _(spark, sf):
    out = summary.population_checks(A.scored(spark, sf))
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


# --- risk, plan, verdict -----------------------------------------------------------------------

def keyword_sql(expr: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({expr}, {TEXT(w)})" for w in words) + ")"


RISK = f"""{A.SCO}, hit AS (
  SELECT *, phq9_suicidal_ideation > 0
    OR {keyword_sql('lower(narrative)', V.RISK_KEYWORDS)} AS si FROM sco), risk AS (
  SELECT *, si AS suicidal_ideation_positive,
    CASE WHEN si THEN 0.9 ELSE 0.05 END::DOUBLE AS suicidal_ideation_prob FROM hit)"""


@query("t04_risk_by_rule", f"""WITH {RISK}
SELECT record_id, suicidal_ideation_positive, suicidal_ideation_prob, severity_score,
  0 AS n_symptoms FROM risk""")
def _(spark, sf):
    return triage.stratify_risk(A.scored(spark, sf)).select(
        "record_id", "suicidal_ideation_positive", "suicidal_ideation_prob", "severity_score",
        F.size("active_symptoms").alias("n_symptoms"))


def model_scores(spark, sf, every=False):
    """Scores as a text model would give them: for two of three records, as narratives without a
    score take another way, or for ``every`` one."""
    r = F.col("record_id")
    probs = F.array(*[((r * (i + 3)) % 100) / F.lit(100.0) for i in range(7)])
    df = A.records(spark, sf).filter(F.lit(every) | (r % 3 != 0)).select(
        "record_id", probs.alias("symptom_prob"),
        (((r * 17) % 100) / F.lit(100.0)).alias("ideation_prob"))
    return triage.threshold_symptoms(df)


PROBS = "[" + ", ".join(f"((record_id * {i + 3}) % 100) / 100.0::DOUBLE" for i in range(7)) + "]"
MODEL = f"""mod AS (
  SELECT record_id, {PROBS} AS symptom_prob, ((record_id * 17) % 100) / 100.0::DOUBLE AS p
  FROM rec WHERE record_id % 3 <> 0), act AS (
  SELECT *, list_filter({A.list_sql(V.SYMPTOMS)}, lambda x, i: symptom_prob[i] >= 0.5) AS active
  FROM mod)"""


@query("t05_threshold_predictions", f"""WITH {A.REC}, {MODEL}
SELECT record_id, array_to_string(active, ' | ') AS active_symptoms, p >= 0.4 AS ideation_positive,
  symptom_prob[3] AS prob_suicidal_ideation FROM act""")
def _(spark, sf):
    return model_scores(spark, sf).select(
        "record_id", joined("active_symptoms"), "ideation_positive",
        F.col("symptom_probabilities")["suicidal_ideation"].alias("prob_suicidal_ideation"))


@query("t05_threshold_predictions_all", f"""WITH {A.REC}, {MODEL.replace("WHERE record_id % 3 <> 0", "")}
SELECT record_id, array_to_string(active, ' | ') AS active_symptoms, p >= 0.4 AS ideation_positive,
  symptom_prob[3] AS prob_suicidal_ideation FROM act""")
def _(spark, sf):
    return model_scores(spark, sf, every=True).select(
        "record_id", joined("active_symptoms"), "ideation_positive",
        F.col("symptom_probabilities")["suicidal_ideation"].alias("prob_suicidal_ideation"))


FUSED = f"""{RISK}, {MODEL}, fused AS (
  SELECT r.* EXCLUDE (suicidal_ideation_positive, suicidal_ideation_prob, severity_score),
    CASE WHEN p IS NULL THEN si ELSE p >= 0.4 OR phq9_suicidal_ideation > 0 END
      AS suicidal_ideation_positive,
    coalesce(p, suicidal_ideation_prob) AS suicidal_ideation_prob,
    CASE WHEN p IS NULL THEN severity_score ELSE 0.6 * severity_score
      + 0.4 * (p * 0.3 + least(len(active) / 7.0::DOUBLE, 1.0) * 0.2) END AS severity_score,
    coalesce(active, []) AS active
  FROM risk r LEFT JOIN act USING (record_id))"""


@query("t03_j09_risk_fusion", f"""WITH {FUSED}
SELECT record_id, suicidal_ideation_positive, suicidal_ideation_prob,
  round(severity_score, 6) AS severity_score, array_to_string(active, ' | ') AS active_symptoms
FROM fused""")
def _(spark, sf):
    df = triage.join_model_scores(A.scored(spark, sf), model_scores(spark, sf))
    return triage.stratify_risk(df).select(
        "record_id", "suicidal_ideation_positive", "suicidal_ideation_prob",
        F.round("severity_score", 6).alias("severity_score"), joined("active_symptoms"))


PLAN = f"""list_filter([
    CASE WHEN suicidal_ideation_positive THEN {TEXT(V.SUGGEST_SAFETY)} END,
    CASE WHEN phq9_band IN ('moderate', 'moderately_severe', 'severe')
      THEN {TEXT(V.SUGGEST_REFERRAL)} END,
    CASE WHEN gad7_band IN ('moderate', 'severe') THEN {TEXT(V.SUGGEST_ANXIETY)} END,
    CASE WHEN phq9_band IN ('mild', 'moderate') THEN {TEXT(V.SUGGEST_FOLLOW_UP)} END],
    lambda x: x IS NOT NULL)"""


@query("t06_care_plan", f"""WITH {RISK}, pl AS (SELECT record_id, {PLAN} AS s FROM risk)
SELECT record_id, CASE WHEN len(s) = 0 THEN {TEXT(V.SUGGEST_ROUTINE)}
  ELSE array_to_string(s, ' | ') END AS care_plan_suggestions FROM pl""")
def _(spark, sf):
    planned = care_plan.add_care_plan(triage.stratify_risk(A.scored(spark, sf)))
    return planned.select("record_id", joined("care_plan_suggestions"))


RULE_SQL = TEXT("(?i)(?:" + "|".join(p for _, p in V.RISK_RULES) + ")")
FRAME_SQL = TEXT("(?i)(?:" + "|".join(V.REPORTED_SPEECH_FRAMES) + ")")


def sentences_sql(expr: str) -> str:
    return rf"string_split(regexp_replace({expr}, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))"


def signal_sql(expr: str) -> str:
    return (f"len(list_filter({sentences_sql(expr)}, lambda s: regexp_matches(s, {RULE_SQL})"
            f" AND NOT regexp_matches(s, {FRAME_SQL}))) > 0")


@query("t09_sentence_signal", f"""WITH {A.REC}
SELECT record_id, {signal_sql('narrative')} AS signal FROM rec""")
def _(spark, sf):
    return A.records(spark, sf).select("record_id", safety.sentence_signal(
        F.col("narrative")).alias("signal"))


def families_sql(expr: str) -> str:
    parts = []
    for family in dict.fromkeys(f for f, _ in V.RISK_RULES):
        pattern = TEXT("(?i)(?:" + "|".join(p for f, p in V.RISK_RULES if f == family) + ")")
        parts.append(f"CASE WHEN len(list_filter({sentences_sql(expr)}, lambda s: regexp_matches(s,"
                     f" {pattern}) AND NOT regexp_matches(s, {FRAME_SQL}))) > 0"
                     f" THEN '{family}' END")
    return f"list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL)"


@query("t09_matched_families", f"""WITH {A.REC}, fam AS (
  SELECT unnest({families_sql('narrative')}) AS family FROM rec)
SELECT family, count(*) AS n FROM fam GROUP BY 1""")
def _(spark, sf):
    return safety.family_counts(A.records(spark, sf))


RAISED = "phq9_band IN ('moderate', 'moderately_severe', 'severe')"
VERDICT = f"""{RISK}, det AS (
  SELECT *, suicidal_ideation_positive OR phq9_suicidal_ideation > 0
    OR {signal_sql('narrative')} AS deterministic_escalation FROM risk), ver AS (
  SELECT *, CASE WHEN deterministic_escalation THEN 'escalate' WHEN {RAISED} THEN 'monitor'
    ELSE 'routine' END AS safety_verdict FROM det)"""


@query("t10_t11_t13_t14_verdict", f"""WITH {VERDICT}
SELECT record_id, safety_verdict, deterministic_escalation,
  CASE WHEN deterministic_escalation THEN {TEXT(V.ESCALATION_REASON)}
    ELSE 'Safety verdict: ' || upper(safety_verdict) || ' | ' || {TEXT(V.REASON_NO_FLAGS)} END
    AS critic_reasoning FROM ver""")
def _(spark, sf):
    judged = safety.judge(triage.stratify_risk(A.scored(spark, sf)))
    return judged.select("record_id", "safety_verdict", "deterministic_escalation",
                         "critic_reasoning")


# Reply shapes of a verifier, chosen per record: clean JSON, JSON in prose, unknown and missing
# recommendation, broken JSON, no JSON, none.
def verifier_reply(r):
    note = F.concat(F.lit("note "), r.cast("string"))
    full = F.to_json(F.struct(F.array(note).alias("flags"),
                              F.lit("escalate").alias("verdict_recommendation")))
    odd = F.to_json(F.struct(F.array(note, F.lit("b")).alias("flags"),
                             F.lit("urgent").alias("verdict_recommendation")))
    bare = F.to_json(F.struct(F.array(note).alias("flags")))
    return (F.when(r % 7 == 0, full).when(r % 7 == 1, F.concat(F.lit("Here you go: "), full))
            .when(r % 7 == 2, odd).when(r % 7 == 3, bare)
            .when(r % 7 == 4, F.lit('{"flags": [oops}')).when(r % 7 == 5, F.lit("no issues")))


@query("t12_verifier_replies", f"""WITH {VERDICT}, rep AS (
  SELECT *, record_id % 7 AS m, 'note ' || record_id AS note FROM ver), dec AS (
  SELECT *, CASE WHEN deterministic_escalation THEN 'escalate' WHEN m IN (0, 1) THEN 'escalate'
      WHEN m = 2 THEN 'monitor' WHEN {RAISED} THEN 'monitor' ELSE 'routine' END AS v,
    CASE WHEN deterministic_escalation THEN '' WHEN m IN (0, 1, 3) THEN note
      WHEN m = 2 THEN note || '; b' ELSE '' END AS f FROM rep)
SELECT record_id, v AS safety_verdict, f AS flags,
  CASE WHEN deterministic_escalation THEN {TEXT(V.ESCALATION_REASON)}
    WHEN f <> '' THEN 'Safety verdict: ' || upper(v) || ' | LLM verifier flags: ' || f
    ELSE 'Safety verdict: ' || upper(v) || ' | ' || {TEXT(V.REASON_NO_FLAGS)} END
    AS critic_reasoning FROM dec""")
def _(spark, sf):
    df = triage.stratify_risk(A.scored(spark, sf)).withColumn(
        "reply", verifier_reply(F.col("record_id")))
    return safety.judge(df, "reply").select(
        "record_id", "safety_verdict", F.array_join("llm_verifier_flags", "; ").alias("flags"),
        "critic_reasoning")


def plan_reply(r):
    a = F.concat(F.lit("Consider: step "), r.cast("string"))
    listed = F.to_json(F.array(a, F.lit("Maybe: rest"), F.lit("Consider: b")))
    lines = F.concat(F.lit("Plan\n  "), a, F.lit("\nother\nConsider: 2\nConsider: 3\nConsider: 4\n"
                                                 "Consider: 5\nConsider: 6"))
    return (F.when(r % 5 == 0, listed).when(r % 5 == 1, F.concat(F.lit("Sure!\n"), listed))
            .when(r % 5 == 2, lines).when(r % 5 == 3, F.concat(F.lit("[broken, "), a)))


@query("t07_l05_plan_replies", f"""WITH {RISK}, pl AS (
  SELECT *, record_id % 5 AS m, 'Consider: step ' || record_id AS a, {PLAN} AS s FROM risk)
SELECT record_id, CASE WHEN m IN (0, 1) THEN a || ' | Consider: b'
  WHEN m = 2 THEN a || ' | Consider: 2 | Consider: 3 | Consider: 4 | Consider: 5'
  WHEN m = 3 THEN ''
  WHEN len(s) = 0 THEN {TEXT(V.SUGGEST_ROUTINE)} ELSE array_to_string(s, ' | ') END
  AS care_plan_suggestions FROM pl""")
def _(spark, sf):
    df = triage.stratify_risk(A.scored(spark, sf)).withColumn(
        "reply", plan_reply(F.col("record_id")))
    return care_plan.add_care_plan(df, "reply", cap_lines=5).select("record_id", joined("care_plan_suggestions"))


@query("t07_plan_replies_all_lines", f"""WITH {RISK}, pl AS (
  SELECT *, record_id % 5 AS m, 'Consider: step ' || record_id AS a, {PLAN} AS s FROM risk)
SELECT record_id, CASE WHEN m IN (0, 1) THEN a || ' | Consider: b'
  WHEN m = 2 THEN a || ' | Consider: 2 | Consider: 3 | Consider: 4 | Consider: 5 | Consider: 6'
  WHEN m = 3 THEN ''
  WHEN len(s) = 0 THEN {TEXT(V.SUGGEST_ROUTINE)} ELSE array_to_string(s, ' | ') END
  AS care_plan_suggestions FROM pl""")
def _(spark, sf):
    df = triage.stratify_risk(A.scored(spark, sf)).withColumn(
        "reply", plan_reply(F.col("record_id")))
    return care_plan.add_care_plan(df, "reply").select("record_id", joined("care_plan_suggestions"))


@query("t08_context_texts", f"""WITH {RISK}, pl AS (SELECT *, {PLAN} AS s FROM risk), p2 AS (
  SELECT *, CASE WHEN len(s) = 0 THEN [{TEXT(V.SUGGEST_ROUTINE)}] ELSE s END AS t FROM pl)
SELECT record_id,
  'PHQ-9 total: ' || phq9_total || ' (' || phq9_band || ')' || chr(10) || 'GAD-7 total: '
    || gad7_total || ' (' || gad7_band || ')' || chr(10) || 'Suicidal ideation positive: '
    || CASE WHEN suicidal_ideation_positive THEN 'True' ELSE 'False' END || chr(10)
    || 'Active symptoms: ' || chr(10) || 'DSM context: ' || {TEXT(V.NO_INDEX_CONTEXT)} || chr(10)
    || 'Citations: 0 retrieved' || chr(10) AS plan_context,
  'PHQ-9: ' || phq9_total || ' (' || phq9_band || ')' || chr(10) || 'GAD-7: ' || gad7_total
    || ' (' || gad7_band || ')' || chr(10) || 'Active symptoms from NLP: none detected' || chr(10)
    || 'Suicidal ideation (MentalBERT): ' || printf('%.2f', suicidal_ideation_prob) || chr(10)
    || 'Suicidal ideation (PHQ-9 item 9): ' || phq9_suicidal_ideation || chr(10)
    || 'Narrative (first 400 chars): ' || substr(narrative, 1, 400) AS record_summary,
  'DSM differential: not specified' || chr(10) || 'Care plan suggestions:' || chr(10)
    || array_to_string(list_transform(t, lambda x: '  - ' || x), chr(10)) AS plan_summary FROM p2""")
def _(spark, sf):
    df = care_plan.add_care_plan(add_literature(triage.stratify_risk(A.scored(spark, sf))))
    return care_plan.verifier_context(care_plan.plan_context(df, max_chars=800), max_chars=400).select(
        "record_id", "plan_context", "record_summary", "plan_summary")


@query("t08_context_texts_whole", f"""WITH {RISK}, pl AS (SELECT *, {PLAN} AS s FROM risk), p2 AS (
  SELECT *, CASE WHEN len(s) = 0 THEN [{TEXT(V.SUGGEST_ROUTINE)}] ELSE s END AS t FROM pl)
SELECT record_id,
  'PHQ-9 total: ' || phq9_total || ' (' || phq9_band || ')' || chr(10) || 'GAD-7 total: '
    || gad7_total || ' (' || gad7_band || ')' || chr(10) || 'Suicidal ideation positive: '
    || CASE WHEN suicidal_ideation_positive THEN 'True' ELSE 'False' END || chr(10)
    || 'Active symptoms: ' || chr(10) || 'DSM context: ' || {TEXT(V.NO_INDEX_CONTEXT)} || chr(10)
    || 'Citations: 0 retrieved' || chr(10) AS plan_context,
  'PHQ-9: ' || phq9_total || ' (' || phq9_band || ')' || chr(10) || 'GAD-7: ' || gad7_total
    || ' (' || gad7_band || ')' || chr(10) || 'Active symptoms from NLP: none detected' || chr(10)
    || 'Suicidal ideation (MentalBERT): ' || printf('%.2f', suicidal_ideation_prob) || chr(10)
    || 'Suicidal ideation (PHQ-9 item 9): ' || phq9_suicidal_ideation || chr(10)
    || 'Narrative: ' || narrative AS record_summary,
  'DSM differential: not specified' || chr(10) || 'Care plan suggestions:' || chr(10)
    || array_to_string(list_transform(t, lambda x: '  - ' || x), chr(10)) AS plan_summary FROM p2""")
def _(spark, sf):
    df = care_plan.add_care_plan(add_literature(triage.stratify_risk(A.scored(spark, sf))))
    return care_plan.verifier_context(care_plan.plan_context(df)).select(
        "record_id", "plan_context", "record_summary", "plan_summary")


CLASSIFY = """CASE WHEN signal THEN 'escalate' ELSE 'routine' END"""


@query("t15_classify_text", f"""WITH {A.REC}, c AS (
  SELECT record_id, {signal_sql('narrative')} AS signal FROM rec)
SELECT record_id, CASE WHEN signal THEN 'escalate' ELSE 'routine' END AS safety_verdict,
  signal AS deterministic_escalation FROM c""")
def _(spark, sf):
    raw = A.records(spark, sf).select("record_id", F.col("narrative").alias("text"))
    return safety.classify_text(raw).select("record_id", "safety_verdict",
                                            "deterministic_escalation")


@query("t15_classify_conversations", f"""SELECT conv_id, turn,
  CASE WHEN {signal_sql('text')} THEN 'escalate' ELSE 'routine' END AS safety_verdict
  FROM conversations""")
def _(spark, sf):
    return safety.classify_text(A.table(spark, sf, "conversations")).select(
        "conv_id", "turn", "safety_verdict")


@query("t16_triage", f"""WITH {VERDICT}, pl AS (SELECT *, {PLAN} AS s FROM ver)
SELECT record_id, phq9_total, gad7_total, phq9_band, gad7_band, severity_score,
  suicidal_ideation_positive, suicidal_ideation_prob, safety_verdict, deterministic_escalation,
  CASE WHEN len(s) = 0 THEN {TEXT(V.SUGGEST_ROUTINE)} ELSE array_to_string(s, ' | ') END
    AS care_plan_suggestions FROM pl""")
def _(spark, sf):
    return triage_records(A.records(spark, sf)).select(
        "record_id", "phq9_total", "gad7_total", "phq9_band", "gad7_band", "severity_score",
        "suicidal_ideation_positive", "suicidal_ideation_prob", "safety_verdict",
        "deterministic_escalation", joined("care_plan_suggestions"))


@query("t17_response", f"""WITH {FUSED}, det AS (
  SELECT *, suicidal_ideation_positive OR phq9_suicidal_ideation > 0
    OR {signal_sql('narrative')} AS det FROM fused), pl AS (SELECT *, {PLAN} AS s FROM det)
SELECT record_id, phq9_total, gad7_total, phq9_band, gad7_band,
  round(severity_score, 4) AS severity_score,
  round(suicidal_ideation_prob, 4) AS suicidal_ideation_prob,
  array_to_string(active, ' | ') AS active_symptoms, 0 AS n_citations, 0 AS n_differential,
  CASE WHEN len(s) = 0 THEN {TEXT(V.SUGGEST_ROUTINE)} ELSE array_to_string(s, ' | ') END
    AS care_plan_suggestions,
  CASE WHEN det THEN 'escalate' WHEN {RAISED} THEN 'monitor' ELSE 'routine' END AS safety_verdict,
  det AS deterministic_escalation, 0 AS n_flags FROM pl""")
def _(spark, sf):
    out = triage.response(triage_records(A.records(spark, sf), model_scores(spark, sf)))
    return out.select("record_id", *[c for c in triage.RESPONSE_COLUMNS[:6]],
                      joined("active_symptoms"), F.size("citations").alias("n_citations"),
                      F.size("dsm_differential").alias("n_differential"),
                      joined("care_plan_suggestions"), "safety_verdict",
                      "deterministic_escalation", F.size("llm_verifier_flags").alias("n_flags"))


CONTRIB = ", ".join(f"{{'s': round({item} / 3.0::DOUBLE * {w}::DOUBLE, 3), 'n': {TEXT(name)}}}"
                    for item, name, w in V.ITEM_WEIGHTS)


@query("t18_l03_item_contributions", f"""WITH {A.REC}, c AS (
  SELECT record_id, list_reverse(list_sort([{CONTRIB}]))[1:6] AS top FROM rec)
SELECT record_id, array_to_string(list_transform(top, lambda x: x.n), ' | ') AS names,
  list_sum(list_transform(top, lambda x: x.s)) ::DECIMAL(10, 3)::DOUBLE AS total FROM c""")
def _(spark, sf):
    out = triage.item_contributions(A.records(spark, sf), top=6)
    total = F.aggregate("contributions", F.lit(0.0), lambda acc, x: acc + x["score"])
    return out.select("record_id", F.array_join(F.transform(
        "contributions", lambda x: x["name"]), " | ").alias("names"),
        F.round(total, 3).alias("total"))


@query("t18_all_item_contributions", f"""WITH {A.REC}, c AS (
  SELECT record_id, list_reverse(list_sort([{CONTRIB}])) AS top FROM rec)
SELECT record_id, array_to_string(list_transform(top, lambda x: x.n), ' | ') AS names,
  list_sum(list_transform(top, lambda x: x.s)) ::DECIMAL(10, 3)::DOUBLE AS total FROM c""")
def _(spark, sf):
    out = triage.item_contributions(A.records(spark, sf))
    total = F.aggregate("contributions", F.lit(0.0), lambda acc, x: acc + x["score"])
    return out.select("record_id", F.array_join(F.transform(
        "contributions", lambda x: x["name"]), " | ").alias("names"),
        F.round(total, 3).alias("total"))


@query("r12_l04_literature_query", f"""WITH {FUSED}, q AS (
  SELECT record_id, concat_ws(' ',
    CASE WHEN {RAISED} THEN 'Major Depressive Disorder' WHEN phq9_band = 'mild'
      THEN 'mild depression dysthymia' END,
    CASE WHEN gad7_band IN ('moderate', 'severe') THEN 'Generalised Anxiety Disorder' END,
    CASE WHEN suicidal_ideation_positive THEN 'suicidal ideation risk assessment escalation' END,
    nullif(array_to_string(active[1:3], ' '), '')) AS t FROM fused)
SELECT record_id, coalesce(nullif(t, ''), 'depression anxiety mental health') AS query_text
FROM q""")
def _(spark, sf):
    df = triage.join_model_scores(A.scored(spark, sf), model_scores(spark, sf))
    return triage.literature_query(triage.stratify_risk(df), max_symptoms=3).select("record_id", "query_text")


@query("r12_literature_query_all_symptoms", f"""WITH {FUSED}, q AS (
  SELECT record_id, concat_ws(' ',
    CASE WHEN {RAISED} THEN 'Major Depressive Disorder' WHEN phq9_band = 'mild'
      THEN 'mild depression dysthymia' END,
    CASE WHEN gad7_band IN ('moderate', 'severe') THEN 'Generalised Anxiety Disorder' END,
    CASE WHEN suicidal_ideation_positive THEN 'suicidal ideation risk assessment escalation' END,
    nullif(array_to_string(active, ' '), '')) AS t FROM fused)
SELECT record_id, coalesce(nullif(t, ''), 'depression anxiety mental health') AS query_text
FROM q""")
def _(spark, sf):
    df = triage.join_model_scores(A.scored(spark, sf), model_scores(spark, sf))
    return triage.literature_query(triage.stratify_risk(df)).select("record_id", "query_text")


# --- validation and defaults -------------------------------------------------------------------

def shifted(df):
    """Records with broken values: item 3 out of range, ages out of range, odd narratives."""
    r = F.col("record_id")
    return df.withColumns({
        "phq3_sleep": F.when(r % 10 == 0, 4).otherwise(F.col("phq3_sleep")),
        "age": F.when(r % 15 == 0, 17).when(r % 77 == 0, None).otherwise(F.col("age")),
        "gender": F.when(r % 21 == 0, F.repeat(F.lit("x"), 21)).otherwise(F.col("gender")),
        "narrative": F.when(r % 12 == 0, F.lit("  N/A ")).when(r % 33 == 0, F.lit("")).when(
            r % 50 == 0, F.repeat(F.col("narrative"), 90)).otherwise(F.col("narrative"))})


SHIFT = f"""{A.REC}, shi AS (
  SELECT * EXCLUDE (phq3_sleep, age, gender, narrative),
    CASE WHEN record_id % 10 = 0 THEN 4 ELSE phq3_sleep END AS phq3_sleep,
    CASE WHEN record_id % 15 = 0 THEN 17 WHEN record_id % 77 = 0 THEN NULL ELSE age END AS age,
    CASE WHEN record_id % 21 = 0 THEN repeat('x', 21) ELSE gender END AS gender,
    CASE WHEN record_id % 12 = 0 THEN '  N/A ' WHEN record_id % 33 = 0 THEN ''
      WHEN record_id % 50 = 0 THEN repeat(narrative, 90) ELSE narrative END AS narrative
  FROM rec)"""
ERRORS = "list_filter([" + ", ".join(
    [f"CASE WHEN NOT coalesce({i} BETWEEN 0 AND 3, false) THEN '{i}' END" for i in V.ALL_ITEMS]
    + ["CASE WHEN NOT coalesce(age BETWEEN 18 AND 100, false) THEN 'age' END",
       "CASE WHEN length(gender) > 20 THEN 'gender' END",
       "CASE WHEN NOT length(narrative) BETWEEN 1 AND 4000 THEN 'narrative_length' END",
       "CASE WHEN lower(trim(narrative)) IN ('test', 'n/a', 'none', '')"
       " THEN 'narrative_placeholder' END"]) + "], lambda x: x IS NOT NULL)"


@query("p06_validate_records", f"""WITH {SHIFT}
SELECT record_id, array_to_string({ERRORS}, ' | ') AS errors FROM shi""")
def _(spark, sf):
    return validate.record_errors(shifted(A.records(spark, sf))).select("record_id",
                                                                         joined("errors"))


@query("p06_valid_and_quarantined", f"""WITH {SHIFT}
SELECT CASE WHEN len({ERRORS}) = 0 THEN 'valid' ELSE 'quarantined' END AS state, count(*) AS n
FROM shi GROUP BY 1""")
def _(spark, sf):
    valid, bad = validate.split_valid(shifted(A.records(spark, sf)))
    both = valid.select(F.lit("valid").alias("state")).unionByName(
        bad.select(F.lit("quarantined").alias("state")))
    return both.groupBy("state").agg(F.count("*").alias("n"))


@query("p12_fill_defaults", f"""WITH {SHIFT}
SELECT record_id, coalesce(age, 0) AS age, 'unknown' AS gender, 'none' AS phq9_band,
  'routine' AS safety_verdict, 0 AS phq9_total, phq1_anhedonia FROM shi""")
def _(spark, sf):
    bare = shifted(A.records(spark, sf)).drop("gender")
    return validate.fill_defaults(bare).select("record_id", "age", "gender", "phq9_band",
                                               "safety_verdict", "phq9_total", "phq1_anhedonia")


@query("p13_require_narrative", f"""WITH {SHIFT}
SELECT record_id, trim(narrative) AS narrative FROM shi WHERE trim(narrative) <> ''""")
def _(spark, sf):
    return validate.with_narrative(shifted(A.records(spark, sf))).select("record_id", "narrative")


@query("p14_check_records", f"""WITH {A.SCO}
SELECT count(*) AS n_rows, 0 AS bad_item, 0 AS bad_phq_total, 0 AS bad_gad_total,
  0 AS bad_phq_band, 0 AS bad_gad_band FROM sco""")
def _(spark, sf):
    return validate.check_records(A.scored(spark, sf))


@query("p06_clamp_items", f"""WITH {SHIFT}
SELECT record_id, least(3, phq3_sleep) AS phq3_sleep FROM shi""")
def _(spark, sf):
    return validate.clamp_items(shifted(A.records(spark, sf))).select("record_id", "phq3_sleep")


# --- features ----------------------------------------------------------------------------------

DERIVED = f"""{A.SCO}, der AS (
  SELECT *, phq3_sleep + phq4_fatigue + phq5_appetite AS somatic_cluster,
    phq6_self_worth + phq7_concentration AS cognitive_cluster,
    gad4_trouble_relaxing + gad5_restless AS gad_physical_cluster,
    (phq9_suicidal_ideation > 0)::INT AS si_flag,
    phq9_total / (gad7_total + 1.0::DOUBLE) AS phq_gad_ratio FROM sco)"""


@query("p05_derived_features", f"""WITH {DERIVED}
SELECT record_id, somatic_cluster, cognitive_cluster, gad_physical_cluster, si_flag,
  round(phq_gad_ratio, 6) AS phq_gad_ratio FROM der""")
def _(spark, sf):
    return features.add_derived(A.scored(spark, sf)).select(
        "record_id", *V.DERIVED_FEATURES[:4], F.round("phq_gad_ratio", 6).alias("phq_gad_ratio"))


NUMERIC = V.NUMERIC_FEATURES + V.DERIVED_FEATURES


@query("a19_scaler_fit", f"""WITH {DERIVED}
SELECT {', '.join(f'round(avg({c}), 6) AS mean_{c}, round(stddev_pop({c}), 6) AS std_{c}'
                  for c in NUMERIC)} FROM der WHERE split = 'train'""")
def _(spark, sf):
    train = features.add_derived(A.scored(spark, sf)).filter("split = 'train'")
    out = features.fit_scaler(train, NUMERIC)
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("j06_scaler_apply", f"""WITH {DERIVED}, st AS (
  SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in NUMERIC)}
  FROM der WHERE split = 'train')
SELECT record_id, {', '.join(f'round(({c} - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1 END, 6)'
                             f' AS {c}' for c in NUMERIC)} FROM der, st""")
def _(spark, sf):
    df = features.add_derived(A.scored(spark, sf))
    stats = features.fit_scaler(df.filter("split = 'train'"), NUMERIC)
    return features.apply_scaler(df, stats, NUMERIC).select(
        "record_id", *[F.round(c, 6).alias(c) for c in NUMERIC])


CATEGORIES = {"gender": ["female", "male"], "education": sorted(A.EDUCATIONS)}


@query("m01_model_matrix", f"""WITH {DERIVED}, st AS (
  SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in NUMERIC)}
  FROM der WHERE split = 'train')
SELECT record_id, round({' + '.join(
    f'({c} - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1 END' for c in NUMERIC)}, 4)
    AS scaled_sum, prior_diagnosis::INT AS prior_diagnosis, on_medication::INT AS on_medication,
  {', '.join(f"(gender = '{v}')::INT AS gender_{v}" for v in CATEGORIES['gender'])},
  {', '.join(f"(education = '{v}')::INT AS education_{v}" for v in CATEGORIES['education'])}
FROM der, st""")
def _(spark, sf):
    out = features.model_matrix(A.scored(spark, sf), CATEGORIES)
    total = sum((F.col(c) for c in NUMERIC[1:]), F.col(NUMERIC[0]))
    hot = [f"{c}_{v}" for c in V.CATEGORICAL_FEATURES for v in CATEGORIES[c]]
    return out.select("record_id", F.round(total, 4).alias("scaled_sum"), *V.BINARY_FEATURES, *hot)


@query("f21_band_codes", f"""WITH {A.SCO}
SELECT record_id, {A.case_sql('phq9_band', A.BAND_CODE)} AS y_ordinal, {A.case_sql(
    'phq9_band', {b: i for i, b in enumerate(sorted(A.BAND_CODE))})} AS y_alphabetical FROM sco""")
def _(spark, sf):
    return features.band_codes(A.scored(spark, sf)).select("record_id", "y_ordinal",
                                                           "y_alphabetical")


# --- lookups and joins -------------------------------------------------------------------------

BANDS = [(1, 10, "small"), (11, 25, "medium"), (26, 40, "large"), (99, 99, "bulk")]


@query("j02_band_join", """SELECT CASE WHEN l_quantity BETWEEN 1 AND 10 THEN 'small'
    WHEN l_quantity BETWEEN 11 AND 25 THEN 'medium' WHEN l_quantity BETWEEN 26 AND 40 THEN 'large'
    ELSE 'bulk' END AS quantity_band, count(*) AS n FROM lineitem GROUP BY 1""")
def _(spark, sf):
    bands = spark.createDataFrame(BANDS, "lo int, hi int, band string")
    banded = lookup.band_join(A.table(spark, sf, "lineitem"), bands, "l_quantity", "quantity_band")
    return banded.groupBy("quantity_band").agg(F.count("*").alias("n"))


@query("j05_dictionary_lookups", f"""WITH {A.SCO}
SELECT record_id, severity_score AS by_map, coalesce(CASE phq9_band WHEN 'mild' THEN 0.25
  WHEN 'severe' THEN 1.0 END, 0.0)::DOUBLE AS by_table FROM sco""")
def _(spark, sf):
    rows = spark.createDataFrame([("mild", 0.25), ("severe", 1.0)],
                                 "phq9_band string, by_table double")
    df = A.scored(spark, sf).withColumn("by_map", band_score(F.col("phq9_band")))
    return lookup.dictionary_join(df, rows, "phq9_band", {"by_table": 0.0}).select(
        "record_id", "by_map", "by_table")


@query("j08_members_and_others", """SELECT side, count(*) AS n FROM (
  SELECT CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    THEN 'member' ELSE 'other' END AS side FROM orders) GROUP BY 1""")
def _(spark, sf):
    orders = A.table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    allowed = A.table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'")
    side = lambda df, name: df.select(F.lit(name).alias("side"))
    both = side(lookup.members(orders, allowed, ["c_custkey"]), "member").unionByName(
        side(lookup.not_members(orders, allowed, ["c_custkey"]), "other"))
    return both.groupBy("side").agg(F.count("*").alias("n"))


# --- scalar functions --------------------------------------------------------------------------

@query("f10_f13_f14_scalars", """SELECT event_id, printf('SUBJ-%08d', event_id) AS padded,
  upper(replace(event_type, 'i', '_')) AS upper_replaced,
  replace(substr(strftime(ts, '%Y-%m-%dT%H:%M:%S'), 1, 19), 'T', ' ') AS short_time,
  least(2.5, greatest(-1.0, value - 50))::DOUBLE AS clipped,
  round(sqrt(abs(value - 100)), 6) AS root FROM events""")
def _(spark, sf):
    df = A.table(spark, sf, "events")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return df.select(
        "event_id", F.format_string("SUBJ-%08d", "event_id").alias("padded"),
        F.upper(F.replace("event_type", F.lit("i"), F.lit("_"))).alias("upper_replaced"),
        text.short_time(iso).alias("short_time"),
        numeric.clip(F.col("value") - 50, -1.0, 2.5).alias("clipped"),
        F.round(F.sqrt(F.abs(F.col("value") - 100)), 6).alias("root"))


@query("f10_title_case", """SELECT DISTINCT phq AS name, CASE phq WHEN 'none' THEN 'None'
  WHEN 'mild' THEN 'Mild' WHEN 'moderate' THEN 'Moderate'
  WHEN 'moderately_severe' THEN 'Moderately Severe' ELSE 'Severe' END AS shown
FROM (WITH """ + A.SCO + " SELECT phq9_band AS phq FROM sco)")
def _(spark, sf):
    return A.scored(spark, sf).select(F.col("phq9_band").alias("name"), text.title_case(
        F.col("phq9_band")).alias("shown")).distinct()


@query("f15_sigmoid_softmax", """SELECT event_id,
  round(1 / (1 + exp(-(value - 50) / 20)), 6) AS share,
  round(exp(value / 100 - greatest(value / 100, 1.0, user_id / 100.0::DOUBLE)) / (
    exp(value / 100 - greatest(value / 100, 1.0, user_id / 100.0::DOUBLE))
    + exp(1.0 - greatest(value / 100, 1.0, user_id / 100.0::DOUBLE))
    + exp(user_id / 100.0::DOUBLE - greatest(value / 100, 1.0, user_id / 100.0::DOUBLE))), 6)
  AS first_share FROM events""")
def _(spark, sf):
    df = A.table(spark, sf, "events")
    logits = F.array(F.col("value") / 100, F.lit(1.0), F.col("user_id") / F.lit(100.0))
    return df.withColumn("logits", logits).select(
        "event_id", F.round(numeric.sigmoid((F.col("value") - 50) / 20), 6).alias("share"),
        F.round(numeric.softmax(F.col("logits"))[0], 6).alias("first_share"))


@query("f16_md5_bucket", f"""SELECT {A.bucket_sql('c_name')} AS bucket, count(*) AS n
FROM customer GROUP BY 1""")
def _(spark, sf):
    return A.table(spark, sf, "customer").groupBy(hashing.bucket(
        F.col("c_name"), 100, "md5").alias("bucket")).agg(F.count("*").alias("n"))


# Murmur3 of 32 bits over the bytes of an ASCII text: whole words of four bytes, then single bytes.
WORD = 1 << 32
BYTE = "ord(substr(c_name, {}, 1))::HUGEINT"
MURMUR = f"""k AS (
  SELECT c_name, length(c_name) AS n, list_concat(
    list_transform(range(0, length(c_name) // 4), lambda i: {BYTE.format('4 * i + 1')} + 256 * {BYTE.format('4 * i + 2')}
      + 65536 * {BYTE.format('4 * i + 3')} + 16777216 * {BYTE.format('4 * i + 4')}),
    list_transform(range(length(c_name) // 4 * 4, length(c_name)), lambda i: {BYTE.format('i + 1')})) AS ks FROM customer), m AS (
  SELECT c_name, n, list_transform(list_transform(list_transform(ks, lambda k: k * 3432918353 % {WORD}),
    lambda k: k * 32768 % {WORD} + k // 131072), lambda k: k * 461845907 % {WORD}) AS ks FROM k), h AS (
  SELECT c_name, xor(list_reduce(list_prepend(42::HUGEINT, ks), lambda h, k:
    ((xor(h, k) * 8192 % {WORD} + xor(h, k) // 524288) * 5 + 3864292196) % {WORD}), n::HUGEINT) AS h FROM m), a AS (
  SELECT c_name, xor(h, h // 65536) * 2246822507 % {WORD} AS h FROM h), b AS (
  SELECT c_name, xor(h, h // 8192) * 3266489909 % {WORD} AS h FROM a), c AS (
  SELECT c_name, xor(h, h // 65536) AS h FROM b), murmur AS (
  SELECT c_name, CASE WHEN h >= {WORD // 2} THEN h - {WORD} ELSE h END AS h FROM c)"""


@query("f16_murmur_bucket", f"""WITH {MURMUR}
SELECT abs(h % 100)::INT AS bucket, count(*) AS n FROM murmur GROUP BY 1""")
def _(spark, sf):
    return A.table(spark, sf, "customer").groupBy(hashing.bucket(
        F.col("c_name")).alias("bucket")).agg(F.count("*").alias("n"))


@query("f17_digest_uuid", """SELECT c_custkey, concat_ws('-', substr(d, 1, 8), substr(d, 9, 4),
  substr(d, 13, 4), substr(d, 17, 4), substr(d, 21, 12)) AS id
FROM (SELECT c_custkey, md5('42/' || c_custkey || '/uuid') AS d FROM customer)""")
def _(spark, sf):
    return A.table(spark, sf, "customer").select("c_custkey", hashing.digest_uuid(
        42, F.col("c_custkey")).alias("id"))


@query("f20_age_bands", f"""WITH {A.REC}
SELECT {A.band_sql('age', V.AGE_BANDS)} AS age_band, count(*) AS n FROM rec GROUP BY 1""")
def _(spark, sf):
    return A.records(spark, sf).groupBy(age_band(F.col("age")).alias("age_band")).agg(
        F.count("*").alias("n"))


@query("f11_json_in_prose", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events""")
def _(spark, sf):
    prose = F.concat(F.lit("reply: "), "props", F.lit(" end {x}"))
    found = F.from_json(text.first_json(prose, "{", "}"), "k bigint")
    return A.table(spark, sf, "events").select("event_id", found["k"].alias("k"))


@query("t20_user_split", f"""SELECT c_custkey, {A.split_sql('c_name')} AS split FROM customer""")
def _(spark, sf):
    return cohort.split_by_user(A.table(spark, sf, "customer"), "c_name", method="md5").select(
        "c_custkey", "split")
