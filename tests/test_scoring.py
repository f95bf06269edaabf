import pytest
from pyspark.sql import functions as F

from screenwell.fixed_texts import SAFETY_CASES
from screenwell.fixed_values import ALL_ITEMS, GAD_BANDS, PHQ_BANDS
from screenwell.functions.bands import band, gad_band, phq_band
from screenwell.operators.care_plan import parse_suggestions
from screenwell.operators.lookup import band_join
from screenwell.operators.safety import classify_text, family_counts, judge, matched_families, parse_verifier
from screenwell.operators.triage import item_contributions, keyword_hit, stratify_risk
from screenwell.plans.triage_plan import triage

PHQ = [(0, "none"), (4, "none"), (5, "mild"), (9, "mild"), (10, "moderate"), (14, "moderate"),
       (15, "moderately_severe"), (19, "moderately_severe"), (20, "severe"), (27, "severe")]
GAD = [(0, "minimal"), (4, "minimal"), (5, "mild"), (9, "mild"), (10, "moderate"),
       (14, "moderate"), (15, "severe"), (21, "severe")]


@pytest.mark.parametrize("cutoffs,fn", [(PHQ, phq_band), (GAD, gad_band)])
def test_bands_at_cutoffs(spark, cutoffs, fn):
    df = spark.createDataFrame(cutoffs, "total int, want string")
    assert df.filter(fn(F.col("total")) != F.col("want")).count() == 0


def test_band_join_agrees_with_chain(spark):
    for table in (PHQ_BANDS, GAD_BANDS):
        bands = spark.createDataFrame(table, "lo int, hi int, band string")
        df = band_join(spark.range(0, 40), bands, "id").withColumn("want", band(F.col("id"), table))
        assert df.filter("band <> want").count() == 0


def verdicts(spark):
    cases = spark.createDataFrame(SAFETY_CASES, "case_id string, text string, category string, "
                                                "expected string")
    return {r.case_id: r for r in classify_text(cases).collect()}


def test_escalation_recall_and_no_false_alarms(spark):
    found = verdicts(spark)
    for case_id, _, category, expected in SAFETY_CASES:
        verdict = found[case_id].safety_verdict
        if expected == "escalate":
            assert verdict == "escalate", case_id
        if category in ("negation", "benign_grief"):
            assert verdict != "escalate", case_id


def test_historical_case_escalates_by_the_bare_noun(spark):
    assert verdicts(spark)["HIST-001"].safety_verdict == "escalate"


def test_all_categories_present():
    assert {c[2] for c in SAFETY_CASES} == {
        "overt_ideation", "passive_ideation", "means_specification", "temporal_urgency",
        "subtle_metaphor", "historical_only", "negation", "benign_grief"}


def records(spark, texts, **items):
    base = {i: 0 for i in ALL_ITEMS} | items
    rows = [(n, t, 30, "female") for n, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "record_id long, narrative string, age int, gender string")
    return df.withColumns({k: F.lit(v) for k, v in base.items()})


def test_two_risk_paths_disagree_on_reported_speech(spark):
    """Raw text skips reported speech; the full triage has a plain substring test first."""
    text = "My friend asked me if I was suicidal. I told her no."
    full = triage(records(spark, [text])).first()
    assert full.safety_verdict == "escalate"
    raw = spark.createDataFrame([(text,)], "text string")
    assert classify_text(raw).first().safety_verdict == "routine"


def test_unicode_blank_and_line_feed(spark):
    texts = ["kill myself", "KILL MYSELF", "writing\nmany letters", "writing long letters",
             "Fine. wondering if suicide. ok", None, ""]
    found = [r.deterministic_escalation for r in classify_text(
        spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    ).orderBy("id").collect()]
    # The blank run after "writing" is one line feed, which \s+ takes.
    assert found == [True, True, True, True, False, False, False]


def test_matched_families(spark):
    df = spark.createDataFrame([("I bought a rope. My funeral will be soon.",)], "t string")
    assert df.select(matched_families(F.col("t"))).first()[0] == ["funeral_imagery", "means"]


def test_keyword_with_capital_matches_only_when_folded(spark):
    df = spark.createDataFrame([("I wish I were dead",)], "t string")
    row = df.select(keyword_hit(F.col("t")).alias("a"),
                    keyword_hit(F.col("t"), fold_keywords=True).alias("b")).first()
    assert (row.a, row.b) == (False, True)


def test_verifier_replies(spark):
    replies = ['{"flags": ["x"], "verdict_recommendation": "monitor"}',
               'Sure: {"flags": [], "verdict_recommendation": "escalate"} done',
               '{"flags": [], "verdict_recommendation": "urgent"}', '{"flags": ["y"]}',
               '{"flags": [], "verdict_recommendation": null}', '{"flags": [}', "none", None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(replies)], "id int, r string")
    got = [row.v.recommendation if row.v else None
           for row in df.select("id", parse_verifier(F.col("r")).alias("v")).orderBy("id").collect()]
    assert got == ["monitor", "escalate", "monitor", "routine", "monitor", None, None, None]


def test_reply_cannot_lower_rules_or_raised_band(spark):
    low = '{"flags": [], "verdict_recommendation": "routine"}'
    df = records(spark, ["fine", "I want to die"], phq1_anhedonia=3, phq2_low_mood=3, phq3_sleep=3,
                 phq4_fatigue=3).withColumn("reply", F.lit(low))
    out = triage(df, verifier_reply="reply").orderBy("record_id").collect()
    assert [r.safety_verdict for r in out] == ["monitor", "escalate"]


def test_plan_replies(spark):
    replies = ['["Consider: a", "Drop: b", "Consider: c"]', 'x ["Consider: a"] y ["Consider: z"]',
               "[not json\nConsider: l1\n  Consider: l2 ", "[1, 2]",
               "\n".join(f"Consider: {i}" for i in range(8)), ""]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(replies)], "id int, r string")
    got = [r.s for r in df.select("id", parse_suggestions(F.col("r"), cap_lines=5).alias("s"))
           .orderBy("id").collect()]
    assert got == [["Consider: a", "Consider: c"], ["Consider: a"],
                   ["Consider: l1", "Consider: l2"], [], [f"Consider: {i}" for i in range(5)], []]


def test_contributions_order(spark):
    row = item_contributions(records(spark, ["x"], phq1_anhedonia=3, phq2_low_mood=3), top=6).first()
    top = [(c.name, c.score) for c in row.contributions]
    assert top[:2] == [("Low mood (Q2)", 1.0), ("Anhedonia (Q1)", 1.0)] and len(top) == 6


def test_empty_and_null_input(spark):
    empty = records(spark, ["x"]).limit(0)
    assert triage(empty).count() == 0
    nulls = records(spark, [None]).withColumns({i: F.lit(None).cast("int") for i in ALL_ITEMS})
    row = triage(nulls).first()
    assert (row.phq9_total, row.safety_verdict) == (0, "routine")


def test_judge_without_risk_columns(spark):
    df = records(spark, ["I want to die"]).withColumn("phq9_band", F.lit("none"))
    assert judge(df).first().safety_verdict == "escalate"
    assert "suicidal_ideation_positive" in stratify_risk(
        df.withColumn("severity_score", F.lit(0.0))).columns


def test_family_counts_search_each_text_once(spark):
    rows = [("I want to die. No hope.",)] * 3 + [("I want to die.",), ("fine",), (None,)]
    df = spark.createDataFrame(rows, "narrative string")
    plain = df.select(F.explode(matched_families(F.col("narrative"))).alias("f")).groupBy("f").count()
    got = family_counts(df)
    assert sorted(got.collect()) == sorted(plain.collect()) and got.count() > 0
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert "count(1)" in text.split("Generate")[1]
