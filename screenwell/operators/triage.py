"""Record scoring: totals and bands, risk fusion, item contributions, response projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenwell.fixed_values import (GAD_ITEMS, IDEATION_ITEM, IDEATION_THRESHOLD, ITEM_WEIGHTS,
                                     PHQ_ITEMS, QUERY_ANXIETY, QUERY_DEFAULT, QUERY_DEPRESSION,
                                     QUERY_IDEATION, QUERY_MILD, RAISED_GAD_BANDS,
                                     RAISED_PHQ_BANDS, RISK_KEYWORDS, SYMPTOM_THRESHOLD, SYMPTOMS)
from screenwell.functions.bands import band_score, gad_band, item_total, phq_band
from screenwell.functions.text import contains_any

NO_SYMPTOMS = "CAST(array() AS array<string>)"


def score_record(df: DataFrame) -> DataFrame:
    """Both totals, both bands and the severity score of the depression band."""
    df = df.withColumns({"phq9_total": item_total(PHQ_ITEMS), "gad7_total": item_total(GAD_ITEMS)})
    df = df.withColumns({"phq9_band": phq_band(F.col("phq9_total")),
                         "gad7_band": gad_band(F.col("gad7_total"))})
    return df.withColumn("severity_score", band_score(F.col("phq9_band")))


def threshold_symptoms(df: DataFrame, probabilities: str = "symptom_prob",
                       ideation: str = "ideation_prob", labels: list[str] = SYMPTOMS,
                       symptom_at: float = SYMPTOM_THRESHOLD,
                       ideation_at: float = IDEATION_THRESHOLD) -> DataFrame:
    """Probability map, active labels and the ideation flag from model probabilities."""
    names = F.array(*[F.lit(x) for x in labels])
    pairs = F.arrays_zip(names.alias("name"), F.col(probabilities).alias("p"))
    active = F.transform(F.filter(pairs, lambda z: z["p"] >= symptom_at), lambda z: z["name"])
    return df.withColumns({
        "symptom_probabilities": F.map_from_arrays(names, F.col(probabilities)),
        "active_symptoms": active,
        "ideation_positive": F.col(ideation) >= ideation_at,
    })


def keyword_hit(narrative: Column, keywords: list[str] = RISK_KEYWORDS,
                fold_keywords: bool = False) -> Column:
    """Substring test on the lower-cased narrative.

    A keyword with a capital letter cannot match lower-cased text. ``fold_keywords`` lower-cases
    the keywords too.
    """
    words = [k.lower() for k in keywords] if fold_keywords else keywords
    return contains_any(F.lower(F.coalesce(narrative, F.lit(""))), words)


def stratify_risk(df: DataFrame, keywords: list[str] = RISK_KEYWORDS,
                  fold_keywords: bool = False) -> DataFrame:
    """Fuse the structured score with text signals.

    Rows with ``model_ideation_prob`` (and a narrative) are blended with the model's scores;
    all others, and tables without such columns, use the keyword rules.
    """
    narrative = F.coalesce(F.col("narrative"), F.lit(""))
    item9 = F.coalesce(F.col(IDEATION_ITEM), F.lit(0)) > 0
    ruled = item9 | keyword_hit(narrative, keywords, fold_keywords)
    by_rule = {"suicidal_ideation_positive": ruled,
               "suicidal_ideation_prob": F.when(ruled, 0.9).otherwise(0.05),
               "active_symptoms": F.expr(NO_SYMPTOMS),
               "symptom_probabilities": F.expr("CAST(map() AS map<string,double>)")}
    if "model_ideation_prob" not in df.columns:
        return df.withColumns(by_rule)
    prob, active = F.col("model_ideation_prob"), F.col("model_active_symptoms")
    scored = prob.isNotNull() & (narrative != "")
    text_score = prob * 0.3 + F.least(F.size(active) / F.lit(7.0), F.lit(1.0)) * 0.2
    by_model = {"suicidal_ideation_positive": F.col("model_ideation_positive") | item9,
                "suicidal_ideation_prob": prob, "active_symptoms": active,
                "symptom_probabilities": F.col("model_symptom_probabilities")}
    out = {name: F.when(scored, by_model[name]).otherwise(by_rule[name]) for name in by_rule}
    out["severity_score"] = F.when(
        scored, 0.6 * F.col("severity_score") + 0.4 * text_score).otherwise(F.col("severity_score"))
    return df.withColumns(out)


def join_model_scores(df: DataFrame, scores: DataFrame, key: str = "record_id") -> DataFrame:
    """Attach model scores by record id; records without a score keep NULL and use the rules.

    ``scores``: key, ideation_prob, ideation_positive, active_symptoms, symptom_probabilities.
    """
    renamed = scores.select(
        key, F.col("ideation_prob").alias("model_ideation_prob"),
        F.col("ideation_positive").alias("model_ideation_positive"),
        F.col("active_symptoms").alias("model_active_symptoms"),
        F.col("symptom_probabilities").alias("model_symptom_probabilities"))
    return df.join(renamed, key, "left")


def literature_query(df: DataFrame, max_symptoms: int | None = None) -> DataFrame:
    """Query text from bands, ideation flag and active symptoms (the first ``max_symptoms``)."""
    phq, gad = F.col("phq9_band"), F.col("gad7_band")
    active = F.col("active_symptoms")
    symptoms = F.array_join(F.slice(active, 1, max_symptoms) if max_symptoms else active, " ")
    text = F.concat_ws(
        " ",
        F.when(phq.isin(*RAISED_PHQ_BANDS), QUERY_DEPRESSION).when(phq == "mild", QUERY_MILD),
        F.when(gad.isin(*RAISED_GAD_BANDS), QUERY_ANXIETY),
        F.when(F.col("suicidal_ideation_positive"), QUERY_IDEATION),
        F.nullif(symptoms, F.lit("")))
    return df.withColumn("query_text",
                         F.coalesce(F.nullif(text, F.lit("")), F.lit(QUERY_DEFAULT)))


def item_contributions(df: DataFrame, weights: list[tuple] = ITEM_WEIGHTS,
                       top: int | None = None) -> DataFrame:
    """Weighted share of each item (the ``top`` ones), the largest first, ties by name descending."""
    parts = [F.struct(F.round(F.coalesce(F.col(item), F.lit(0)) / F.lit(3.0) * F.lit(w), 3)
                      .alias("score"), F.lit(name).alias("name")) for item, name, w in weights]
    ranked = F.sort_array(F.array(*parts), asc=False)
    return df.withColumn("contributions", F.slice(ranked, 1, top) if top else ranked)


RESPONSE_COLUMNS = [
    "phq9_total", "gad7_total", "phq9_band", "gad7_band", "severity_score",
    "suicidal_ideation_prob", "active_symptoms", "dsm_differential", "citations",
    "care_plan_suggestions", "safety_verdict", "critic_reasoning", "deterministic_escalation",
    "llm_verifier_flags",
]


def response(df: DataFrame, keys: list[str] = ("record_id",)) -> DataFrame:
    """The 14 result columns, scores rounded to 4 digits."""
    out = [F.round(c, 4).alias(c) if c in ("severity_score", "suicidal_ideation_prob")
           else F.col(c) for c in RESPONSE_COLUMNS]
    return df.select(*keys, *out)
