"""Care-plan suggestions by rule or from replies, and record texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenwell.fixed_values import (IDEATION_ITEM, RAISED_GAD_BANDS, RAISED_PHQ_BANDS,
                                     SUGGEST_ANXIETY, SUGGEST_FOLLOW_UP, SUGGEST_REFERRAL,
                                     SUGGEST_ROUTINE, SUGGEST_SAFETY, SUGGESTION_PREFIX)
from screenwell.functions.text import UNICODE, first_json, strip_blank


def rule_suggestions() -> Column:
    """Conditional suggestions in fixed order, a default when none applies."""
    phq, gad = F.col("phq9_band"), F.col("gad7_band")
    picked = F.array_compact(F.array(
        F.when(F.col("suicidal_ideation_positive"), SUGGEST_SAFETY),
        F.when(phq.isin(*RAISED_PHQ_BANDS), SUGGEST_REFERRAL),
        F.when(gad.isin(*RAISED_GAD_BANDS), SUGGEST_ANXIETY),
        F.when(phq.isin("mild", "moderate"), SUGGEST_FOLLOW_UP)))
    return F.when(F.size(picked) > 0, picked).otherwise(F.array(F.lit(SUGGEST_ROUTINE)))


def parse_suggestions(reply: Column, cap_lines: int | None = None, cap_json: int | None = None) -> Column:
    """Suggestions in a reply: the first JSON array, else the lines with the prefix.

    ``cap_lines`` keeps the first lines only, ``cap_json`` the first of an array; both off by default.
    """
    reply = strip_blank(reply)
    prefixed = lambda s: s.startswith(SUGGESTION_PREFIX)
    items = F.from_json(first_json(reply, "[", "]"), "array<string>")
    from_json = F.filter(items, prefixed)
    if cap_json:
        from_json = F.slice(from_json, 1, cap_json)
    lines = F.transform(F.split(reply, "\n"), lambda s: F.regexp_replace(
        s, f"{UNICODE}^\\s+|\\s+$", ""))
    from_lines = F.filter(lines, prefixed)
    return F.coalesce(from_json, F.slice(from_lines, 1, cap_lines) if cap_lines else from_lines)


def add_care_plan(df: DataFrame, reply: str | None = None,
                  cap_lines: int | None = None) -> DataFrame:
    """Suggestions by rule; where a reply is present, those of the reply."""
    if reply is None:
        return df.withColumn("care_plan_suggestions", rule_suggestions())
    text = F.col(reply)
    return df.withColumn("care_plan_suggestions", F.when(
        text.isNotNull(), parse_suggestions(text, cap_lines)).otherwise(rule_suggestions()))


def _py_bool(flag: Column) -> Column:
    return F.when(flag, "True").otherwise("False")


def _cut(text: Column, max_chars: int | None) -> Column:
    return text if max_chars is None else F.substring(text, 1, max_chars)


def plan_context(df: DataFrame, context: str = "dsm_context",
                 max_chars: int | None = None) -> DataFrame:
    """Record text shown to a plan writer; ``max_chars`` cuts the retrieved context."""
    text = F.concat(
        F.lit("PHQ-9 total: "), F.col("phq9_total").cast("string"),
        F.lit(" ("), F.col("phq9_band"), F.lit(")\nGAD-7 total: "),
        F.col("gad7_total").cast("string"), F.lit(" ("), F.col("gad7_band"),
        F.lit(")\nSuicidal ideation positive: "), _py_bool(F.col("suicidal_ideation_positive")),
        F.lit("\nActive symptoms: "), F.array_join("active_symptoms", ", "),
        F.lit("\nDSM context: "), _cut(F.col(context), max_chars),
        F.lit("\nCitations: "), F.size("citations").cast("string"), F.lit(" retrieved\n"))
    return df.withColumn("plan_context", text)


def verifier_context(df: DataFrame, max_chars: int | None = None) -> DataFrame:
    """Record and plan summaries shown to a verifier; ``max_chars`` cuts the narrative."""
    none_if_empty = lambda c, word: F.when(
        F.size(c) > 0, F.array_join(c, ", ")).otherwise(word)
    record = F.concat(
        F.lit("PHQ-9: "), F.col("phq9_total").cast("string"), F.lit(" ("), F.col("phq9_band"),
        F.lit(")\nGAD-7: "), F.col("gad7_total").cast("string"), F.lit(" ("), F.col("gad7_band"),
        F.lit(")\nActive symptoms from NLP: "), none_if_empty("active_symptoms", "none detected"),
        F.lit("\nSuicidal ideation (MentalBERT): "),
        F.format_string("%.2f", F.col("suicidal_ideation_prob")),
        F.lit("\nSuicidal ideation (PHQ-9 item 9): "), F.col(IDEATION_ITEM).cast("string"),
        F.lit("\nNarrative: " if max_chars is None else f"\nNarrative (first {max_chars} chars): "),
        _cut(F.col("narrative"), max_chars))
    listed = F.array_join(F.transform("care_plan_suggestions",
                                      lambda s: F.concat(F.lit("  - "), s)), "\n")
    plan = F.concat(F.lit("DSM differential: "), none_if_empty("dsm_differential", "not specified"),
                    F.lit("\nCare plan suggestions:\n"), listed)
    return df.withColumns({"record_summary": record, "plan_summary": plan})
