"""Safety verdicts: sentence rules, overriding escalation, verifier replies, reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenwell.fixed_values import (ESCALATION_REASON, IDEATION_ITEM, RAISED_PHQ_BANDS,
                                     REASON_FLAGS, REASON_NO_FLAGS, REASON_VERDICT,
                                     REPORTED_SPEECH_FRAMES, RISK_RULES, VERDICTS)
from screenwell.functions.text import any_of, first_json, sentences, strip_blank

NO_FLAGS = "CAST(array() AS array<string>)"


def sentence_signal(text: Column, rules: list[tuple] = RISK_RULES,
                    frames: list[str] = REPORTED_SPEECH_FRAMES) -> Column:
    """True when some sentence matches a rule and no reported-speech frame.

    A sentence can match only if the whole text does, so one search over the text spares the
    split for the large share of texts without any match.
    """
    text = F.coalesce(text, F.lit(""))
    risk, frame = any_of([p for _, p in rules]), any_of(frames)
    return text.rlike(risk) & F.exists(
        sentences(text), lambda s: s.rlike(risk) & ~s.rlike(frame))


def matched_families(text: Column, rules: list[tuple] = RISK_RULES,
                     frames: list[str] = REPORTED_SPEECH_FRAMES) -> Column:
    """Names of the rule families that fire in an unframed sentence, in rule order."""
    frame = any_of(frames)
    kept = F.filter(sentences(F.coalesce(text, F.lit(""))), lambda s: ~s.rlike(frame))
    tests = []
    for family in dict.fromkeys(f for f, _ in rules):
        pattern = any_of([p for f, p in rules if f == family])
        tests.append(F.when(_some_match(kept, pattern), F.lit(family)))
    return F.array_compact(F.array(*tests))


def family_counts(df: DataFrame, text: str = "narrative") -> DataFrame:
    """(family, n): rows whose text matches each family. Copies of a text are counted first, so
    every different text is searched once."""
    texts = df.groupBy(F.col(text).alias("_text")).agg(F.count("*").alias("_n"))
    found = texts.select("_n", F.explode(matched_families(F.col("_text"))).alias("family"))
    return found.groupBy("family").agg(F.sum("_n").alias("n"))


def _some_match(texts: Column, pattern: str) -> Column:
    return F.exists(texts, lambda s: s.rlike(pattern))


def parse_verifier(reply: Column) -> Column:
    """Struct (flags, recommendation) from a reply; NULL when it holds no readable JSON.

    No recommendation means routine, an unknown one means monitor.
    """
    found = first_json(strip_blank(reply), "{", "}")
    # Each field is read alone: flags of another shape leave the recommendation readable.
    parsed = F.from_json(found, "verdict_recommendation string, _bad string",
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    flags = F.from_json(F.get_json_object(found, "$.flags"), "array<string>")
    given = F.array_contains(F.json_object_keys(found), "verdict_recommendation")
    rec = F.when(given, F.coalesce(parsed["verdict_recommendation"], F.lit("null"))
                 ).otherwise("routine")
    ok = found.isNotNull() & parsed["_bad"].isNull()
    return F.when(ok, F.struct(
        F.coalesce(flags, F.expr(NO_FLAGS)).alias("flags"),
        F.when(rec.isin(*VERDICTS), rec).otherwise("monitor").alias("recommendation")))


def judge(df: DataFrame, reply: str | None = None, rules: list[tuple] = RISK_RULES,
          frames: list[str] = REPORTED_SPEECH_FRAMES) -> DataFrame:
    """Verdict, reason, rule flag and verifier flags.

    Rules escalate first and cannot be lowered. Otherwise a readable reply decides, else the
    band; a raised band is never below monitor.
    """
    flag = F.coalesce(F.col("suicidal_ideation_positive"), F.lit(False)) \
        if "suicidal_ideation_positive" in df.columns else F.lit(False)
    item9 = F.coalesce(F.col(IDEATION_ITEM), F.lit(0)) > 0
    raised = F.col("phq9_band").isin(*RAISED_PHQ_BANDS)
    df = df.withColumn("deterministic_escalation",
                       flag | item9 | sentence_signal(F.col("narrative"), rules, frames))
    by_band = F.when(raised, "monitor").otherwise("routine")
    if reply is None:
        df = df.withColumns({"_verdict": by_band, "_flags": F.expr(NO_FLAGS)})
    else:
        df = df.withColumn("_reply", parse_verifier(F.col(reply)))
        df = df.withColumns({
            "_verdict": F.coalesce(F.col("_reply.recommendation"), by_band),
            "_flags": F.coalesce(F.col("_reply.flags"), F.expr(NO_FLAGS))})
    escalate = F.col("deterministic_escalation")
    floor = F.when(raised & (F.col("_verdict") == "routine"), "monitor").otherwise(F.col("_verdict"))
    df = df.withColumns({
        "safety_verdict": F.when(escalate, "escalate").otherwise(floor),
        "llm_verifier_flags": F.when(escalate, F.expr(NO_FLAGS)).otherwise(F.col("_flags"))})
    noted = F.when(F.size("llm_verifier_flags") > 0,
                   F.concat(F.lit(REASON_FLAGS), F.array_join("llm_verifier_flags", "; "))
                   ).otherwise(REASON_NO_FLAGS)
    reason = F.concat_ws(" | ", F.concat(F.lit(REASON_VERDICT), F.upper("safety_verdict")), noted)
    df = df.withColumn("critic_reasoning", F.when(escalate, ESCALATION_REASON).otherwise(reason))
    return df.drop("_verdict", "_flags", "_reply")


def classify_text(df: DataFrame, text: str = "text") -> DataFrame:
    """Verdict for raw text alone: a neutral record carrying the text as its narrative."""
    neutral = df.withColumns({"narrative": F.col(text), IDEATION_ITEM: F.lit(0),
                              "phq9_band": F.lit("none"),
                              "suicidal_ideation_positive": F.lit(False)})
    judged = judge(neutral)
    extra = ["safety_verdict", "critic_reasoning", "deterministic_escalation", "llm_verifier_flags"]
    return judged.select(*df.columns, *[c for c in extra if c not in df.columns])
