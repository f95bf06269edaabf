"""Audit log tables: verdict summary, agreement, last records, display lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenwell.fixed_values import VERDICTS
from screenwell.functions.text import short_time


def of_verdict(log: DataFrame, verdict: str) -> DataFrame:
    if verdict not in VERDICTS:
        raise ValueError(f"unknown verdict {verdict!r}")
    return log.filter(F.col("safety_verdict") == verdict)


def verdict_summary(log: DataFrame, by: list[Column] = ()) -> DataFrame:
    """Total, count and share per verdict, and rule-triggered count; NULL shares when empty."""
    counts = [F.count_if(F.col("safety_verdict") == v).alias(f"n_{v}") for v in VERDICTS]
    grouped = log.groupBy(*by).agg(
        F.count("*").alias("n_records"), *counts,
        F.count_if(F.coalesce("deterministic_escalation", F.lit(False))).alias("n_deterministic"))
    return grouped.withColumns({
        f"share_{v}": F.try_divide(F.col(f"n_{v}"), F.col("n_records")) for v in VERDICTS})


def rule_agreement(log: DataFrame) -> DataFrame:
    """How often the rule flag and the final verdict go together."""
    return log.groupBy("deterministic_escalation", "safety_verdict").agg(F.count("*").alias("n"))


def last_records(log: DataFrame, n: int, time: str = "timestamp",
                 key: str = "log_id") -> DataFrame:
    """The last ``n`` records, returned in log order.

    ``orderBy().limit()`` keeps only n rows per task before the final merge.
    """
    return log.orderBy(F.desc(time), F.desc(key)).limit(n).orderBy(time, key)


def log_lines(log: DataFrame) -> DataFrame:
    """One display line per record, with a mark on rule escalations."""
    mark = F.when(F.col("deterministic_escalation"), "  ← ESCALATED").otherwise("")
    line = F.format_string("  %s  PHQ-9=%2d  GAD-7=%2d  band=%-18s  verdict=%s%s",
                           short_time(F.col("timestamp")), "phq9_total", "gad7_total",
                           "phq9_band", F.upper("safety_verdict"), mark)
    return log.withColumn("line", line)


def review_rows(log: DataFrame) -> DataFrame:
    """Escalated and monitored records with the columns a reviewer reads."""
    raised = log.filter(F.col("safety_verdict").isin("escalate", "monitor"))
    return raised.select(
        "log_id", short_time(F.col("timestamp")).alias("time"), "phq9_total", "gad7_total",
        F.coalesce("phq9_band", F.lit("?")).alias("phq9_band"), "safety_verdict",
        F.format_string("%.3f", F.coalesce("suicidal_ideation_prob", F.lit(0.0))).alias("si_prob"),
        F.when(F.col("deterministic_escalation"), "YES").otherwise("no").alias("deterministic"))
