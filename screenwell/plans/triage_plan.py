"""Triage of a table of records from answers to verdict."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenwell.fixed_values import NO_INDEX_CONTEXT
from screenwell.operators.care_plan import add_care_plan
from screenwell.operators.safety import judge
from screenwell.operators.triage import (join_model_scores, literature_query, score_record,
                                         stratify_risk)
from screenwell.plans.retrieval_plan import retrieve
from screenwell.retrieval.hybrid import answers, cite, differential
from screenwell.session import broadcast_checked, cut_lineage
from screenwell.sources.index_store import Index

NO_CITATIONS = ("CAST(array() AS array<struct<source:string,pmid:string,disorder:string,"
                "title:string,score:double>>)")


def add_literature(df: DataFrame, index: Index | None = None,
                   max_symptoms: int | None = None, **options) -> DataFrame:
    """Context, citations and differential for each record's query.

    Records share few distinct queries (they depend on bands, a flag and symptom names), so the
    search runs once per distinct query text and its small result goes to the records.
    """
    df = literature_query(df, max_symptoms)
    if index is None:
        return df.withColumns({"dsm_context": F.lit(NO_INDEX_CONTEXT),
                               "citations": F.expr(NO_CITATIONS),
                               "dsm_differential": F.expr("CAST(array() AS array<string>)")})
    queries = cut_lineage(df.select("query_text").distinct().withColumn(
        "query_id", F.md5("query_text")))
    found = cut_lineage(answers(queries, cite(retrieve(queries, index, **options))).select(
        "query_text", F.col("answer").alias("dsm_context"), "citations",
        differential(F.col("citations")).alias("dsm_differential")))
    return df.join(broadcast_checked(found), "query_text", "left")


def triage(records: DataFrame, scores: DataFrame | None = None, index: Index | None = None,
           plan_reply: str | None = None, verifier_reply: str | None = None) -> DataFrame:
    """Screening, risk, literature, care plan and verdict.

    Without scores, index and replies every step is a row expression: no shuffle, and the same
    function runs on a streaming table.
    """
    df = score_record(records)
    if scores is not None:
        df = join_model_scores(df, scores)
    df = add_literature(stratify_risk(df), index)
    return judge(add_care_plan(df, plan_reply), verifier_reply)
