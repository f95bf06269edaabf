"""Retrieval for a table of queries: search, merge, re-rank, cite, answer, evaluate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenwell.fixed_texts import QUESTIONS
from screenwell.operators.sampling import repeat_rows
from screenwell.retrieval.bm25 import bm25_top, query_terms
from screenwell.retrieval.dense import dense_top, embed
from screenwell.retrieval.hybrid import (K_BM25, K_DENSE, K_FINAL, answers, cite, context_scores,
                                         merge_hits, only_sources, rerank, word_overlap)
from screenwell.session import broadcast_checked, cut_lineage
from screenwell.sources.index_store import Index


def retrieve(queries: DataFrame, index: Index, sources: list[str] | None = None,
             k_bm25: int = K_BM25, k_dense: int = K_DENSE, k_final: int = K_FINAL,
             scorer=word_overlap, encoder=None) -> DataFrame:
    """Final hits per query (query_id, query_text)."""
    index = index.select(lambda t: only_sources(t, sources))
    keyword = bm25_top(index.postings, index.term_stats, query_terms(queries), k_bm25)
    dense = dense_top(index.vectors, embed(queries, "query_text", "vector", encoder), k_dense)
    return rerank(merge_hits(keyword, dense, index.chunks), queries, k_final, scorer)


def answer_queries(queries: DataFrame, index: Index, replies: DataFrame | None = None,
                   **options) -> DataFrame:
    return answers(queries, cite(retrieve(queries, index, **options)), replies)


def evaluation_questions(spark: SparkSession, n: int = 50) -> DataFrame:
    """The fixed question set, repeated to ``n`` rows."""
    rows = [(i, q, t) for i, (q, t) in enumerate(QUESTIONS)]
    fixed = spark.createDataFrame(rows, "place long, question string, ground_truth string")
    return repeat_rows(fixed, "place", n)


def evaluate(questions: DataFrame, index: Index, **options) -> DataFrame:
    """Scored evaluation table for questions (question, ground_truth).

    Equal questions are searched once.
    """
    queries = cut_lineage(questions.select(F.col("question").alias("query_text")).distinct()
                          .withColumn("query_id", F.md5("query_text")))
    found = cut_lineage(answer_queries(queries, index, **options).select(
        F.col("query_text").alias("question"), "answer", "citations", "context_chunks"))
    return context_scores(questions.join(broadcast_checked(found), "question"))
