"""Hybrid retrieval: keyword and vector hits merged, re-ranked and cited."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenwell.fixed_values import CONTEXT_SEPARATOR, NO_HIT_ANSWER
from screenwell.functions.text import words
from screenwell.operators.sampling import top_per_group
from screenwell.session import broadcast_checked, cut_lineage

K_BM25, K_DENSE, K_FINAL = 20, 20, 5


def only_sources(df: DataFrame, sources: list[str] | None) -> DataFrame:
    """Rows of the wanted sources: None keeps all, an empty list none."""
    if sources is None:
        return df
    return df.filter(F.col("source").isin(*sources)) if sources else df.limit(0)


def word_overlap(query: Column, text: Column) -> Column:
    """Default pair scorer: share of the query's distinct words found in the text."""
    q = F.array_distinct(words(query))
    shared = F.size(F.array_intersect(q, words(text)))
    return F.coalesce(F.try_divide(shared.cast("double"), F.size(q)), F.lit(0.0))


def merge_hits(keyword: DataFrame, dense: DataFrame, chunks: DataFrame,
               prefix: int | None = None) -> DataFrame:
    """Union of both hit lists with chunk text; per (query, source) the first hit of each text stays,
    keyword hits before vector hits. With ``prefix``, texts that share so many characters are one."""
    tagged = cut_lineage(keyword.withColumn("origin", F.lit(0)).unionByName(
        dense.withColumn("origin", F.lit(1))))
    joined = chunks.join(broadcast_checked(tagged), ["source", "chunk_id"])
    w = Window.partitionBy("query_id", "source", F.md5("text") if prefix is None else F.substring("text", 1, prefix)).orderBy(
        "origin", "rank")
    return joined.withColumn("_first", F.row_number().over(w)).filter("_first = 1").drop("_first")


def rerank(candidates: DataFrame, queries: DataFrame, k: int = K_FINAL,
           scorer: Callable[[Column, Column], Column] | None = word_overlap) -> DataFrame:
    """Final ``k`` per query by the pair scorer; a lone candidate keeps its raw score.

    Without a scorer both raw scores are sorted on one scale.
    """
    raw = F.col("score")
    ranked = candidates
    if scorer is not None:
        alone = F.count("*").over(Window.partitionBy("query_id")) == 1
        ranked = ranked.join(queries.select("query_id", "query_text"), "query_id").withColumn(
            "score", F.when(alone, raw).otherwise(
                scorer(F.col("query_text"), F.col("text")))).drop("query_text")
    # Equal scores keep candidate order: source, keyword hits, rank.
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "source", "origin", "rank")
    return ranked.withColumn("final_rank", F.row_number().over(w)).filter(F.col("final_rank") <= k)


def fuse_ranks(candidates: DataFrame, k: int = K_FINAL, constant: int = 60) -> DataFrame:
    """Optional reciprocal-rank fusion of both hit lists instead of a pair scorer."""
    share = F.lit(1.0) / (F.col("rank") + constant)
    fused = candidates.groupBy("query_id", "source", "chunk_id").agg(F.sum(share).alias("score"))
    return top_per_group(fused, ["query_id"], "score", "chunk_id", k)


def cite(final: DataFrame) -> DataFrame:
    """One row per query: context, citations (score to 4 digits) and chunk labels in rank order.

    A group holds at most the final k rows.
    """
    named = lambda c: F.col(c) if c in final.columns else F.lit(None).cast("string")
    entry = F.struct("final_rank", "text", F.struct(
        "source", named("pmid").alias("pmid"), named("disorder").alias("disorder"),
        named("title").alias("title"), F.round("score", 4).alias("score")).alias("c"))
    grouped = final.groupBy("query_id").agg(F.sort_array(F.collect_list(entry)).alias("_rows"))
    label = lambda c: F.coalesce(F.nullif(c["title"], F.lit("")), c["disorder"], F.lit(""))
    return grouped.select(
        "query_id", F.array_join(F.transform("_rows", lambda r: r["text"]),
                                 CONTEXT_SEPARATOR).alias("context"),
        F.transform("_rows", lambda r: r["c"]).alias("citations"),
        F.transform("_rows", lambda r: label(r["c"])).alias("context_chunks"))


def answers(queries: DataFrame, cited: DataFrame, replies: DataFrame | None = None) -> DataFrame:
    """Answer, citations and chunk labels for every query.

    A query without hits gets the fixed refusal; written answers come in as a table
    (query_id, answer). Without one, a query with hits is answered by its context.
    """
    out = queries.join(cited, "query_id", "left")
    answer = F.col("context")
    if replies is not None:
        out = out.join(replies.select("query_id", F.col("answer").alias("_reply")), "query_id",
                       "left")
        answer = F.col("_reply")
    empty = F.coalesce(F.col("context"), F.lit("")) == ""
    none = F.expr("CAST(array() AS array<struct<source:string,pmid:string,disorder:string,"
                  "title:string,score:double>>)")
    return out.withColumns({
        "answer": F.when(empty, NO_HIT_ANSWER).otherwise(F.coalesce(answer, F.lit(NO_HIT_ANSWER))),
        "citations": F.when(empty, none).otherwise(F.col("citations")),
        "context_chunks": F.when(empty, F.expr("CAST(array() AS array<string>)"))
        .otherwise(F.col("context_chunks"))}).drop("context", "_reply")


def differential(citations: Column, criteria_source: str = "dsm") -> Column:
    """Disorders cited from the criteria source, in citation order."""
    kept = F.filter(citations, lambda c: (c["source"] == criteria_source)
                    & (F.coalesce(c["disorder"], F.lit("")) != ""))
    return F.transform(kept, lambda c: c["disorder"])


def context_scores(df: DataFrame, contexts: str = "context_chunks", truth: str = "ground_truth",
                   answer: str = "answer") -> DataFrame:
    """Word-based evaluation columns for a question table.

    ``context_precision``: share of contexts that hold a word of the truth; ``context_recall``:
    share of the truth's words found in the contexts; ``answer_overlap``: the same in the answer.
    """
    want = F.array_distinct(words(F.col(truth)))
    useful = F.size(F.filter(F.col(contexts), lambda c: F.arrays_overlap(words(c), want)))
    joined = words(F.array_join(contexts, " "))
    part = lambda have: F.coalesce(F.try_divide(
        F.size(F.array_intersect(want, have)).cast("double"), F.size(want)), F.lit(0.0))
    return df.withColumns({
        "context_precision": F.coalesce(F.try_divide(useful.cast("double"), F.size(contexts)),
                                        F.lit(0.0)),
        "context_recall": part(joined), "answer_overlap": part(words(F.col(answer)))})


def mean_scores(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count("*").alias("n"), *[F.avg(c).alias(c) for c in (
        "context_precision", "context_recall", "answer_overlap")])
