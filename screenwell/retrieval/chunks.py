"""Chunks, postings and corpus statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenwell.functions.text import words
from screenwell.session import cut_lineage, fits


K1, B = 1.5, 0.75


def saturation(tf: Column, dl: Column, avg_dl: Column) -> Column:
    """Term-frequency part of BM25."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / avg_dl))


def chunk_text(df: DataFrame, text: str = "text", size: int = 512, overlap: int = 64) -> DataFrame:
    """One row per chunk with its position; empty text has none.

    A short last chunk may lie wholly inside the one before it.
    """
    stride = size - overlap
    length = F.length(text)
    starts = F.sequence(F.lit(0), length - 1, F.lit(stride))
    parts = F.transform(starts, lambda i: F.substring(F.col(text), i + 1, F.lit(size)))
    others = [c for c in df.columns if c != text]
    return df.filter(length > 0).select(*others, F.posexplode(parts).alias("chunk_no", text))


def number_chunks(df: DataFrame, key: str = "doc_id", width: int = 1_000_000) -> DataFrame:
    """Add ``chunk_id``: document id and chunk position in one ordered number."""
    return df.withColumn("chunk_id", F.col(key) * F.lit(width) + F.col("chunk_no"))


def postings(chunks: DataFrame, text: str = "text") -> DataFrame:
    """(source, chunk_id, term, tf, dl), one row per distinct word of a chunk.

    Word counts are taken inside the chunk's own row, so building postings needs no shuffle.
    """
    keys = ["source", "chunk_id"]
    listed = chunks.select(*keys, words(F.col(text)).alias("_words"))
    size = F.size("_words").alias("dl")
    # Counted before the explode, so that no output row carries the word list.
    counted = F.transform(F.array_distinct("_words"), lambda w: F.struct(
        w.alias("term"), (F.size("_words") - F.size(F.array_remove(F.col("_words"), w))).alias("tf")))
    return listed.select(*keys, F.inline(counted), size).select(*keys, "term", "tf", "dl")


def corpus_stats(counts: DataFrame, totals: DataFrame, epsilon: float = 0.25) -> DataFrame:
    """(source, term, df, n_chunks, avg_dl, idf) from document frequencies (source, term, df) and
    totals (source, n_chunks, n_words); chunks without words count.

    A negative idf (a term in more than half of the chunks) becomes ``epsilon`` times the mean
    idf of the source. The values are stored, being needed for the mean and for the result.
    ``totals`` and the means have one row per source and are broadcast when those are few.
    """
    hint = F.broadcast if fits(totals, 10_000) else lambda df: df
    n = F.col("n_chunks")
    raw = cut_lineage(counts.join(hint(totals), "source").select(
        "source", "term", "df", "n_chunks", (F.col("n_words") / n).alias("avg_dl"),
        (F.ln(n - F.col("df") + 0.5) - F.ln(F.col("df") + 0.5)).alias("_idf")))
    means = raw.groupBy("source").agg(F.avg("_idf").alias("_mean"))
    floor = F.when(F.col("_idf") < 0, F.col("_mean") * epsilon).otherwise(F.col("_idf"))
    return raw.join(hint(means), "source").select("source", "term", "df", "n_chunks", "avg_dl", floor.alias("idf"))
