"""Exact inner-product search and the default text encoder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenwell.functions.text import words
from screenwell.operators.sampling import top_per_group

DIGITS = 6
NO_HITS = pd.DataFrame({c: pd.Series([], dtype=object) for c in ("query_id", "source", "chunk_id", "score")})
QUERY_BLOCK, VECTOR_BLOCK, STEP = 4096, 65_536, 2048


def _slot(word: str, dim: int) -> int:
    return int(hashlib.md5(word.encode(), usedforsecurity=False).hexdigest()[:8], 16) % dim


def hashing_encoder(dim: int = 64) -> Callable[[Column], Column]:
    """Encoder: hashed word counts scaled to length 1 (all zeros without words)."""
    @F.arrow_udf("array<double>")
    def encode(lists: pa.Array) -> pa.Array:
        size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        coded = lists.flatten().dictionary_encode()
        slots = np.array([_slot(w, dim) for w in coded.dictionary.to_pylist()], dtype=np.int64)
        cell = np.repeat(np.arange(len(lists)), size) * dim + slots[coded.indices.to_numpy(zero_copy_only=False)]
        out = np.bincount(cell, minlength=len(lists) * dim).reshape(-1, dim).astype(float)
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return pa.ListArray.from_arrays(np.arange(len(lists) + 1, dtype=np.int32) * dim, (out / np.where(norm > 0, norm, 1.0)).ravel())

    return lambda text, split=True: encode(words(text) if split else text)


def embed_words(df: DataFrame, listed: str, out: str = "vector") -> DataFrame:
    """The default encoder on words that are split already."""
    return df.withColumn(out, hashing_encoder()(F.col(listed), split=False))


def embed(df: DataFrame, text: str, out: str = "vector",
          encoder: Callable[[Column], Column] | None = None) -> DataFrame:
    """Add a unit vector per text; ``encoder`` maps a text column to an array column."""
    return df.withColumn(out, (encoder or hashing_encoder())(F.col(text)))


def unit(vector: Column) -> Column:
    """Scale an array to length 1."""
    vector = vector.cast("array<double>")
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.transform(vector, lambda x: F.coalesce(F.try_divide(x, norm), F.lit(0.0)))


def _merged(query: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best entries of every query, ties by the larger id."""
    order = np.lexsort((-ids, -score, query))
    query, score, ids = query[order], score[order], ids[order]
    keep = np.arange(len(query)) - np.searchsorted(query, query) < k
    return query[keep], score[keep], ids[keep]


def _search(vectors: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """Best ``k`` rows of one block of vectors for one block of queries.

    Products are taken ``STEP`` vectors at a time; the best of each query so far are kept across the
    steps, and only scores that reach its k-th go on.
    """
    if vectors.empty or queries.empty:
        return NO_HITS
    matrix = np.vstack(queries["vector"].to_list()).T
    ids = vectors["chunk_id"].to_numpy()
    best = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, ids.dtype))
    least = np.full(matrix.shape[1], -np.inf)
    for at in range(0, len(vectors), STEP):
        scores = np.round(np.vstack(vectors["vector"].iloc[at:at + STEP].to_list()) @ matrix, DIGITS)
        edge = least
        if len(scores) > k:
            edge = np.maximum(least, np.partition(scores, len(scores) - k, axis=0)[len(scores) - k])
        row, query = np.nonzero(scores >= edge)
        best = _merged(np.concatenate([best[0], query]), np.concatenate([best[1], scores[row, query]]),
                       np.concatenate([best[2], ids[at + row]]), k)
        full = np.flatnonzero(np.bincount(best[0], minlength=len(least)) == k)
        least[full] = best[1][np.searchsorted(best[0], full, "right") - 1]
    return pd.DataFrame({"query_id": queries["query_id"].to_numpy()[best[0]], "source": vectors["source"].iloc[0],
                         "chunk_id": best[2], "score": best[1]})


def _by_source(vectors: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    return pd.concat([_search(part, queries, k) for _, part in vectors.groupby("source", dropna=False)] or [_search(vectors, queries, k)])


def dense_top(vectors: DataFrame, queries: DataFrame, k: int = 20, block: int = QUERY_BLOCK,
              vector_block: int = VECTOR_BLOCK) -> DataFrame:
    """Best ``k`` vectors by inner product per (query, source), exhaustively.

    ``vectors``: source, chunk_id, vector; ``queries``: query_id, vector. Both are cut by hash into
    blocks of about ``vector_block`` and ``block`` rows; a task gets one block of each and passes on
    k rows per query. Vectors are shuffled once per block of queries, nothing passes the driver, and
    no task or shuffle holds all query-vector pairs. Rows without a vector are left out.
    """
    kind = queries.schema["query_id"].dataType.simpleString()
    usable = vectors.where("vector is not null").select("source", "chunk_id", F.col("vector").cast("array<double>").alias("vector"))
    asked = queries.where("vector is not null").select("query_id", F.col("vector").cast("array<double>").alias("vector"))
    n_vectors, n_queries = usable.count(), asked.count()
    parts = max(1, -(-n_queries // block))
    ways = max(-(-n_vectors // vector_block), min(vectors.sparkSession.sparkContext.defaultParallelism, -(-n_vectors // STEP)), 1)
    way = F.sequence(F.lit(0), F.lit(ways - 1)).cast("array<bigint>")
    part = F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<bigint>")
    left = usable.withColumns({"_way": F.pmod(F.xxhash64("chunk_id"), F.lit(ways)), "_part": F.explode(part)})
    right = asked.withColumns({"_part": F.pmod(F.xxhash64("query_id"), F.lit(parts)), "_way": F.explode(way)})
    key = ["_way", "_part"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
        lambda a, b: _by_source(a, b, k), f"query_id {kind}, source string, chunk_id long, score double")
    return top_per_group(found, ["query_id", "source"], "score", "chunk_id", k)
