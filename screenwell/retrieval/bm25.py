"""Exact BM25 top-k for a table of queries over postings in blocks with known score bounds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from screenwell.functions.text import words
from screenwell.operators.sampling import top_per_group
from screenwell.retrieval.chunks import B, K1, saturation
from screenwell.session import broadcast_checked, cut_lineage

DIGITS = 6
# Bounds are compared with scores rounded to DIGITS.
SLACK = 1e-5
GROUP = ["query_id", "source"]
FIRST_BLOCKS, MORE = 4, 1024
TERMS_PUSHED = 512
QUERIES_PER_TASK, QUERY_ROWS = 2048, 256


def query_terms(queries: DataFrame, text: str = "query_text") -> DataFrame:
    """(query_id, term, times): words of each query with their number of uses."""
    return queries.select("query_id", F.explode(words(F.col(text))).alias("term")).groupBy(
        "query_id", "term").agg(F.count("*").alias("times"))


def block_top() -> Column:
    """Largest saturation of a block's postings: their best (tf, dl) pairs hold it for any corpus."""
    return F.array_max(F.transform("tops", lambda t: saturation(t["tf"], t["dl"], F.col("avg_dl"))))


def weighted_terms(terms: DataFrame, stats: DataFrame) -> DataFrame:
    """(query_id, source, term, weight, avg_dl): weight is uses times idf."""
    return stats.join(broadcast_checked(terms), "term").select(
        *GROUP, "term", (F.col("times") * F.col("idf")).alias("weight"), "avg_dl")


def block_bounds(blocks: DataFrame, used: DataFrame) -> DataFrame:
    """(query_id, source, block, bound, place): the most a block's chunks can score for a query, and
    its place among the query's blocks. Only block heads are read here, no postings."""
    means = used.select("source", "term", "avg_dl").distinct()
    heads = blocks.select("source", "term", "block", "tops").join(broadcast_checked(means), ["source", "term"]).select(
        "source", "term", "block", block_top().alias("top"))
    sums = heads.join(broadcast_checked(used.where("weight > 0").drop("avg_dl")), ["source", "term"]).groupBy(
        *GROUP, "block").agg(F.sum(F.col("weight") * F.col("top")).alias("bound"))
    order = Window.partitionBy(*GROUP).orderBy(F.desc("bound"), "block")
    return sums.where("bound > 0").withColumn("place", F.row_number().over(order))


def block_scores(left: pa.Table, right: pa.Table, k: int, schema: pa.Schema) -> pa.Table:
    """The ``k`` best chunks of one block for each of some queries, none below its threshold.

    ``left``: query_id, source, terms, weights, avg_dl, least; ``right``: term, ids, tfs, dls.
    """
    if not left.num_rows or not right.num_rows:
        return schema.empty_table()
    flat = lambda table, c: table.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    sizes = lambda table, c: table.column(c).combine_chunks().value_lengths().to_numpy()
    ids, column = np.unique(flat(right, "ids"), return_inverse=True)
    tf, dl = (flat(right, c).astype(float) for c in ("tfs", "dls"))
    table = np.zeros((right.num_rows, len(ids)))
    table[np.repeat(np.arange(right.num_rows), sizes(right, "ids")), column] = tf * (K1 + 1) / (
        tf + K1 * (1 - B + B * dl / left.column("avg_dl")[0].as_py()))
    row = pc.index_in(left.column("terms").combine_chunks().flatten(), right.column("term").combine_chunks())
    row = row.fill_null(-1).to_numpy(zero_copy_only=False)
    query = np.repeat(np.arange(left.num_rows), sizes(left, "terms"))
    weight, known = flat(left, "weights"), row >= 0
    query, row, weight = query[known], row[known], weight[known]
    asked, low = left.column("query_id").combine_chunks(), left.column("least").to_numpy()
    out = []
    for at in range(0, left.num_rows, QUERY_ROWS):
        n = min(QUERY_ROWS, left.num_rows - at)
        own = slice(*np.searchsorted(query, [at, at + n]))
        weights = np.zeros((n, right.num_rows))
        weights[query[own] - at, row[own]] = weight[own]
        scores = np.round(weights @ table, DIGITS)
        least = np.maximum(low[at:at + n], 10.0 ** -DIGITS)
        if len(ids) > k:
            least = np.maximum(least, np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k])
        q, c = np.nonzero(scores >= least[:, None])
        order = np.lexsort((-ids[c], -scores[q, c], q))
        q, c = q[order], c[order]
        keep = np.arange(len(q)) - np.searchsorted(q, q) < k
        q, c = q[keep], c[keep]
        out.append(pa.Table.from_arrays([asked.take(pa.array(q + at)), pa.array([left.column("source")[0].as_py()] * len(q), pa.string()),
                                         pa.array(ids[c], pa.int64()), pa.array(scores[q, c])], schema=schema))
    return pa.concat_tables(out)


def scored(blocks: DataFrame, packed: DataFrame, pairs: DataFrame, k: int, ways: int) -> DataFrame:
    """Best chunks of every (query, block) pair (columns query_id, source, block, least).

    A group is one block with up to about ``QUERIES_PER_TASK`` queries: its postings come once per
    such set of queries, each query with its words as arrays, and the scores are one product of
    matrices inside the task.
    """
    kind = packed.schema["query_id"].dataType
    schema = pa.schema([("query_id", to_arrow_type(kind)), ("source", pa.string()), ("chunk_id", pa.int64()), ("score", pa.float64())])
    way = F.pmod(F.xxhash64("query_id"), F.lit(ways)).cast("int")
    left = pairs.join(packed, GROUP).select(*GROUP, "block", "least", "terms", "weights", "avg_dl", way.alias("way"))
    wanted = pairs.select("source", "block", way.alias("way")).distinct()
    right = blocks.select("source", "block", "term", "ids", "tfs", "dls").join(broadcast_checked(wanted), ["source", "block"])
    key = ["source", "block", "way"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        lambda a, b: block_scores(a, b, k, schema), f"query_id {kind.simpleString()}, source string, chunk_id long, score double")


def bm25_top(blocks: DataFrame, stats: DataFrame, terms: DataFrame, k: int = 20) -> DataFrame:
    """Best ``k`` chunks with a positive score per (query, source), ties by the larger chunk_id.

    ``blocks``: postings of ``retrieval.blocks``; ``stats``: source, term, idf, avg_dl. Block-max
    search in rounds: the blocks with the highest bounds of each query are scored first, its k-th
    score becomes its threshold, and further blocks are scored only while their bound reaches it, each
    round ``MORE`` times as many. No chunk of the blocks left out can be among the best. The pairs of
    a round and the best so far are stored, so that every round starts from written tables.
    """
    used = cut_lineage(weighted_terms(terms, stats))
    names = [r[0] for r in used.select("term").distinct().limit(TERMS_PUSHED + 1).collect()]
    if len(names) <= TERMS_PUSHED:
        blocks = blocks.where(F.col("term").isin(names))
    blocks = blocks.join(broadcast_checked(used.select("source", "term").distinct()), ["source", "term"], "left_semi")
    packed = used.groupBy(*GROUP, "avg_dl").agg(F.collect_list(F.struct("term", "weight")).alias("_t")).select(
        *GROUP, "avg_dl", F.col("_t.term").alias("terms"), F.col("_t.weight").alias("weights"))
    bounds = cut_lineage(block_bounds(blocks, used))
    queries = used.agg(F.count_distinct("query_id")).first()[0]
    ways = max(1, -(-queries // QUERIES_PER_TASK))
    best, low, high = None, 0, FIRST_BLOCKS
    while True:
        pairs = bounds.where((F.col("place") > low) & (F.col("place") <= high))
        if best is None:
            pairs = pairs.withColumn("least", F.lit(0.0))
        else:
            kth = best.where(F.col("rank") == k).select(*GROUP, F.col("score").alias("least"))
            open_bounds = bounds.where(F.col("place") > low).join(broadcast_checked(kth), GROUP, "left").withColumn(
                "least", F.coalesce("least", F.lit(0.0))).where(F.col("bound") >= F.col("least") - SLACK)
            # The blocks of a query lie in falling order of their bounds: once one is below, all are.
            pairs = cut_lineage(open_bounds.where(F.col("place") <= high))
            if pairs.isEmpty():
                return best
        found = scored(blocks, packed, pairs, k, ways)
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        best = cut_lineage(top_per_group(found, GROUP, "score", "chunk_id", k))
        low, high = high, high * MORE
