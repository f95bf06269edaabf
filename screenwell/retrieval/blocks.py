"""Postings in blocks of neighbouring chunks, each with what bounds its scores."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenwell.functions.text import words

BLOCK_BITS = 7
SHELF_BITS = 5
SEGMENT_BITS = 47


def in_blocks(chunks: DataFrame, segment: int = 0, bits: int = BLOCK_BITS) -> DataFrame:
    """Chunks with their ``words`` and ``block``: at most ``2 ** bits`` neighbours of a task, sorted
    by (source, chunk_id), share one. Numbers are unique over segments. They depend on the tasks:
    store the result before use."""
    ordered = chunks.sortWithinPartitions("source", "chunk_id")
    place = F.shiftright(F.monotonically_increasing_id(), bits)
    return ordered.withColumn("block", place + F.lit(segment << SEGMENT_BITS)).withColumn("words", words(F.col("text")))


def some_blocks(chunks: pa.Table, schema: pa.Schema) -> pa.Table:
    """The postings of some blocks of one source, a row per word and block, sorted by them: a count
    of (word, chunk) pairs by sorting. Rows in order come cheap to the sort that follows."""
    chunks = chunks.sort_by([("block", "ascending"), ("chunk_id", "ascending")])
    lists = chunks.column("words").combine_chunks()
    coded = lists.flatten().dictionary_encode()
    by_word = pc.array_sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(by_word), np.int64)
    place[by_word] = np.arange(len(by_word))
    length = lists.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    blocks, block = np.unique(chunks.column("block").to_numpy(), return_inverse=True)
    n = max(len(length), 1)
    pair, tf = np.unique(place[coded.indices.to_numpy(zero_copy_only=False)] * n + np.repeat(np.arange(len(length)), length),
                         return_counts=True)
    code, chunk = pair // n, pair % n
    row = code * max(len(blocks), 1) + block[chunk]
    dl, at = length[chunk], np.flatnonzero(np.diff(row, prepend=-1))
    ends = np.append(at, len(row))
    order = np.lexsort((dl, tf, row))
    best = order[np.flatnonzero((np.diff(row[order], prepend=-1) != 0) | (np.diff(tf[order], prepend=-1) != 0))]
    lists_of = lambda values, kind: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))
    pairs = pa.StructArray.from_arrays([pa.array(tf[best], pa.int32()), pa.array(dl[best], pa.int32())], ["tf", "dl"])
    return pa.Table.from_arrays([
        pa.array([chunks.column("source")[0].as_py()] * len(at), pa.string()), coded.dictionary.take(pa.array(by_word[code[at]])),
        pa.array(blocks[block[chunk[at]]], pa.int64()), pa.array(np.diff(ends), pa.int32()),
        pa.ListArray.from_arrays(pa.array(np.searchsorted(row[best], np.append(row[at], np.iinfo(np.int64).max)), pa.int32()), pairs),
        lists_of(chunks.column("chunk_id").combine_chunks().to_numpy()[chunk], pa.int64()),
        lists_of(tf, pa.int32()), lists_of(dl, pa.int32())], schema=schema)


def block_postings(chunks: DataFrame) -> DataFrame:
    """(source, term, block, n, tops, ids, tfs, dls) from chunks (source, block, chunk_id, words).

    ``tops`` has, for each tf in the block, its smallest dl: saturation rises with tf and falls with
    dl, so the best of these pairs is the block's maximum whatever the mean length of the corpus
    becomes. A task gets whole blocks of bounded size, ``2 ** SHELF_BITS`` of them at a time; its rows
    are sorted by word, so that readers can skip row groups.
    """
    schema = pa.schema([("source", pa.string()), ("term", pa.string()), ("block", pa.int64()), ("n", pa.int32()),
                        ("tops", pa.list_(pa.struct([("tf", pa.int32()), ("dl", pa.int32())]))),
                        ("ids", pa.list_(pa.int64())), ("tfs", pa.list_(pa.int32())), ("dls", pa.list_(pa.int32()))])
    rows = chunks.select("source", "block", F.col("chunk_id").cast("long").alias("chunk_id"), "words")
    return rows.groupBy("source", F.shiftright("block", SHELF_BITS)).applyInArrow(
        lambda t: some_blocks(t, schema), "source string, term string, block long, n int, tops array<struct<tf:int,dl:int>>, "
        "ids array<long>, tfs array<int>, dls array<int>").sortWithinPartitions("source", "term", "block")


def block_rows(blocks: DataFrame) -> DataFrame:
    """The postings of blocks, one row each: source, chunk_id, term, tf, dl."""
    zipped = F.arrays_zip("ids", "tfs", "dls")
    return blocks.select("source", "term", F.inline(zipped)).select(
        "source", F.col("ids").alias("chunk_id"), "term", F.col("tfs").cast("long").alias("tf"), F.col("dls").cast("long").alias("dl"))
