"""Benchmark decontamination: short test items that long documents contain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenwell.llm.store import Scratch, small

WORDS, SHARE = 5, 0.8


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingled(rows: DataFrame, make, n: int = WORDS) -> DataFrame:
    """Column text becomes column own: ``make`` of each n neighbouring words; a shorter text is one
    shingle, one without words has none. The words are a column first, made once per row."""
    w = F.col("_words")
    own = (F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(0), F.size(w) - n),
                                              lambda i: make(*[F.get(w, i + k) for k in range(n)])))
           .when(F.size(w) > 0, F.array(make(F.array_join(w, " "))))
           .otherwise(F.array().cast(f"array<{'bigint' if make is F.xxhash64 else 'string'}>")))
    return rows.withColumn("_words", words(F.col("text"))).drop("text").withColumn("own", own).drop("_words")


def joined(*parts: Column) -> Column:
    return F.concat_ws(" ", *parts)


def items_of(benchmark: DataFrame, share: float) -> DataFrame:
    """A row per distinct (item_id, text): shingles, their number, and how many may be missing.

    Items are partitioned by size, each twice as wide as the last. An item that is contained by
    ``share`` lacks at most size - ceil(share * size) shingles, so of one more than the largest such
    number in its partition at least one must be in the document. That number is computed as in the
    check of ``contained``, with the same 1e-9 for shares that floating point does not hold.
    """
    rows = shingled(benchmark.select("item_id", "text"), joined).withColumn("own", F.array_distinct("own"))
    rows = rows.where(F.size("own") > 0).distinct().withColumn("item", F.xxhash64("item_id", "own"))
    top = F.lit(2).cast("double") ** (F.floor(F.log2(F.size("own"))) + 1) - 1
    return rows.withColumn("probes", top - F.ceil(top * share - 1e-9) + 1)


def sketch(items: DataFrame) -> DataFrame:
    """(item, h): the ``probes`` smallest shingle hashes of each item (bottom-k MinHash)."""
    hashed = F.array_sort(F.transform("own", lambda s: F.struct(F.xxhash64(F.lit(11), s), s.alias("s"))))
    picked = F.slice(hashed, 1, F.col("probes").cast("int"))
    return items.select("item", F.explode(F.transform(picked, lambda x: hash_of_shingle(x["s"]))).alias("h"))


def hash_of_shingle(text: Column) -> Column:
    """The hash of a shingle's text that ``hash_of_words`` gives for its words."""
    w = F.split(text, " ")
    return F.when(F.size(w) == WORDS, F.xxhash64(*[F.get(w, F.lit(k)) for k in range(WORDS)])).otherwise(
        F.xxhash64(text))


def contained(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, text_key, item_id, n_shared, n_item, containment) for each document and each item of
    which at least ``share`` of the distinct five-word shingles are in the document.

    The search has no false negatives: each item is looked up by as many of its smallest shingle
    hashes as its size partition can lack, plus one; every hit is then counted exactly on the words
    themselves. Only hits leave the tasks: the sketch of the benchmark is small and is broadcast as
    long as its written size allows, beyond that the join is dealt out by hash.

    Words are runs of letters and digits, without regard to case. A text of fewer than five words is
    one shingle; one without words (null, empty) contains nothing and is contained nowhere. Rows
    that repeat an id and text give one row; a null id is an id like others.
    """
    own = scratch or Scratch(docs.sparkSession)
    items = own.cut(items_of(benchmark, share))
    probes = own.cut(sketch(items))
    key = F.xxhash64("text").alias("text_key")
    # explode_outer: for explode, a filter on the array is inferred and pushed below the words
    hits = (shingled(docs.select("doc_id", key, "text"), F.xxhash64)
            .select("doc_id", "text_key", F.explode_outer("own").alias("h"))
            .join(small(probes), "h").select("doc_id", "text_key", "item").distinct())
    hits = own.cut(hits)
    texts = shingled(docs.select("doc_id", key, "text").join(
        small(hits.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k")).distinct()),
        F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")), "left_semi"), joined)
    texts = texts.select("doc_id", "text_key", F.array_distinct("own").alias("theirs"))
    pairs = hits.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "item")
    out = (texts.join(small(pairs), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")))
           .join(small(items), "item")
           .select("doc_id", "text_key", "item_id", F.size(F.array_intersect("theirs", "own")).cast("long").alias("n_shared"),
                   F.size("own").cast("long").alias("n_item")))
    return (out.where(F.col("n_shared") >= share * F.col("n_item") - 1e-9).distinct()
            .withColumn("containment", F.col("n_shared") / F.col("n_item")))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """The rows of ``docs`` that contain no item; same columns, clean rows untouched."""
    scratch = Scratch(docs.sparkSession)
    bad = scratch.cut(contained(docs, benchmark, share, scratch).select(
        F.col("doc_id").alias("_d"), F.col("text_key").alias("_k")).distinct())
    return docs.join(small(bad), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.xxhash64("text") == F.col("_k")), "left_anti")
