"""Search index in immutable segments: created, appended to, merged, and loaded without rebuilding.

A folder holds segments (chunks, blocked postings, vectors, word counts, totals) and numbered
manifests. A manifest names its segments, their tables' schemas, and the table of corpus statistics
that belongs to this state. Every change writes new tables first and its manifest last, so readers
see the old state or the new one. Of two writers that start from one manifest, the second fails.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from screenwell.retrieval.blocks import block_postings, in_blocks
from screenwell.retrieval.chunks import corpus_stats
from screenwell.retrieval.dense import embed, embed_words
from screenwell.session import own_folder


@dataclass
class Index:
    """Tables of a search index; every one has a ``source`` column."""

    chunks: DataFrame
    postings: DataFrame
    term_stats: DataFrame
    vectors: DataFrame

    TABLES = ("chunks", "postings", "term_stats", "vectors")

    def select(self, keep) -> Index:
        """The same index with ``keep`` applied to every table."""
        return Index(*[keep(getattr(self, t)) for t in self.TABLES])


# ---- manifests -----------------------------------------------------------------------------------

def _files(spark: SparkSession, path: str):
    """(file system, path) of a folder in whatever store it lies."""
    held = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return held.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), held


def latest(spark: SparkSession, folder: str) -> dict | None:
    """The newest manifest of an index, or None."""
    fs, path = _files(spark, f"{folder}/manifest")
    if not fs.exists(path):
        return None
    names = sorted(s.getPath().getName() for s in fs.listStatus(path) if s.getPath().getName().endswith(".json"))
    return json.loads(spark.read.text(f"{folder}/manifest/{names[-1]}", wholetext=True).first()[0]) if names else None


def _publish(spark: SparkSession, folder: str, manifest: dict) -> None:
    """Write a manifest under its version; fails when that version is there already."""
    name = f"{folder}/manifest/{manifest['version']:08d}.json"
    fs, path = _files(spark, f"{name}.{uuid.uuid4().hex}")
    out = fs.create(path, False)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    _, final = _files(spark, name)
    if fs.exists(final) or not fs.rename(path, final):
        fs.delete(path, False)
        raise FileExistsError(f"another writer has published version {manifest['version']}")


# ---- segments ------------------------------------------------------------------------------------

def _write_segment(spark: SparkSession, folder: str, number: int, chunks: DataFrame, encoder=None,
                   vectors: DataFrame | None = None) -> dict:
    """Write one segment and give its entry in the manifest. Each table is written once and read
    back for the next one; postings are sorted by word within their source."""
    name = f"segment-{number:06d}-{uuid.uuid4().hex[:8]}"
    schemas = {}

    def stored(table: str, df: DataFrame, split: bool = True) -> DataFrame:
        path = f"{folder}/{name}/{table}"
        (df.write.partitionBy("source") if split else df.write).parquet(path)
        schemas[table] = json.loads(StructType(sorted(df.schema.fields, key=lambda f: split and f.name == "source")).json())
        return spark.read.schema(StructType.fromJson(schemas[table])).parquet(path)

    held = stored("chunks", in_blocks(chunks, number).withColumn("n_words", F.coalesce(F.size("words"), F.lit(0))))
    blocks = stored("postings", block_postings(held))
    stored("terms", blocks.groupBy("source", "term").agg(F.sum("n").alias("df")), False)
    stored("totals", held.groupBy("source").agg(F.count("*").alias("n_chunks"), F.sum("n_words").alias("n_words")), False)
    if vectors is None:
        vectors = embed(held, "text", "vector", encoder) if encoder else embed_words(held, "words", "vector")
    stored("vectors", vectors.select("source", "chunk_id", "vector"))
    return {"name": name, "number": number, "schemas": schemas}


def _table(spark: SparkSession, folder: str, segments: list[dict], table: str) -> DataFrame:
    """One table over all segments; columns that a segment lacks are null there."""
    out = None
    for s in segments:
        df = spark.read.schema(StructType.fromJson(s["schemas"][table])).parquet(f"{folder}/{s['name']}/{table}")
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def _commit(spark: SparkSession, folder: str, version: int, segments: list[dict]) -> None:
    """Write the statistics over all segments, then the manifest that names them."""
    counts = _table(spark, folder, segments, "terms").groupBy("source", "term").agg(F.sum("df").alias("df"))
    totals = _table(spark, folder, segments, "totals").groupBy("source").agg(
        F.sum("n_chunks").alias("n_chunks"), F.sum("n_words").alias("n_words"))
    stats = corpus_stats(counts, totals)
    name = f"stats-{version:08d}-{uuid.uuid4().hex[:8]}"
    stats.write.parquet(f"{folder}/{name}")
    _publish(spark, folder, {"version": version, "segments": segments, "stats": name, "stats_schema": json.loads(stats.schema.json())})


def create_index(spark: SparkSession, folder: str, chunks: DataFrame, encoder=None) -> None:
    """Store an index over chunks (source, chunk_id, text and further metadata columns)."""
    if latest(spark, folder) is not None:
        raise FileExistsError(f"{folder} has an index")
    _commit(spark, folder, 1, [_write_segment(spark, folder, 0, chunks, encoder)])


def append_chunks(spark: SparkSession, folder: str, chunks: DataFrame, encoder=None) -> None:
    """Add chunks as a new segment; the others stay as they are, statistics cover all of them.

    A (source, chunk_id) that is there already is an error, also within ``chunks``.
    """
    now = latest(spark, folder)
    known = _table(spark, folder, now["segments"], "chunks").select("source", "chunk_id")
    fresh = chunks.select("source", "chunk_id")
    if not fresh.join(known, ["source", "chunk_id"], "left_semi").isEmpty() or not fresh.groupBy(
            "source", "chunk_id").count().where("count > 1").isEmpty():
        raise ValueError("chunks that the index has already")
    number = 1 + max(s["number"] for s in now["segments"])
    _commit(spark, folder, now["version"] + 1, [*now["segments"], _write_segment(spark, folder, number, chunks, encoder)])


def merge_segments(spark: SparkSession, folder: str) -> None:
    """One segment in place of all: blocks are cut anew, vectors are taken over."""
    now = latest(spark, folder)
    chunks = _table(spark, folder, now["segments"], "chunks").drop("block", "words", "n_words")
    number = 1 + max(s["number"] for s in now["segments"])
    one = _write_segment(spark, folder, number, chunks, vectors=_table(spark, folder, now["segments"], "vectors"))
    _commit(spark, folder, now["version"] + 1, [one])


def load_index(spark: SparkSession, folder: str, sources: list[str] | None = None) -> Index:
    """The newest state of a stored index; with ``sources`` only their folders are read."""
    now = latest(spark, folder)
    if now is None:
        raise FileNotFoundError(f"no index in {folder}")
    chunks, post, vectors = (_table(spark, folder, now["segments"], t) for t in ("chunks", "postings", "vectors"))
    stats = spark.read.schema(StructType.fromJson(now["stats_schema"])).parquet(f"{folder}/{now['stats']}")
    index = Index(chunks.drop("block", "words", "n_words"), post, stats, vectors)
    return index if sources is None else index.select(lambda t: t.where(F.col("source").isin(sources)))


def build_index(chunks: DataFrame, encoder=None) -> Index:
    """An index over chunks in a new folder of the shared location."""
    spark = chunks.sparkSession
    folder = f"{own_folder(spark)}/index-{uuid.uuid4().hex}"
    create_index(spark, folder, chunks, encoder)
    return load_index(spark, folder)
