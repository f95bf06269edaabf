"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenwell.llm.store import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) for each vertex of ``edges`` (columns a, b); component: the smallest id.

    Alternates two star steps (Kiveris et al., 2014): neighbours above a vertex, then those below
    it, move to its smallest neighbour, until nothing changes. Every step is a minimum with
    map-side combine and a join; each round is written to the shared folder and replaces the one
    before. An edgeless vertex has no row; an empty table gives an empty one.
    """
    def toward_least(pairs: DataFrame) -> DataFrame:
        least = pairs.groupBy("u").agg(F.min("v").alias("m"))
        return pairs.join(least, "u")

    own = Scratch(scratch.spark)
    now = own.cut(edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    print_of = [F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
    state = now.agg(*print_of).first()
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = toward_least(both).select(F.col("v").alias("u"), F.least("u", "m").alias("v"),
                                          (F.col("v") > F.col("u")).alias("up"))
        large = large.where("up and u > v").select("u", "v").distinct()
        pulled = toward_least(large)
        later = Scratch(scratch.spark)
        then = later.cut(pulled.select("u", F.col("m").alias("v")).union(
            pulled.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct())
        after = then.agg(*print_of).first()
        own.delete()
        if after == state:
            out = scratch.cut(then.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
                then.select("v", "v").distinct()))
            later.delete()
            return out
        now, state, own = then, after, later
