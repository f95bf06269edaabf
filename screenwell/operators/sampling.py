"""Repeatable samples, top lists and repeated question sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def fixed_sample(df: DataFrame, key: str, n: int, seed: int = 42,
                 method: str = "xxhash") -> DataFrame:
    """Exactly min(n, rows) rows, the same for the same seed and data.

    Rows are ordered by a hash of the key; each task keeps n rows before the final merge.
    """
    salted = F.concat_ws("/", F.lit(str(seed)), F.col(key).cast("string"))
    order = F.md5(salted) if method == "md5" else F.xxhash64(salted)
    return df.orderBy(order, key).limit(n)


def top_per_group(df: DataFrame, groups: list[str], score: str, tie: str, k: int) -> DataFrame:
    """Best ``k`` rows per group with their rank; ties by the larger ``tie`` value first.

    The rank filter lets Spark trim every task to k rows per group before the shuffle.
    """
    w = Window.partitionBy(*groups).orderBy(F.desc(score), F.desc(tie))
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def repeat_rows(df: DataFrame, place: str, n: int) -> DataFrame:
    """Repeat a table in order until it has ``n`` rows; ``place`` numbers its rows from 0."""
    held = df.withColumn("_size", df.select(F.count("*")).scalar())
    copies = F.sequence(F.lit(0), F.floor((F.lit(n - 1) - F.col(place)) / F.col("_size")))
    return (held.filter(F.col(place) < n)
            .withColumn("_copy", F.explode(copies))
            .withColumn("position", F.col("_copy") * F.col("_size") + F.col(place))
            .drop("_size", "_copy"))
