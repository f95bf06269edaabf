"""Joins that lookups become when both sides are tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def band_join(df: DataFrame, bands: DataFrame, value: str, name: str = "band") -> DataFrame:
    """Interval lookup against a table (lo, hi, band); values in no interval get the last band.

    The intervals become one sorted array in a single-row subquery, so the large side is neither
    shuffled nor multiplied and the band table is never joined row by row.
    """
    rows = bands.select(F.struct("lo", "hi", "band").alias("b")).agg(
        F.sort_array(F.collect_list("b")).alias("all")).select("all").scalar()
    held = df.withColumn("_bands", rows)
    hit = F.filter("_bands", lambda b: (F.col(value) >= b["lo"]) & (F.col(value) <= b["hi"]))
    found = F.coalesce(F.get(hit, F.lit(0))["band"], F.element_at("_bands", -1)["band"])
    return held.withColumn(name, found).drop("_bands")


def dictionary_join(df: DataFrame, table: DataFrame, key: str, default: dict) -> DataFrame:
    """Left equi-join to a dictionary table with defaults for missing keys."""
    return df.join(table, key, "left").na.fill(default)


def members(df: DataFrame, allowed: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(allowed.select(*keys), keys, "left_semi")


def not_members(df: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(seen.select(*keys), keys, "left_anti")
