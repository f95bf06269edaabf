"""Summary tables: bands, rates, splits, prevalence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenwell.fixed_values import IDEATION_ITEM


def band_distribution(df: DataFrame, band: str = "phq9_band") -> DataFrame:
    return df.groupBy(band).agg(F.count("*").alias("n")).orderBy(F.desc("n"), band)


def ideation_by_band(df: DataFrame, band: str = "phq9_band") -> DataFrame:
    """Share of records with a positive item 9 and row count per band."""
    return df.groupBy(band).agg(F.avg((F.col(IDEATION_ITEM) > 0).cast("double")).alias("si_rate"),
                                F.count("*").alias("n")).orderBy(band)


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("n")).orderBy("split")


def label_by_split(df: DataFrame) -> DataFrame:
    return df.groupBy("split", "label").agg(F.count("*").alias("n")).orderBy(
        "split", F.desc("n"), "label")


def split_and_label_totals(df: DataFrame) -> DataFrame:
    """Both tables above in one pass: totals per split carry a NULL label."""
    return df.rollup("split", "label").agg(F.count("*").alias("n")).filter(
        F.col("split").isNotNull())


def ideation_flag(df: DataFrame) -> DataFrame:
    """Global count and rate of a positive item 9."""
    flag = F.col(IDEATION_ITEM) > 0
    return df.agg(F.count("*").alias("n"), F.count_if(flag).alias("n_flagged"),
                  F.avg(flag.cast("double")).alias("flag_rate"))


def population_checks(df: DataFrame) -> DataFrame:
    """Correlation of both totals, prevalence of a total of at least 10, ideation rate ratio."""
    flag = (F.col(IDEATION_ITEM) > 0).cast("double")
    rate = lambda name: F.avg(F.when(F.col("phq9_band") == name, flag))
    return df.agg(F.corr(F.col("phq9_total").cast("double"), F.col("gad7_total").cast("double"))
                  .alias("total_correlation"),
                  F.avg((F.col("phq9_total") >= 10).cast("double")).alias("prevalence_10"),
                  rate("none").alias("si_rate_none"), rate("severe").alias("si_rate_severe"))
