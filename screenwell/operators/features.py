"""Model inputs: derived columns, standardisation, codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenwell.fixed_values import (BAND_ORDER, BINARY_FEATURES, CATEGORICAL_FEATURES,
                                     DERIVED_FEATURES, IDEATION_ITEM, NUMERIC_FEATURES)
from screenwell.functions.bands import class_code


def add_derived(df: DataFrame) -> DataFrame:
    """Item clusters, ideation flag and the ratio of both totals."""
    return df.withColumns({
        "somatic_cluster": F.col("phq3_sleep") + F.col("phq4_fatigue") + F.col("phq5_appetite"),
        "cognitive_cluster": F.col("phq6_self_worth") + F.col("phq7_concentration"),
        "gad_physical_cluster": F.col("gad4_trouble_relaxing") + F.col("gad5_restless"),
        "si_flag": (F.col(IDEATION_ITEM) > 0).cast("int"),
        "phq_gad_ratio": F.col("phq9_total") / (F.col("gad7_total") + F.lit(1.0)),
    })


def fit_scaler(train: DataFrame, columns: list[str]) -> DataFrame:
    """One row: mean and population standard deviation per column, in one pass."""
    return train.agg(*[F.avg(c).alias(f"mean_{c}") for c in columns],
                     *[F.stddev_pop(c).alias(f"std_{c}") for c in columns])


def apply_scaler(df: DataFrame, stats: DataFrame, columns: list[str]) -> DataFrame:
    """Subtract the fitted mean and divide by the fitted deviation (a zero deviation by 1)."""
    row = stats.select(F.struct("*")).scalar()
    wide = df.withColumn("_stats", row)

    def scaled(c: str) -> Column:
        std = F.col(f"_stats.std_{c}")
        return (F.col(c) - F.col(f"_stats.mean_{c}")) / F.when(std > 0, std).otherwise(1.0)

    return wide.withColumns({c: scaled(c) for c in columns}).drop("_stats")


def one_hot(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """0/1 indicator per known value; a value outside the list gives all zeros."""
    return df.withColumns({f"{column}_{v}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0))
                           for v in values})


def band_codes(df: DataFrame, band: str = "phq9_band", order: list[str] = BAND_ORDER) -> DataFrame:
    """Ordinal code (clinical order) and alphabetical code of a band."""
    return df.withColumns({"y_ordinal": class_code(F.col(band), order),
                           "y_alphabetical": class_code(F.col(band), sorted(order))})


def model_matrix(df: DataFrame, categories: dict[str, list[str]], split: str = "split",
                 train: str = "train") -> DataFrame:
    """Scaled numeric and derived columns, binary flags and one-hot columns.

    The scaler sees the training rows only.
    """
    numeric = NUMERIC_FEATURES + DERIVED_FEATURES
    df = add_derived(df)
    stats = fit_scaler(df.filter(F.col(split) == train), numeric)
    out = apply_scaler(df, stats, numeric)
    out = out.withColumns({b: F.col(b).cast("int") for b in BINARY_FEATURES})
    for column in CATEGORICAL_FEATURES:
        out = one_hot(out, column, categories[column])
    return out
