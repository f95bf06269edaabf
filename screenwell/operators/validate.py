"""Input contract, defaults for missing inputs and checks of derived columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenwell.fixed_values import (AGE_RANGE, ALL_ITEMS, AUDIT_DEFAULTS, GAD_ITEMS, GENDER_MAX,
                                     NARRATIVE_MAX, PHQ_ITEMS, PLACEHOLDER_NARRATIVES)
from screenwell.functions.bands import gad_band, item_total, phq_band
from screenwell.functions.text import strip_blank
from screenwell.operators.rows import with_kept


def record_errors(df: DataFrame) -> DataFrame:
    """Add ``errors``: one short code per broken rule, empty for a valid record."""
    def broken(test: Column, code: str) -> Column:
        return F.when(~F.coalesce(test, F.lit(False)), F.lit(code))

    narrative = F.col("narrative")
    tests = [broken(F.col(i).between(0, 3), i) for i in ALL_ITEMS]
    tests += [
        broken(F.col("age").between(*AGE_RANGE), "age"),
        broken(F.length(F.coalesce("gender", F.lit("unknown"))) <= GENDER_MAX, "gender"),
        broken(F.length(narrative).between(1, NARRATIVE_MAX), "narrative_length"),
        broken(~F.lower(strip_blank(narrative)).isin(*PLACEHOLDER_NARRATIVES),
               "narrative_placeholder"),
    ]
    return df.withColumn("errors", F.array_compact(F.array(*tests)))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid records, quarantined records with their errors)."""
    checked = record_errors(df)
    return checked.filter(F.size("errors") == 0).drop("errors"), checked.filter(F.size("errors") > 0)


def clamp_items(df: DataFrame, items: list[str] = ALL_ITEMS) -> DataFrame:
    return df.withColumns({i: F.least(F.greatest(F.col(i), F.lit(0)), F.lit(3)) for i in items})


def fill_defaults(df: DataFrame, defaults: dict = AUDIT_DEFAULTS) -> DataFrame:
    """Defaults for missing columns and NULL values."""
    return df.withColumns({
        name: F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
        for name, value in defaults.items()})


def with_narrative(df: DataFrame, column: str = "narrative") -> DataFrame:
    """Keep records whose narrative is not blank, stripped."""
    return with_kept(df, column, strip_blank(F.col(column)), lambda t: F.length(t) > 0)


def check_records(df: DataFrame) -> DataFrame:
    """One row: row count and the number of violations of each rule on derived columns."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(~F.array_min(F.array(*[F.col(i).between(0, 3) for i in ALL_ITEMS])))
        .alias("bad_item"),
        F.count_if(F.col("phq9_total") != item_total(PHQ_ITEMS)).alias("bad_phq_total"),
        F.count_if(F.col("gad7_total") != item_total(GAD_ITEMS)).alias("bad_gad_total"),
        F.count_if(F.col("phq9_band") != phq_band(F.col("phq9_total"))).alias("bad_phq_band"),
        F.count_if(F.col("gad7_band") != gad_band(F.col("gad7_total"))).alias("bad_gad_band"))
