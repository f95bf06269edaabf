"""Posts, cohort, screening and summary files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screenwell.fixed_texts import SUMMARIES
from screenwell.fixed_values import GAD_ITEMS, PHQ_ITEMS

SUMMARY_SCHEMA = "disorder string, icd10 string, criteria_summary string, source string"


def screening_schema() -> T.StructType:
    """Population-profile record: all fields non-null."""
    def field(name: str, kind: T.DataType) -> T.StructField:
        return T.StructField(name, kind, False)

    whole, text, flag = T.IntegerType(), T.StringType(), T.BooleanType()
    fields = [field("subject_id", text), field("age", whole), field("gender", text),
              field("education", text), field("prior_diagnosis", flag),
              field("on_medication", flag)]
    fields += [field(i, whole) for i in PHQ_ITEMS]
    fields += [field("phq9_total", whole), field("phq9_band", text)]
    fields += [field(i, whole) for i in GAD_ITEMS]
    fields += [field("gad7_total", whole), field("gad7_band", text),
               field("latent_severity", T.DoubleType())]
    return T.StructType(fields)


def header_schema(spark: SparkSession, glob: str) -> T.StructType:
    """All-string schema from the header of the files of ``glob``: the first line of one of them."""
    first = spark.read.option("header", True).option("escape", '"').csv(glob)
    return T.StructType([T.StructField(c, T.StringType()) for c in first.columns])


def read_posts(spark: SparkSession, *globs: str, schemas: list[T.StructType] | None = None) -> DataFrame:
    """CSV files with a header, quoted multi-line bodies and doubled quotes; all strings.

    Files of one glob share a header and are read with its explicit schema (``schemas`` gives one
    for each glob, else the header tells it); a file with another header fails instead of being
    misread. Several globs are united by column name, a column that one of them lacks being NULL
    there.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("enforceSchema", False)
    kinds = schemas or [header_schema(spark, g) for g in globs]
    first, *others = [reader.schema(kind).csv(g) for g, kind in zip(globs, kinds, strict=True)]
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def write_cohort(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split; the filter prunes partition folders."""
    return spark.read.parquet(path).where(F.col("split") == split)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def builtin_summaries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SUMMARIES, SUMMARY_SCHEMA)


def read_summaries(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Built-in summaries, plus custom ones (one JSON object per line) when a path is given."""
    own = builtin_summaries(spark)
    if path is None:
        return own
    custom = spark.read.schema(SUMMARY_SCHEMA).json(path).dropna(how="all")
    return own.unionByName(custom, allowMissingColumns=True)
