"""Append-only prediction log as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screenwell.fixed_values import AUDIT_DEFAULTS
from screenwell.functions.text import iso_now
from screenwell.operators.audit import last_records
from screenwell.operators.validate import fill_defaults

HEAD = ["log_id", "timestamp", "model_version"]
COLUMNS = HEAD + list(AUDIT_DEFAULTS)


def log_schema() -> T.StructType:
    kinds = {str: T.StringType(), int: T.IntegerType(), float: T.DoubleType(),
             bool: T.BooleanType()}
    fields = [T.StructField(n, T.StringType()) for n in HEAD]
    return T.StructType(fields + [T.StructField(n, kinds[type(v)])
                                  for n, v in AUDIT_DEFAULTS.items()])


def log_records(df: DataFrame, model_version: str = "fallback") -> DataFrame:
    """Log records from predictions: defaults filled, id, time and version added if absent."""
    filled = fill_defaults(df)
    made = {"log_id": F.uuid(), "timestamp": iso_now(), "model_version": F.lit(model_version)}
    filled = filled.withColumns({n: c for n, c in made.items() if n not in df.columns})
    return filled.select(*[F.col(f.name).cast(f.dataType) for f in log_schema()])


def append_log(df: DataFrame, path: str, model_version: str = "fallback") -> None:
    """Append one JSON line per record; existing files are never touched."""
    log_records(df, model_version).write.mode("append").json(path)


def read_log(spark: SparkSession, path: str, last_n: int | None = None) -> DataFrame:
    """All records or the last ``last_n``; blank lines are skipped, missing keys are NULL."""
    log = spark.read.schema(log_schema()).json(path).filter(F.col("log_id").isNotNull())
    return log if last_n is None else last_records(log, last_n)


def json_line(df: DataFrame) -> DataFrame:
    """Each record as one JSON string, in record order."""
    return df.select(F.to_json(F.struct(*[c for c in COLUMNS if c in df.columns])).alias("line"))
