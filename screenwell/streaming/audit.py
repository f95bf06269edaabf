"""Audit log as a stream: continuous append, counts per period, replay removal, triage.

Rows later than the watermark are dropped, as Spark does by default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from screenwell.operators.audit import verdict_summary
from screenwell.plans.triage_plan import triage
from screenwell.sources.audit_log import log_records, log_schema


def stream_log(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(log_schema())
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path).filter(F.col("log_id").isNotNull())


def append_stream(records: DataFrame, path: str, checkpoint: str,
                  model_version: str = "fallback") -> StreamingQuery:
    """Append log lines as they arrive; started with everything available now."""
    lines = log_records(records, model_version)
    return (lines.writeStream.format("json").outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path))


def with_event_time(log: DataFrame, time: str = "timestamp") -> DataFrame:
    return log.withColumn("event_time", F.to_timestamp(time))


def verdicts_per_period(log: DataFrame, time: str = "event_time", period: str = "1 week",
                        slide: str | None = None, late: str = "1 day") -> DataFrame:
    """Verdict counts per tumbling period, or per sliding one when ``slide`` is given."""
    timed = log.withWatermark(time, late) if log.isStreaming else log
    counted = verdict_summary(timed, [F.window(time, period, slide) if slide
                                      else F.window(time, period)])
    return counted.select(F.col("window.start").alias("period_start"),
                          F.col("window.end").alias("period_end"),
                          *[c for c in counted.columns if c != "window"])


def without_replays(log: DataFrame, key: str = "log_id", time: str = "event_time",
                    late: str = "1 day") -> DataFrame:
    """Each log line once; on a stream, copies arriving within the watermark are dropped."""
    if log.isStreaming:
        return log.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
    return log.dropDuplicates([key])


def triage_stream(records: DataFrame) -> DataFrame:
    """Rule-based triage of a stream of records: row expressions only, no state."""
    return triage(records)
