"""Run a stream over everything available and read its result as a table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenwell.session import own_folder


def drain(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Process all available input, write the result to the shared folder, return it."""
    spark = stream.sparkSession
    base = f"{own_folder(spark)}/stream-{uuid.uuid4().hex}"
    writer = stream.writeStream.option("checkpointLocation", f"{base}/state").trigger(
        availableNow=True)
    if mode == "append":
        query = writer.format("parquet").outputMode("append").start(f"{base}/out")
    else:
        # Complete mode gives the whole (small) result each time; the last one stays.
        def keep(batch: DataFrame, _: int) -> None:
            batch.write.mode("overwrite").parquet(f"{base}/out")

        query = writer.outputMode(mode).foreachBatch(keep).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def drain_updates(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Process all available input in update mode; the newest row of every key.

    A trigger passes on the rows that it changed, so the watermark can drop state of closed periods.
    A batch goes to its own folder, which a repeated batch overwrites.
    """
    spark = stream.sparkSession
    base = f"{own_folder(spark)}/stream-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/_batch={number}")

    stream.writeStream.option("checkpointLocation", f"{base}/state").trigger(availableNow=True).outputMode(
        "update").foreachBatch(keep).start().awaitTermination()
    spark.createDataFrame([], stream.schema).write.mode("overwrite").parquet(f"{base}/out/_batch=-1")
    rows = spark.read.schema(f"{stream.schema.toDDL()}, _batch long").parquet(f"{base}/out")
    rest = [c for c in stream.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("_row"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in stream.columns])
