"""Intermediate tables in the shared folder, with an owner that deletes them."""

from __future__ import annotations

import atexit
import sys
import types
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenwell.session import checkpoint_folder


class Scratch:
    """A folder below ``spark.checkpoint.dir`` for the tables of one operator call.

    ``cut`` writes a table and reads it back, which survives the loss of executors. ``finish``
    writes the result and deletes everything else; the result goes when the application ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{checkpoint_folder(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
        self.tables = 0

    def path(self) -> str:
        self.tables += 1
        return f"{self.folder}/{self.tables}"

    def cut(self, df: DataFrame) -> DataFrame:
        path = self.path()
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def finish(self, df: DataFrame) -> DataFrame:
        last = Scratch(self.spark)
        out = last.cut(df)
        atexit.register(last.delete)
        self.delete()
        return out

    def settle(self) -> None:
        """Lets Spark delete the files of finished shuffles: it does when the driver collects its garbage."""
        if self.spark.sparkContext._jvm is not None:
            self.spark.sparkContext._jvm.java.lang.System.gc()

    def delete(self) -> None:
        context = self.spark.sparkContext
        if context._jsc is None:
            return
        path = context._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def small(table: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Broadcast hint for a written table of at most ``max_rows`` narrow rows, else as it is."""
    return F.broadcast(table) if table.count() <= max_rows else table


def worker_state() -> dict:
    """A dict that lives as long as the Python worker, across tasks."""
    module = sys.modules.setdefault("_screenwell_state", types.ModuleType("_screenwell_state"))
    return module.__dict__
