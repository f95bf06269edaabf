"""Row filters on computed columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_kept(df: DataFrame, name: str, value: Column,
              test: Callable[[Column], Column]) -> DataFrame:
    """Add ``name`` = ``value`` and keep the rows whose value passes ``test``.

    A plain filter is pushed below the projection and computes the value again for each use in
    the condition. Exploding a filtered one-element array computes it once per row, which
    matters for chains of regular expressions and JSON parsing.
    """
    return df.withColumn(name, F.explode(F.filter(F.array(value), test)))
