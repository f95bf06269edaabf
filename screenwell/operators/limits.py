"""Request limits per key over a trailing time span."""

from __future__ import annotations

from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenwell.operators.running import running_sums
from screenwell.session import cut_lineage

MICROS = 1_000_000


def micros(name: str):
    return F.unix_micros(F.col(name))


def trailing_requests(df: DataFrame, key: str, time: str, limit: int = 10, window: int = 60,
                      slices: int | None = None) -> DataFrame:
    """Add ``recent`` (requests of the key in the ``window`` seconds before this one, ties
    included) and ``over_limit``.

    Requests are counted per (key, time), before the shuffle too. Each time also sends a mark
    ``window`` earlier; in one running sum over times and marks (``running_sums``: range partitions
    and their totals, so a key's line may span many tasks) the requests up to a time, less those up
    to its mark, are those between. Raw rows only meet the finished (key, time) values. A row without a time stays, both
    columns NULL; rows without a key count together.
    """
    span = window * MICROS
    at = micros(time)
    both = F.array(F.struct(at.alias("_at"), F.lit(1).alias("_n")), F.struct((at - span).alias("_at"), F.lit(0).alias("_n")))
    line = df.where(F.col(time).isNotNull()).select(F.col(key).alias("_key"), F.inline(both)).groupBy("_key", "_at").agg(
        F.sum("_n").alias("_n"), F.max("_n").alias("_real"))
    run = cut_lineage(running_sums(line, ["_key"], "_at", ["_n"], slices).select(
        "_key", "_at", "_real", (F.col("before__n") + F.col("_n")).alias("_upto")))
    before = run.select(F.col("_key").alias("_mark_key"), (F.col("_at") + span).alias("_mark_at"), F.col("_upto").alias("_old"))
    same = F.col("_key").eqNullSafe(F.col("_mark_key")) & (F.col("_at") == F.col("_mark_at"))
    found = run.where("_real > 0").join(before, same).select(
        "_key", "_at", (F.col("_upto") - F.col("_old") - 1).alias("recent"))
    own = F.col(key).eqNullSafe(F.col("_key")) & (micros(time) == F.col("_at"))
    return df.join(found, own, "left").drop("_key", "_at").withColumn("over_limit", F.col("recent") >= limit)


def admit(times: np.ndarray, counts: np.ndarray, recent: deque, limit: int,
          span: int) -> np.ndarray:
    """How many of the requests at each sorted distinct time are admitted.

    ``recent`` holds the admitted times that still count. While it is full, the scan jumps to
    the first time at which a place is free.
    """
    out = np.zeros(len(times), dtype=np.int32)
    i = 0
    while i < len(times):
        at = int(times[i])
        while recent and at - recent[0] >= span:
            recent.popleft()
        if len(recent) == limit:
            i = int(np.searchsorted(times, recent[0] + span))
            continue
        out[i] = min(int(counts[i]), limit - len(recent))
        recent.extend([at] * int(out[i]))
        i += 1
    return out


def admitted_requests(df: DataFrame, key: str, time: str, order: str, limit: int = 10,
                      window: int = 60) -> DataFrame:
    """Add ``admitted``: only admitted requests count against later ones.

    The rule is recursive along a key's time line, so rows are reduced before they are scanned:
    one (time, count) pair per distinct time, and a fresh session wherever a key pauses for the
    whole window (nothing older can count then). Sessions are scanned in sorted batches with at
    most ``limit`` times kept, so memory does not grow with a session. A session without any
    pause depends on its own past at every step and is read by one task from start to end; on
    logs where that is too long use the streaming form, which carries the same state from one
    micro-batch to the next. ``order`` must be unique. A request without a key or a time cannot be
    judged: its ``admitted`` is NULL, and it counts against none.
    """
    span = window * MICROS
    whole = F.col(key).isNotNull() & F.col(time).isNotNull()
    timed = df.filter(whole).withColumn("_at", micros(time))
    pairs = timed.groupBy(key, "_at").agg(F.count("*").alias("_n")).withColumn(
        "_slot", F.floor(F.col("_at") / F.lit(span)).cast("long"))
    # Two requests of one slot are closer than the window: a pause lies between slots only.
    slots = pairs.groupBy(key, "_slot").agg(F.min("_at").alias("_lo"), F.max("_at").alias("_hi"))
    by_key = Window.partitionBy(key).orderBy("_slot")
    fresh = F.coalesce(F.col("_lo") - F.lag("_hi").over(by_key) >= span, F.lit(True))
    sessions = slots.withColumn("_fresh", fresh.cast("long")).select(
        key, "_slot", F.sum("_fresh").over(by_key).alias("_session"))
    lined = pairs.join(sessions, [key, "_slot"]).drop("_slot").repartition(key, "_session")
    lined = lined.sortWithinPartitions(key, "_session", "_at")

    def scan(batches):
        current, recent = None, deque(maxlen=limit)
        for batch in batches:
            free = []
            runs = batch.groupby([key, "_session"], sort=False, dropna=False)
            for name, part in runs:
                if name != current:
                    current, recent = name, deque(maxlen=limit)
                free.append(admit(part["_at"].to_numpy(), part["_n"].to_numpy(), recent, limit,
                                  span))
            yield pd.DataFrame({key: batch[key], "_at": batch["_at"],
                                "_free": np.concatenate(free) if free else []})

    kind = df.schema[key].dataType.simpleString()
    free = lined.mapInPandas(scan, f"`{key}` {kind}, _at bigint, _free int")
    first = Window.partitionBy(key, "_at").orderBy(order)
    placed = timed.select(key, "_at", order).withColumn("_place", F.row_number().over(first))
    winners = placed.filter(F.col("_place") <= limit).join(
        free.filter(F.col("_free") > 0), [key, "_at"]).filter(F.col("_place") <= F.col("_free"))
    marked = winners.select(order, F.lit(True).alias("admitted"))
    return df.join(marked, order, "left").withColumn(
        "admitted", F.when(whole, F.coalesce("admitted", F.lit(False))))
