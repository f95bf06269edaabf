"""Exact admit/reject per key on a stream."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupStateTimeout

from screenwell.operators.limits import MICROS, admit, micros


def admit_stream(df: DataFrame, key: str, time: str, order: str, limit: int = 10,
                 window: int = 60, late: str = "1 hour") -> DataFrame:
    """(key, order, time, admitted) for every request.

    The state of a key is its admitted times of the last ``window`` seconds, at most ``limit`` of
    them; it is dropped once the watermark shows that none of them counts any more. Rows of a
    micro-batch are judged in time order; a row older than the state is judged against what the
    state holds, rows later than the watermark are dropped. Bound the micro-batch with the
    source's per-trigger options.
    """
    span = window * MICROS
    rows = df.select(key, order, time, micros(time).alias("_at")).withWatermark(time, late)
    out_schema = (f"`{key}` {rows.schema[key].dataType.simpleString()}, "
                  f"`{order}` {rows.schema[order].dataType.simpleString()}, "
                  f"`{time}` {rows.schema[time].dataType.simpleString()}, admitted boolean")

    def step(_, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        recent = deque(state.get[0] if state.exists else [], maxlen=limit)
        batch = pd.concat(list(parts)).sort_values(["_at", order], kind="stable")
        times, counts = np.unique(batch["_at"].to_numpy(), return_counts=True)
        free = np.repeat(admit(times, counts, recent, limit, span), counts)
        place = batch.groupby("_at", sort=False).cumcount().to_numpy()
        state.update((list(recent),))
        state.setTimeoutTimestamp((int(times[-1]) + span) // 1000 + 1)
        yield batch.assign(admitted=place < free)[[key, order, time, "admitted"]]

    return rows.groupBy(key).applyInPandasWithState(
        step, out_schema, "recent array<bigint>", "append", GroupStateTimeout.EventTimeTimeout)
