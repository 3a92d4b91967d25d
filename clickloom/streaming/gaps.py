"""Time since the previous event of the same user, on a stream.

The one place outside the corpus operators that runs Python on executors: Spark
has no built-in state that orders events.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from clickloom.functions import events as E

LATE = "1 day"
AHEAD = "1 day"

_OUTPUT = "event_id string, uid string, timestamp bigint, gap_sec bigint"
_STATE = "ids array<string>, times array<bigint>, last bigint"


def with_gap(events: DataFrame, late: str = LATE, ahead: str = AHEAD) -> DataFrame:
    """event_id, uid, timestamp and gap_sec (NULL for a user's first event) of parsed messages (``ingest.parse``).

    An event comes out once the watermark has passed it, when no earlier one can come any more: so the
    gaps are those of the batch form however the events were shuffled. What arrives
    behind the watermark is dropped and counted in the query's progress. Events
    without a time, or further ahead of their message than ``ahead``, are left out, since one absurd
    time would move the watermark past all others. State is the events of the last
    ``late`` and one time for each user.
    """
    at = E.epoch_to_timestamp(F.col("timestamp"))
    sane = at <= F.col("kafka_timestamp") + F.expr(f"INTERVAL {ahead}")
    timed = events.filter(sane).select("event_id", "uid", "timestamp", at.alias("at")).withWatermark("at", late)
    return timed.groupBy("uid").applyInPandasWithState(
        _in_order, _OUTPUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def _in_order(key: tuple, arrived: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    ids, times, last = state.get if state.exists else ([], [], None)
    held = [*zip(times, ids, strict=True)]
    if not state.hasTimedOut:
        for rows in arrived:
            held += zip(map(int, rows["timestamp"]), rows["event_id"], strict=True)
    # Without an id after all others, as NULLs sort in no window here: ids are given.
    held.sort(key=lambda row: (row[0], row[1] is not None, row[1] or ""))
    watermark = state.getCurrentWatermarkMs()
    n = sum(time * 1000 <= watermark for time, _ in held)
    ready, waiting = held[:n], held[n:]
    if ready:
        before = [last, *(time for time, _ in ready[:-1])]
        yield pd.DataFrame(
            {
                "event_id": [name for _, name in ready],
                "uid": [key[0]] * n,
                "timestamp": [time for time, _ in ready],
                "gap_sec": pd.array(
                    [None if b is None else time - b for (time, _), b in zip(ready, before, strict=True)], "Int64"
                ),
            }
        )
        last = ready[-1][0]
    state.update(([name for _, name in waiting], [time for time, _ in waiting], last))
    if waiting:
        state.setTimeoutTimestamp(waiting[0][0] * 1000)
