"""Batches of a stream that end after so many rows or so much time, whichever comes first."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# The function runs in tasks; send it along instead of expecting the package there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}


def seconds(duration: str) -> int:
    """``'10 seconds'`` and the like."""
    m = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day)s?\s*", duration)
    if not m:
        raise ValueError(f"no duration in seconds, minutes, hours or days: '{duration}'")
    return int(m[1]) * _UNITS[m[2]]


class CountOrTime:
    """Per key, the open batch: its number, the times (in microseconds) of its first and last row, and how many it has."""

    STATE = "number long, first long, last long, rows long"

    def __init__(self, key: str, ts: str, size: int, span: int):
        self.key, self.ts, self.size, self.span = key, ts, size, span

    def _record(self, key, number: int, first: int, last: int, rows: int, by: str) -> tuple:
        return (key[0], number, pd.Timestamp(first, unit="us"), pd.Timestamp(last, unit="us"), rows, by)

    def _frame(self, records: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(records, columns=[self.key, "batch", "first", "last", "rows", "closed_by"])

    def _due(self, first: int) -> int:
        """The last millisecond before the batch is over by time: a timeout comes once the watermark is beyond it."""
        return -(-(first + self.span) // 1000) - 1

    def rows(self, key, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        number, first, last, count = state.get if state.exists else (0, 0, 0, 0)
        if state.hasTimedOut:  # nothing came for the key until its batch was over
            state.update((number + 1, first, last, 0))
            yield self._frame([self._record(key, number, first, last, count, "time")])
            return
        # Only the times of one key in one micro-batch, eight bytes a row.
        times = [pdf[self.ts].to_numpy("datetime64[us]").astype(np.int64) for pdf in rows]
        ts = np.sort(np.concatenate(times))
        closed, i = [], 0
        while i < len(ts):
            first = first if count else int(ts[i])
            stop = min(i + self.size - count, int(np.searchsorted(ts, first + self.span)))
            if stop > i:
                count, last, i = count + stop - i, max(last if count else 0, int(ts[stop - 1])), stop
            if count == self.size or i < len(ts):
                closed.append(self._record(key, number, first, last, count, "count" if count == self.size else "time"))
                number, count = number + 1, 0
        state.update((number, first, last, count))
        if count:  # a timeout holds until the next call only; that of rows without a time is over with the next watermark
            state.setTimeoutTimestamp(max(self._due(first), state.getCurrentWatermarkMs(), 1))
        if closed:
            yield self._frame(closed)


def count_or_time_batches(stream: DataFrame, key: str, ts: str, size: int, span: str, delay: str) -> DataFrame:
    """``key, batch, first, last, rows, closed_by``: one row for each batch of a key that is over.

    A batch begins with the first row that comes after the one before, and is over with its ``size``-th row (``count``) or when
    ``span`` has gone by since its first one (``time``): told by a later row of the key, or by the watermark, ``delay`` behind
    the latest time of the whole stream, so a key that falls silent is flushed too. Rows of a micro-batch are taken in order
    of time; rows that come late but above the watermark go to the open batch. The state is four numbers a key, kept by whichever
    state store the session has. Batches still open when the stream ends stay in the checkpoint and go on from there.
    """
    if stream.sparkSession.conf.get("spark.sql.session.timeZone") != "UTC":
        raise ValueError("times without zone need a session whose spark.sql.session.timeZone is UTC")
    if size < 1:
        raise ValueError("a batch has at least one row")
    timed = stream.select(F.col(key), F.col(ts).cast("timestamp").alias(ts)).withWatermark(ts, delay)
    kind = stream.schema[key].dataType.simpleString()
    return timed.groupBy(key).applyInPandasWithState(
        CountOrTime(key, ts, size, seconds(span) * 1_000_000).rows,
        f"`{key}` {kind}, batch long, first timestamp, last timestamp, rows long, closed_by string",
        CountOrTime.STATE,
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
