"""Repeated ids in a stream, with a time limit that counts from the first sight."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class _FirstSight(StatefulProcessor):
    """State of an id: the arrival that was kept last. A timer forgets it when its limit is over."""

    def __init__(self, columns: Sequence[str], order: Sequence[str], ttl_ms: int):
        self.columns, self.order, self.ttl_ms = list(columns), list(order), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", T.StructType([T.StructField("at", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.kept.get()[0] if self.kept.exists() else None
        last, flagged = known, Row(*self.columns, "duplicate")
        for row in sorted(rows, key=lambda r: tuple(r[c] for c in self.order)):
            at = row[self.order[0]]
            again = last is not None and at - last <= self.ttl_ms
            if not again:
                last = at
            yield flagged(*[row[c] for c in self.columns], again)
        if last != known:
            self.kept.update((last,))
            self.handle.registerTimer(last + self.ttl_ms + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # the timer of an arrival that is no longer the last one kept changes nothing
        if self.kept.exists() and self.kept.get()[0] + self.ttl_ms < expiredTimerInfo.getExpiryTimeInMs():
            self.kept.clear()
        return iter(())

    def close(self) -> None:
        pass


def flag_repeats(
    stream: DataFrame, key: str = "event_id", ttl_ms: int = 600_000, order: Sequence[str] = ("arr", "event_id"),
    slack: str = "0 seconds",
) -> DataFrame:
    """Every record with ``duplicate``: whether a kept record of its id lies within the limit before it.

    The limit is not renewed by copies. ``order`` is the arrival time in ms, the clock of the rule, then tie-breaks;
    micro-batches come in that order, and a record that is older than the latest by more than ``slack`` is dropped by
    Spark. State holds the ids of one limit and the slack, in RocksDB (``runs.disk_state``). The records that one id
    has in one micro-batch are sorted in memory, so admission bounds them. Records without id or arrival are left out.
    """
    rows = stream.filter(F.col(key).isNotNull() & F.col(order[0]).isNotNull())
    timed = rows.withColumn("__at", F.timestamp_millis(order[0])).withWatermark("__at", slack)
    schema = T.StructType([*stream.schema.fields, T.StructField("duplicate", T.BooleanType())])
    return timed.groupBy(key).transformWithState(
        statefulProcessor=_FirstSight(stream.columns, order, ttl_ms), outputStructType=schema, outputMode="Append", timeMode="EventTime")
