"""Operators that must answer in time and remember: new-visitor repair, daily unique visits, bounces.

State lives in the RocksDB store, small values per key. Only what can read or set state reaches Python: new-flagged rows for
the repair, entry pages for visits, of other pages their times for bounces. Rows pass through one by one; only the repair waits, with the new-flagged
rows of a device it has never seen, for the end of that one micro-batch.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructField, StructType

from tidemart.functions import day_of_millis
from tidemart.operators.logs import entry_pages, is_entry, repaired_flag
from tidemart.operators.visits import BOUNCE_TIMEOUT_MS, visit_order


class FirstDay(StatefulProcessor):
    """Appends the device's first new day to each of its new-flagged records."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._first = handle.getValueState("first_day", "first_day string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if self._first.exists():
            first = self._first.get()[0]
        else:
            rows = list(rows)
            first = min((row["_day"] for row in rows if row["_day"]), default=None)
            if first:
                self._first.update((first,))
        for row in rows:
            yield Row(**{**row.asDict(recursive=False), "first_day": first})

    def close(self) -> None:
        pass


def repair_new_visitors(log: DataFrame) -> DataFrame:
    """Streaming form of ``operators.logs.repair_new_visitors``; a device's first day is kept for good.

    Records that aren't flagged new can't change: they pass beside the state, unshuffled.
    """
    flagged = F.coalesce(F.col("common.is_new") == "1", F.lit(False))
    tagged = log.filter(flagged).withColumn("_day", day_of_millis(F.col("ts"), "yyyyMMdd"))
    schema = StructType(tagged.schema.fields + [StructField("first_day", StringType())])
    seen = (
        tagged.withColumn("_mid", F.col("common.mid"))
        .groupBy("_mid")
        .transformWithState(FirstDay(), _with_key(schema), "append", "none")
    )
    flag = repaired_flag(F.col("common.is_new"), F.col("ts"), F.col("first_day"))
    repaired = seen.withColumn("common", F.col("common").withField("is_new", flag)).select(*log.columns)
    return repaired.union(log.filter(~flagged))


def _with_key(schema: StructType) -> StructType:
    return StructType(schema.fields[:-1] + [StructField("_mid", StringType()), schema.fields[-1]])


class FirstOfDay(StatefulProcessor):
    """Emits the earliest row of a (device, day) once, and forgets the key when the day is over."""

    def __init__(self, order: tuple[str, ...]):
        self._order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if self._seen.exists():
            for _ in rows:
                pass
            return
        # nulls first, as in sorts
        first = min(rows, key=lambda r: tuple((r[c] is not None, r[c]) for c in self._order))
        self._seen.update((True,))
        self._handle.registerTimer(first["_day_end"])
        yield first

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def unique_visits(pages: DataFrame, delay: str = "0 seconds", tie: tuple[str, ...] = ()) -> DataFrame:
    """Streaming form of ``operators.visits.unique_visits``: a visit is emitted in the batch that brings it.

    State is keyed by device and day and dropped at the day's end, when the watermark rules out further rows.
    """
    day_end = F.unix_millis(F.date_trunc("day", F.timestamp_millis("ts")) + F.expr("interval 1 day"))
    order = visit_order(pages, tie)
    entries = (
        entry_pages(pages)
        .filter(F.col("ts").isNotNull())
        .withColumns(order)
        .withColumns(
            {
                "_mid": F.col("common.mid"),
                "_day": day_of_millis(F.col("ts")),
                "_day_end": day_end,
                "_time": F.timestamp_millis("ts"),
            }
        )
        .withWatermark("_time", delay)
    )
    kept = entries.groupBy("_mid", "_day").transformWithState(
        FirstOfDay(tuple(order)), entries.schema, "append", "eventTime"
    )
    return kept.select(*pages.columns)


class OpenPages(StatefulProcessor):
    """Holds a device's youngest pages and emits an entry page when its timer finds that no page followed.

    Two pages closer than the timeout can't both be bounces, so of each slot as wide as the timeout it keeps the first
    time and the last page only, whatever number of pages there were. The slots are those that the watermark has not
    passed: one or two where pages come in order.
    """

    def __init__(self, order: tuple[str, ...], timeout_ms: int):
        self._order, self._timeout = order, timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        # ``last``: time, order and, of an entry page, the row
        self._slots = handle.getMapState("slots", "slot long", "first_ts long, last binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        met: dict[int, tuple] = {}
        for row in rows:
            # nulls first, as in sorts
            order = tuple((row[c] is not None, row[c]) for c in self._order)
            slot = row["ts"] // self._timeout
            first, last = met.get(slot, (row["ts"], None))
            if last is None or order > last[0]:
                last = (order, row["ts"], row["_page"])
            met[slot] = (min(first, row["ts"]), last)
        for slot, (first, last) in met.items():
            if self._slots.containsKey((slot,)):
                stored_first, stored = self._slots.getValue((slot,))
                stored = pickle.loads(stored)
                first, last = min(first, stored_first), max(last, stored, key=lambda x: x[0])
            self._slots.updateValue((slot,), (first, pickle.dumps(last)))
            self._handle.registerTimer(last[1] + self._timeout)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        slots = {k[0]: (v[0], pickle.loads(v[1])) for k, v in self._slots.iterator()}
        # the watermark has passed these slots, no page can join them
        for slot in sorted(s for s, (_, last) in slots.items() if last[1] + self._timeout <= now):
            _, (_, ts, page) = slots[slot]
            following = slots[slot + 1][0] if slot + 1 in slots else None
            self._slots.removeKey((slot,))
            if page is not None and (following is None or following - ts >= self._timeout):
                yield Row(**page)

    def close(self) -> None:
        pass


def bounces(
    pages: DataFrame,
    timeout_ms: int = BOUNCE_TIMEOUT_MS,
    tie: tuple[str, ...] = (),
    delay: str = "0 seconds",
) -> DataFrame:
    """Streaming form of ``operators.visits.bounces`` with timers: a bounce is emitted by the first micro-batch whose
    watermark has passed its page by the timeout.

    Pages may come in any order within ``delay``. Pages without time are left out, as in batch.
    """
    order = visit_order(pages, tie)
    timed = pages.filter(F.col("ts").isNotNull()).select(
        F.col("common.mid").alias("_mid"),
        *[c.alias(n) for n, c in order.items()],
        F.when(is_entry(), F.struct(*pages.columns)).alias("_page"),
        F.timestamp_millis("ts").alias("_time"),
    )
    found = (
        timed.withWatermark("_time", delay)
        .groupBy("_mid")
        .transformWithState(OpenPages(tuple(order), timeout_ms), pages.schema, "append", "eventTime")
    )
    return found
