"""Running box office on opening balances, whose keys are dropped after a time without tickets.

One state processor holds a key's totals. Opening balances are its initial state: Spark reads them for the
first batch of a checkpoint and never again. Idle time is watched by a timer per key, which the
state store keeps in a column family of its own, so it survives a restart.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo,
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)

from foyer.operators.sales import BOX_OFFICE_KEY, opening_balances

# Executors get these functions with the plan and need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_MEASURES = ("ticket_num", "ticket_amt")
_TOTALS = "ticket_num bigint, ticket_amt bigint"

# Fixed value: 108,000 s.
THIRTY_HOURS_MS = 108_000 * 1000

_HELD_ROWS = 200_000


def _sums(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches(held)
    keys = [name for name in rows.column_names if name not in _MEASURES]
    sums = rows.group_by(keys, use_threads=False).aggregate([(name, "sum") for name in _MEASURES])
    columns = [*(sums[name] for name in keys), *(sums[f"{name}_sum"] for name in _MEASURES)]
    yield from pa.table(columns, names=[*keys, *_MEASURES]).to_batches()


def _combine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per key, the columns that are no measures, of each stretch of ``_HELD_ROWS`` rows."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= _HELD_ROWS:
            yield from _sums(held)
            held, rows = [], 0
    if held:
        yield from _sums(held)


def _combine_twice(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map-side sums: the sums of stretches are summed in stretches too, so the rows that reach the state tasks
    follow a task's keys and not its tickets."""
    yield from _combine(_combine(batches))


class BoxOfficeState(StatefulProcessor):
    """Totals of a key, and the time at which it has been idle for too long.

    A ticket only moves that time; the timer is looked at when it goes off, and set again if the key
    was not idle. So a batch costs a key one read and one write, however often it comes.
    """

    def __init__(self, idle_ms: int | None):
        self._idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._totals = handle.getValueState("totals", f"{_TOTALS}, due bigint")

    def _due(self, timers: TimerValues) -> int:
        return 0 if self._idle_ms is None else timers.getCurrentProcessingTimeInMs() + self._idle_ms

    def _begin(self, num: int, amt: int, due: int) -> None:
        self._totals.update((num, amt, due))
        if self._idle_ms is not None:
            self._handle.registerTimer(due)

    def handleInitialState(self, key: tuple, initialState: Row, timerValues: TimerValues) -> None:
        """An opening balance: kept quietly until a ticket comes or the key has been idle."""
        self._begin(initialState["ticket_num"], initialState["ticket_amt"], self._due(timerValues))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        """Add the batch's sums to the totals, which come out."""
        num = amt = 0
        for row in rows:
            num += row["ticket_num"]
            amt += row["ticket_amt"]
        now, due = self._totals.get(), self._due(timerValues)
        if now is None:
            self._begin(num, amt, due)
        else:
            num, amt = num + now[0], amt + now[1]
            self._totals.update((num, amt, due))
        yield Row(key=key[0], ticket_num=num, ticket_amt=amt)

    def handleExpiredTimer(
        self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo
    ) -> Iterator[Row]:
        """A key that has been idle comes out once more, unchanged, and is forgotten."""
        num, amt, due = self._totals.get()
        if due > timerValues.getCurrentProcessingTimeInMs():
            self._handle.registerTimer(due)
            return
        self._totals.clear()
        yield Row(key=key[0], ticket_num=num, ticket_amt=amt)

    def close(self) -> None:
        pass


def running_box_office(
    tickets: DataFrame, balances: DataFrame | None = None, idle_ms: int | None = THIRTY_HOURS_MS
) -> DataFrame:
    """``box_office`` of a stream on opening balances, in ``update`` mode; a table that is not a stream.

    Only keys with a ticket in the batch come out, and keys that have been idle for ``idle_ms``; with
    ``None`` no key is ever idle. The clock is processing time. With an ``availableNow`` trigger start the
    stream with ``idle_batches=False``, or it keeps running empty batches to watch the clock.
    """
    # The cost of a key in Python grows with its columns, so the four travel as one; packed after the sums,
    # as there are fewer of them than tickets.
    packed = F.to_json(F.struct(*BOX_OFFICE_KEY)).alias("key")
    named = ", ".join(f"{name} string" for name in BOX_OFFICE_KEY)
    combined = tickets.select(*BOX_OFFICE_KEY, *_MEASURES).mapInArrow(_combine_twice, f"{named}, {_TOTALS}")
    sums = combined.select(packed, *_MEASURES)
    start = None
    if balances is not None:
        start = opening_balances(balances).select(packed, *_MEASURES).groupBy("key")
    totals = sums.groupBy("key").transformWithState(
        BoxOfficeState(idle_ms), f"key string, {_TOTALS}", "update",
        "None" if idle_ms is None else "ProcessingTime", start,
    )
    return totals.select(F.from_json("key", named).alias("key"), *_MEASURES).select("key.*", *_MEASURES)
