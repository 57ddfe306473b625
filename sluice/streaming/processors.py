"""State of streams that Spark's own operators do not keep, one processor per operator.

Spark starts a Python process of its own beside the driver for these, which sees neither the driver's module path nor
files shipped to executors. So this module imports nothing of the package, and what it defines is pickled by value.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The state store that keeps several states per key and timers; others do not.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Sessions(StatefulProcessor):
    """One open session per key; panes arrive in the order of time. No column starts with an underscore, which Spark renames."""

    def __init__(self, gap: int, n_keys: int, parts: dict[str, str], state_type: T.StructType):
        self.gap, self.n_keys, self.parts, self.state_type = pd.Timedelta(seconds=gap), n_keys, parts, state_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", self.state_type)

    def _out(self, key, session: tuple) -> pd.DataFrame:
        keys = {f"k{i}": [k] for i, k in enumerate(key[: self.n_keys])}
        values = dict(zip(("first", "last", *self.parts), ([v] for v in session)))
        return pd.DataFrame({**keys, **values})

    def _due(self, session: tuple) -> int:
        """When no pane can come any more that goes on with the session: all panes up to the gap's end are complete."""
        return int((pd.Timestamp(session[1]) + 2 * self.gap).timestamp() * 1000)

    def _joined(self, a: tuple, b: tuple) -> tuple:
        out = [min(a[0], b[0]), max(a[1], b[1])]
        for op, x, y in zip(self.parts.values(), a[2:], b[2:]):
            if x is None or y is None:
                out.append(x if y is None else y)
            else:
                out.append(min(x, y) if op == "min" else max(x, y) if op == "max" else x + y)
        return tuple(out)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        panes = pd.concat(list(rows)).sort_values("first")
        session = tuple(self.open.get()) if self.open.exists() else None
        if session is not None:
            self.handle.deleteTimer(self._due(session))
        names = ["first", "last", *self.parts]
        for values in panes[names].itertuples(index=False, name=None):
            pane = tuple(None if pd.isna(v) else v.to_pydatetime() if isinstance(v, pd.Timestamp) else v for v in values)
            if session is None:
                session = pane
            elif pane[0] <= session[1] + self.gap:
                session = self._joined(session, pane)
            else:
                yield self._out(key, session)
                session = pane
        self.open.update(session)
        self.handle.registerTimer(self._due(session))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.open.exists():
            yield self._out(key, tuple(self.open.get()))
            self.open.clear()


class BatchCollector(StatefulProcessor):
    """Rows of one lane, given out ``size`` at a time, or fewer when the first of them has waited ``wait_ms``.

    The rows of a batch that is not full are state, so they are there again after a restart, and are given out once.
    A batch's rows follow each other under its lane and number. Spark holds what comes out of one key and micro-batch in
    memory; so blocks of whole batches are keys of their own (``block``, with a lane below 0), which leave no state.
    """

    def __init__(self, size: int, wait_ms: int, row: T.StructType):
        self.size, self.wait_ms, self.row = size, wait_ms, row
        self.made = Row("lane", "number", *row.names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", self.row)
        self.due = handle.getValueState("due", "at long")
        self.given = handle.getValueState("given", "n long")

    def _next(self) -> int:
        n = self.given.get()[0] if self.given.exists() else 0
        self.given.update((n + 1,))
        return n

    def _out(self, key, rows: list[tuple]) -> Iterator[Row]:
        number = self._next()
        for row in rows:
            yield self.made(key[0], number, *row)

    def _block(self, first: int, rows: Iterator[Row]) -> Iterator[Row]:
        """A block's rows, batch by batch; its number leaves room for those of its batches."""
        for i, r in enumerate(rows):
            yield self.made(-1, first + i // self.size, *(r[name] for name in self.row.names))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if key[0] < 0:
            yield from self._block(key[1], rows)
            return
        held = list(map(tuple, self.held.get())) if self.held.exists() else []
        old = len(held)
        for r in rows:
            held.append(tuple(r[name] for name in self.row.names))
            if len(held) == self.size:
                yield from self._out(key, held)
                held, old = [], 0
        self._hold(held, timerValues.getCurrentProcessingTimeInMs(), bool(old))

    def _hold(self, rows: list[tuple], now: int, since_before: bool) -> None:
        """Keep what is left; its time counts from its first row, and goes on if that was here before."""
        if not since_before and self.due.exists():
            self.handle.deleteTimer(self.due.get()[0])
            self.due.clear()
        if not rows:
            self.held.clear()
            return
        self.held.put(rows)
        if not since_before:
            self.due.update((now + self.wait_ms,))
            self.handle.registerTimer(now + self.wait_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.due.clear()
        if self.held.exists():
            rows = list(map(tuple, self.held.get()))
            self.held.clear()
            yield from self._out(key, rows)
