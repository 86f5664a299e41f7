"""Rows of a stream in the order of their time, whatever the order they come in.

Rows of a key wait in a list state until the watermark has passed them, and so none that belongs before them can come any more;
timers then give them, sorted, to the key's machine, which is kept in a value state, and tell it what time it is. So the
results are those of the rows sorted by time, if none comes later than the watermark allows, and they don't depend on how
rows fall into batches. A key's state holds its rows of about the allowed lateness and of one batch (bound batches
by the source's options), and is gone when its machine has nothing to remember. Rows wait in packs, of which each is one element
of the list and tells its least time: so they don't pass to and from the state one by one, and packs that aren't due stay closed.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType

#: Rows of one pack.
CHUNK = 50_000


class InOrder(StatefulProcessor):
    """Gives the rows of each key to ``make(state)`` in the order of their fields, of which the first is the time."""

    def __init__(self, make: Callable, fields: str, columns: Sequence[str]):
        self.make, self.fields, self.columns = make, fields, list(columns)
        self.names = [f.split()[0] for f in fields.split(", ")]

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "least long, rows binary")
        self.kept = handle.getValueState("machine", "state string")

    def _call(self, us: int) -> None:
        """A timer for when the watermark, which counts milliseconds, is past us."""
        self.handle.registerTimer(us // 1000 + 1)

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues) -> None:
        machine = self.make(json.loads(initialState["state"].iloc[0]))
        self.kept.update((json.dumps(machine.state),))
        if (at := machine.wait()) is not None:
            self._call(at)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        packs = [_pack(list(zip(*[_plain(own[c]) for c in self.names], strict=True))) for part in rows for at in range(0, len(part), CHUNK) for own in [part.iloc[at : at + CHUNK]]]
        if packs:
            self._wait(packs)
        return iter(())

    def _wait(self, packs: list[tuple]) -> None:
        for pack in packs:
            self.waiting.appendList([pack])
        self._call(min(p[0] for p in packs))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        due, later, packs = [], [], []
        for least, rows in self.waiting.get() if self.waiting.exists() else ():
            if least > now:
                packs.append((least, bytes(rows)))
                continue
            for r in pickle.loads(rows):
                (due if r[0] <= now else later).append(r)
        due.sort()
        kept = self.kept.get()
        machine = self.make(json.loads(kept[0]) if kept is not None else None)
        out = [x for r in due for x in machine.step(*r)]
        out += machine.until(now)
        if due:
            self.waiting.clear()
            packs += [_pack(later[at : at + CHUNK]) for at in range(0, len(later), CHUNK)]
            if packs:
                self._wait(packs)
        if machine.state is None:
            if kept is not None:
                self.kept.clear()
        else:
            if (state := json.dumps(machine.state)) != (kept and kept[0]):
                self.kept.update((state,))
            if (at := machine.wait()) is not None:
                self._call(at)
        if out:
            yield pd.DataFrame([(*key, *x) for x in out], columns=self.columns)

    def close(self) -> None:
        pass


def _plain(column: pd.Series) -> list:
    """A column's values without numpy's types, and without missing numbers but as None."""
    values = column.tolist()
    return [None if x is None or x != x else x for x in values] if column.dtype.kind in "fO" else values


def _pack(rows: list[tuple]) -> tuple[int, bytes]:
    """The least time of rows, and the rows."""
    return min(r[0] for r in rows), pickle.dumps(rows, pickle.HIGHEST_PROTOCOL)


def in_order(df: DataFrame, keys: Sequence[str], ts: str, late: str | None, make: Callable, fields: str, results: str, initial: DataFrame | None = None) -> DataFrame:
    """(keys, results): what the machines that ``make`` gives for each key make of its rows.

    df: keys as text or numbers, the event time ts (with a watermark where late is None), and the columns of ``fields`` ("us long, ..."); rows without time are left out.
    initial: keys and ``state``, the JSON of a machine's state, for keys that are there before their first row. Needs the
    RocksDB state store, which streams.run_available sees to.
    """
    kinds = dict(df.dtypes)
    names = [f.split()[0] for f in fields.split(", ")]
    rows = (df.withWatermark(ts, late) if late is not None else df).where(F.col(ts).isNotNull()).select(ts, *keys, *[c for c in names if c not in keys])
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keys), results])
    columns = StructType.fromDDL(schema).names
    first = initial.select(*keys, "state").groupBy(*keys) if initial is not None else None
    return rows.groupBy(*keys).transformWithStateInPandas(InOrder(make, fields, columns), schema, "Append", "EventTime", initialState=first)
