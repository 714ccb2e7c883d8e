"""Per-key state on streams, for ``groupBy(key).transformWithState`` and its form in pandas.

A processor takes the rows of a key that one micro-batch brings at once, in arrival
order, and reads and writes its state once. Batches are bounded by the source's
rate limit or the steps of a replay, and so is what a hot key hands to one task.
A ``KeyedProcessor`` gets a frame, a ``PlainProcessor`` plain tuples: to build a frame and to turn
one into Arrow take some milliseconds per key and batch, which with many keys of few rows is most of the time.
Each class names its output in ``OUTPUT``; ``apply`` wires it to a stream. A null value
is no value, as in the batch operators: it changes no sum, extreme or last value, and
counts as a row. Values are 32-bit integers, which pandas holds exactly beside nulls.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def apply(
    stream: DataFrame, key: str, processor: KeyedProcessor | PlainProcessor, time_mode: str = "None", before: DataFrame | None = None
) -> DataFrame:
    """Run a processor per key. ``time_mode``: ``None``, ``ProcessingTime`` or ``EventTime``.

    ``before`` has the state of keys from an earlier query, one row per key, for a processor with ``on_state``.
    """
    grouped = stream.groupBy(key)
    run = grouped.transformWithState if isinstance(processor, PlainProcessor) else grouped.transformWithStateInPandas
    return run(
        statefulProcessor=processor,
        outputStructType=f"{key} {dict(stream.dtypes)[key]}, {processor.OUTPUT}",
        outputMode="Append",
        timeMode=time_mode,
        initialState=before.groupBy(key) if before is not None else None,
    )


def state_of(spark: SparkSession, checkpoint: str, key: str, name: str) -> DataFrame:
    """The value state ``name`` that a stopped query left in its checkpoint: the key and the state's columns."""
    stored = spark.read.format("statestore").option("stateVarName", name).load(checkpoint)
    return stored.select(F.col(f"key.{key}").alias(key), "value.*")


class KeyedProcessor(StatefulProcessor):
    """Sorts a key's new rows and hands them to ``on_rows``, which returns the columns of ``OUTPUT``."""

    OUTPUT = ""
    key = "uid"
    order = "seq"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open(handle)

    def open(self, handle: StatefulProcessorHandle) -> None:
        """Declare the state."""

    def on_rows(self, rows: pd.DataFrame, timers: Any) -> list[Any] | None:
        """One array per output column, or nothing."""

    def on_timer(self, at_ms: int) -> list[Any] | None:
        """What an expired timer puts out."""

    def on_state(self, row: tuple) -> None:
        """Take up what an earlier query left for the key, without the key itself."""

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues: Any) -> None:
        for row in initialState.drop(columns=self.key).astype(object).itertuples(index=False, name=None):
            self.on_state(tuple(None if pd.isna(v) else v for v in row))

    def _frame(self, key: tuple, columns: list[Any] | None) -> Iterator[pd.DataFrame]:
        if columns is not None and len(columns[0]):
            names = [part.split()[0] for part in self.OUTPUT.split(", ")]
            yield pd.DataFrame({self.key: [key[0]] * len(columns[0])} | dict(zip(names, columns, strict=True)))

    def handleInputRows(
        self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: Any
    ) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values(self.order, kind="stable", ignore_index=True)
        yield from self._frame(key, self.on_rows(batch, timerValues))

    def handleExpiredTimer(
        self, key: tuple, timerValues: Any, expiredTimerInfo: Any
    ) -> Iterator[pd.DataFrame]:
        yield from self._frame(key, self.on_timer(expiredTimerInfo.getExpiryTimeInMs()))

    def close(self) -> None:
        pass


class PlainProcessor(StatefulProcessor):
    """Sorts a key's new rows and hands their columns to ``on_rows`` as tuples of plain values, a null as None."""

    OUTPUT = ""
    key = "uid"
    order = "seq"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.made = Row(self.key, *[part.split()[0] for part in self.OUTPUT.split(", ")])
        self.open(handle)

    def open(self, handle: StatefulProcessorHandle) -> None:
        """Declare the state."""

    def on_rows(self, rows: dict[str, tuple], timers: Any) -> list[Sequence[Any]] | None:
        """One sequence per output column, or nothing."""

    def on_timer(self, at_ms: int, timers: Any) -> list[Sequence[Any]] | None:
        """What an expired timer puts out."""

    def on_state(self, row: tuple) -> None:
        """Take up what an earlier query left for the key, without the key itself."""

    def handleInitialState(self, key: tuple, initialState: Row, timerValues: Any) -> None:
        self.on_state(tuple(v for name, v in zip(initialState.__fields__, initialState, strict=True) if name != self.key))

    def _rows(self, key: tuple, columns: list[Sequence[Any]] | None) -> Iterator[Row]:
        return (self.made(key[0], *values) for values in zip(*columns, strict=True)) if columns else iter(())

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        batch = list(rows)
        names = batch[0].__fields__
        at = names.index(self.order)
        batch.sort(key=lambda row: (row[at] is None, row[at]))
        return self._rows(key, self.on_rows(dict(zip(names, zip(*batch, strict=True), strict=True)), timerValues))

    def handleExpiredTimer(self, key: tuple, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        return self._rows(key, self.on_timer(expiredTimerInfo.getExpiryTimeInMs(), timerValues))

    def close(self) -> None:
        pass


def values_of(rows: pd.DataFrame) -> pd.Series:
    return rows["vc"].astype("Int64")


def last_of(values: pd.Series, before: Any) -> Any:
    """The last value that is not null, else what was there before."""
    known = values.dropna()
    return int(known.iloc[-1]) if len(known) else before


class JumpAlerts(KeyedProcessor):
    """Value state: rows more than ``limit`` away from the key's previous value (0 at first)."""

    OUTPUT = "seq bigint, last int, vc int"

    def __init__(self, limit: int) -> None:
        self.limit = limit

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "vc int")

    def on_rows(self, rows: pd.DataFrame, timers: Any) -> list[Any]:
        seen = self.last.get()[0] if self.last.exists() else 0
        vc = values_of(rows)
        last = vc.ffill().shift(1).fillna(seen)
        jumps = ((vc - last).abs() > self.limit).fillna(False).to_numpy(bool)
        self.last.update((last_of(vc, seen),))
        return [rows["seq"][jumps], last[jumps], vc[jumps]]


class TopValues(KeyedProcessor):
    """List state: the ``k`` largest values so far, descending, after each row."""

    OUTPUT = "seq bigint, top array<int>"

    def __init__(self, k: int = 3) -> None:
        self.k = k

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.stored = handle.getListState("top", "vc int")

    def on_rows(self, rows: pd.DataFrame, timers: Any) -> list[Any]:
        held = [-item[0] for item in self.stored.get()] if self.stored.exists() else []
        tops = []
        for value in values_of(rows).to_numpy(dtype=object, na_value=None):
            if value is not None:
                insort(held, -value)
                del held[self.k :]
            tops.append([-v for v in held])
        if held:
            self.stored.put([(-v,) for v in held])
        return [rows["seq"], tops]


class ValueCounts(KeyedProcessor):
    """Map state: how often the row's value has come up for the key; null is a value of its own."""

    OUTPUT = "seq bigint, vc int, cnt bigint"

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", "known boolean, vc int", "cnt bigint")

    def on_rows(self, rows: pd.DataFrame, timers: Any) -> list[Any]:
        vc = values_of(rows)
        place = vc.groupby(vc, dropna=False).cumcount() + 1
        before = {}
        for value, n in vc.value_counts(dropna=False).items():
            entry = (False, 0) if pd.isna(value) else (True, int(value))
            known = self.counts.getValue(entry)[0] if self.counts.containsKey(entry) else 0
            before[None if pd.isna(value) else int(value)] = known
            self.counts.updateValue(entry, (known + int(n),))
        start = [before[None if pd.isna(v) else int(v)] for v in vc]
        return [rows["seq"], vc, place.to_numpy() + np.array(start)]


class RunningFold(PlainProcessor):
    """Reducing and aggregating state: running sum, count, mean, smallest and largest value."""

    OUTPUT = "seq bigint, total bigint, n bigint, mean double, low int, high int"

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.stored = handle.getValueState("fold", "total bigint, n bigint, low int, high int")

    def on_rows(self, rows: dict[str, tuple], timers: Any) -> list[Sequence[Any]]:
        total, n, low, high = self.stored.get() or (None, 0, None, None)
        totals, counts, lows, highs = [], [], [], []
        for n, vc in enumerate(rows["vc"], n + 1):
            if vc is not None:
                total = vc if total is None else total + vc
                low = vc if low is None or vc < low else low
                high = vc if high is None or vc > high else high
            totals.append(total)
            counts.append(n)
            lows.append(low)
            highs.append(high)
        self.stored.update((total, n, low, high))
        means = [None if t is None else float(t) / n for t, n in zip(totals, counts, strict=True)]
        return [rows["seq"], totals, counts, means, lows, highs]


class CarriedFold(RunningFold):
    """The running fold as a changed query: its state comes from the query before, and it gives other columns."""

    OUTPUT = "seq bigint, total bigint, n bigint, spread int"

    def on_state(self, row: tuple) -> None:
        self.stored.update(tuple(None if v is None else int(v) for v in row))

    def on_rows(self, rows: dict[str, tuple], timers: Any) -> list[Sequence[Any]]:
        seq, totals, counts, _, lows, highs = super().on_rows(rows, timers)
        return [seq, totals, counts, [None if h is None else h - l for l, h in zip(lows, highs, strict=True)]]


class SumChangelog(KeyedProcessor):
    """Change rows of a grouped sum: ``+I`` first, then ``-U`` and ``+U`` per row."""

    OUTPUT = "seq bigint, op string, total bigint"

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.stored = handle.getValueState("total", "total bigint, known boolean")

    def on_rows(self, rows: pd.DataFrame, timers: Any) -> list[Any]:
        first = not self.stored.exists()
        before, known = (0, False) if first else self.stored.get()
        vc = values_of(rows)
        seen = vc.notna().cummax() | known
        new = (vc.fillna(0).cumsum() + before).where(seen)
        old = new - vc.fillna(0)
        seq = np.repeat(rows["seq"].to_numpy(), 2)
        op = np.tile(np.array(["-U", "+U"], object), len(vc))
        both = pd.concat([old, new], ignore_index=True)
        total = both.iloc[np.arange(len(both)).reshape(2, -1).T.ravel()]
        if first:
            seq, op, total = seq[1:], np.r_[np.array(["+I"], object), op[2:]], total.iloc[1:]
        self.stored.update((int(vc.fillna(0).sum()) + before, bool(seen.iloc[-1])))
        return [seq, op, total.reset_index(drop=True)]


class CountWindows(KeyedProcessor):
    """Count windows: every ``slide`` rows the count and sum of the last ``size``.

    With ``slide == size`` windows do not overlap and only full ones fire.
    """

    OUTPUT = "firing bigint, n bigint, total bigint"

    def __init__(self, size: int, slide: int | None = None) -> None:
        self.size, self.slide = size, slide or size

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.buffer = handle.getListState("rows", "vc int")
        self.count = handle.getValueState("count", "n bigint")

    def on_rows(self, rows: pd.DataFrame, timers: Any) -> list[Any]:
        recent = [item[0] for item in self.buffer.get()] if self.buffer.exists() else []
        seen = self.count.get()[0] if self.count.exists() else 0
        held = pd.concat([pd.Series(recent, dtype="Int64"), values_of(rows)], ignore_index=True)
        sums = np.concatenate([[0], np.cumsum(held.fillna(0).to_numpy(np.int64))])
        known = np.concatenate([[0], np.cumsum(held.notna().to_numpy())])
        number = seen - len(recent) + 1 + np.arange(len(held))
        fires = np.flatnonzero((number > seen) & (number % self.slide == 0))
        low = np.maximum(0, fires + 1 - self.size)
        total = pd.Series(sums[fires + 1] - sums[low], dtype="Int64")
        total = total.where(pd.Series(known[fires + 1] > known[low]))
        self.buffer.put([(None if pd.isna(v) else int(v),) for v in held.iloc[-self.size :]])
        self.count.update((seen + len(rows),))
        return [number[fires], fires + 1 - low, total]


class ExpiringValue(PlainProcessor):
    """A value that is gone ``ttl_ms`` after the last read or write (processing time).

    Each row reads the state, which renews it, and writes its own value if above
    ``floor``.
    """

    OUTPUT = "seq bigint, state int"

    def __init__(self, floor: int, ttl_ms: int) -> None:
        self.floor, self.ttl_ms = floor, ttl_ms

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.stored = handle.getValueState("last", "vc int", ttlDurationMs=self.ttl_ms)

    def on_rows(self, rows: dict[str, tuple], timers: Any) -> list[Sequence[Any]]:
        found = self.stored.get()
        held, states = found[0] if found else None, []
        for vc in rows["vc"]:
            states.append(held)
            if vc is not None and vc > self.floor:
                held = vc
        if held is not None:
            self.stored.update((held,))
        return [rows["seq"], states]


class FirstRowTimer(PlainProcessor):
    """Event-time timer set by a key's first row, ``after_ms`` later; fires once per key.

    ``time_ms`` is the event time of a row. With ``cancel_above`` a later row of a larger
    value deletes the pending timer. The state that remembers it stays, so that no
    second timer is set.
    """

    OUTPUT = "timer_ms bigint"

    def __init__(self, after_ms: int, cancel_above: int | None = None) -> None:
        self.after_ms, self.cancel_above = after_ms, cancel_above

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.timer = handle.getValueState("timer", "at_ms bigint")

    def on_rows(self, rows: dict[str, tuple], timers: Any) -> None:
        found = self.timer.get()
        at = found[0] if found else rows["time_ms"][0] + self.after_ms
        if not found:
            self.timer.update((at,))
            self.handle.registerTimer(at)
        if self.cancel_above is not None and any(v is not None and v > self.cancel_above for v in rows["vc"][not found :]):
            self.handle.deleteTimer(at)

    def on_timer(self, at_ms: int, timers: Any) -> list[Sequence[Any]]:
        return [[at_ms]]


class RowTimers(PlainProcessor):
    """Event-time timers one after another: a row at or past the key's last timer sets the next, ``after_ms`` later.

    Only the earliest pending one is a timer of Spark's; when it fires, all that the watermark has passed come out at once
    and the next one is set, so a batch calls a key once however many timers it passes. The last of them clears the
    state, so a key that falls silent keeps nothing. Rows before a fired timer are late and do not reach the processor.
    """

    OUTPUT = "timer_ms bigint"

    def __init__(self, after_ms: int) -> None:
        self.after_ms = after_ms

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "at_ms bigint, pending array<bigint>")

    def on_rows(self, rows: dict[str, tuple], timers: Any) -> None:
        last, pending = self.last.get() or (None, [])
        added = []
        for time_ms in rows["time_ms"]:
            if time_ms is not None and (last is None or time_ms >= last):
                last = time_ms + self.after_ms
                added.append(last)
        if added:
            if not pending:
                self.handle.registerTimer(added[0])
            self.last.update((last, [*pending, *added]))

    def on_timer(self, at_ms: int, timers: Any) -> list[Sequence[Any]]:
        last, pending = self.last.get()
        due = bisect_right(pending, timers.getCurrentWatermarkInMs())
        if due < len(pending):
            self.handle.registerTimer(pending[due])
            self.last.update((last, pending[due:]))
        else:
            self.last.clear()
        return [pending[:due]]


class ClockTimer(KeyedProcessor):
    """Processing-time timer ``after_ms`` past the batch that brings a key's row."""

    OUTPUT = "fired bigint"

    def __init__(self, after_ms: int) -> None:
        self.after_ms = after_ms

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.fired = handle.getValueState("fired", "n bigint")

    def on_rows(self, rows: pd.DataFrame, timers: Any) -> None:
        self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + self.after_ms)

    def on_timer(self, at_ms: int) -> list[Any]:
        count = (self.fired.get()[0] if self.fired.exists() else 0) + 1
        self.fired.update((count,))
        return [[count]]


class RowContext(KeyedProcessor):
    """Each row with its key, its event time and the watermark its batch sees."""

    OUTPUT = "seq bigint, time_ms bigint, watermark_ms bigint"

    def on_rows(self, rows: pd.DataFrame, timers: Any) -> list[Any]:
        return [rows["seq"], rows["time_ms"], np.full(len(rows), timers.getCurrentWatermarkInMs(), np.int64)]


class RunningExtreme(KeyedProcessor):
    """Running largest value with the columns of the key's first row, or of the row that holds it.

    ``whole_row`` takes ``id`` and ``ts`` from the earliest row of the largest value (maxBy), else
    from the first row (max).
    """

    OUTPUT = "seq bigint, id string, ts bigint, vc int, row_seq bigint"

    def __init__(self, whole_row: bool = False) -> None:
        self.whole_row = whole_row

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.stored = handle.getValueState("best", "id string, ts bigint, vc int, row_seq bigint")

    def on_rows(self, rows: pd.DataFrame, timers: Any) -> list[Any]:
        new = rows[["id", "ts", "vc", "seq"]].rename(columns={"seq": "row_seq"})
        if self.stored.exists():
            new = pd.concat([pd.DataFrame([tuple(self.stored.get())], columns=new.columns), new], ignore_index=True)
        vc = new["vc"].astype("Int64")
        best = vc.cummax().ffill()
        rises = (best > best.shift(1).fillna(np.iinfo(np.int64).min)).fillna(False).to_numpy(bool)
        rises[0] = True
        source = np.maximum.accumulate(np.where(rises, np.arange(len(new)), 0)) if self.whole_row else np.zeros(len(new), int)
        held = new.take(source).reset_index(drop=True)
        held["vc"] = best
        last = held.iloc[-1]
        self.stored.update((last["id"], int(last["ts"]), None if pd.isna(last["vc"]) else int(last["vc"]), int(last["row_seq"])))
        held = held.iloc[len(new) - len(rows) :]
        return [rows["seq"].to_numpy(), *[held[c].reset_index(drop=True) for c in ("id", "ts", "vc", "row_seq")]]


class RunningReduce(KeyedProcessor):
    """Pairwise fold: ``id`` of the key's first row, ``ts`` of the latest, sum of the values."""

    OUTPUT = "seq bigint, id string, ts bigint, vc bigint"

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.stored = handle.getValueState("fold", "id string, vc bigint")

    def on_rows(self, rows: pd.DataFrame, timers: Any) -> list[Any]:
        name, before = self.stored.get() if self.stored.exists() else (rows["id"].iloc[0], None)
        vc = pd.concat([pd.Series([pd.NA if before is None else before], dtype="Int64"), values_of(rows)], ignore_index=True)
        total = vc.cumsum().ffill().iloc[1:].reset_index(drop=True)
        last = total.iloc[-1]
        self.stored.update((name, None if pd.isna(last) else int(last)))
        return [rows["seq"], [name] * len(rows), rows["ts"], total]


class LatenessWindows(KeyedProcessor):
    """Tumbling windows that fire at their end and again for each accepted late row.

    The stream's watermark must lag by delay *plus* lateness. A window then fires
    when that watermark reaches ``end - lateness`` and is dropped when it reaches
    ``end``; rows Spark lets through in between are the accepted late ones.
    """

    OUTPUT = "start_ms bigint, firing bigint, n bigint, total bigint"

    def __init__(self, window_ms: int, lateness_ms: int) -> None:
        self.window_ms, self.lateness_ms = window_ms, lateness_ms

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.windows = handle.getMapState("windows", "start bigint", "n bigint, total bigint, fired bigint")

    def on_rows(self, rows: pd.DataFrame, timers: Any) -> list[Any] | None:
        watermark = timers.getCurrentWatermarkInMs()
        starts = rows["time_ms"].astype("int64") // self.window_ms * self.window_ms
        made = []
        for start, values in values_of(rows).fillna(0).groupby(starts):
            start, end = int(start), int(start) + self.window_ms
            if watermark >= end:
                continue
            if self.windows.containsKey((start,)):
                n, total, fired = self.windows.getValue((start,))
            else:
                n, total, fired = 0, 0, 0
                self.handle.registerTimer(end)
                if watermark < end - self.lateness_ms:
                    self.handle.registerTimer(end - self.lateness_ms)
            if watermark >= end - self.lateness_ms:
                step = np.arange(len(values))
                made.append((np.full(len(values), start), fired + step, n + 1 + step, total + values.cumsum().to_numpy(np.int64)))
                fired += len(values)
            self.windows.updateValue((start,), (n + len(values), total + int(values.sum()), fired))
        return [np.concatenate(column) for column in zip(*made, strict=True)] if made else None

    def on_timer(self, at_ms: int) -> list[Any] | None:
        fires, out = at_ms + self.lateness_ms, None
        if fires % self.window_ms == 0:
            entry = (fires - self.window_ms,)
            if self.windows.containsKey(entry):
                n, total, fired = self.windows.getValue(entry)
                if fired == 0:
                    out = [[entry[0]], [0], [n], [total]]
                    self.windows.updateValue(entry, (n, total, 1))
        if at_ms % self.window_ms == 0:
            closed = (at_ms - self.window_ms,)
            if self.windows.containsKey(closed):
                self.windows.removeKey(closed)
        return out


class TopCounts(KeyedProcessor):
    """The ``n`` largest counts of a window, ranked when a timer at its end fires; equal counts by value, null first.

    The key is the window's end in milliseconds. Counts of a window may come in any number of frames and batches; only the
    ``n`` largest are kept, and the timer clears them.
    """

    OUTPUT = "vc int, cnt bigint, rank int"
    key = "end_ms"

    def __init__(self, n: int) -> None:
        self.n = n

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getListState("best", "vc int, cnt bigint")
        self.timer = handle.getValueState("timer", "at_ms bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        best = [tuple(item) for item in self.best.get()] if self.best.exists() else []
        for frame in rows:
            most = frame.assign(vc=values_of(frame)).sort_values(["cnt", "vc"], ascending=[False, True], na_position="first").head(self.n)
            new = [(None if pd.isna(v) else int(v), int(c)) for v, c in zip(most["vc"], most["cnt"], strict=True)]
            best = sorted(best + new, key=lambda item: (-item[1], item[0] is not None, item[0] or 0))[: self.n]
        self.best.put(best)
        if not self.timer.exists():
            self.timer.update((int(key[0]),))
            self.handle.registerTimer(int(key[0]))
        yield from ()

    def on_timer(self, at_ms: int) -> list[Any]:
        best = [tuple(item) for item in self.best.get()]
        self.best.clear()
        self.timer.clear()
        values = pd.Series([v for v, _ in best], dtype="Int64")
        return [values, [c for _, c in best], list(range(1, len(best) + 1))]
