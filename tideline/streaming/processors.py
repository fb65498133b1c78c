"""Keyed state: processors for ``transformWithStateInPandas``.

Spark hands a processor the rows of one key in a micro-batch as Arrow batches in no set order, so
each sorts them by the arrival columns first and then works on whole columns. What one key brings
in a micro-batch is held at once; the source's byte limit bounds it. State is read once and
written once per key and micro-batch. Nulls count as rows but add nothing, as in the batch forms.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import sqrt

import numpy as np
import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tideline.session import ship_by_value

ship_by_value(__name__)

LONG, DOUBLE, FLAG = T.LongType(), T.DoubleType(), T.BooleanType()
#: Beside a value column, whether the value was there; the value itself is then 0. (Spark hands names
#: that begin with an underscore to processors under other names.)
GIVEN = "given_"


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


class Ordered(StatefulProcessor):
    """A processor that knows the arrival columns, and the ``names`` of its output columns."""

    names: Sequence[str] = ()
    ttl_ms: int | None = None

    def __init__(self, order: Sequence[str]):
        self.order = list(order)

    def value_state(self, name: str, **fields: T.DataType):
        return self.handle.getValueState(name, _schema(**fields), self.ttl_ms)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open()

    def open(self) -> None:
        raise NotImplementedError

    def close(self) -> None:
        pass

    def in_order(self, rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
        batches = [batch for batch in rows if len(batch)]
        together = pd.concat(batches, ignore_index=True) if batches else pd.DataFrame()
        if len(together) and self.order:
            together = together.sort_values(self.order, kind="stable", ignore_index=True)
        return together

    def out(self, key: tuple, *columns) -> pd.DataFrame:
        """Rows with the key before the columns."""
        n = len(columns[0])
        name = None if pd.isna(key[0]) else key[0]
        data = {self.names[0]: pd.Series([name] * n, dtype=object)}
        data |= {c: pd.Series(list(v), dtype=object) for c, v in zip(self.names[1:], columns)}
        return pd.DataFrame(data)


def _kept(values: np.ndarray, given: np.ndarray) -> list:
    """Python values, None where nothing was given."""
    return [value if ok else None for value, ok in zip(values.tolist(), given.tolist())]


class BlockAverage(Ordered):
    """The average of every ``size`` values of a key. The open block is kept as counts and a
    sum (``store="value"``), as a list, or as a map by position."""

    OUTPUT = "block long, average double"

    def __init__(self, order: Sequence[str], value: str, size: int, store: str = "value"):
        super().__init__(order)
        self.value, self.size, self.store = value, size, store

    def open(self) -> None:
        self.done = self.value_state("blocks", blocks=LONG)
        pair = {"value": DOUBLE, "given": FLAG}
        if self.store == "value":
            self.state = self.value_state("open", n=LONG, given=LONG, total=DOUBLE)
        elif self.store == "list":
            self.state = self.handle.getListState("open", _schema(**pair), self.ttl_ms)
        elif self.store == "map":
            self.state = self.handle.getMapState(
                "open", _schema(pos=LONG), _schema(**pair), self.ttl_ms
            )
        else:
            raise ValueError(f"unknown state kind: {self.store}")

    def _load(self) -> tuple[int, int, float]:
        """Rows, values and sum of the open block."""
        if not self.state.exists():
            return 0, 0, 0.0
        if self.store == "value":
            return tuple(self.state.get())
        rows = list(self.state.get() if self.store == "list" else self.state.values())
        return len(rows), sum(row[1] for row in rows), sum(row[0] for row in rows)

    def _save(self, kept: int, values: np.ndarray, given: np.ndarray, sums: tuple) -> None:
        """``values`` are those of the open block behind the first ``kept``."""
        if self.store == "value":
            self.state.update(sums)
            return
        if not kept:
            self.state.clear()
        added = list(zip(values.tolist(), given.tolist()))
        if self.store == "list":
            if added:
                self.state.appendList(added)
        else:
            for i, pair in enumerate(added):
                self.state.updateValue((kept + i,), pair)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = self.in_order(rows)
        n, known, total = self._load()
        block = self.done.get()[0] if self.done.exists() else 0
        values = found[self.value].to_numpy(float)
        given = found[GIVEN].to_numpy(bool)
        number = (n + np.arange(len(values))) // self.size
        full = (n + len(values)) // self.size
        sums = np.bincount(number, values, full + 1)
        counts = np.bincount(number, given, full + 1)
        sums[0] += total
        counts[0] += known
        if full:
            with np.errstate(invalid="ignore"):
                averages = _kept(sums[:full] / counts[:full], counts[:full] > 0)
            yield self.out(key, range(block + 1, block + 1 + full), averages)
            self.done.update((block + full,))
        last = number == full
        rows_open = (n + len(values)) % self.size
        state = (int(rows_open), int(counts[full]), float(sums[full]))
        self._save(0 if full else n, values[last], given[last], state)


class CountWindow(Ordered):
    """Sums over counted rows of a key, at each ``every``-th row: of all rows so far
    (``size`` None), or of the last ``size`` rows. ``kind`` is the sum's type."""

    def __init__(
        self, order: Sequence[str], value: str, every: int, size: int | None, kind: T.DataType
    ):
        super().__init__(order)
        self.value, self.every, self.size, self.kind = value, every, size, kind

    def open(self) -> None:
        self.state = self.value_state(
            "window",
            n=LONG,
            total=self.kind,
            given=LONG,
            tail=T.ArrayType(self.kind),
            there=T.ArrayType(FLAG),
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = self.in_order(rows)
        n, total, known, tail, there = 0, 0, 0, [], []
        if self.state.exists():
            n, total, known, tail, there = self.state.get()
        values = found[self.value].to_numpy()
        # sums from before the tail, so that a window is a difference of two places
        values = np.concatenate([np.array(list(tail), values.dtype), values])
        given = np.concatenate([np.array(list(there), bool), found[GIVEN].to_numpy(bool)])
        # what was there before comes first, so that sums are added up in the order of the rows
        start = np.array([total if self.size is None else 0], values.dtype)
        sums = np.cumsum(np.concatenate([start, values]))
        counts = np.concatenate([[0], np.cumsum(given)])
        held = len(tail)
        place = np.arange(1, len(found) + 1)
        fires = place[(n + place) % self.every == 0]
        at = held + fires
        if self.size is None:
            result, some = sums[at], known + counts[at]
        else:
            begin = np.maximum(at - self.size, 0)
            if values.dtype.kind == "f":
                # no difference of large sums: each window is added up by itself
                result = np.array([values[a:b].sum() for a, b in zip(begin, at)])
            else:
                result = sums[at] - sums[begin]
            some = counts[at] - counts[begin]
        if len(fires):
            yield self.out(key, (n + fires).tolist(), _kept(result, some > 0))
        keep = 0 if self.size is None else self.size
        self.state.update(
            (
                n + len(found),
                sums[-1].item() if self.size is None else 0 * sums[-1].item(),
                known + int(given[held:].sum()),
                values[len(values) - min(keep, len(values)) :].tolist(),
                given[len(given) - min(keep, len(given)) :].tolist(),
            )
        )


class RunningFold(Ordered):
    """Per row, the sum of its key so far and the text of all its values (``words``)."""

    def __init__(self, order: Sequence[str], value: str, with_text: bool, kind: T.DataType):
        super().__init__(order)
        self.value, self.with_text, self.kind = value, with_text, kind

    def open(self) -> None:
        self.state = self.value_state("so_far", total=self.kind, given=FLAG, text=T.StringType())

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = self.in_order(rows)
        total, known, text = self.state.get() if self.state.exists() else (0, False, None)
        given = found[GIVEN].to_numpy(bool)
        values = found[self.value].to_numpy()
        sums = np.cumsum(np.concatenate([np.array([total], values.dtype), values]))[1:]
        some = known | (np.cumsum(given) > 0)
        texts = [None] * len(found)
        if self.with_text:
            for i, (word, ok) in enumerate(zip(found["words"], given.tolist())):
                if ok:
                    text = f"Contains: {word}" if text is None else f"{text} and {word}"
                texts[i] = text
        yield self.out(key, found[self.order[0]].tolist(), _kept(sums, some), texts)
        self.state.update((sums[-1].item(), bool(some[-1]), text))


class IdleCount(Ordered):
    """Rows per key, emitted and forgotten once the key has had no row for ``idle_ms``."""

    OUTPUT = "n long"

    def __init__(self, idle_ms: int):
        super().__init__([])
        self.idle_ms = idle_ms

    def open(self) -> None:
        self.state = self.value_state("count", n=LONG, due=LONG)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n, due = self.state.get() if self.state.exists() else (0, None)
        if due is not None:
            self.handle.deleteTimer(due)
        n += sum(len(batch) for batch in rows)
        due = timerValues.getCurrentProcessingTimeInMs() + self.idle_ms
        self.handle.registerTimer(due)
        self.state.update((n, due))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        n, _ = self.state.get()
        self.state.clear()
        yield self.out(key, [n])


class BlockList(Ordered):
    """Rows pass until a control row of their key has arrived; then the key is blocked."""

    def __init__(self, order: Sequence[str], is_control: str, columns: Sequence[str]):
        super().__init__(order)
        self.is_control, self.columns = is_control, list(columns)

    def open(self) -> None:
        self.state = self.value_state("blocked", blocked=FLAG)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            return
        found = self.in_order(rows)
        controls = np.flatnonzero(found[self.is_control].to_numpy(bool))
        if len(controls):
            self.state.update((True,))
            found = found.iloc[: controls[0]]
        if len(found):
            yield self.out(key, *[_plain(found[name]) for name in self.columns])


def _plain(column: pd.Series) -> list:
    """The values with None for what is missing."""
    return [None if missing else value for value, missing in zip(column.tolist(), column.isna())]


class Slots(Ordered):
    """Pairs rows of two sides of a key, with one saved row per side; a payload may be null."""

    def __init__(self, order: Sequence[str], is_left: str, payload: str, kind: T.DataType):
        super().__init__(order)
        self.is_left, self.payload, self.kind = is_left, payload, kind

    def open(self) -> None:
        self.sides = {
            side: self.value_state(name, payload=self.kind)
            for side, name in ((True, "left"), (False, "right"))
        }

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = self.in_order(rows)
        # what is saved is a tuple with the payload, or nothing
        saved = {s: tuple(state.get()) if state.exists() else None for s, state in self.sides.items()}
        before = dict(saved)
        pairs = []
        given = found[GIVEN].tolist()
        payloads = [value if ok else None for value, ok in zip(found[self.payload].tolist(), given)]
        arrivals = zip(
            found[self.order[0]].tolist(), found[self.is_left].tolist(), payloads
        )
        for seq, side, payload in arrivals:
            partner = saved[not side]
            if partner is None:
                saved[side] = (payload,)
                continue
            saved[not side] = None
            pairs.append((seq, payload, partner[0]) if side else (seq, partner[0], payload))
        for side, state in self.sides.items():
            if saved[side] is None and before[side] is not None:
                state.clear()
            elif saved[side] != before[side]:
                state.update(saved[side])
        if pairs:
            yield self.out(key, *zip(*pairs))


class StopSegments(Ordered):
    """Segments of a key closed by stop rows, emitted when the watermark passes the stop.

    Columns: ``at`` (microseconds), ``is_stop``, ``speed``, ``throttle``. Rows wait until the
    watermark has passed them, then they are folded into the open segment's count, start, top
    speed, and the count, mean and sum of squared differences of its throttle. So a key keeps
    the rows of one watermark delay and one summary, however long its segment lasts.
    """

    OUTPUT = "start_at long, stop_at long, length long, max_speed double, erraticness double"
    NOTHING = (0, None, None, 0, 0.0, 0.0)

    def __init__(self):
        super().__init__(["at", "is_stop"])

    def open(self) -> None:
        self.held = self.handle.getListState(
            "held", _schema(at=LONG, is_stop=FLAG, speed=DOUBLE, throttle=DOUBLE)
        )
        self.due = self.value_state("due", due=LONG)
        self.segment = self.value_state(
            "segment", n=LONG, start=LONG, speed=DOUBLE, k=LONG, mean=DOUBLE, squares=DOUBLE
        )

    def _wake_at(self, at: int) -> None:
        """One timer per key, at the earliest row that waits."""
        due = -(-at // 1000)
        if self.due.exists():
            before = self.due.get()[0]
            if before <= due:
                return
            self.handle.deleteTimer(before)
        self.handle.registerTimer(due)
        self.due.update((due,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = self.in_order(rows)
        columns = [_plain(found[name]) for name in ("at", "is_stop", "speed", "throttle")]
        added = list(zip(*columns))
        if added:
            self.held.appendList(added)
            self._wake_at(added[0][0])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        limit = timerValues.getCurrentWatermarkInMs() * 1000
        rows = sorted((tuple(row) for row in self.held.get()), key=lambda row: row[:2])
        ready = [row for row in rows if row[0] <= limit]
        rest = rows[len(ready) :]
        part = tuple(self.segment.get()) if self.segment.exists() else self.NOTHING
        closed = []
        # a stop closes the rows of its own moment too, which sort before it
        for at, is_stop, speed, throttle in ready:
            n, start, top, k, mean, squares = part
            if is_stop:
                if n:
                    spread = sqrt(squares / k) if k else None
                    closed.append((start, at, n, top, spread))
                part = self.NOTHING
                continue
            if throttle is not None:
                k += 1
                step = throttle - mean
                mean += step / k
                squares += step * (throttle - mean)
            top = speed if top is None else top if speed is None else max(top, speed)
            part = (n + 1, at if start is None else start, top, k, mean, squares)
        if part[0]:
            self.segment.update(part)
        else:
            self.segment.clear()
        self.due.clear()
        if rest:
            self.held.put(rest)
            self._wake_at(rest[0][0])
        else:
            self.held.clear()
        if closed:
            yield self.out(key, *zip(*closed))
