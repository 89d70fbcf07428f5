"""Operators on unbounded frames that act at instants of their own, or before the watermark drops a row."""

from __future__ import annotations

import heapq
import tempfile
from collections.abc import Iterable, Iterator, Sequence
from itertools import batched
from typing import IO

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidelog.operators.orders import FAIL, FAILED, ORDER_COLUMNS, PASS, RULES, VALIDATED
from tidelog.operators.windows import MINUTE
from tidelog.plans.ordered import micros
from tidelog.streaming.packed import ROWS_PER_PACK, blob, pack, packed_by, unpack, unpacked
from tidelog.streaming.stateful import Lateness, ddl, transform_state


def punctuate_stream(
    df: DataFrame, keys: Sequence[str], ts: str, every: int, late: Lateness, name: str = "cnt", until: int | None = None
) -> DataFrame:
    """Streaming form of ``punctuate_snapshot``: at each tick of ``every`` microseconds the count of every key seen so far.

    Ticks go on while the watermark does; ``until`` is the last one of an input that ends.
    """

    if late.end and until is None:
        raise ValueError("an input that ends needs the last tick")

    def tick(state, at):
        after = at + every
        return state, [(state[0], at)], after if until is None or after <= until else None

    def wake(state, at):
        return (at // every + 1) * every

    rows = df.select(*keys, F.col(ts).alias("_ts"))
    made = transform_state(
        rows, keys, lambda state, row: ((state[0] + 1,), []), f"{name} bigint, tick_us bigint", (0,), ["_ts"], late, tick=tick, wake=wake
    )
    return made.select(*keys, name, F.timestamp_micros("tick_us").alias("tick"))


def sliding_inverse_reduce_stream(
    df: DataFrame, keys: Sequence[str], ts: str, size: int, step: int, late: Lateness, name: str = "cnt"
) -> DataFrame:
    """Streaming form of ``sliding_inverse_reduce``: runs of window starts with one count, each when its end is known.

    A key holds a ring of panes, at most ``size / step + 1``: how many rows leave at which window start. A row is added when it
    enters; a timer subtracts a pane once no row can come any more that enters before it. A key without rows stays at 0.
    """

    def moved(begin, count, at):
        """The run that ends before ``at``, unless it begins there."""
        return [] if begin is None or begin == at else [(begin, at - step, count)]

    def enter(state, row):
        begin, count, leaving = state
        place = row["_place"]
        at, until = ((place - size) // step + 1) * step, (place // step + 1) * step
        made = moved(begin, count, at)
        if leaving and leaving[-1][0] == until:
            leaving = (*leaving[:-1], (until, leaving[-1][1] + 1))
        else:
            leaving = (*leaving, (until, 1))
        return (at, count + 1, leaving), made

    def leave(state, _):
        begin, count, ((at, rows), *others) = state
        left = (at, count - rows, tuple(others))
        return left, moved(begin, count, at), wake(left, None)

    def wake(state, _):
        # A row before this instant can still enter at or before the first start that loses rows.
        return state[2][0][0] + size if state[2] else None

    rows = df.select(*keys, F.col(ts).alias("_ts"))
    output = f"from_us bigint, to_us bigint, {name} bigint"
    runs = transform_state(rows, keys, enter, output, (None, 0, ()), ["_ts"], late, tick=leave, wake=wake)
    return runs.select(
        *keys, F.timestamp_micros("from_us").alias("start_from"), F.timestamp_micros("to_us").alias("start_to"), name
    )


class AsArrived(StatefulProcessor):
    """Flags rows that are far behind the newest of their lane that arrived before. There is no watermark, so none is dropped.

    The packed rows of a trigger are sorted list by list, written to a file of the task, and merged from there: a slice of each list is in memory.
    """

    def __init__(self, allowed: int, arrival: Sequence[str], fields: Sequence[str]) -> None:
        self.allowed, self.arrival, self.at = allowed, [fields.index(c) for c in arrival], fields.index("_at")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("newest", "at bigint")

    def _turn(self, row: tuple) -> list[tuple]:
        return [(row[c] is None, row[c]) for c in self.arrival]

    def _written(self, file: IO[bytes], rows: list[tuple]) -> Iterator[tuple]:
        """The rows in order, read again slice by slice."""
        rows.sort(key=self._turn)
        places = []
        for some in batched(rows, ROWS_PER_PACK):
            one = blob(some)
            places.append((file.tell(), len(one)))
            file.write(one)

        def again() -> Iterator[tuple]:
            for place, length in places:
                file.seek(place)
                yield from unpack(file.read(length))

        return again()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        with tempfile.TemporaryFile() as file:
            lists = [self._written(file, unpack(row["row"])) for row in rows]
            yield from pack(self._flagged(heapq.merge(*lists, key=self._turn)))

    def _flagged(self, rows: Iterable[tuple]) -> Iterator[tuple]:
        newest = self.state.get()[0] if self.state.exists() else None
        for row in rows:
            at = row[self.at]
            yield (*row[: self.at], newest is not None and at is not None and at < newest - self.allowed)
            if at is not None and (newest is None or at > newest):
                newest = at
        if newest is not None:
            self.state.update((newest,))

    def close(self) -> None:
        pass


def late_flag_stream(
    df: DataFrame, ts: str, allowed: int, lane: Sequence[str], arrival: Sequence[str], flag: str = "late"
) -> DataFrame:
    """Streaming form of ``late_flag``: rows in time and late rows are two filters over one output, so late ones can go elsewhere.

    State is one instant a lane, and a lane is a partition of the source. Triggers must follow the order of arrival; rows of one trigger are sorted
    by it.
    """
    rows = df.withColumn("_at", micros(ts))
    flagged = packed_by(rows, lane).groupBy(*lane).transformWithState(
        AsArrived(allowed, arrival, rows.columns), "rows binary", "append", "none"
    )
    return unpacked(flagged, f"{ddl(df, df.columns)}, `{flag}` boolean")


def validation_stream(
    validations: DataFrame, orders: DataFrame, late: Lateness, window: int = 5 * MINUTE, rules: int = RULES, keep: int | None = None
) -> DataFrame:
    """Streaming form of ``validation_aggregate``: new orders with their verdict.

    An order is VALIDATED when a window in which all rules passed can no longer change and no order near it can come any more,
    and FAILED, once, when its own window is over and a rule failed in it. That an order failed is remembered for ``keep`` microseconds after its
    last row, or for ever; rows that were decided on leave the state.
    """
    payload = [c for c in ORDER_COLUMNS if c not in ("id", "state")]
    created = orders.filter("state = 'CREATED'").select(
        "id", F.col("ts").alias("_ts"), F.lit(0).alias("_side"), F.lit(None).cast("string").alias("_result"),
        *[F.col(c).alias(f"o_{c}") for c in payload],
    )
    results = validations.filter(F.col("result").isin(PASS, FAIL)).select(
        "id", F.col("ts").alias("_ts"), F.lit(1).alias("_side"), F.col("result").alias("_result")
    )

    def step(state, row):
        waiting, passed, failed, fired = state
        at = row["_place"]
        if row["_side"] == 0:
            waiting = [*waiting, (at, False, tuple(row[f"o_{c}"] for c in payload))]
        elif row["_result"] == PASS:
            slot = at // window
            n, newest = passed.get(slot, (0, at))
            passed = {**passed, slot: (n + 1, max(newest, at))}
        elif not fired:
            failed = [*failed, at]
        return (waiting, passed, failed, fired), []

    def due(state):
        waiting, passed, _, _ = state
        ends = [(slot + 2) * window for slot in passed]
        ends += [at + 3 * window + 1 if checked else at + window + 1 for at, checked, _ in waiting]
        return min(ends, default=None)

    def tick(state, now):
        waiting, passed, failed, fired = state
        made = []
        for slot in [s for s in sorted(passed) if (s + 2) * window <= now]:
            n, newest = passed[slot]
            if n >= rules:
                made += [(*order, VALIDATED) for at, _, order in waiting if abs(newest - at) <= window]
        passed = {s: v for s, v in passed.items() if (s + 2) * window > now}
        kept = []
        for at, checked, order in waiting:
            if not checked and at + window < now:
                checked = True
                if not fired and any(abs(f - at) <= window for f in failed):
                    fired = True
                    made.append((*order, FAILED))
            if at + 3 * window >= now:
                kept.append((at, checked, order))
        # A failure can still meet orders that come within the window behind it.
        failed = [] if fired else [f for f in failed if f + window >= now or any(not c for _, c, _ in kept)]
        state = (kept, passed, failed, fired)
        return state, made, due(state)

    rows = created.unionByName(results, allowMissingColumns=True)
    columns = ", ".join([ddl(orders, payload), "state string"])
    made = transform_state(
        rows, ["id"], step, columns, ([], {}, [], False), ["_ts", "_side"], late, keep, tick=tick, wake=lambda state, at: due(state)
    )
    return made.select(*ORDER_COLUMNS)
