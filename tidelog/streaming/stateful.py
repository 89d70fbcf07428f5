"""Operators that keep state per key on an unbounded frame.

Each is a small ``step(state, row) -> (state, rows)`` given to ``transform_state``. Spark
shuffles by key, keeps the state and restores it after a failure.

Rows are put in order before they are seen: a row waits until the watermark
has passed it, so results do not depend on how the input is split into triggers. ``Lateness``
says how far rows may be out of order; a row that comes later than that is dropped.

Keys are dealt to shards, and Spark's state is kept by shard: calls to the state cost more than the work on a row, and so does handing
over a row. Rows go to their shard many at a time, under the newest instant among them; a shard knows how far the watermark was, by a timer at
each of its steps, and drops the late rows among them itself. Rows that wait
lie in pieces by stretches of time. A trigger writes pieces of what arrived, reads
the stretches that are due, and reads and writes each key that is due once; it does not touch what else waits.
"""

from __future__ import annotations

import heapq
import pickle
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidelog.functions import nfa
from tidelog.operators.cep import Pattern, match_schema, runtime_steps, with_conditions
from tidelog.operators.orders import exact_amount
from tidelog.plans.ordered import micros
from tidelog.sources.sinks import end_of_input
from tidelog.streaming.packed import blob, pack, packed, unpack, unpacked

Step = Callable[[tuple, dict], tuple[tuple, list[tuple]]]
# A user's timer: state and instant (microseconds) to state, rows, and the next instant or None.
Tick = Callable[[tuple, int], tuple[tuple, list[tuple], "int | None"]]
# Whole numbers as instants, one microsecond each, begin a day after the first watermark.
DAY = 86_400_000_000


@dataclass(frozen=True)
class Lateness:
    """How far rows may be out of order, and how a finite input ends.

    ``delay`` is how far behind the newest position a row may still come: microseconds for
    timestamps, units for whole numbers. A key's state holds the rows of that stretch.
    ``end`` names a folder: once ``close_input`` has put a file there, all rows that wait come out.
    """

    delay: int = 0
    end: str | None = None


def ddl(df: DataFrame, columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


# Groups of keys whose state is kept together; a part of the state's layout, so it must not change while a query lives.
SHARDS = 256
# The stretch that rows may be out of order is cut into so many buckets.
BUCKETS = 64
# Rows of a shard that are held before they are written, and keys whose state is held before it is written.
ROWS_HELD, KEYS_HELD = 20_000, 100_000
# A call to the state takes about as long as hundreds of rows: neighbouring buckets share a piece up to so many rows, and keys share a block.
ROWS_PER_PIECE, KEYS_PER_BLOCK = 2_000, 64


def _in_time(df: DataFrame, keys: Sequence[str], first: str, late: Lateness) -> tuple[DataFrame, list[str]]:
    """Packed rows (``row``, a list of the values of the columns named beside) with shard and newest instant (``_time``, watermarked).
    A null list has no rows: it tells of the end of the input, or that others go on."""
    whole = isinstance(df.schema[first].dataType, T.IntegralType)
    instant = F.timestamp_micros(F.col(first).cast("bigint") + DAY) if whole else F.col(first)
    for key in keys:
        if isinstance(df.schema[key].dataType, (T.FloatType, T.DoubleType)):
            # Zeros of both signs are one key.
            df = df.withColumn(key, (F.col(key) + F.lit(0.0)).cast(df.schema[key].dataType))
    rows = df.withColumn("_time", instant).filter(F.col("_time").isNotNull()).withColumn("_place", F.unix_micros("_time"))
    names = [*keys, *[c for c in df.columns if c not in keys], "_place"]
    shard = F.pmod(F.xxhash64(*keys), F.lit(SHARDS)).cast("int")
    rows = packed(rows.withColumn("_shard", shard), "_shard", "_place", names, SHARDS)
    if late.end:
        end = end_of_input(df.sparkSession, late.end)
        rows = rows.unionByName(end.select("_time", F.lit(0).alias("_shard")), allowMissingColumns=True)
    return rows.withWatermark("_time", f"{late.delay // 1000 + 1} milliseconds"), names


class InOrder(StatefulProcessor):
    """Hands the rows of a key to ``step`` in order, once the watermark has passed them.

    ``tick`` is called at the instant a state asks for: ``wake(state, place)`` says when that is, after each row. Rows before an
    instant are seen before its tick, rows at it after. A key that must be looked at without a row (for a tick, or to be forgotten) waits
    by its name among the rows; far ahead it waits at the beginning of a longer stretch, and is put in its place from there.
    """

    def __init__(
        self, keys: Sequence[str], fields: Sequence[str], step: Step, initial: tuple, ties: Sequence[str], width: int,
        keep: int | None, tick: Tick | None = None, wake: Callable[[tuple, int], int | None] | None = None,
    ) -> None:
        self.count, self.fields, self.step, self.initial, self.width, self.keep = len(keys), fields, step, initial, width, keep
        self.tick, self.wake = tick, wake
        self.place, self.ties = fields.index("_place"), [fields.index(c) for c in ties]
        self.blank = pickle.dumps(initial)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Rows, and keys to look at with the millisecond when they are due, under the first bucket that they lie in.
        self.pieces = handle.getMapState("pieces", "bucket bigint, piece int", "entries binary")
        # Buckets with the number of their pieces and the first instant due, the watermark so far, and the numbers of stored keys and blocks.
        self.plan = handle.getValueState("plan", "buckets binary")
        # States of the keys of a block, by their names.
        self.states = handle.getMapState("states", "block bigint", "value binary")

    def _planned(self) -> tuple[dict[int, tuple[int, int]], int]:
        stored = self.plan.get()
        plan, passed, self.stored, self.blocks = pickle.loads(stored[0]) if stored else ({}, 0, 0, 1)
        return plan, passed

    def _save(self, plan: dict, passed: int) -> None:
        self.plan.update((pickle.dumps((plan, passed, self.stored, self.blocks)),))
        self.handle.registerTimer(passed + 1)

    def _file(self, plan: dict, found: dict[int, list]) -> None:
        """Write what waits, by bucket: the first instant due, rows, and names."""
        home, first, rows, names = None, None, [], []
        for bucket in sorted(found):
            due, some, named = found[bucket]
            if home is None:
                home, first = bucket, due
            rows, names = rows + some, names + named
            if len(rows) + len(names) >= ROWS_PER_PIECE:
                self._piece(plan, home, first, rows, names)
                home, rows, names = None, [], []
        if home is not None:
            self._piece(plan, home, first, rows, names)

    def _piece(self, plan: dict, bucket: int, first: int, rows: list[tuple], names: list[tuple[int, str]]) -> None:
        pieces, before = plan.get(bucket, (0, first))
        self.pieces.updateValue((bucket, pieces), (blob((rows, names)),))
        plan[bucket] = (pieces + 1, min(first, before))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        plan, passed = self._planned()
        # The watermark of the trigger before: what Spark drops late rows by. The timer moves it on, once these rows wait.
        found, held, late = {}, 0, passed * 1000
        for row in rows:
            if row["row"] is None:
                continue
            for values in unpack(row["row"]):
                if values[self.place] > late:
                    self._to(found, values)
                    held += 1
            if held >= ROWS_HELD:
                self._file(plan, found)
                found, held = {}, 0
        self._file(plan, found)
        self._save(plan, passed)
        return iter(())

    def _to(self, found: dict[int, list], row: tuple) -> int:
        due = row[self.place] // 1000 + 1
        bucket = due // self.width
        entry = found.get(bucket)
        if entry is None:
            found[bucket] = [due, [row], []]
        else:
            entry[1].append(row)
            if due < entry[0]:
                entry[0] = due
        return bucket

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        plan, passed = self._planned()
        if now <= passed:
            return
        if any(first <= now for _, first in plan.values()):
            self.known, self.held, self.changed = {}, {}, set()
            self.ahead, self.turns, self.listed = {}, list(plan), set(plan)
            heapq.heapify(self.turns)
            yield from pack(self._due_rows(plan, now))
            self._write()
            self._file(plan, self.ahead)
        self._save(plan, now)

    def _list(self, bucket: int) -> None:
        if bucket not in self.listed:
            self.listed.add(bucket)
            heapq.heappush(self.turns, bucket)

    def _due_rows(self, plan: dict, now: int) -> Iterator[tuple]:
        """Rows made up to ``now``, bucket after bucket. A bucket is handled as if the watermark stood at its end."""
        while self.turns:
            bucket = self.turns[0]
            pieces, first = plan.get(bucket, (0, None))
            entry = self.ahead.get(bucket)
            if min(due for due in (first, entry and entry[0]) if due is not None) > now:
                return
            heapq.heappop(self.turns)
            self.listed.remove(bucket)
            plan.pop(bucket, None)
            self.ahead.pop(bucket, None)
            until, found = min(now, (bucket + 1) * self.width - 1), {}
            end, parts = until * 1000, [entry[1:]] if entry else []
            for piece in range(pieces):
                parts.append(unpack(self.pieces.getValue((bucket, piece))[0]))
                self.pieces.removeKey((bucket, piece))
            while parts:
                rows, names = parts.pop()
                for row in rows:
                    if row[self.place] >= end:
                        self._list(self._to(self.ahead, row))
                        continue
                    name = repr(row[: self.count])
                    if name in found:
                        found[name].append(row)
                    else:
                        found[name] = [row]
                for due, name in names:
                    if due > until:
                        self._name(due, name)
                    else:
                        found.setdefault(name, [])
            for name in sorted(found, key=self._block):
                yield from self._advance(name, found[name], until)
                if len(self.known) > KEYS_HELD:
                    self._write()

    def _name(self, due: int, name: str) -> None:
        """A key that is looked at when ``due``, without a row."""
        bucket = due // self.width
        entry = self.ahead.setdefault(bucket, [due, [], []])
        entry[0] = min(entry[0], due)
        entry[2].append((due, name))
        self._list(bucket)

    def _turn(self, row: tuple) -> tuple:
        return (row[self.place], *[(row[c] is None, row[c]) for c in self.ties])

    def _advance(self, name: str, rows: list[tuple], until: int) -> Iterator[tuple]:
        """A key's rows in order, then its ticks up to ``until`` (milliseconds)."""
        block = self._block(name)
        if block not in self.held:
            self._read(block)
        known = self.known.get(name)
        if known is None:
            if not rows:
                return
            known = (rows[0][: self.count], self.initial, 0, None, None)
        key, current, newest, alarm, told = known
        if len(rows) > 1:
            rows.sort(key=self._turn)
        for values in rows:
            row = dict(zip(self.fields, values))
            place = row["_place"]
            while alarm is not None and alarm <= place:
                current, made, alarm = self.tick(current, alarm)
                for one in made:
                    yield (*key, *one)
            if self.keep is not None and place - newest > self.keep:
                current = self.initial
            current, made = self.step(current, row)
            for one in made:
                yield (*key, *one)
            newest = place
            if self.wake is not None:
                alarm = self.wake(current, newest)
        while alarm is not None and alarm <= until * 1000:
            current, made, alarm = self.tick(current, alarm)
            for one in made:
                yield (*key, *one)
        if alarm is not None:
            told = self._look(name, -(-alarm // 1000), told, until)
        elif self.keep is not None:
            if until * 1000 > newest + self.keep + 1000:
                current, newest = self.initial, 0
            else:
                told = self._look(name, (newest + self.keep) // 1000 + 3, told, until)
        self.known[name] = (key, current, newest, alarm, told)
        self.changed.add(block)

    def _look(self, name: str, due: int, told: int | None, until: int) -> int:
        """When the key is looked at next, at ``due`` or before."""
        bucket = due // self.width
        if bucket - until // self.width > BUCKETS:
            bucket = bucket // BUCKETS * BUCKETS
            due = bucket * self.width
        if told is not None and until < told <= due:
            return told
        self._name(due, name)
        return due

    def _block(self, name: str) -> int:
        return zlib.crc32(name.encode()) & (self.blocks - 1)

    def _read(self, block: int) -> None:
        value = self.states.getValue((block,)) if self.stored else None
        found = unpack(value[0]) if value else {}
        self.held[block] = len(found)
        self.known.update(found)

    def _write(self) -> None:
        kept = {}
        for name, known in self.known.items():
            _, current, newest, alarm, _ = known
            # A key in its first state is not kept.
            if alarm is not None or (self.keep is not None and newest != 0) or pickle.dumps(current) != self.blank:
                kept[name] = known
        total = self.stored - sum(self.held.values()) + len(kept)
        if total > KEYS_PER_BLOCK * self.blocks:
            self._split(total)
        by_block: dict[int, dict] = {}
        for name, known in kept.items():
            by_block.setdefault(self._block(name), {})[name] = known
        for block in self.changed:
            some = by_block.get(block, {})
            if some:
                self.states.updateValue((block,), (blob(some),))
            elif self.held.get(block):
                self.states.removeKey((block,))
        self.stored = total
        self.known, self.held, self.changed = {}, {}, set()

    def _split(self, total: int) -> None:
        """More blocks, each a part of an old one. Keys of old blocks that are not held are written to them at once."""
        before = self.blocks
        while total > KEYS_PER_BLOCK // 2 * self.blocks:
            self.blocks *= 2
        for block in range(before) if self.stored else ():
            if block in self.held:
                continue
            value = self.states.getValue((block,))
            parts: dict[int, dict] = {}
            for name, known in (unpack(value[0]) if value else {}).items():
                parts.setdefault(self._block(name), {})[name] = known
            for part, some in parts.items():
                self.states.updateValue((part,), (blob(some),))
            if value and block not in parts:
                self.states.removeKey((block,))
        self.changed = {part for block in self.held for part in range(block, self.blocks, before)}

    def close(self) -> None:
        pass


def transform_state(
    df: DataFrame,
    keys: Sequence[str],
    step: Step,
    output: str,
    initial: tuple,
    order: Sequence[str],
    late: Lateness,
    keep: int | None = None,
    mode: str = "append",
    tick: Tick | None = None,
    wake: Callable[[tuple, int], int | None] | None = None,
) -> DataFrame:
    """User function with a store per key; it may emit any number of rows per input row.

    ``order`` begins with a timestamp or whole number, whose watermark decides when rows are due;
    it must be total and lie in the years 1970 to 2261. ``output`` lists the columns after the keys. A key without rows for ``keep``
    microseconds (or units) of that position is forgotten; None keeps it for ever. Rows without a
    key or a position are dropped.

    Timers: after each row ``wake(state, place)`` may name an instant (microseconds since 1970, behind the row's) at which
    ``tick(state, instant) -> (state, rows, next instant or None)`` is called, between the rows before and after it.
    """
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    rows, fields = _in_time(df, keys, order[0], late)
    least = 1 if isinstance(df.schema[order[0]].dataType, T.IntegralType) else 1000
    width = max(least, late.delay // 1000 // BUCKETS)
    processor = InOrder(keys, fields, step, initial, list(order[1:]), width, keep, tick, wake)
    return unpacked(
        rows.groupBy("_shard").transformWithState(processor, "rows binary", mode, "eventTime"), f"{ddl(df, keys)}, {output}"
    )


def running_count_stream(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], late: Lateness, carry: Sequence[str] = ()
) -> DataFrame:
    """Count so far, once per row."""
    kept = list(dict.fromkeys([*carry, *order]))

    def step(state, row):
        n = state[0] + 1
        return (n,), [(*[row[c] for c in kept], n)]

    return transform_state(
        df.select(*keys, *kept), keys, step, f"{ddl(df, kept)}, cnt bigint", (0,), order, late
    )


def sessionize_stream(
    df: DataFrame, keys: Sequence[str], arrival: Sequence[str], ts: str, gap: int, late: Lateness
) -> DataFrame:
    """Session number per row; state follows arrival order."""

    def step(state, row):
        last, session = state
        if last is not None and last < row["_at"] - gap:
            session += 1
        return (row["_at"], session), [(*[row[c] for c in arrival], session)]

    rows = df.select(*keys, *arrival, micros(ts).alias("_at"))
    return transform_state(
        rows, keys, step, f"{ddl(df, arrival)}, session_id bigint", (None, 0), arrival, late
    )


def moving_average_stream(
    df: DataFrame, n: int, keys: Sequence[str], order: Sequence[str], number: Column, late: Lateness
) -> DataFrame:
    """Whole-number mean of the last ``n`` valid numbers; invalid rows repeat it."""

    def step(state, row):
        recent = list(state[0])
        if row["_num"] is not None:
            recent = [*recent, int(row["_num"])][-n:]
        made = []
        if recent:
            total = sum(recent)
            mean = abs(total) // len(recent) * (1 if total >= 0 else -1)
            made = [(*[row[c] for c in order], mean)]
        return (recent,), made

    rows = df.select(*keys, *order, number.alias("_num"))
    return transform_state(
        rows, keys, step, f"{ddl(df, order)}, avg bigint", ([],), order, late
    )


def dedup_stream(
    df: DataFrame, ids: Sequence[str], ts: str, arrival: Sequence[str], span: int, late: Lateness,
    grace: int = 0,
) -> DataFrame:
    """Streaming form of ``dedup_window``. The memory keeps instants up to ``span + grace``
    behind the newest of the id, in order, so that a row looks only at its neighbours."""
    half, carry = span // 2, [c for c in df.columns if c not in ids]

    def step(state, row):
        # The first state is shared by all keys: a list of its own takes its place.
        seen, at = state[0] or [], row["_at"]
        near = bisect_left(seen, at - half)
        repeat = near < len(seen) and seen[near] <= at + (span - half)
        insort(seen, at)
        del seen[: bisect_left(seen, seen[-1] - span - grace)]
        return (seen,), [] if repeat else [tuple(row[c] for c in carry)]

    rows = df.withColumn("_at", micros(ts))
    return transform_state(
        rows, ids, step, ddl(df, carry), ([],), arrival, late
    )


def fraud_stream(orders: DataFrame, gap: int, limit: float, late: Lateness) -> DataFrame:
    """Running session total per customer with its verdict."""

    def step(state, row):
        last, total = state
        if last is not None and last < row["_at"] - gap:
            total = Decimal(0)
        total += row["_amount"] or 0
        return (row["_at"], total), [(row["id"], "PASS" if float(total) < limit else "FAIL", float(total))]

    rows = orders.filter("state = 'CREATED'").withColumn("_at", micros("ts")).withColumn("_amount", exact_amount())
    return transform_state(
        rows.select("customer_id", "id", "_amount", "ts", "_at"), ["customer_id"], step,
        f"{ddl(orders, ['id'])}, result string, session_total double", (None, Decimal(0)), ["ts", "id"], late,
        keep=gap,
    )


def inventory_stream(
    orders: DataFrame, stock: DataFrame, order: Sequence[str], late: Lateness
) -> DataFrame:
    """Reserve stock per product; the stock table is joined to the stream first."""

    def step(state, row):
        reserved, q = state[0], row["quantity"]
        ok = q is not None and q >= 0 and row["stock"] - reserved - int(q) >= 0
        return (reserved + (int(q) if ok else 0),), [(row["id"], "PASS" if ok else "FAIL")]

    named = orders.join(stock.select("product", F.col("stock").cast("bigint")), "product")
    rows = named.select("product", *dict.fromkeys(["id", "quantity", "stock", *order]))
    return transform_state(
        rows, ["product"], step, f"{ddl(orders, ['id'])}, result string", (0,), order, late
    )


def table_regroup_stream(
    changelog: DataFrame, keys: Sequence[str], order: Sequence[str], group: str, value: Column,
    late: Lateness,
) -> DataFrame:
    """Moves between groups as additions: ``-old`` for the group left and ``+new`` for the one
    entered. Summing ``delta`` per ``grp`` gives the regrouped table at any time."""
    kind = changelog.schema[group].dataType.simpleString()

    def step(state, row):
        made = []
        if state[0] is not None:
            made.append((state[0], -state[1]))
        if row["_g"] is not None:
            made.append((row["_g"], row["_v"]))
        return (row["_g"], row["_v"] if row["_g"] is not None else None), made

    rows = changelog.select(
        *keys, *order, F.col(group).alias("_g"), value.cast("bigint").alias("_v")
    )
    return transform_state(
        rows, keys, step, f"grp {kind}, delta bigint", (None, None), order, late
    )


def session_changelog(
    df: DataFrame, keys: Sequence[str], arrival: Sequence[str], ts: str, gap: int, late: Lateness
) -> DataFrame:
    """Every change of the session table. A row that extends or bridges sessions deletes them
    (null count) and adds the merged one. Bounds are epoch milliseconds.

    The sessions of a key are kept in order, more than a gap apart, so a row looks only at its neighbours."""

    def step(state, row):
        at = row["_at"]
        # The first state is shared by all keys: lists of its own take its place.
        starts, ends, counts = state if state[0] else ([], [], [])
        near = slice(bisect_left(ends, at - gap), bisect_right(starts, at + gap))
        start, end = min([at, *starts[near]]), max([at, *ends[near]])
        count = 1 + sum(counts[near])
        made = [(s, e, None) for s, e in zip(starts[near], ends[near])] if (start, end) != (at, at) else []
        made.append((start, end, count))
        starts[near], ends[near], counts[near] = [start], [end], [count]
        return (starts, ends, counts), made

    gap //= 1000
    rows = df.select(*keys, *arrival, F.unix_millis(ts).alias("_at"))
    return transform_state(
        rows, keys, step, "start_ms bigint, end_ms bigint, cnt bigint", ([], [], []), arrival, late
    )


def interval_outer_eager_stream(
    left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, arrival: str, span: int,
    left_value: str, right_value: str, late: Lateness,
) -> DataFrame:
    """Streaming form of ``interval_outer_eager`` for two streams with equal column types.

    Rows wait for partners until they lie two spans behind the newest row of their key.
    """

    def step(state, row):
        at, waiting, mine = row["_at"], list(state[0]), row["_side"]
        partners = [w for w in waiting if w[0] != mine and abs(w[1] - at) <= span]
        values = [(row["_v"], w[2]) if mine == 0 else (w[2], row["_v"]) for w in partners]
        if not values:
            values = [(row["_v"], None) if mine == 0 else (None, row["_v"])]
        waiting.append((mine, at, row["_v"]))
        newest = max(w[1] for w in waiting)
        waiting = [w for w in waiting if w[1] >= newest - 2 * span]
        return (waiting,), values

    sides = [
        side.select(*keys, F.col(arrival).alias("_arrival"), micros(ts).alias("_at"),
                    F.lit(i).alias("_side"), F.col(v).alias("_v"))
        for i, (side, v) in enumerate([(left, left_value), (right, right_value)])
    ]
    return transform_state(
        sides[0].unionByName(sides[1]), keys, step,
        f"{ddl(left, [left_value])}, {ddl(right, [right_value])}", ([],), ["_arrival"], late,
    )


def cep_stream(
    df: DataFrame, pattern: Pattern, partition_by: Sequence[str], ts: str, row_id: str, late: Lateness
) -> DataFrame:
    """Resumable pattern matching: open runs are the state of each key, as long as ``within`` lets them live."""
    pattern.check()
    steps, count, within = runtime_steps(pattern), len(pattern.stages), pattern.within_micros

    def step(state, row):
        runs, done = nfa.advance(steps, state[0], row, row[row_id], row["_at"], True)
        made = [tuple(d.taken.get(i, []) for i in range(count)) for d in done]
        return (runs,), made

    rows = with_conditions(df, pattern).withColumn("_at", micros(ts))
    output = match_schema(df, pattern, [], row_id)
    return transform_state(
        rows, partition_by, step, output, ([],), [ts, row_id], late, keep=within
    )
