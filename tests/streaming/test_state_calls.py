"""Streaming state is called by pieces and blocks, not by rows and keys, and gives what a replay in order gives."""

from __future__ import annotations

import os
import random
from collections import Counter

from pyspark.sql import Row
from pyspark.sql import functions as F

from tests.conftest import at, rows, spread
from tidelog.plans.ordered import KeyedOrder
from tidelog.sources import sinks, tables
from tidelog.sources.scratch import scratch_dir
from tidelog.streaming import charts, packed, stateful, timed


class Store:
    """A state variable, or a handle that makes them."""

    def __init__(self, calls=None):
        self.calls, self.found = Counter() if calls is None else calls, {}

    def getMapState(self, *_):
        return Store(self.calls)

    getValueState = getMapState

    def registerTimer(self, _):
        self.calls["timer"] += 1

    def getValue(self, key):
        self.calls["get"] += 1
        return self.found.get(key)

    def updateValue(self, key, value):
        self.calls["put"] += 1
        self.found[key] = value

    def removeKey(self, key):
        self.calls["remove"] += 1
        self.found.pop(key, None)

    def get(self):
        return self.found.get(())

    def update(self, value):
        self.found[()] = value

    def exists(self):
        return () in self.found


class Now:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


Wrapped = Row("row")


def running(handle, **kw):
    def step(state, row):
        return (state[0] + 1,), [(row["_place"], state[0] + 1)]

    made = stateful.InOrder(["k"], ["k", "_place"], step, (0,), [], 1_000, None, **kw)
    made.init(handle)
    return made


def emitted(blocks):
    return [r for b in blocks for r in packed.unpack(b["rows"])]


def replayed(found):
    seen, made = Counter(), []
    for k, place in sorted(found, key=lambda r: r[1]):
        seen[k] += 1
        made.append((k, place, seen[k]))
    return sorted(made)


def test_calls_do_not_grow_with_rows_and_keys():
    chance, handle = random.Random(1), Store()
    found = list({(k, chance.randrange(1, 64_000_000)) for k in range(3_000) for _ in range(10)})
    state = running(handle)
    lists = [Wrapped(packed.blob(found[i : i + 500])) for i in range(0, len(found), 500)]
    assert list(state.handleInputRows((0,), iter(lists), Now(0))) == []
    got = emitted(state.handleExpiredTimer((0,), Now(100_000), None))
    assert sorted(got) == replayed(found)
    # 30,000 rows of 3,000 keys over 64 buckets.
    assert sum(handle.calls.values()) < 400


def test_pieces_and_blocks_over_many_triggers(monkeypatch):
    """Blocks are split while others are not held, rows come back to later buckets, and late rows are dropped one by one."""
    monkeypatch.setattr(stateful, "KEYS_HELD", 100)
    monkeypatch.setattr(stateful, "KEYS_PER_BLOCK", 4)
    monkeypatch.setattr(stateful, "ROWS_PER_PIECE", 50)
    chance, state, got, kept, passed = random.Random(2), running(Store()), [], [], 0
    for trigger in range(1, 30):
        base = trigger * 500_000
        some = list({(chance.randrange(700), base + chance.randrange(-2_000_000, 2_000_000) * 2 + trigger % 2) for _ in range(400)})
        some = [r for r in some if r[1] > 0 and r not in kept]
        kept += [r for r in some if r[1] > passed * 1000]
        list(state.handleInputRows((0,), iter([Wrapped(None), Wrapped(packed.blob(some))]), Now(passed)))
        now = max(passed, max(r[1] for r in kept) // 1000 - 3_333)
        got += emitted(state.handleExpiredTimer((0,), Now(now), None))
        passed = now
    got += emitted(state.handleExpiredTimer((0,), Now(10**9), None))
    assert len({k for k, _ in kept}) > 600 and state.blocks > 64
    assert sorted(got) == replayed(kept)
    stored = [name for b in state.states.found.values() for name in packed.unpack(b[0])]
    assert len(stored) == len(set(stored)) == state.stored == len({k for k, _ in kept})


def test_a_stream_opens_few_state_partitions(spark):
    path, out, chk = (scratch_dir(spark, n) for n in ("in", "out", "chk"))
    schema = "k string, n bigint"
    spread(spark, path, [spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], schema)])
    before = spark.conf.get(sinks.SHUFFLE_PARTITIONS)
    spark.conf.set(sinks.SHUFFLE_PARTITIONS, "60")
    try:
        counts = stateful.running_count_stream(
            tables.read_stream(spark, path, schema), ["k"], ["n"], stateful.Lateness(10, scratch_dir(spark, "end"))
        )
        sinks.sink_idempotent(counts, out, chk)
        assert spark.conf.get(sinks.SHUFFLE_PARTITIONS) == "60"
    finally:
        spark.conf.set(sinks.SHUFFLE_PARTITIONS, before)
    opened = [d for d in os.listdir(f"{chk.removeprefix('file://')}/state/0") if d.isdigit()]
    assert 0 < len(opened) <= max(sinks.LEAST_PARTITIONS, 2 * spark.sparkContext.defaultParallelism) < 60


def test_late_flags_merge_sorted_lists():
    chance = random.Random(3)
    found = [(n, chance.randrange(1000) if n % 50 else None, n if n % 70 else None) for n in range(5_000)]
    chance.shuffle(found)
    flags = timed.AsArrived(100, ["arrival", "n"], ["n", "at", "arrival", "_at"])
    flags.init(Store())
    lists = [Wrapped(packed.blob([(n, a, v, a) for n, a, v in found[i : i + 600]])) for i in range(0, 5_000, 600)]
    got = emitted(flags.handleInputRows((0,), iter(lists), None))
    want, newest = [], None
    for n, a, v in sorted(found, key=lambda r: (r[2] is None, r[2] or 0, r[0])):
        want.append((n, a, v, newest is not None and a is not None and a < newest - 100))
        newest = a if newest is None else max(newest, newest if a is None else a)
    assert got == want and any(w[3] for w in want)


def test_windowed_charts_keep_null_groups_and_items(spark):
    path = scratch_dir(spark, "charts")
    schema = "g string, u bigint, ts timestamp"
    spread(spark, path, [
        spark.createDataFrame([(None, 1, at(0)), (None, 2, at(1)), (None, 2, at(2)), ("a", None, at(3)), ("a", 5, at(7200))], schema)
    ])
    late = stateful.Lateness(10**12, scratch_dir(spark, "end"))
    made = charts.top_n_windowed_stream(tables.read_stream(spark, path, schema), 1, "ts", 3_600_000_000, ["g"], "u", late, shards=1)
    assert made.columns == ["g", "shard", "window_end", "rank", "u", "count"]
    got = sinks.run_available_now(made, "append", end=late.end)
    hour = int(at(3600).timestamp()) * 1_000_000
    assert rows(got, "g", "window_end", "rank", "u", "count") == sorted(
        [(None, hour, 1, 2, 2), ("a", hour, 1, None, 1), ("a", hour + 7_200_000_000, 1, 5, 1)], key=repr
    )


def test_a_key_of_some_million_rows_is_cut(spark):
    df = spark.range(3_000_000).select(F.lit(1).alias("k"), "id")
    assert KeyedOrder.of(df, ["k"], ["id"], F.col("id")).cut


class Compared(int):
    """A number that counts how often it is compared."""

    done = 0

    def _counted(name):
        def compare(self, other):
            Compared.done += 1
            return getattr(int, name)(self, other)

        return compare

    __lt__, __le__, __gt__, __ge__, __eq__ = map(_counted, ("__lt__", "__le__", "__gt__", "__ge__", "__eq__"))
    __hash__ = int.__hash__


def steps_of(monkeypatch, build):
    """The step that an operator gives to ``transform_state``."""
    monkeypatch.setattr(stateful, "transform_state", lambda rows, keys, step, *_, **__: step)
    return build()


def test_session_changes_look_only_at_neighbours(spark, monkeypatch):
    table, late = spark.createDataFrame([], "k int, n int, ts timestamp"), stateful.Lateness()
    step = steps_of(monkeypatch, lambda: stateful.session_changelog(table, ["k"], ["n"], "ts", 5_000, late))
    chance, first, seen = random.Random(2), ([], [], []), []
    state, Compared.done = first, 0
    for _ in range(3_000):
        at_ = chance.randrange(100_000) * 3
        seen.append(at_)
        state, _ = step(state, {"_at": Compared(at_)})
    assert Compared.done < 3_000 * 60 and first == ([], [], [])
    want = []
    for x in sorted(seen):
        if want and x - want[-1][1] <= 5:
            want[-1] = (want[-1][0], x, want[-1][2] + 1)
        else:
            want.append((x, x, 1))
    assert len(want) > 2_000 and list(zip(*state)) == want


def test_repeats_are_looked_up_among_neighbours(spark, monkeypatch):
    table, late = spark.createDataFrame([], "k int, n int, ts timestamp"), stateful.Lateness()
    step = steps_of(monkeypatch, lambda: stateful.dedup_stream(table, ["k"], "ts", ["n"], 2_001, late, grace=100))
    chance, first, seen = random.Random(2), ([],), []
    state, Compared.done = first, 0
    for n in range(4_000):
        at_ = n + chance.randrange(-200, 200)
        repeat = any(at_ - 1_000 <= s <= at_ + 1_001 for s in seen)
        newest = max([*seen, at_])
        seen = [s for s in [*seen, at_] if s >= newest - 2_101]
        state, made = step(state, {"_at": Compared(at_), "n": n, "ts": None})
        assert made == ([] if repeat else [(n, None)]) and [int(s) for s in state[0]] == sorted(seen)
    assert Compared.done < 4_000 * 60 and first == ([],)
