"""Streams read file by file give what the batch form gives."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import at, rows, spread
from tidelog.functions import text
from tidelog.operators import aggregate, dedup, joins, records, routing, windows
from tidelog.operators.cep import Pattern, match_pattern
from tidelog.sources import sinks, tables
from tidelog.sources.scratch import scratch_dir
from tidelog.streaming import stateful

H = windows.HOUR


@pytest.fixture(scope="module")
def events(spark, small):
    return tables.load(spark, small, "events")


@pytest.fixture(scope="module")
def parts(spark, events):
    """Folder with the events in three files, in order."""
    path = scratch_dir(spark, "parts")
    spread(spark, path, [events.filter(f"event_id DIV 340 = {n}") for n in range(3)])
    return path


@pytest.fixture()
def stream(spark, parts, events):
    def read():
        return tables.read_stream(spark, parts, events.schema, max_files_per_trigger=1)

    return read


def emitted(df, mode="append", end=None):
    return sinks.run_available_now(df, mode, end=end)


def waiting(spark, delay=1000 * 24 * H):
    """Rows may be late by more than the table is long; the input ends."""
    return stateful.Lateness(delay, scratch_dir(spark, "end"))


def test_stateless_operators_on_a_stream(stream, events):
    def work(df):
        df = records.filter_not(df, F.col("value") > 90)
        df = records.branch(df, [F.col("event_type") == "view", F.col("value") > 10])
        df = routing.route_fanout(df, ["a", "b"])
        return records.select_key(df, text.anonymize_ip(F.col("event_type"))).select("event_id", "branch", "queue", "key")

    assert rows(emitted(work(stream()))) == rows(work(events))


def test_windows_on_a_stream(stream, events):
    for fn in (
        lambda df: windows.tumbling_count(df, ["event_type"], "ts", H),
        lambda df: windows.hopping_count(df, ["event_type"], "ts", 4 * H, H),
        lambda df: windows.session_count(df, ["user_id"], "ts", H // 2),
    ):
        want, got = fn(events), emitted(fn(stream()), "complete")
        columns = sorted(want.columns)
        assert rows(got, *columns) == rows(want, *columns)


def test_late_rows_are_dropped_by_the_watermark(spark):
    path = scratch_dir(spark, "late")
    schema = "k string, ts timestamp, v int"
    spread(spark, path, [
        spark.createDataFrame([("a", at(10), 1), ("a", at(3600), 2)], schema),
        spark.createDataFrame([("a", at(3500), 7)], schema),
        spark.createDataFrame([("a", at(20), 50), ("a", at(3610), 3)], schema),
        spark.createDataFrame([("a", at(90000), 9)], schema),
        spark.createDataFrame([("a", at(90001), 9)], schema),
    ])
    source = tables.read_stream(spark, path, schema, max_files_per_trigger=1)
    kept = windows.tumbling_max_retained(source, ["k"], "ts", 60_000_000, 300_000_000, "v")
    got = rows(emitted(kept), "start", "max_value")
    # The row at second 20 came after the watermark had passed its window.
    assert sorted(v for _, v in got) == [1, 3, 7]


def test_running_count_and_sessionize(spark, stream, events):
    late = waiting(spark, 0)
    counts = stateful.running_count_stream(stream(), ["event_type"], ["event_id"], late)
    batch = aggregate.running_count(events, ["event_type"], ["event_id"], F.col("event_id"))
    assert rows(emitted(counts, end=late.end), "event_id", "cnt") == rows(batch, "event_id", "cnt")
    late = waiting(spark, 0)
    numbered = stateful.sessionize_stream(stream(), ["user_id"], ["event_id"], "ts", H, late)
    batch = windows.sessionize(events, ["user_id"], ["event_id"], F.col("event_id"), "ts", H)
    assert rows(emitted(numbered, end=late.end), "event_id", "session_id") == rows(batch, "event_id", "session_id")


def test_moving_average_and_dedup(spark, stream, events):
    late = waiting(spark, 0)
    number = F.when(F.col("event_id") % 5 != 0, F.floor("value"))
    got = stateful.moving_average_stream(stream(), 10, ["user_id"], ["event_id"], number, late)
    want = aggregate.moving_average(events, 10, ["user_id"], ["event_id"], F.col("event_id"), number)
    assert rows(emitted(got, end=late.end), "event_id", "avg") == rows(want, "event_id", "avg")
    ids = ["user_id", "event_type"]
    late = waiting(spark, 0)
    got = stateful.dedup_stream(stream().select("event_id", "ts", *ids), ids, "ts", ["event_id"], 12 * H, late)
    want = dedup.dedup_window(events, ids, "ts", ["event_id"], 12 * H)
    assert rows(emitted(got, end=late.end), "event_id") == rows(want, "event_id")


def test_eager_outer_join_and_patterns(spark, stream, events):
    late = waiting(spark)

    def side(df, kind, name):
        return df.filter(F.col("event_type") == kind).select(
            "user_id", "ts", F.col("event_id").alias("arrival"), F.col("event_id").alias(name)
        )

    got = stateful.interval_outer_eager_stream(
        side(stream(), "click", "c"), side(stream(), "view", "v"), ["user_id"], "ts", "arrival", H, "c", "v", late
    )
    left = side(events, "click", "c").withColumnRenamed("ts", "lt").withColumnRenamed("arrival", "la")
    right = side(events, "view", "v").withColumnRenamed("ts", "rt").withColumnRenamed("arrival", "ra")
    want = joins.interval_outer_eager(left, right, ["user_id"], "lt", "rt", H, "la", "ra")
    assert rows(emitted(got, end=late.end), "user_id", "c", "v") == rows(want, "user_id", "c", "v")

    pattern = (
        Pattern.select("a").where(F.col("event_type") == "view")
        .then("b").zero_or_more().skip_till_next_match().where(F.col("event_type") == "click")
        .then("c").skip_till_next_match().where(F.col("event_type") == "purchase").within(86400)
    )
    late = waiting(spark)
    got = emitted(stateful.cep_stream(stream(), pattern, ["user_id"], "ts", "event_id", late), end=late.end)
    want = match_pattern(events, pattern, ["user_id"], "ts", "event_id")
    assert want.count() > 0 and rows(got) == rows(want)


def test_results_do_not_depend_on_triggers(spark, events):
    """One trigger, and four with the rows dealt at random, give the same rows."""
    whole, dealt = scratch_dir(spark, "whole"), scratch_dir(spark, "dealt")
    spread(spark, whole, [events])
    spread(spark, dealt, [events.filter(F.pmod(F.xxhash64("event_id"), F.lit(4)) == n) for n in range(4)])
    users, order = ["user_id"], ["ts", "event_id"]
    number = F.when(F.col("event_id") % 5 != 0, F.floor("value"))
    request = "user_id AS customer_id, event_id AS id, CAST(event_id % 3 AS bigint) AS quantity, value AS price, ts, 'CREATED' AS state"
    pattern = (
        Pattern.select("a").where(F.col("event_type") == "view")
        .then("b").skip_till_next_match().where(F.col("event_type") == "click").within(86400)
    )

    def sides(df):
        return [
            df.filter(F.col("event_type") == kind).select("user_id", "ts", F.col("event_id").alias("arrival"), F.col("event_id").alias(name))
            for kind, name in (("click", "c"), ("view", "v"))
        ]

    for name, build in {
        "count": lambda df, late: stateful.running_count_stream(df, ["event_type"], order, late),
        "sessions": lambda df, late: stateful.sessionize_stream(df, users, order, "ts", H, late),
        "average": lambda df, late: stateful.moving_average_stream(df, 10, users, order, number, late),
        "dedup": lambda df, late: stateful.dedup_stream(df.drop("props"), ["user_id", "event_type"], "ts", order, 12 * H, late),
        "fraud": lambda df, late: stateful.fraud_stream(df.selectExpr(*request.split(", ")), H, 2000, late),
        "regroup": lambda df, late: stateful.table_regroup_stream(df, users, ["event_id"], "event_type", F.lit(1), late),
        "changes": lambda df, late: stateful.session_changelog(df, users, order, "ts", H, late),
        "eager": lambda df, late: stateful.interval_outer_eager_stream(*sides(df), users, "ts", "arrival", H, "c", "v", late),
        "pattern": lambda df, late: stateful.cep_stream(df, pattern, users, "ts", "event_id", late),
    }.items():
        found = []
        for path in (whole, dealt):
            late = waiting(spark)
            source = tables.read_stream(spark, path, events.schema, max_files_per_trigger=1)
            found.append(rows(emitted(build(source, late), end=late.end)))
        assert found[0] and found[0] == found[1], name


def test_ordered_state_expires_and_keeps_whole_numbers(spark):
    path, big = scratch_dir(spark, "expire"), 9007199254740993
    schema = "k string, ts timestamp, v bigint"
    spread(spark, path, [
        spark.createDataFrame([("a", at(0), big), ("a", at(1), None)], schema),
        spark.createDataFrame([("b", at(100), 1)], schema),
        spark.createDataFrame([("a", at(200), 2), (None, at(201), 3), ("c", None, 4)], schema),
    ])

    def step(state, row):
        return (state[0] + 1,), [(row["v"], state[0] + 1)]

    late = waiting(spark, 0)
    source = tables.read_stream(spark, path, schema, max_files_per_trigger=1)
    got = stateful.transform_state(source, ["k"], step, "v bigint, n bigint", (0,), ["ts", "v"], late, keep=10_000_000)
    # The key starts anew after ten idle seconds.
    assert rows(emitted(got, end=late.end)) == sorted([("a", big, 1), ("a", None, 2), ("b", 1, 1), ("a", 2, 1)], key=repr)


def test_session_changelog_golden(spark):
    gap = 30 * 60
    path = scratch_dir(spark, "clicks")
    schema = "user string, n bigint, ts timestamp"
    second = gap + 0.001
    spread(spark, path, [
        spark.createDataFrame([("erica", n, at(t))], schema)
        for n, t in enumerate([0, second, gap / 2])
    ])
    source = tables.read_stream(spark, path, schema, max_files_per_trigger=1)
    late = waiting(spark, 0)
    got = emitted(stateful.session_changelog(source, ["user"], ["n"], "ts", gap * 1_000_000, late), end=late.end)
    t = int(at(0).timestamp() * 1000)
    s = t + gap * 1000 + 1
    assert rows(got, "start_ms", "end_ms", "cnt") == sorted(
        [(t, t, 1), (s, s, 1), (t, t, None), (s, s, None), (t, s, 3)], key=repr
    )


def test_upsert_keeps_the_newest_row_over_batches(spark, stream, events):
    out, chk = scratch_dir(spark, "up"), scratch_dir(spark, "chk")
    source = stream().select("user_id", "event_id", "value")
    sinks.sink_upsert(source, out, chk, ["user_id"], ["event_id"])
    merged = sinks.read_upserted(spark, out, source.schema, ["user_id"], ["event_id"])
    want = aggregate.latest_rows(events.select("user_id", "event_id", "value"), ["user_id"], ["event_id"])
    assert rows(merged) == rows(want)
    compact = scratch_dir(spark, "compact")
    sinks.compact_upserted(spark, out, source.schema, ["user_id"], ["event_id"], compact)
    assert rows(sinks.read_upserted(spark, compact, source.schema, ["user_id"], ["event_id"])) == rows(want)


def test_idempotent_sink_resumes_and_repeats(spark, stream, events):
    out, chk = scratch_dir(spark, "once"), scratch_dir(spark, "chk")
    for _ in range(2):
        sinks.sink_idempotent(stream().select("event_id"), out, chk)
    sinks.write_batch(events.filter("event_id < 340").select("event_id"), out, 0)
    assert sinks.read_batches(spark, out, events.select("event_id").schema).count() == events.count()


def test_delivery_modes_lose_or_repeat(spark):
    df = spark.createDataFrame([(p, o) for p in (0, 1) for o in range(5)], "partition int, offset bigint")
    none = spark.createDataFrame([], "partition int, saved_offset bigint")
    seen = []

    def crash(batch):
        raise ConnectionError("before the work")

    def work(batch):
        seen.extend(rows(batch))

    for mode, times in (("at_least_once", 10), ("at_most_once", 0)):
        store = scratch_dir(spark, mode)
        with pytest.raises(ConnectionError):
            sinks.deliver(df, none, store, 0, crash, mode)
        saved = none
        if mode == "at_most_once":
            saved = spark.read.schema(none.schema).parquet(f"{store}/version=0")
        seen.clear()
        sinks.deliver(df, saved, store, 1, work, mode)
        assert len(seen) == times


def test_restart_gives_the_same_result(spark, stream):
    first, second = sinks.restart_from_scratch(
        lambda: aggregate.group_count(stream(), ["event_type"]), "complete"
    )
    assert rows(first) == rows(second)


def test_update_mode_emits_every_change(spark, stream, events):
    changes = emitted(aggregate.group_count(stream(), ["event_type"]), "update")
    final = changes.groupBy("event_type").agg(F.max("cnt").alias("cnt"))
    assert changes.count() == 15
    assert rows(final) == rows(aggregate.group_count(events, ["event_type"]))
