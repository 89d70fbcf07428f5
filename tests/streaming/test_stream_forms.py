"""Streaming joins, charts, timers and side outputs: equal to batch at any split, and rows out before the input ends."""

from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import at, rows, spread
from tidelog.operators import aggregate, joins, orders, topn, windows
from tidelog.sources import sinks, tables
from tidelog.sources.scratch import scratch_dir
from tidelog.streaming import charts, stateful, timed
from tidelog.streaming.joins import as_of_join_stream, current_rows, table_table_join_stream

H, M, S = windows.HOUR, windows.MINUTE, 1_000_000


def follow(spark, frames):
    """A stream that reads one frame a trigger."""
    path = scratch_dir(spark, "frames")
    spread(spark, path, frames)
    return tables.read_stream(spark, path, frames[0].schema, max_files_per_trigger=1)


def split(df, order: str, parts: int):
    """The frame in so many parts, one after another."""
    numbers = [r[0] for r in df.select(order).orderBy(order).collect()]
    cuts = [numbers[len(numbers) * p // parts] for p in range(1, parts)]
    part = sum((F.when(F.col(order) >= c, 1).otherwise(0) for c in cuts), F.lit(0))
    return [df.filter(part == p) for p in range(parts)]


def emitted(df, mode="append", end=None):
    return sinks.run_available_now(df, mode, end=end)


@pytest.fixture(scope="module")
def events(spark, small):
    return tables.load(spark, small, "events").cache()


def sides(df):
    purchases = df.filter("event_type = 'purchase'").select("user_id", "event_id", "ts", "value")
    views = df.filter("event_type = 'view'").select("user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_id"),
                                                    F.col("event_id").alias("last_view"))
    return purchases, views


@pytest.mark.parametrize("parts", [1, 4])
def test_as_of_join(spark, events, parts):
    late = stateful.Lateness(M, scratch_dir(spark, "end"))
    found = as_of_join_stream(*[side for side in sides(follow(spark, split(events, "ts", parts)))], ["user_id"], "ts", "view_ts",
                              ("event_id", "view_id"), late, "left")
    want = joins.as_of_join(*sides(events), ["user_id"], "ts", "view_ts", ("event_id", "view_id"), "left")
    assert rows(emitted(found, end=late.end), "event_id", "last_view") == rows(want, "event_id", "last_view")


def test_rows_come_out_before_the_input_ends(spark, events):
    """With ordered files and a small delay only the rows of the last minute wait for the end."""
    late = stateful.Lateness(M)
    stream = follow(spark, split(events, "ts", 4))
    before_end = emitted(as_of_join_stream(*sides(stream), ["user_id"], "ts", "view_ts", ("event_id", "view_id"), late, "left"))
    newest = events.agg(F.max("ts")).first()[0]
    purchases = sides(events)[0]
    assert before_end.count() >= purchases.filter(F.col("ts") < F.lit(newest - timedelta(minutes=2))).count() > 0


def test_table_join_golden(spark):
    """Four changes: left, right, update of the left side, deletion of the right one."""
    left = [("k", at(1), 1, "a"), ("k", at(3), 3, "b"), ("other", at(1), 1, "x")]
    right = [("k", at(2), 2, 10), ("k", at(4), 4, None)]
    schema = "key string, ts timestamp, id bigint, {}"
    a = spark.createDataFrame(left, schema.format("l string"))
    b = spark.createDataFrame(right, schema.format("r bigint"))
    late = stateful.Lateness(0, scratch_dir(spark, "end"))
    changes = emitted(table_table_join_stream(follow(spark, split(a, "id", 2)), follow(spark, split(b, "id", 2)), ["key"],
                                              ["ts", "id"], "l", "r", late), end=late.end)
    got = [tuple(r) for r in changes.orderBy("id").select("key", "id", "side", "l", "r").collect()]
    assert got == [("k", 2, 1, "a", 10), ("k", 3, 0, "b", 10), ("k", 4, 1, None, None)]
    assert current_rows(changes, ["key"], ["ts", "id"], "l", "r").count() == 0


@pytest.mark.parametrize("parts", [1, 3])
def test_charts_equal_batch_charts(spark, events, parts):
    emits = emitted(charts.top_n_stream(follow(spark, split(events, "event_id", parts)), 3, ["event_type"], "user_id", F.lit(1)), "update")
    counts = events.groupBy("event_type", "user_id").count()
    want = topn.top_n_per_group(counts, 3, ["event_type"], [F.col("count").desc(), F.col("user_id").asc()])
    got = charts.latest_charts(emits, 3, ["event_type"], "user_id")
    assert rows(got, "event_type", "user_id", "count", "rank") == rows(want, "event_type", "user_id", "count", "rank")


def test_charts_take_back(spark):
    """An item that loses makes room for one outside the chart; nulls are an item; an emptied chart is gone."""
    first = [("g", "a", 5), ("g", "b", 4), ("g", "c", 3), ("g", None, 2), ("h", "x", 1)]
    second = [("g", "a", -4), ("h", "x", -1), ("g", "c", None)]
    frames = [spark.createDataFrame(f, "grp string, item string, w bigint") for f in (first, second)]
    emits = emitted(charts.top_n_stream(follow(spark, frames), 2, ["grp"], "item", F.col("w"), shards=1), "update")
    got = charts.latest_charts(emits, 2, ["grp"], "item")
    assert rows(got, "grp", "rank", "item", "count") == [("g", 1, "b", 4), ("g", 2, "c", 3)]


def test_windowed_charts_come_when_the_window_closes(spark, events):
    late = stateful.Lateness(M, scratch_dir(spark, "end"))
    stream = follow(spark, split(events, "ts", 3))
    closed = emitted(charts.top_n_windowed_stream(stream, 2, "ts", H, ["event_type"], "user_id", late), end=late.end)
    got = charts.windowed_charts(closed, 2, "event_type", "user_id").select(
        F.timestamp_micros(F.col("window_end") - H).alias("start"), "event_type", "top"
    )
    want = topn.top_n_windowed(events, 2, "ts", "60 minutes", "event_type", "user_id")
    assert rows(got, "start", "event_type", "top") == rows(want, "start", "event_type", "top")


def test_punctuation(spark, events):
    day, late = 24 * H, stateful.Lateness(M, scratch_dir(spark, "end"))
    last = events.agg(F.max(F.unix_micros("ts"))).first()[0]
    stream = follow(spark, split(events, "ts", 3))
    ticks = timed.punctuate_stream(stream, ["event_type"], "ts", day, late, until=(last // day + 1) * day)
    want = aggregate.punctuate_snapshot(events, ["event_type"], "ts", day)
    assert rows(emitted(ticks, end=late.end), "event_type", "tick", "cnt") == rows(want, "event_type", "tick", "cnt")
    with pytest.raises(ValueError):
        timed.punctuate_stream(stream, ["event_type"], "ts", day, late)


@pytest.mark.parametrize("parts", [1, 5])
def test_late_rows_at_any_split(spark, events, parts):
    late = F.when(F.col("event_id") % 17 == 0, 40).otherwise(0)
    arrived = events.select("event_id", "ts", (F.col("event_id") + late).alias("arrival"), (F.col("user_id") % 4).alias("lane"))
    got = timed.late_flag_stream(follow(spark, split(arrived, "arrival", parts)), "ts", H, ["lane"], ["arrival", "event_id"])
    want = windows.late_flag(arrived, "ts", H, ["lane"], ["arrival", "event_id"], F.col("arrival"))
    assert rows(emitted(got), "event_id", "late") == rows(want, "event_id", "late")
    assert want.filter("late").count() > 0


@pytest.mark.parametrize("parts, size", [(1, 6 * H), (3, 25 * M)])
def test_panes_added_and_subtracted(spark, events, parts, size):
    """Windows that are no multiple of the step as well; equal to the batch runs at any split."""
    late = stateful.Lateness(M, scratch_dir(spark, "end"))
    found = timed.sliding_inverse_reduce_stream(follow(spark, split(events, "ts", parts)), ["user_id"], "ts", size, 10 * M, late)
    want = windows.sliding_inverse_reduce(events, ["user_id"], "ts", size, 10 * M)
    assert rows(emitted(found, end=late.end)) == rows(want)


def test_order_verdicts(spark):
    schema = "id bigint, customer_id bigint, state string, product bigint, quantity int, price double, ts timestamp"
    new = [(i, i, "CREATED", 1, 1, 1.0, at(100 * i)) for i in range(1, 9)] + [(9, 9, "PAID", 1, 1, 1.0, at(0))]
    checks = [(i, "FAIL" if (i + c) % 4 == 0 else "PASS", at(100 * i + 20 * c + (900 if i == 5 and c else 0))) for i in range(1, 10) for c in range(3)]
    checks += [(4, "FAIL", at(401)), (4, "FAIL", at(2000)), (77, "FAIL", at(5))]
    order = spark.createDataFrame(new, schema)
    results = spark.createDataFrame(checks, "id bigint, result string, ts timestamp")
    late = stateful.Lateness(S, scratch_dir(spark, "end"))
    got = timed.validation_stream(follow(spark, split(results, "ts", 3)), follow(spark, split(order, "ts", 3)), late)
    want = orders.validation_aggregate(results, order)
    assert rows(emitted(got, end=late.end)) == rows(want)
    assert {r.state for r in want.collect()} == {"FAILED", "VALIDATED"}


def test_fraud_totals_agree_to_the_last_digit(spark):
    """Two orders that sum up to just under the limit pass in batch and on a stream; one at the limit fails."""
    schema = "id bigint, customer_id bigint, state string, product bigint, quantity int, price double, ts timestamp"
    new = [(1, 1, "CREATED", 1, 1, 1999.99996, at(0)), (2, 2, "CREATED", 1, 3, 666.666666666, at(1)), (3, 3, "CREATED", 1, 2, 1000.0, at(2)),
           (4, 2, "CREATED", 1, 1, 0.000000002, at(3)), (5, 4, "CREATED", 1, None, None, at(3))]
    order = spark.createDataFrame(new, schema)
    late = stateful.Lateness(S, scratch_dir(spark, "end"))
    got = emitted(stateful.fraud_stream(follow(spark, split(order, "id", 2)), H, 2000, late), end=late.end)
    want = orders.fraud_check(order)
    assert rows(got, "id", "result", "session_total") == rows(want.fillna(0.0, ["session_total"]), "id", "result", "session_total")
    assert dict(rows(want, "id", "result"))[1] == "PASS" and dict(rows(want, "id", "result"))[3] == "FAIL"
