"""Nulls, exact sums, whole numbers beside nulls, and one pass where one is enough."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import at, rows
from tidelog.operators import custom, detectors, joins, records, routing, windows


def test_values_outside_the_frame_leave_no_trace(spark):
    data = [(1, at(2), 1e9)] + [(1, at(s), float(1 + s % 3)) for s in range(15, 40)]
    events = spark.createDataFrame(data, "k int, ts timestamp, v double")
    buckets = detectors.second_buckets(events, ["k"], "ts", F.col("v"))
    start = int(at(0).timestamp())
    for r in detectors.time_weighted_moments(buckets, ["k"], 10).collect():
        second = r["sec"] - start
        if second < 26:
            continue
        frame = [float(1 + s % 3) for s in range(second - 10, second)]
        first, rest = frame[0], frame[1:]
        sum1 = (first + rest[0]) / 2 * 2 + sum(rest[1:])
        sum2 = first * first + rest[0] * rest[0] + sum(x * x for x in rest[1:])
        mean = sum1 / 10
        assert r["mean"] == pytest.approx(mean, rel=1e-12)
        assert r["variance"] == pytest.approx(sum2 / 10 - mean * mean, rel=1e-9)
        assert r["window_sum"] == sum(frame)


@pytest.mark.parametrize("how", ["inner", "left", "full", "semi", "anti"])
def test_interval_join_drops_null_keys_on_both_sides(spark, how):
    left = spark.createDataFrame([(1, at(0), "a"), (None, at(0), "b"), (2, at(0), "c")], "k int, lt timestamp, l string")
    right = spark.createDataFrame([(1, at(1), "x"), (None, at(1), "y"), (3, at(1), "z")], "k int, rt timestamp, r string")
    found = rows(joins.interval_join(left, right, ["k"], "lt", "rt", 5_000_000, 5_000_000, how).select("k"))
    want = {"inner": [1], "left": [1, 2], "full": [1, 2, 3], "semi": [1], "anti": [2]}[how]
    assert sorted(k for (k,) in found) == want


def test_stream_join_refuses_an_extra_condition(spark):
    stream = spark.readStream.format("rate").load().select(F.col("value").alias("k"), F.col("timestamp").alias("lt"))
    other = stream.withColumnRenamed("lt", "rt")
    with pytest.raises(ValueError):
        joins.interval_join(stream, other, ["k"], "lt", "rt", 1, 1, extra=F.lit(True))


def test_user_aggregate_keeps_large_whole_numbers_beside_nulls(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(1, big), (1, None), (2, None)], "k int, v bigint")
    out = custom.aggregate_with(
        df, ["k"], lambda: (0, 0),
        lambda s, r: (s[0] + (r["v"] or 0), s[1] + (r["v"] is None)),
        lambda a, b: (a[0] + b[0], a[1] + b[1]), [("total", "bigint"), ("nulls", "bigint")],
    )
    assert rows(out) == [(1, big, 1), (2, 0, 1)]


def test_fanout_of_projections_reads_once(spark, tmp_path):
    path = f"{tmp_path}/in"
    spark.range(10).write.parquet(path)
    out = records.fanout_values(
        spark.read.parquet(path), {"a": [F.col("id")], "b": [(F.col("id") + 1).alias("id")]}
    )
    assert out.count() == 20
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_queues_are_ordered_over_several_tasks(spark):
    df = spark.range(0, 4000).select((F.col("id") % 3).alias("k"), "id")
    placed = routing.ordered_queue(df, 2, "k", ["id"], move=True).withColumn("task", F.spark_partition_id())
    found = placed.select("task", "queue", "id").collect()
    for queue in (0, 1):
        ids = [r["id"] for r in sorted((r for r in found if r["queue"] == queue), key=lambda r: r["task"])]
        assert ids == sorted(ids)


def test_counts_agree_at_any_overlap(spark):
    data = [(k, at(s)) for k in (1, 2) for s in (0, 1, 1, 700, 2900, 3050, 9000)]
    df = spark.createDataFrame(data, "k int, ts timestamp")
    size, step = 3_000_000_000, 1_000_000
    dense = windows.hopping(df, ["k"], "ts", size, step)
    copied = windows.hopping(df, ["k"], "ts", size, step, value=F.lit(1).cast("bigint"))
    assert dense.count() == copied.count() and dense.exceptAll(copied).isEmpty()
