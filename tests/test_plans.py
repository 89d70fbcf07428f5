"""Hot keys are cut without changing results, and plans keep their shape."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import at, rows
from tidelog.catalog import REGISTRY
from tidelog.operators import batching, dedup, joins, windows
from tidelog.operators.cep import Pattern, match_pattern
from tidelog.operators.detectors import sliding_sum
from tidelog.plans.ordered import KeyedOrder, tiles
from tidelog.sources import log


@pytest.fixture(scope="module")
def skewed(spark):
    """600 rows; one key holds about half of them, another a quarter."""
    rng = random.Random(11)
    data = [
        (n, rng.choice([0, 0, 0, 0, 1, 1, 2, 3]), at(n * 60 + rng.randint(0, 59)), rng.randint(0, 9),
         n + (40 if n % 17 == 0 else 0))
        for n in range(600)
    ]
    return spark.createDataFrame(data, "n bigint, k int, ts timestamp, v int, arrival bigint").repartition(4).cache()


def test_running_measures_against_brute_force(skewed):
    value = F.when(F.col("v") > 3, F.col("v"))
    measures = {"s": ("sum", value), "c": ("count", value), "lo": ("min", value), "hi": ("max", value), "l": ("last", value)}
    data = sorted(tuple(r) for r in skewed.select("k", "n", "v").collect())

    def expected(inclusive, reverse):
        out = []
        for k, n, _ in data:
            before = [
                v for kk, m, v in data
                if kk == k and v > 3 and ((m > n if reverse else m < n) or (inclusive and m == n))
            ]
            out.append((k, n, sum(before), len(before), min(before, default=None), max(before, default=None),
                        (before[0] if reverse else before[-1]) if before else None))
        return out

    for chunk in (7, 10_000):
        keyed = KeyedOrder.of(skewed.select("k", "n", "v"), ["k"], ["n"], F.col("n"), chunk)
        assert keyed.cut is (chunk == 7)
        for inclusive in (True, False):
            for reverse in (True, False):
                got = keyed.running(measures, inclusive=inclusive, reverse=reverse).result()
                assert sorted(tuple(r) for r in got.select("k", "n", *measures).collect()) == expected(inclusive, reverse)


def cut_operators(df):
    other = df.filter("v < 3").select("k", F.col("ts").alias("t2"), F.col("n").alias("n2"), F.col("v").alias("v2"))
    lanes = df.withColumn("lane", F.col("k"))
    follow = Pattern.select("a").where(F.col("v") > 6)
    strict = follow.then("b").where(F.col("v") > 3)
    chain = strict.then("c").skip_till_next_match().where(F.col("v") == 0)
    return {
        "sessionize": lambda c: windows.sessionize(df, ["k"], ["n"], F.col("n"), "ts", 100_000_000, rows_per_chunk=c),
        "late": lambda c: windows.late_split(lanes, "ts", 60_000_000, ["lane"], ["arrival", "n"], F.col("arrival"), c)[1],
        "replay": lambda c: log.drop_replayed(df.select(F.col("k").alias("partition"), F.col("n").alias("offset"), "arrival", "n"), rows_per_chunk=c),
        "as_of": lambda c: joins.as_of_join(df.filter("v > 6"), other, ["k"], "ts", "t2", ("n", "n2"), rows_per_chunk=c),
        "grouped": lambda c: batching.grouped(df, 10, ["k"], ["n"], F.col("n"), "n", c).withColumn("values", F.array_join("values", ",")),
        "sliding": lambda c: sliding_sum(df, ["k"], "ts", F.col("v"), 600, ["arrival", "n"], F.col("arrival"), c),
        "cep": lambda c: match_pattern(df, chain, ["k"], "ts", "n", c).select("k", *[F.col(x)[0].alias(x) for x in "abc"]),
    }


@pytest.mark.parametrize("name", ["sessionize", "late", "replay", "as_of", "grouped", "sliding", "cep"])
def test_cut_hot_keys_give_the_same_rows(skewed, name):
    run = cut_operators(skewed)[name]
    whole, cut = run(10_000), run(9)
    assert whole.count() > 0
    assert rows(cut, *sorted(whole.columns)) == rows(whole, *sorted(whole.columns))


def test_dedup_out_of_order_against_brute_force(spark):
    rng = random.Random(4)
    data = [(n, rng.choice("aaab"), rng.randint(0, 300) * 5) for n in range(150)]
    df = spark.createDataFrame([(n, k, at(t)) for n, k, t in data], "n bigint, k string, ts timestamp")
    for span in (40, 55):
        half = span // 2
        expected = [
            (n,) for n, k, t in data
            if not any(kk == k and m < n and t - half <= tt <= t + span - half for m, kk, tt in data)
        ]
        # An odd span is halved in whole microseconds.
        got = dedup.dedup_window(df, ["k"], "ts", ["n"], span * 1_000_000, in_order=False)
        assert sorted(rows(got, "n")) == expected


def test_hot_chunks_stay_small(skewed):
    keyed = KeyedOrder.of(skewed, ["k"], ["n"], F.col("n"), 50)
    sizes = keyed.df.groupBy("k", "_chunk").count().agg(F.max("count")).collect()[0][0]
    assert sizes <= 100


def test_bursts_and_equal_positions_are_cut(spark):
    """One far-off row, all others in one instant: chunks follow rows, not positions."""
    place = F.when(F.col("id") < 10, F.col("id") * 1_000_000).otherwise(10_000_000)
    df = spark.range(10_000).select(F.lit("a").alias("k"), place.alias("at"), "id", (F.col("id") % 7).alias("v"))
    keyed = KeyedOrder.of(df, ["k"], ["at", "id"], F.col("at"), 1_000)
    sizes = [r["count"] for r in keyed.df.groupBy("_chunk").count().collect()]
    assert len(sizes) >= 5 and max(sizes) <= 2_000
    got = keyed.running({"s": ("sum", F.col("v")), "last": ("last", F.when(F.col("v") == 3, F.col("id")))}).result()
    plain = KeyedOrder.of(df, ["k"], ["at", "id"], F.col("at")).running(
        {"s": ("sum", F.col("v")), "last": ("last", F.when(F.col("v") == 3, F.col("id")))}
    ).result()
    assert rows(got, "id", "s", "last") == rows(plain, "id", "s", "last")


def test_tiles_hold_every_visible_row(spark):
    df = spark.range(40)
    cut = tiles(df, F.col("id"), 8, before=3, after=5)
    for own in cut.filter("_own").collect():
        inside = {r.id for r in cut.filter(F.col("_tile") == own._tile).collect()} if own.id % 9 == 0 else None
        if inside is not None:
            assert {i for i in range(own.id - 3, own.id + 6) if 0 <= i < 40} <= inside
    assert cut.filter("_own").count() == 40


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# Python runs only for patterns with repeated stages or running state, and for streaming state
# (which is finished before the returned frame is read).
PYTHON = {"cep_fold"}
CHEAP = ["page_views_by_region", "group_count", "word_count_ascii", "top_n_per_group", "interval_join",
         "cep_kleene", "cep_fold", "cep_within", "hopping_count_dense", "composite_event", "time_weighted_moments"]


@pytest.mark.parametrize("name", CHEAP)
def test_python_only_where_needed(spark, small, name):
    text = plan(REGISTRY[name](spark, small))
    assert any(node in text for node in ("Python", "InPandas", "InArrow")) is (name in PYTHON)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_one_shuffle_for_running_values(spark, small):
    text = plan(REGISTRY["running_count"](spark, small))
    assert text.count("Exchange hashpartitioning") == 1


def test_filters_and_columns_reach_the_scan(spark, small):
    text = plan(REGISTRY["filter_rows"](spark, small))
    assert "GreaterThan(value,20.0)" in text and "ReadSchema: struct<event_id:bigint,value:double>" in text


def test_top_n_limits_groups_before_the_shuffle(spark, small):
    assert "WindowGroupLimit" in plan(REGISTRY["top_n_per_group"](spark, small))
