"""Known inputs with known outputs, on tiny literal frames."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import at, rows
from tidelog.functions import text
from tidelog.operators import (
    aggregate,
    batching,
    cep,
    dedup,
    detectors,
    joins,
    orders,
    records,
    routing,
    sketch,
    topn,
    windows,
)
from tidelog.operators.cep import Pattern, match_pattern
from tidelog.sources import log

M = windows.MINUTE


def texts(spark, lines):
    return spark.createDataFrame(list(enumerate(lines)), "n bigint, value string")


LINES = ["Hello Spark Streams", "All streams lead to Spark", "Join Spark Summit"]


def test_word_count_unicode(spark):
    lines = texts(spark, [*LINES, "И теперь пошли русские слова"])
    words = lines.select(F.explode(text.unicode_words(F.col("value"))).alias("w"))
    expected = dict(hello=1, all=1, streams=2, lead=1, to=1, join=1, spark=3, summit=1)
    expected |= {"и": 1, "теперь": 1, "пошли": 1, "русские": 1, "слова": 1}
    assert dict(rows(aggregate.group_count(words, ["w"]))) == expected


@pytest.mark.parametrize("line,tokens", [("", [""]), (" ", []), (" a", ["", "a"]), ("a  b ", ["a", "", "b"])])
def test_split_drops_only_trailing_empties(spark, line, tokens):
    df = texts(spark, [line]).select(text.space_tokens(F.col("value")))
    assert df.collect()[0][0] == tokens


def test_running_count(spark):
    words = texts(spark, "foo bar foo quux bar foo".split())
    for chunk in (1, 100):
        counted = aggregate.running_count(words, ["value"], ["n"], F.col("n"), rows_per_chunk=chunk)
        got = [(r.value, r.cnt) for r in counted.orderBy("n").collect()]
        assert got == [("foo", 1), ("bar", 1), ("foo", 2), ("quux", 1), ("bar", 2), ("foo", 3)]


def test_cms_small_counts_are_exact_and_all_heavy(spark):
    items = texts(spark, ["foo"] * 3 + ["bar"] * 2 + ["quux", "foor"])
    cells = sketch.cms_build(items, "value")
    expected = [("bar", 2), ("foo", 3), ("foor", 1), ("quux", 1)]
    assert rows(sketch.cms_count(cells, items, "value")) == expected
    assert rows(sketch.cms_heavy_hitters(cells, items, "value")) == expected
    assert cells.filter("depth = 0").agg(F.sum("cnt")).scalar() is not None


def test_cms_bounds_and_merge(spark):
    shape = sketch.SketchShape(delta=0.01, eps=0.05)
    random.seed(5)
    items = texts(spark, [f"w{int(random.paretovariate(0.7)) % 400}" for _ in range(5000)])
    whole = sketch.cms_build(items, "value", shape)
    parts = [sketch.cms_build(items.filter(f"n % 2 = {i}"), "value", shape) for i in (0, 1)]
    assert rows(sketch.cms_merge(*parts), "depth", "bucket", "cnt") == rows(whole, "depth", "bucket", "cnt")
    true = dict(rows(aggregate.group_count(items, ["value"])))
    for item, estimate in rows(sketch.cms_count(whole, items, "value", shape)):
        assert true[item] <= estimate <= true[item] + 0.05 * 5000
    assert (shape.depth, shape.width) == (math.ceil(math.log(100)), math.ceil(math.e / 0.05))


def test_group_reduce_even_sum(spark):
    numbers = spark.range(1, 11).filter("id % 2 = 0").withColumn("k", F.lit(1))
    assert rows(aggregate.group_reduce(numbers, ["k"], F.col("id"), "total")) == [(1, 30)]


def test_group_max(spark):
    data = [("alice", 13), ("bob", 4), ("chao", 25), ("bob", 19), ("chao", 56), ("alice", 78), ("alice", 40), ("bob", 3)]
    df = spark.createDataFrame(data, "user string, n int")
    assert rows(aggregate.group_max(df, ["user"], "n", "m")) == [("alice", 78), ("bob", 19), ("chao", 56)]


def test_table_regroup_count_and_emptied_group(spark):
    data = [(1, "alice", "asia"), (2, "bob", "europe"), (3, "alice", "europe"), (4, "bob", "asia")]
    df = spark.createDataFrame(data, "n int, user string, region string")
    assert rows(aggregate.table_regroup_count(df, ["user"], ["n"], "region")) == [("asia", 1), ("europe", 1)]
    moved = df.filter("n < 4").unionByName(
        spark.createDataFrame([(5, "bob", None)], df.schema)
    ).unionByName(spark.createDataFrame([(6, "alice", "asia")], df.schema))
    assert rows(aggregate.table_regroup_count(moved, ["user"], ["n"], "region")) == [("asia", 1), ("europe", 0)]


def test_group_count_new_pages(spark):
    users = texts(spark, ["donna"] * 3 + ["becca"] * 2 + ["john"])
    assert rows(aggregate.group_count(users, ["value"])) == [("becca", 2), ("donna", 3), ("john", 1)]


def _region_logins(spark):
    regions = [("alice", "asia"), ("bob", "europe"), ("alice", "europe"), ("charlie", "europe"), ("bob", "asia")]
    logins = [("alice", 1485500000), ("bob", 1485520000), ("alice", 1485530000), ("bob", 1485560000)]
    r = spark.createDataFrame([(u, i, x) for i, (u, x) in enumerate(regions)], "user string, n bigint, region string")
    s = spark.createDataFrame([(u, 100 + i, x) for i, (u, x) in enumerate(logins)], "user string, n bigint, login bigint")
    return r, s


def test_table_table_join(spark):
    r, s = _region_logins(spark)
    final = joins.table_table_join(r, s, ["user"], ["n"], "region", "login")
    assert rows(final) == [("alice", "europe", 1485530000), ("bob", "asia", 1485560000)]
    for chunk in (1, 1000):
        changes = joins.table_table_changelog(r, s, ["user"], "n", "region", "login", rows_per_chunk=chunk)
        got = [tuple(x)[0:1] + tuple(x)[2:] for x in changes.orderBy("n").collect()]
        assert got == [
            ("alice", "europe", 1485500000), ("bob", "asia", 1485520000),
            ("alice", "europe", 1485530000), ("bob", "asia", 1485560000),
        ]


def test_clicks_per_region(spark):
    clicks = [("alice", 13), ("bob", 4), ("chao", 25), ("bob", 19), ("dave", 56), ("eve", 78), ("alice", 40), ("fang", 99)]
    regions = [("alice", "asia"), ("bob", "americas"), ("chao", "asia"), ("dave", "europe"), ("alice", "europe"), ("eve", "americas"), ("fang", "asia")]
    c = spark.createDataFrame(clicks, "user string, n bigint")
    r = spark.createDataFrame([(i, *x) for i, x in enumerate(regions)], "i int, user string, region string")
    table = aggregate.latest_by_key(r, ["user"], ["i"], "region").drop("i")
    placed = joins.stream_table_left_join(c, table, ["user"], {"region": "UNKNOWN"})
    assert rows(aggregate.group_reduce(placed, ["region"], F.col("n"), "n")) == [("americas", 101), ("asia", 124), ("europe", 109)]


def test_interval_outer_eager(spark):
    shown = [("car", 0), ("newspaper", 1), ("gadget", 2)]
    clicked = [("newspaper", 3), ("gadget", 4), ("newspaper", 5)]
    left = spark.createDataFrame([(k, at(n * 0.5), n, "shown") for k, n in shown], "k string, lt timestamp, la bigint, l string")
    right = spark.createDataFrame([(k, at(n * 0.5), n, "clicked") for k, n in clicked], "k string, rt timestamp, ra bigint, r string")
    got = joins.interval_outer_eager(left, right, ["k"], "lt", "rt", 5_000_000, "la", "ra")
    assert rows(got, "k", "l", "r") == sorted(
        [("car", "shown", None), ("newspaper", "shown", None), ("gadget", "shown", None),
         ("newspaper", "shown", "clicked"), ("gadget", "shown", "clicked"), ("newspaper", "shown", "clicked")], key=repr)


def test_session_count_closed_gap(spark):
    gap = 30 * 60
    df = spark.createDataFrame([("erica", 0, at(0)), ("erica", 1, at(gap)), ("erica", 2, at(2 * gap + 0.001)), ("bob", 3, at(5))], "user string, n int, ts timestamp")
    for chunk in (1, 100):
        got = windows.session_count(df, ["user"], "ts", 30 * M, tie=["n"], rows_per_chunk=chunk)
        assert rows(got, "user", "cnt") == [("bob", 1), ("erica", 1), ("erica", 2)]


def test_top_n_windowed(spark):
    views = {"eng": ["news"] * 3 + ["random"] * 2 + ["stuff"], "science": ["index"] * 3 + ["about"] * 2 + ["help"]}
    df = spark.createDataFrame([(i, p, at(1)) for i, ps in views.items() for p in ps], "industry string, page string, ts timestamp")
    got = topn.top_n_windowed(df, 100, "ts", "60 minutes", "industry", "page")
    assert rows(got, "industry", "top") == [("eng", "news\nrandom\nstuff"), ("science", "index\nabout\nhelp")]


def test_top_n_per_group_and_global(spark):
    songs = [(i + 1, "punk" if i < 6 else "hip hop", 6 - i % 6) for i in range(12)]
    df = spark.createDataFrame(songs, "id int, genre string, plays int")
    order = [F.col("plays").desc(), F.col("id").asc()]
    best = topn.top_n_per_group(df, 5, ["genre"], order)
    assert [r[0] for r in sorted(best.filter("genre = 'punk'").select("id").collect())] == [1, 2, 3, 4, 5]
    assert [r[0] for r in sorted(best.filter("genre = 'hip hop'").select("id").collect())] == [7, 8, 9, 10, 11]
    assert [r.id for r in topn.top_n_global(df, 5, order).collect()][:4] == [1, 7, 2, 8]


@pytest.mark.parametrize("in_order", [True, False])
def test_dedup_window(spark, in_order):
    data = [(n, k, at(n)) for n, k in enumerate("ABAABCCAB")] + [(20, None, at(3)), (21, None, at(3))]
    df = spark.createDataFrame(data, "n int, id string, ts timestamp")
    got = dedup.dedup_window(df, ["id"], "ts", ["n"], 10 * M, in_order=in_order)
    assert rows(got, "id") == sorted([("A",), ("B",), ("C",), (None,), (None,)], key=repr)


def test_dedup_duplicates_extend_the_memory(spark):
    df = spark.createDataFrame([(n, "A", at(n * 240)) for n in range(5)] + [(9, "A", at(960 + 301))], "n int, id string, ts timestamp")
    assert rows(dedup.dedup_window(df, ["id"], "ts", ["n"], 10 * M), "n") == [(0,), (9,)]


def test_anonymize_ip(spark):
    lines = texts(spark, ["Hello, 1.2.3.4!", "foo 192.168.1.55 bar"])
    got = lines.select(text.anonymize_ip(F.upper("value"))).collect()
    assert [r[0] for r in got] == ["HELLO, 1.2.3.XXX!", "FOO 192.168.1.XXX BAR"]


def test_fanout_and_corrupt_input(spark):
    df = texts(spark, ["Hello", "World"])
    out = records.sink_fanout(df, {"b": lambda d: d.select(F.upper("value").alias("v")), "c": lambda d: d.select(F.lower("value").alias("v"))})
    assert rows(out) == [("HELLO", "b"), ("WORLD", "b"), ("hello", "c"), ("world", "c")]
    good, dead = records.drop_corrupt(texts(spark, ["1", "x", "2", "", "3"]), text.parse_int(F.col("value")), "n64")
    assert [r[0] for r in good.select(F.col("n64") * 2).collect()] == [2, 4, 6]
    assert dead.count() == 2


def test_state_counts(spark):
    lines = texts(spark, ["hello", "world", "world", "hello world", "all streams lead to spark", "streams", "spark streams"])
    words = lines.select(F.explode(text.space_tokens(F.col("value"))).alias("w"))
    assert dict(rows(aggregate.group_count(words, ["w"]))) == dict(all=1, hello=2, spark=2, lead=1, streams=3, to=1, world=3)


ORDER = "id string, customer_id bigint, state string, product string, quantity bigint, price double, ts timestamp"


def test_order_details_check(spark):
    df = spark.createDataFrame([("a", 1, "CREATED", "J", 3, 10.0, at(0)), ("b", 1, "CREATED", "J", -1, 10.0, at(0)), ("c", 1, "PAID", "J", 3, 1.0, at(0))], ORDER)
    assert rows(orders.order_details_check(df), "id", "result") == [("a", "PASS"), ("b", "FAIL")]


def test_fraud_check(spark):
    spent = [(0, 3, 5), (0, 1, 75), (1, 1, 75), (1, 1, 75), (1, 50, 75), (2, 10, 100), (2, 10, 100), (2, 1, 5)]
    df = spark.createDataFrame([(str(i), c, "CREATED", "J", q, float(p), at(i)) for i, (c, q, p) in enumerate(spent)], ORDER)
    for chunk in (1, 100):
        got = [r.result for r in orders.fraud_check(df, rows_per_chunk=chunk).orderBy("id").collect()]
        assert got == ["PASS"] * 4 + ["FAIL", "PASS", "FAIL", "FAIL"]


def test_fraud_check_new_session_starts_from_zero(spark):
    df = spark.createDataFrame([(str(i), 1, "CREATED", "J", 1, 1500.0, at(i * 3601)) for i in range(4)], ORDER)
    for chunk in (1, 2, 100):
        assert {r.result for r in orders.fraud_check(df, rows_per_chunk=chunk).collect()} == {"PASS"}


def test_inventory_reserve(spark):
    stock = spark.createDataFrame([("U", 75), ("J", 1)], "product string, stock int")
    df = spark.createDataFrame([("0", 1, "CREATED", "U", 3, 1.0, at(0)), ("1", 1, "CREATED", "J", 1, 1.0, at(1)), ("2", 1, "CREATED", "J", 1, 1.0, at(2)), ("3", 1, "CREATED", "X", 1, 1.0, at(2))], ORDER)
    assert rows(orders.inventory_check(df, stock), "id", "result") == [("0", "PASS"), ("1", "PASS"), ("2", "FAIL")]


@pytest.mark.parametrize("chunk", [3, 1000])
def test_inventory_reserve_against_replay(spark, chunk):
    """Hot products, orders larger than the stock, zero and negative quantities."""
    rng = random.Random(chunk)
    stock = {0: 40, 1: 0, 2: 500, 3: 17, 4: -5}
    data = [(n, rng.choice([0, 0, 0, 1, 2, 3, 4]), rng.choice([-1, 0, 1, 2, 3, 5, 8, 13, 30, 60])) for n in range(300)]
    left, expected = dict(stock), []
    for n, p, q in data:
        ok = 0 <= q <= left[p]
        left[p] -= q if ok else 0
        expected.append((n, "PASS" if ok else "FAIL"))
    df = spark.createDataFrame(data, "n bigint, product bigint, quantity bigint")
    table = spark.createDataFrame(list(stock.items()), "product bigint, stock bigint")
    got = orders.inventory_reserve(df, table, ["n"], F.col("n"), rows_per_chunk=chunk)
    assert sorted(rows(got, "n", "result")) == expected


def test_validation_aggregate(spark):
    new = spark.createDataFrame([(str(i), 1, "CREATED", "J", 1, 1.0, at(0)) for i in range(2)], ORDER)
    results = [("0", "PASS"), ("0", "PASS"), ("0", "PASS"), ("1", "PASS"), ("1", "FAIL"), ("1", "PASS")]
    checks = spark.createDataFrame([(i, r, at(1)) for i, r in results], "id string, result string, ts timestamp")
    assert rows(orders.validation_aggregate(checks, new), "id", "state") == [("0", "VALIDATED"), ("1", "FAILED")]


def test_notify_join(spark):
    order = spark.createDataFrame([("o", 15, "VALIDATED", "J", 3, 5.0, at(0))], ORDER)
    paid = spark.createDataFrame([("p", "o", 1000.0, at(30))], "id string, order_id string, amount double, ts timestamp")
    who = spark.createDataFrame([(15, "Franz")], "customer_id bigint, customer_name string")
    assert rows(orders.notify_join(order, paid, who), "id", "payment_id", "customer_name") == [("o", "p", "Franz")]


def test_offset_range_scan(spark):
    def scan(start, stop):
        return log.offset_range_scan(df, {0: (start, stop)}).count()

    df = spark.createDataFrame([("t", 0, n, "e" if n < 8 else "a") for n in range(109)], "topic string, partition int, offset bigint, value string")
    assert (scan(0, 6), scan(6, 8), scan(8, 109), scan(109, 109)) == (6, 2, 101, 0)
    assert rows(log.offset_bounds(df)) == [(0, 0, 109)]
    with pytest.raises(ValueError):
        log.offset_range_scan(df, {0: (0, 1)}, expected={0, 1})


def test_range_and_fold(spark):
    one = spark.range(1).withColumn("upto", F.lit(3))
    numbers = records.range_source(one, F.col("upto"))
    assert records.fold_sum(numbers, F.col("n")).scalar() is not None
    assert rows(records.fold_sum(numbers, F.col("n"))) == [(6,)]
    assert rows(records.fold_sum(numbers, F.col("n") * 2)) == [(12,)]


@pytest.mark.parametrize("pattern,key,hit", [
    ("*.orange.*", "quick.orange.rabbit", True), ("*.*.rabbit", "lazy.orange.rabbit", True),
    ("lazy.#", "lazy", True), ("lazy.#", "lazy.a.b.c", True), ("lazy.#", "lazyx.a", False),
    ("#.end", "end", True), ("#.end", "a.b.end", True), ("#.end", "aend", False), ("#", "", True),
    ("*.orange.*", "orange", False), ("a.#.b", "a.b", True), ("a.#.b", "a.x.y.b", True), ("a.#.b", "ab", False),
    ("#.#", "x.y", True), ("*", "x.y", False), ("a.*", "a.b", True), ("*.#", "x.y", True),
])
def test_topic_patterns(pattern, key, hit):
    import re

    assert bool(re.search(routing.topic_regex(pattern), key)) is hit


def test_size_batches_oversize_row_is_alone(spark):
    sizes = [40, 50, 20, 500, 10, 60, 40, 1]
    df = spark.createDataFrame([(n, "k", s) for n, s in enumerate(sizes)], "n bigint, k string, s int")
    for piece in (1, 3, 4, 100):
        got = batching.size_batches(df, 100, ["k"], ["n"], F.col("n"), F.col("s"), "n", rows_per_piece=piece)
        assert [r.batch for r in got.orderBy("n").collect()] == [0, 0, 1, 2, 3, 3, 4, 4]


@pytest.mark.parametrize("piece", [1, 2, 7, 50, 1000])
def test_size_batches_against_greedy(spark, piece):
    """Batches do not depend on pieces: zero and null sizes, rows at and above the limit, a hot key."""
    rng = random.Random(piece)
    data = [(n, rng.choice([0, 0, 0, 1, None]), rng.choice([0, 0, 1, 3, 10, 19, 20, 21, 90, None])) for n in range(400)]
    expected, state = [], {}
    for n, k, s in data:
        if k is None:
            continue
        batch, used = state.get(k, (-1, 21))
        batch, used = (batch + 1, s or 0) if used + (s or 0) > 20 else (batch, used + (s or 0))
        state[k] = batch, used
        expected.append((n, batch))
    df = spark.createDataFrame(data, "n bigint, k bigint, s bigint")
    got = batching.size_batches(df, 20, ["k"], ["n"], F.col("n"), F.col("s"), "n", rows_per_chunk=30, rows_per_piece=piece)
    assert sorted((r.n, r.batch) for r in got.collect()) == expected


def test_size_batches_of_no_rows(spark):
    df = spark.createDataFrame([], "n bigint, k bigint, s bigint")
    assert batching.size_batches(df, 20, ["k"], ["n"], F.col("n"), F.col("s"), "n").collect() == []


def letters(spark, word):
    data = [(1, n, at(n), c) for n, c in enumerate(word)]
    return spark.createDataFrame(data, "p int, n bigint, ts timestamp, c string")


def one(c):
    return F.col("c") == c


def matched(spark, word, pattern):
    found = match_pattern(letters(spark, word), pattern, ["p"], "ts", "n")
    return sorted(tuple(map(tuple, list(r)[1:])) for r in found.collect())


def test_cep_goldens(spark):
    hour = 3600
    strict = Pattern.select("a").where(one("A")).then("b").where(one("B")).then("c").where(one("C"))
    assert matched(spark, "ABC", strict) == [((0,), (1,), (2,))]
    assert matched(spark, "ABCCD", strict.within(hour)) == [((0,), (1,), (2,))]
    kleene = (Pattern.select("a").where(one("A")).then("b").where(one("B"))
              .then("c").one_or_more().where(one("C")).then("d").where(one("D")).within(hour))
    assert matched(spark, "ABCCD", kleene) == [((0,), (1,), (2, 3), (4,))]
    assert matched(spark, "ABCCD", kleene.within(2)) == []
    unbounded = (Pattern.select("a").where(one("A")).then("b").where(one("B"))
                 .then("c").one_or_more().where(one("C")).then("d").where(one("D")))
    assert matched(spark, "ABCCD", unbounded) == [((0,), (1,), (2, 3), (4,))]
    skip = (Pattern.select("a").where(one("A")).then("c").skip_till_next_match().where(one("C"))
            .then("d").skip_till_next_match().where(one("D")))
    assert matched(spark, "ABCCD", skip) == [((0,), (2,), (4,))]
    assert matched(spark, "ABCCD", skip.within(hour)) == [((0,), (2,), (4,))]
    assert matched(spark, "ABCCD", skip.within(4)) == [((0,), (2,), (4,))]
    assert matched(spark, "ABCCD", skip.within(3)) == []
    anyone = (Pattern.select("a").where(one("A")).then("b").where(one("B"))
              .then("c").skip_till_any_match().where(one("C"))
              .then("d").skip_till_any_match().where(one("D")).within(hour))
    assert matched(spark, "ABCCD", anyone) == [((0,), (1,), (2,), (4,)), ((0,), (1,), (3,), (4,))]


def test_cep_bounds_of_stages(spark):
    a = Pattern.select("a").where(one("A"))
    skipping = a.then("b").skip_till_next_match().where(one("B")).within(2).then("c").skip_till_next_match().where(one("C"))
    assert matched(spark, "AABXXC", skipping) == [((0,), (2,), (5,)), ((1,), (2,), (5,))]
    assert matched(spark, "AAXBXC", skipping) == [((1,), (3,), (5,))]
    # What ends a repeated stage lies within its bound.
    kleene = a.then("b").one_or_more().where(one("B"))
    assert matched(spark, "ABBC", kleene.within(2).then("c").where(one("C"))) == []
    assert matched(spark, "ABBC", kleene.within(3).then("c").where(one("C"))) == [((0,), (1, 2), (3,))]


SPLITS = {
    "middle": lambda p: p("x").then("y").one_or_more().where(F.col("c").isin("B", "C")).then("z").where(F.col("c").isin("C", "D")),
    "first": lambda p: p("x").one_or_more().then("y").where(F.col("c").isin("A", "B")).then("z").optional().where(one("C")).then("w").where(one("D")),
    "bounds": lambda p: p("x").then("y").zero_or_more().where(F.col("c").isin("A", "B")).within(2).then("z").one_or_more()
    .where(F.col("c").isin("B", "C")).then("w").where(F.col("c") != "A").within(6),
}


@pytest.mark.parametrize("name", SPLITS)
@pytest.mark.parametrize("chunk", [9, 1000])
def test_contiguous_patterns_equal_the_run_by_run_search(spark, name, chunk):
    """Rows that fit several stages, equal instants, several keys, cut keys."""
    rng = random.Random(name)
    data = [(rng.choice([1, 1, 1, 2, None]), n, at(n // 2), rng.choice("AABBCCD")) for n in range(120)]
    df = spark.createDataFrame(data, "p int, n bigint, ts timestamp, c string")
    pattern = SPLITS[name](lambda first: Pattern.select(first).where(F.col("c").isin("A", "B")))
    got = cep.match_pattern(df, pattern, ["p"], "ts", "n", rows_per_chunk=chunk)
    expected = cep._match_runs(df.filter("p IS NOT NULL"), pattern, ["p"], "ts", "n")
    assert len(rows(expected)) > 5
    assert rows(got) == rows(expected)


def test_user_predicates_see_whole_numbers_beside_nulls(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(1, n, at(n), v) for n, v in enumerate([5, None, big])], "p int, n bigint, ts timestamp, v bigint")
    pattern = (Pattern.select("x").one_or_more().where(lambda row, state: row["v"] is None or row["v"] == 5)
               .then("y").where(lambda row, state: row["v"] == big))
    assert rows(match_pattern(df, pattern, ["p"], "ts", "n"), "x", "y") == [([0, 1], [2]), ([1], [2])]


def test_cep_optional_and_rejections(spark):
    base = Pattern.select("a").where(one("A"))
    maybe = base.then("b").optional().where(one("B")).then("c").where(one("C")).within(60)
    assert matched(spark, "ACABC", maybe) == [((0,), (), (1,)), ((2,), (3,), (4,))]
    many = base.then("b").zero_or_more().where(one("B")).then("c").where(one("C")).within(60)
    assert matched(spark, "ACABBBC", many) == [((0,), (), (1,)), ((2,), (3, 4, 5), (6,))]
    with pytest.raises(ValueError):
        base.then("b").one_or_more().where(one("B")).check()
    with pytest.raises(ValueError):
        base.then("b").skip_till_any_match().where(one("B")).check()


def test_cep_fold_stock_query(spark):
    ticks = [(100, 1010), (120, 990), (120, 1005), (121, 999), (120, 999), (125, 750), (120, 950), (120, 700)]
    data = [(1, n + 1, at(n), p, v) for n, (p, v) in enumerate(ticks)]
    df = spark.createDataFrame(data, "p int, n bigint, ts timestamp, price bigint, volume bigint")
    pattern = (
        Pattern.select("s1").where(F.col("volume") > 1000).fold("avg", lambda r, cur: r["price"])
        .then("s2").zero_or_more().skip_till_next_match()
        .where(lambda r, s: r["price"] > s["avg"])
        .fold("avg", lambda r, cur: (cur + r["price"]) // 2)
        .fold("volume", lambda r, cur: r["volume"])
        .then("s3").skip_till_next_match().where(lambda r, s: r["volume"] < 0.8 * s.get("volume", 0))
        .within(3600)
    )
    found = match_pattern(df, pattern, ["p"], "ts", "n")
    got = sorted((tuple(r.s1), tuple(r.s2), tuple(r.s3)) for r in found.collect())
    assert got == sorted([
        ((1,), (2, 3, 4, 5), (6,)), ((3,), (4,), (6,)), ((1,), (2, 3, 4, 5, 6, 7), (8,)), ((3,), (4, 6), (8,)),
    ])


def test_dense_windows_equal_expanded_windows(spark):
    random.seed(3)
    df = spark.createDataFrame([(n % 2, at(random.randint(0, 400))) for n in range(60)], "k int, ts timestamp")
    runs = windows.change_points(df, ["k"], "ts", 60_000_000, 5_000_000)
    starts = F.sequence(F.unix_seconds("start_from"), F.unix_seconds("start_to"), F.lit(5).cast("bigint"))
    flat = runs.select("k", F.explode(starts).alias("s"), "cnt")
    wanted = windows.hopping_count(df, ["k"], "ts", 60_000_000, 5_000_000).select("k", F.unix_seconds("start").alias("s"), "cnt")
    assert rows(flat) == rows(wanted)
    # Any overlap is answered: each row counts once in every window that covers it.
    wide = windows.hopping_count(df, ["k"], "ts", 7 * windows.DAY, 1_000_000)
    assert rows(wide.agg(F.sum("cnt"))) == [(60 * 7 * 24 * 3600,)]


def test_moving_average_repeats_on_invalid(spark):
    raw = ["x", "1", "2", "x", "6", "4", "bad", "10"]
    df = texts(spark, raw).withColumn("k", F.lit(1))
    for tile in (3, 1000):
        got = aggregate.moving_average(df, 3, ["k"], ["n"], F.col("n"), text.parse_int(F.col("value")), tile_rows=tile, rows_per_chunk=2)
        assert [r.avg for r in got.orderBy("n").collect()] == [1, 1, 1, 3, 4, 4, 6]


def test_time_weighted_moments_by_hand(spark):
    df = spark.createDataFrame([(1, at(0), 2.0), (1, at(3), 4.0), (1, at(5), 1.0), (1, at(6), 9.0)], "k int, ts timestamp, v double")
    buckets = detectors.second_buckets(df, ["k"], "ts", F.col("v"))
    got = detectors.time_weighted_moments(buckets, ["k"], 100).orderBy("sec").collect()
    # One bucket: 2. Two: (2 + 4) / 2 * 4 over 4. Three: 12 + 1 * 2 over 6.
    assert [(r.n, round(r.mean, 6)) for r in got] == [(1, 2.0), (4, 3.0), (6, round(14 / 6, 6))]
    assert round(got[1].variance, 6) == round((16 * 2 + 4 * 2) / 4 - 9, 6)


def test_composite_and_expiry(spark):
    data = [("x", "a", at(0), 1.0), ("x", "b", at(50), 2.0), ("x", "a", at(55), 9.0), ("y", "a", at(0), 5.0), ("y", "b", at(61), 6.0)]
    df = spark.createDataFrame(data, "id string, k string, ts timestamp, v double")
    parts = {n: F.col("k") == n for n in "ab"}
    made = detectors.composite_event(df, ["id"], parts, "ts", "v", ["ts"], 60_000_000)
    assert rows(made, "id", "complete", "a_value", "b_value") == [("x", True, 1.0, 2.0), ("y", False, 5.0, None)]
    old = detectors.expired_event(made, 60_000_000, F.lit(at(100)))
    assert rows(old, "id", "age_ms") == [("y", 100_000)]
    assert detectors.expired_event(made, 60_000_000, F.lit(at(70))).count() == 0
    assert rows(detectors.value_aggregate(made, ["a", "b"]), "id", "value") == [("x", 3.0)]


def test_sequence_event(spark):
    df = spark.createDataFrame([("k", n, at(s)) for n, s in enumerate([0, 1, 2, 50])], "k string, n int, ts timestamp")
    got = detectors.sequence_event(df, ["k"], "ts", 10, 2)
    # At second 2 the frame holds seconds 0 and 1; at second 50 it is empty.
    assert rows(got, "n", "size") == [(0, 2), (1, 2)]
