"""Composable event detectors over keyed constituents and second-wide buckets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.plans.ordered import ROWS_PER_CHUNK, KeyedOrder, frame_edge, micros, tiles

SECOND = 1_000_000
# Fixed value: incomplete composites live for five quarters of their frame.
LIFE_NUMERATOR, LIFE_DENOMINATOR = 5, 4


def composite_event(
    df: DataFrame,
    ids: Sequence[str],
    constituents: Mapping[str, Column],
    ts: str,
    value: str,
    order: Sequence[str],
    frame: int,
) -> DataFrame:
    """Per id the first firing of each constituent, combined before the shuffle.

    Adds ``ts`` (earliest), ``bits`` (which fired inside the frame), ``complete`` and
    ``<name>_value`` per constituent.
    """
    firsts = [
        F.min_by(F.struct(ts, value), F.when(cond, F.struct(*order))).alias(f"_c_{name}")
        for name, cond in constituents.items()
    ]
    any_fired = F.lit(False)
    for cond in constituents.values():
        any_fired = any_fired | cond
    grouped = df.filter(any_fired).groupBy(*ids).agg(*firsts)
    names = list(constituents)
    times = [F.col(f"_c_{n}.{ts}") for n in names]
    earliest = F.least(*times) if len(times) > 1 else times[0]
    fired = [F.coalesce(micros(t) - micros("_first") <= frame, F.lit(False)) for t in times]
    values = [
        F.when(f, F.col(f"_c_{n}.{value}")).alias(f"{n}_value") for n, f in zip(names, fired)
    ]
    return (
        grouped.withColumn("_first", earliest)
        .select(*ids, F.col("_first").alias("ts"), F.array(*fired).alias("bits"), *values)
        .withColumn("complete", F.forall("bits", lambda b: b))
    )


def expired_event(composites: DataFrame, frame: int, now: Column) -> DataFrame:
    """Incomplete composites past their life, with their age in milliseconds."""
    age = micros(now) - micros("ts")
    life = frame * LIFE_NUMERATOR // LIFE_DENOMINATOR
    return (
        composites.filter(~F.col("complete") & (age > life))
        .withColumn("age_ms", F.floor(age / 1000))
    )


def value_aggregate(composites: DataFrame, names: Sequence[str], out: str = "value") -> DataFrame:
    """Sum of the constituents' values of complete composites."""
    total = F.lit(0.0)
    for n in names:
        total = total + F.coalesce(F.col(f"{n}_value"), F.lit(0.0))
    return composites.filter("complete").withColumn(out, total)


def value_log_ratio(
    composites: DataFrame, first: str, second: str, threshold: float, out: str = "value"
) -> DataFrame:
    """Natural logarithm of the ratio of two values, where it exceeds the threshold."""
    ratio = F.ln(F.try_divide(F.col(f"{first}_value"), F.col(f"{second}_value")))
    return (
        composites.filter("complete").withColumn(out, ratio).filter(F.abs(out) > threshold)
    )


def second_buckets(df: DataFrame, keys: Sequence[str], ts: str, value: Column) -> DataFrame:
    """Sum and count per key and second: at most one row per second of a key's time span."""
    sec = F.floor(micros(ts) / F.lit(SECOND))
    return df.groupBy(*keys, sec.alias("sec")).agg(
        F.sum(value).alias("v"), F.count(F.lit(1)).alias("n")
    )


def _framed(
    buckets: DataFrame,
    keys: Sequence[str],
    seconds: int,
    sums: Mapping[str, Column],
    ahead: int = 0,
) -> DataFrame:
    """Buckets with the edges of their frame ``[sec - seconds, sec - 1]``.

    The newest second is still filling and stays out of its own frame. ``_first``, ``_second``
    and ``_last`` are the frame's first two buckets and its last one; all are null for an empty
    frame. ``_d`` holds the seconds since the bucket before. Callers keep the ``_own`` rows.

    Time is cut into blocks as long as the frame, so a frame is the end of one block and the
    beginning of the next. Sums over it are a running sum from its first bucket to the end of
    that block plus one from the start of the next: nothing is subtracted, and values outside
    the frame leave no rounding error in it.
    """
    cut = tiles(buckets, F.col("sec"), 4 * seconds, before=seconds, after=ahead)
    order = Window.partitionBy(*keys, "_tile").orderBy("sec")
    block = F.floor(F.col("sec") / F.lit(seconds))
    within = Window.partitionBy(*keys, "_tile", "_block")
    before = within.orderBy("sec").rowsBetween(Window.unboundedPreceding, -1)
    onward = within.orderBy(F.col("sec").desc()).rowsBetween(Window.unboundedPreceding, 0)
    step = F.coalesce(F.col("sec") - F.lag("sec").over(order), F.lit(0))
    at = cut.withColumn("_d", step).withColumn("_block", block)
    for name, value in sums.items():
        at = at.withColumn(f"_x_{name}", value)
    at = at.withColumns({f"_to_{n}": F.sum(f"_x_{n}").over(onward) for n in sums})
    at = at.withColumns({f"_from_{n}": F.sum(f"_x_{n}").over(before) for n in sums})
    here = F.struct("sec", "v", "_d", "_block", *[f"_to_{n}" for n in sums])
    at = at.withColumn("_here", here)
    at = at.withColumn(
        "_pair", F.struct(F.col("_here").alias("one"), F.lead("_here").over(order).alias("two"))
    ).withColumn("_before", F.lag("_here").over(order))
    at = frame_edge(
        at, [*keys, "_tile"], "sec", -seconds, F.col("_pair"), "_edge", upward=True
    )
    filled = F.col("_edge.one.sec") < F.col("sec")
    at = (
        at.withColumn("_first", F.when(filled, F.col("_edge.one")))
        .withColumn("_second", F.when(F.col("_edge.two.sec") < F.col("sec"), F.col("_edge.two")))
        .withColumn("_last", F.when(filled, F.col("_before")))
    )

    def total(name: str) -> Column:
        start = F.col(f"_from_{name}")
        end = F.col(f"_first._to_{name}")
        earlier = F.col("_first._block") < F.col("_block")
        both = F.when(start.isNull(), end).otherwise(end + start)
        return F.when(earlier, both).when(F.col("_first").isNotNull(), start).alias(name)

    kept = [c for c in buckets.columns if c not in sums]
    return at.select(*kept, "_tile", "_own", "_first", "_second", "_last", *[total(n) for n in sums])


def sliding_sum(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: Column,
    seconds: int,
    arrival: Sequence[str],
    position: Column,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Sum over the last ``seconds`` full seconds, per second with data. Rows older than the
    frame behind the newest that arrived before are rejected."""
    seen = KeyedOrder.of(df, keys, arrival, position, rows_per_chunk).running(
        {"_newest": ("max", micros(ts))}, inclusive=False
    )
    late = F.coalesce(micros(ts) < F.col("_newest") - F.lit(seconds * SECOND), F.lit(False))
    kept = seen.result().filter(~late)
    buckets = second_buckets(kept, keys, ts, value.cast("double"))
    framed = _framed(buckets, keys, seconds, {"window_sum": F.col("v")}).filter("_own")
    return framed.select(*keys, "sec", F.coalesce("window_sum", F.lit(0.0)).alias("window_sum"))


def sequence_event(
    complete: DataFrame, keys: Sequence[str], ts: str, seconds: int, limit: int
) -> DataFrame:
    """Events that stood in a frame with at least ``limit`` events when another one arrived.

    Each arrival reports every event of its frame with the frame's size; a later report
    replaces an earlier one, so each event carries the size of its last report.
    """
    buckets = second_buckets(complete, keys, ts, F.lit(1).cast("bigint"))
    # An event is reported by arrivals up to one frame later, each looking one frame back.
    sized = _framed(buckets, keys, seconds, {"_size": F.col("v")}, ahead=seconds)
    fired = F.when(F.col("_size") >= limit, F.struct("sec", "_size"))
    reported = frame_edge(
        sized.select(*keys, "_tile", "_own", "sec", "_size"),
        [*keys, "_tile"], "sec", seconds, fired, "_report", upward=False,
    ).filter(F.col("_own") & (F.col("_report.sec") > F.col("sec")))
    reported = reported.select(*keys, "sec", F.col("_report._size").alias("size"))
    sec = F.floor(micros(ts) / F.lit(SECOND))
    return complete.withColumn("sec", sec).join(reported, [*keys, "sec"])


def time_weighted_moments(buckets: DataFrame, keys: Sequence[str], seconds: int) -> DataFrame:
    """Mean and variance over the frame before each second, weighting a value by the seconds
    since the bucket before it.

    The first bucket of a frame counts once. When it is positive, it is averaged with the
    second bucket over their distance. Later buckets add value times distance. Sums over the
    frame minus the special first buckets give this without collecting the frame.
    """
    weighted = {
        "_s1": F.col("v") * F.col("_d"),
        "_s2": F.col("v") * F.col("v") * F.col("_d"),
        "window_sum": F.col("v"),
    }
    at = _framed(buckets, keys, seconds, weighted).filter(
        F.col("_own") & F.col("_first").isNotNull()
    )
    v1, k1, v2, k2 = (F.col(c) for c in ("_first.v", "_first._d", "_second.v", "_second._d"))
    gap = F.col("_second.sec") - F.col("_first.sec")
    alone, blend = F.col("_second").isNull(), v1 > 0
    sum1 = (
        F.when(alone, v1)
        .when(blend, (v1 + v2) / 2 * (gap + 1) + F.col("_s1") - v1 * k1 - v2 * k2)
        .otherwise(v1 + F.col("_s1") - v1 * k1)
    )
    half = F.floor(gap / 2) + 1
    sum2 = (
        F.when(alone, v1 * v1)
        .when(blend, (v1 * v1 + v2 * v2) * half + F.col("_s2") - v1 * v1 * k1 - v2 * v2 * k2)
        .otherwise(v1 * v1 + F.col("_s2") - v1 * v1 * k1)
    )
    n = F.lit(1) + F.col("_last.sec") - F.col("_first.sec")
    mean = sum1 / n
    return at.select(
        *keys, "sec", n.alias("n"), mean.alias("mean"),
        (sum2 / n - mean * mean).alias("variance"), "window_sum",
    )


def rate_event(df: DataFrame, keys: Sequence[str], ts: str, seconds: int) -> DataFrame:
    """Arrival rate per frame: each mark counts one frame before its instant, over two frames.

    The last mark of a frame decides. ``rate_sum`` is half of the two frames' count.
    """
    shifted = df.withColumn("_t", F.timestamp_micros(micros(ts) - F.lit(seconds * SECOND)))
    buckets = second_buckets(shifted, keys, "_t", F.lit(1.0))
    moments = time_weighted_moments(buckets, keys, 2 * seconds)
    frame_id = F.floor(F.col("sec") / seconds) * F.lit(seconds * 1000)
    last = F.max_by(F.struct("mean", (F.col("window_sum") / 2).alias("rate_sum")), "sec")
    return (
        moments.groupBy(*keys, frame_id.alias("frame_id"))
        .agg(last.alias("l"))
        .select(*keys, "frame_id", F.col("l.mean").alias("mean"), F.col("l.rate_sum").alias("rate_sum"))
    )


def value_stdev(
    events: DataFrame, keys: Sequence[str], ts: str, value: str, seconds: int, threshold: float
) -> DataFrame:
    """Events whose value lies more than ``threshold`` deviations from the frame's mean, given
    a positive deviation and more than two weighted points."""
    buckets = second_buckets(events, keys, ts, F.col(value))
    moments = time_weighted_moments(buckets, keys, seconds).drop("window_sum")
    sec = F.floor(micros(ts) / F.lit(SECOND))
    scored = events.withColumn("sec", sec).join(moments, [*keys, "sec"])
    # All conditions sit in one expression over both sides, so the moments are computed once
    # and not again inside a filter pushed below the join.
    usable = (F.col("variance") > 0) & (F.col("n") > 2)
    deviation = F.when(usable, F.abs(F.col(value) - F.col("mean")) / F.sqrt("variance"))
    return scored.withColumn("deviation", deviation).filter(F.col("deviation") > threshold)
