"""Time windows: tumbling, hopping, dense sliding, sessions and late rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.plans.ordered import ROWS_PER_CHUNK, KeyedOrder, micros

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR

PANE_COPIES = 2_000


def interval(length: int) -> str:
    return f"{length} microseconds"


def tumbling(df: DataFrame, keys: Sequence[str], ts: str, size: int, *aggs: Column) -> DataFrame:
    """Epoch-aligned ``[start, end)`` windows, batch or streaming."""
    w = F.window(ts, interval(size)).alias("w")
    names = [c for c in df.groupBy(w, *keys).agg(*aggs).columns if c != "w" and c not in keys]
    return (
        df.groupBy(w, *keys)
        .agg(*aggs)
        .select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), *names)
    )


def tumbling_count(df: DataFrame, keys: Sequence[str], ts: str, size: int) -> DataFrame:
    return tumbling(df, keys, ts, size, F.count(F.lit(1)).alias("cnt"))


tumbling_aggregate = tumbling
tumbling_reduce = tumbling


def tumbling_max_retained(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: int,
    retention: int,
    value: str,
    *,
    lane: Sequence[str] = (),
    arrival: Sequence[str] = (),
    position: Column | None = None,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Windowed max where rows older than the retention behind the newest are ignored.

    Streaming frames use the watermark. Batch frames look at the highest instant that arrived
    before in the same ``lane`` (a log partition).
    """
    if df.isStreaming:
        kept = df.withWatermark(ts, interval(retention))
    else:
        kept, _ = late_split(df, ts, retention, lane, arrival, position, rows_per_chunk)
    return tumbling(kept, keys, ts, size, F.max(value).alias("max_value"))


def anomaly_users(df: DataFrame, user: str, ts: str, size: int, least: int) -> DataFrame:
    """Users with at least ``least`` rows in one window."""
    return tumbling_count(df, [user], ts, size).filter(F.col("cnt") >= least)


def hopping(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: int,
    step: int,
    value: Column | None = None,
    name: str = "cnt",
) -> DataFrame:
    """Sum (or count) in overlapping windows.

    A batch frame is summed into panes of one step first; only the panes are copied into the
    windows they belong to. Counts in windows that overlap very much come from runs of equal
    windows, so that panes are not copied thousands of times; results are the same. A stream uses
    the built-in window so that its watermark works.
    """
    if size % step:
        raise ValueError("the window size must be a multiple of the step")
    if size // step > PANE_COPIES and value is None and not df.isStreaming:
        runs = change_points(df, keys, ts, size, step, name=name)
        ends = F.sequence(F.unix_micros("start_from"), F.unix_micros("start_to"), F.lit(step).cast("bigint"))
        return runs.select(*keys, F.explode(ends).alias("_start"), name).select(
            *keys,
            F.timestamp_micros("_start").alias("start"),
            F.timestamp_micros(F.col("_start") + F.lit(size)).alias("end"),
            name,
        )
    one = F.lit(1) if value is None else value
    if df.isStreaming:
        w = F.window(ts, interval(size), interval(step)).alias("w")
        return (
            df.groupBy(w, *keys)
            .agg(F.sum(one).alias(name))
            .select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), name)
        )
    pane = F.floor(micros(ts) / F.lit(step)) * F.lit(step)
    panes = df.groupBy(*keys, pane.alias("_pane")).agg(F.sum(one).alias("_v"))
    starts = F.sequence(F.col("_pane") - F.lit(size - step), F.col("_pane"), F.lit(step).cast("bigint"))
    return (
        panes.withColumn("_start", F.explode(starts))
        .groupBy(*keys, "_start")
        .agg(F.sum("_v").alias(name))
        .select(
            *keys,
            F.timestamp_micros("_start").alias("start"),
            F.timestamp_micros(F.col("_start") + F.lit(size)).alias("end"),
            name,
        )
    )


def hopping_count(
    df: DataFrame, keys: Sequence[str], ts: str, size: int, step: int
) -> DataFrame:
    return hopping(df, keys, ts, size, step)


def change_points(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: int,
    step: int,
    value: Column | None = None,
    name: str = "cnt",
    *,
    keep_empty: bool = False,
) -> DataFrame:
    """Hopping windows with any overlap, as runs of equal neighbouring windows.

    A row enters at its first covering window start and leaves after its last one, so it adds
    two changes instead of one copy per window. Changes are summed per key and window start
    before they are ordered; a key has at most one change per step of its time span.
    Returns ``start_from, start_to`` (inclusive) and the value; runs after a key has emptied
    are kept only with ``keep_empty``, and then only between rows of the key.
    """
    if df.isStreaming:
        raise ValueError("dense windows are a batch operator")
    one = F.lit(1).cast("bigint") if value is None else value
    t = micros(ts)
    enter = (F.floor((t - F.lit(size)) / F.lit(step)) + 1) * F.lit(step)
    leave = (F.floor(t / F.lit(step)) + 1) * F.lit(step)
    moves = df.select(
        *keys,
        F.explode(
            F.array(
                F.struct(enter.alias("at"), one.alias("d"), F.lit(1).alias("r")),
                F.struct(leave.alias("at"), (-one).alias("d"), F.lit(-1).alias("r")),
            )
        ).alias("m"),
    )
    summed = moves.groupBy(*keys, F.col("m.at").alias("at")).agg(
        F.sum("m.d").alias("d"), F.sum("m.r").alias("r")
    )
    order = Window.partitionBy(*keys).orderBy("at")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    runs = summed.select(
        *keys,
        F.col("at").alias("_from"),
        (F.lead("at").over(order) - F.lit(step)).alias("_to"),
        F.sum("d").over(upto).alias(name),
        F.sum("r").over(upto).alias("_rows"),
    ).filter(F.col("_to").isNotNull())
    if not keep_empty:
        runs = runs.filter(F.col("_rows") > 0)
    return runs.select(
        *keys,
        F.timestamp_micros("_from").alias("start_from"),
        F.timestamp_micros("_to").alias("start_to"),
        name,
    )


def hopping_count_dense(
    df: DataFrame, keys: Sequence[str], ts: str, size: int, step: int
) -> DataFrame:
    return change_points(df, keys, ts, size, step)


def sliding_inverse_reduce(
    df: DataFrame, keys: Sequence[str], ts: str, size: int, step: int
) -> DataFrame:
    """Counts kept by adding what enters and subtracting what leaves; idle keys stay at 0."""
    return change_points(df, keys, ts, size, step, keep_empty=True)


def sessionize(
    df: DataFrame,
    keys: Sequence[str],
    arrival: Sequence[str],
    position: Column,
    ts: str,
    gap: int,
    name: str = "session_id",
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Number each row's session from 0. A row more than ``gap`` after the row that arrived
    before it opens the next session."""
    at = micros(ts)
    # In time order the newest instant so far is that of the row before, and a maximum is
    # cheaper to carry between chunks than the last row.
    kind = "max" if arrival[0] == ts else "last"
    with_last = KeyedOrder.of(df, keys, arrival, position, rows_per_chunk).running(
        {"_last": (kind, at)}, inclusive=False
    )
    opens = F.when(F.col("_last") < at - F.lit(gap), F.lit(1)).otherwise(F.lit(0))
    numbered = with_last.with_column("_opens", opens).running(
        {name: ("sum", F.col("_opens"))}
    )
    return numbered.result().drop("_last", "_opens")


def session_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    gap: int,
    *aggs: Column,
    tie: Sequence[str] = (),
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Aggregates per session ``[first row, last row]``, with a closed gap.

    Batch: number the sessions in time order, then aggregate with partial sums. Streaming: the
    built-in session window, which merges sessions as rows arrive.
    """
    if df.isStreaming:
        w = F.session_window(ts, interval(gap)).alias("w")
        grouped = df.groupBy(w, *keys).agg(*aggs)
        names = [c for c in grouped.columns if c != "w" and c not in keys]
        end = F.timestamp_micros(F.unix_micros("w.end") - F.lit(gap))
        return grouped.select(
            *keys, F.col("w.start").alias("start"), end.alias("end"), *names
        )
    numbered = sessionize(
        df, keys, [ts, *tie], micros(ts), ts, gap, "_session", rows_per_chunk
    )
    grouped = numbered.groupBy(*keys, "_session").agg(
        F.min(ts).alias("start"), F.max(ts).alias("end"), *aggs
    )
    return grouped.drop("_session")


def session_count(
    df: DataFrame, keys: Sequence[str], ts: str, gap: int, tie: Sequence[str] = (), **kw
) -> DataFrame:
    return session_aggregate(df, keys, ts, gap, F.count(F.lit(1)).alias("cnt"), tie=tie, **kw)


session_reduce = session_aggregate


def late_flag(
    df: DataFrame,
    ts: str,
    allowed: int,
    lane: Sequence[str],
    arrival: Sequence[str],
    position: Column,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    flag: str = "late",
) -> DataFrame:
    """Every row with a flag: is it more than ``allowed`` behind the newest that arrived before?"""
    seen = (
        KeyedOrder.of(df, lane, arrival, position, rows_per_chunk)
        .running({"_newest": ("max", micros(ts))}, inclusive=False)
        .result()
    )
    late = F.coalesce(micros(ts) < F.col("_newest") - F.lit(allowed), F.lit(False))
    return seen.withColumn(flag, late).drop("_newest")


def late_split(df: DataFrame, *where, **options) -> tuple[DataFrame, DataFrame]:
    """Rows in time and late rows, as two filters over one pass (see ``late_flag``)."""
    flagged = late_flag(df, *where, flag="_late", **options)
    return flagged.filter("NOT _late").drop("_late"), flagged.filter("_late").drop("_late")
