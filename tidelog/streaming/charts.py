"""Charts on unbounded frames: the best items of each group, from full counts in state."""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidelog.streaming.stateful import Lateness, ddl, transform_state


def place(entry: tuple) -> tuple:
    """Larger counts first, then smaller items, null items before all others."""
    item, count = entry
    return (-count, item is not None, item)


class Chart(StatefulProcessor):
    """Counts by item in a map, and the best ``n`` of them beside it.

    An item that gains or loses only moves inside the best or enters them. Only when one of the best loses are the counts
    read again, as another item may take its place. A count of 0 is removed.
    """

    def __init__(self, n: int, item: str, weight: str, fields: Sequence[str]) -> None:
        self.n, self.item, self.weight = n, item, weight
        self.out = Row(*fields)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", "item binary", "count bigint")
        self.best = handle.getValueState("best", "version bigint, entries binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        gains: dict = {}
        for row in rows:
            gains[row[self.item]] = gains.get(row[self.item], 0) + (row[self.weight] or 0)
        if not gains:
            return
        stored = self.best.get() if self.best.exists() else None
        version, entries = (stored[0], pickle.loads(stored[1])) if stored else (0, [])
        chart, full, again = dict(entries), len(entries) >= self.n, False
        for item, gain in gains.items():
            name = (pickle.dumps(item),)
            before = self.counts.getValue(name)
            count = (before[0] if before else 0) + gain
            if count:
                self.counts.updateValue(name, (count,))
            elif before:
                self.counts.removeKey(name)
            again |= full and item in chart and gain < 0
            chart[item] = count
        chart = self.counts.iterator() if again else chart.items()
        if again:
            chart = [(pickle.loads(bytes(k[0])), v[0]) for k, v in chart]
        entries = sorted(((i, c) for i, c in chart if c), key=place)[: self.n]
        self.best.update((version + 1, pickle.dumps(entries)))
        # A chart that became empty is told by a row of rank 0.
        for rank, (item, count) in enumerate(entries, 1):
            yield self.out(*key, version + 1, rank, item, count)
        if not entries:
            yield self.out(*key, version + 1, 0, None, None)

    def close(self) -> None:
        pass


def _shard(item: str, shards: int) -> Column:
    return F.pmod(F.xxhash64(F.col(item)), F.lit(shards)).cast("int")


def top_n_stream(
    df: DataFrame, n: int, groups: Sequence[str], item: str, weight: Column, shards: int = 4
) -> DataFrame:
    """Each new chart of each group, shard and trigger: ``groups``, ``shard``, ``version``, ``rank``, ``item``, ``count``.

    ``weight`` adds to an item's count and may be negative, or null for nothing. Items of a group are dealt to ``shards``, so that a group with
    many rows is not one task; ``latest_charts`` puts the shards' charts together.
    """
    rows = df.select(
        *groups, _shard(item, shards).alias("shard"), F.col(item), weight.cast("bigint").alias("_weight")
    )
    fields = [*groups, "shard", "version", "rank", item, "count"]
    kinds = f"{ddl(rows, [*groups, 'shard'])}, version bigint, rank int, {ddl(rows, [item])}, count bigint"
    chart = Chart(n, item, "_weight", fields)
    return rows.groupBy(*groups, "shard").transformWithState(chart, kinds, "update", "none")


def latest_charts(charts: DataFrame, n: int, groups: Sequence[str], item: str) -> DataFrame:
    """The charts now: of each shard the newest version, and of these the best ``n`` per group. Few rows: ``n`` a shard."""
    newest = Window.partitionBy(*groups, "shard")
    now = charts.withColumn("_last", F.max("version").over(newest)).filter("version = _last AND rank > 0")
    best = Window.partitionBy(*groups).orderBy(F.col("count").desc(), F.col(item).asc())
    ranked = now.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)
    return ranked.select(*groups, item, "count", "rank")


def top_n_windowed_stream(
    df: DataFrame, n: int, ts: str, window: int, groups: Sequence[str], item: str, late: Lateness, shards: int = 4
) -> DataFrame:
    """The charts of closed windows of ``window`` microseconds, once each: ``groups``, ``shard``, ``window_end`` (microseconds),
    ``rank``, ``item``, ``count``. A window's counts are one value, and leave the state when the watermark passes its end."""
    end = (F.floor(F.unix_micros(ts) / F.lit(window)) + 1).cast("bigint") * F.lit(window)
    # Null groups are groups, so the key is a struct; zeros of both signs are one.
    named = [
        (F.col(g) + F.lit(0.0)).cast(df.schema[g].dataType).alias(g)
        if isinstance(df.schema[g].dataType, (T.FloatType, T.DoubleType)) else F.col(g)
        for g in groups
    ]
    key = F.struct(*named, _shard(item, shards).alias("shard"), end.alias("window_end"))
    rows = df.select(key.alias("_key"), F.col(ts).alias("_ts"), F.col(item))

    def step(state, row):
        counts = {} if state[0] is None else state[0]
        counts[row[item]] = counts.get(row[item], 0) + 1
        return (counts, row["_key"]["window_end"]), []

    def close(state, _):
        best = heapq.nsmallest(n, state[0].items(), key=place)
        return (None, None), [(rank, *entry) for rank, entry in enumerate(best, 1)], None

    output = f"rank int, {ddl(df, [item])}, count bigint"
    charts = transform_state(
        rows, ["_key"], step, output, (None, None), ["_ts"], late, tick=close, wake=lambda state, _: state[1]
    )
    return charts.select("_key.*", "rank", item, "count")


def windowed_charts(charts: DataFrame, n: int, group: str, item: str, name: str = "top") -> DataFrame:
    """The shards' charts of each window and group put together: the best items, joined by line breaks."""
    best = Window.partitionBy("window_end", group).orderBy(F.col("count").desc(), F.col(item).asc())
    ranked = charts.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= n)
    names = F.sort_array(F.collect_list(F.struct("_r", F.col(item).cast("string").alias("i"))))
    return ranked.groupBy("window_end", group).agg(F.array_join(names["i"], "\n").alias(name))
