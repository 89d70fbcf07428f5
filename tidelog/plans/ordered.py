"""Order-dependent computations that do not put a whole key into one task.

A window over ``(key)`` sorts every row of a key in one task, which fails when a single key
holds a large share of the rows. Two shapes avoid that.

``KeyedOrder`` first counts rows per key, combined before the shuffle. Without a key above the
row limit it plans ordinary windows. Otherwise it cuts only the *hot* keys into consecutive
chunks of about that many rows, at places of the order found from a sample of its rows (so
bursts and equal positions are cut as well), computes running values inside each chunk, and completes them with what
earlier chunks carry in. The tables of hot keys and of carried values have at most about
``2 * total_rows / rows_per_chunk`` rows. They are written to the shared folder and counted,
and are broadcast only while small.

``tiles`` is for frames of known length: rows are cut into fixed tiles of the order and copied
into neighbouring tiles only where a frame reaches across the border.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.sources.scratch import scratch_dir, through

# A task sorts a chunk: windows over 7 million rows were projected to take 4.5 GB in one.
ROWS_PER_CHUNK = 2_000_000
# The sampled rows that decide a chunk: its size is within a few tenths of the limit.
SAMPLES_PER_CHUNK = 100
# About 100 bytes a row: far below what a task can hold.
BROADCAST_ROWS = 500_000

_LO = "_hot_lo"
_CUTS = "_hot_cuts"
_CHUNK = "_chunk"


def micros(ts: str | Column) -> Column:
    """Instant as a count of microseconds, usable as an order position."""
    return F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)


def small_side(written: DataFrame, rows: int | None = None) -> DataFrame:
    """Broadcast a written table when it has few rows; otherwise leave the join to Spark, which
    shuffles both sides and splits skewed partitions."""
    counted = written.count() if rows is None else rows
    return F.broadcast(written) if counted <= BROADCAST_ROWS else written


@dataclass(frozen=True)
class KeyedOrder:
    """Rows of ``df`` ordered by ``order`` inside ``keys``; ``cut`` when hot keys are chunked."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    cut: bool

    @staticmethod
    def of(
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        position: Column,
        rows_per_chunk: int = ROWS_PER_CHUNK,
    ) -> "KeyedOrder":
        """``position`` is a number that never decreases along ``order``.

        Rows with a null key belong to no group and are dropped. ``order`` must be total.
        Counting the keys runs a job.
        """
        for key in keys:
            df = df.filter(F.col(key).isNotNull())
        placed = df.withColumn("_pos", position)
        limit = F.lit(rows_per_chunk)
        hot = (
            placed.groupBy(*keys)
            .agg(
                F.count(F.lit(1)).alias("_n"),
                F.min("_pos").alias(_LO),
            )
            .filter(F.col("_n") > limit)
            .select(*keys, _LO)
        )
        found = through(hot, scratch_dir(df.sparkSession, "hot-keys"))
        count = found.count()
        if count == 0:
            return KeyedOrder(df, tuple(keys), tuple(order), False)
        found = _with_cuts(placed, found, count, keys, order, rows_per_chunk)
        cut_points = found.agg(F.sum(F.size(_CUTS) + 1)).first()[0]
        chunked = placed.join(small_side(found, cut_points), list(keys), "left")
        chunk = F.when(F.col(_CUTS).isNotNull(), _at_or_below(F.col(_CUTS), F.struct(*order)))
        chunked = chunked.withColumn(_CHUNK, chunk.cast("bigint")).drop("_pos", _CUTS)
        return KeyedOrder(chunked, tuple(keys), tuple(order), True)

    def running(
        self,
        measures: dict[str, tuple[str, Column]],
        *,
        inclusive: bool = True,
        reverse: bool = False,
    ) -> "KeyedOrder":
        """Add one column per measure: its value over all rows up to this one.

        Kinds: ``sum``, ``count``, ``min``, ``max`` and ``last`` (latest non-null value).
        ``inclusive=False`` leaves the row itself out; ``reverse`` looks at later rows.
        """
        unknown = {kind for kind, _ in measures.values()} - set(_KINDS)
        if unknown:
            raise ValueError(f"unknown measure kinds {sorted(unknown)}")
        ordering = [F.col(c).desc() if reverse else F.col(c).asc() for c in self.order]
        end = 0 if inclusive else -1
        # The chunk origin is in the partitioning so that "hot rows only" reaches the scan.
        pieces = (_LO, _CHUNK) if self.cut else ()
        local = (
            Window.partitionBy(*self.keys, *pieces)
            .orderBy(*ordering)
            .rowsBetween(Window.unboundedPreceding, end)
        )
        kept = [c for c in self.df.columns if c not in measures]
        inside = {
            name: _KINDS[kind](value).over(local) for name, (kind, value) in measures.items()
        }
        if not self.cut:
            zero = [
                (F.coalesce(v, F.lit(0)) if measures[n][0] == "sum" else v).alias(n)
                for n, v in inside.items()
            ]
            return replace(self, df=self.df.select(*kept, *zero))
        carry = self._carried(measures, reverse)
        rows = self.df.select(*kept, *[v.alias(f"_in_{n}") for n, v in inside.items()])
        joined = rows.join(small_side(carry), [*self.keys, _CHUNK], "left")
        final = [
            _COMBINE[kind](F.col(f"_in_{n}"), F.col(f"_carry_{n}")).alias(n)
            for n, (kind, _) in measures.items()
        ]
        return replace(self, df=joined.select(*kept, *final))

    def _carried(self, measures: dict[str, tuple[str, Column]], reverse: bool) -> DataFrame:
        """What the chunks before a chunk add up to, one row per chunk of a hot key."""
        at = F.struct(*self.order)
        newest = F.min_by if reverse else F.max_by
        totals = [
            (
                newest(value, F.when(value.isNotNull(), at))
                if kind == "last"
                else _KINDS[kind](value)
            ).alias(name)
            for name, (kind, value) in measures.items()
        ]
        before = (
            Window.partitionBy(*self.keys)
            .orderBy(F.col(_CHUNK).desc() if reverse else F.col(_CHUNK).asc())
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        merged = [
            _KINDS["sum" if kind == "count" else kind](F.col(name)).over(before).alias(f"_carry_{name}")
            for name, (kind, _) in measures.items()
        ]
        summary = (
            self.df.filter(F.col(_LO).isNotNull())
            .groupBy(*self.keys, _CHUNK)
            .agg(*totals)
            .select(*self.keys, _CHUNK, *merged)
        )
        return through(summary, scratch_dir(self.df.sparkSession, "carried"))

    def number(self, name: str = "rn") -> "KeyedOrder":
        """1-based position of each row inside its key."""
        return self.running({name: ("count", F.lit(1))})

    def with_column(self, name: str, value: Column) -> "KeyedOrder":
        return replace(self, df=self.df.withColumn(name, value))

    def result(self) -> DataFrame:
        return self.df.drop(_LO, _CHUNK)


def _with_cuts(
    df: DataFrame, hot: DataFrame, hot_rows: int, keys: Sequence[str], order: Sequence[str], limit: int
) -> DataFrame:
    """Add to each hot key where its chunks begin: every so many of its sampled rows."""
    every = max(1, limit // SAMPLES_PER_CHUNK)
    sampled = (
        df.join(small_side(hot, hot_rows), list(keys), "left_semi")
        .filter(F.pmod(F.xxhash64(*order), F.lit(every)) == 0)
        .select(*keys, F.struct(*order).alias("_at"))
    )
    numbered = sampled.withColumn(
        "_n", F.row_number().over(Window.partitionBy(*keys).orderBy("_at"))
    )
    cuts = (
        numbered.filter(F.col("_n") % max(1, limit // every) == 0)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list("_at")).alias("_found"))
    )
    none = F.array().cast(cuts.schema["_found"].dataType)
    placed = hot.join(cuts, list(keys), "left").select(
        *keys, _LO, F.coalesce("_found", none).alias(_CUTS)
    )
    return through(placed, scratch_dir(df.sparkSession, "hot-cuts"))


def _at_or_below(cuts: Column, at: Column) -> Column:
    """How many of the sorted cuts are at or below a place, found by halving."""

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        open_ = s["lo"] < s["hi"]
        below = open_ & (F.get(cuts, middle) <= at)
        return F.struct(
            F.when(below, middle + 1).otherwise(s["lo"]).alias("lo"),
            F.when(open_ & ~below, middle).otherwise(s["hi"]).alias("hi"),
        )

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(cuts) + 1)).cast("int"))
    start = F.struct(F.lit(0).alias("lo"), F.size(cuts).alias("hi"))
    return F.aggregate(steps, start, halve, lambda s: s["lo"])


def _last(value: Column) -> Column:
    return F.last(value, ignorenulls=True)


def _added(here: Column, carry: Column) -> Column:
    return F.coalesce(here, F.lit(0)) + F.coalesce(carry, F.lit(0))


_KINDS = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "last": _last}
_COMBINE = {
    "sum": _added, "count": _added, "min": F.least, "max": F.greatest, "last": F.coalesce,
}


def tiles(
    df: DataFrame, position: Column, length: int, before: int = 0, after: int = 0
) -> DataFrame:
    """Cut rows into tiles of ``length`` positions, adding ``_tile`` and ``_own``.

    A row is owned by one tile and copied into each tile whose owned rows can see it, where a
    row at ``p`` sees positions ``p - before`` to ``p + after``. Group by ``_tile`` next to the
    key, compute the frame, and keep the ``_own`` rows. With ``length`` four times the reach,
    about a quarter of the rows is copied.
    """
    span = F.sequence(
        F.floor((position - F.lit(after)) / F.lit(length)),
        F.floor((position + F.lit(before)) / F.lit(length)),
    )
    home = F.floor(position / F.lit(length))
    return df.withColumn("_tile", F.explode(span)).withColumn("_own", F.col("_tile") == home)


def frame_edge(
    df: DataFrame,
    group: Sequence[str],
    position: str,
    offset: int,
    value: Column,
    name: str,
    *,
    upward: bool,
) -> DataFrame:
    """For each row the ``value`` of the first row at or above ``position + offset``, or of the
    last row at or below it. Rows with a null value are passed over.

    Each row also enters the order as a question at the place it asks about, so one sorted pass
    answers all of them. A range frame would visit every row of the frame for every row.
    """
    asked = df.withColumn("_ask", F.explode(F.array(F.lit(False), F.lit(True))))
    place = F.col(position) + F.when(F.col("_ask"), offset).otherwise(0)
    asked = asked.withColumn("_place", place)
    along = F.col("_place").desc() if upward else F.col("_place").asc()
    w = (
        Window.partitionBy(*group)
        .orderBy(along, F.col("_ask").asc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    seen = F.last(F.when(~F.col("_ask"), value), ignorenulls=True).over(w)
    return asked.withColumn(name, seen).filter("_ask").drop("_ask", "_place")
