"""Stream-stream, table-table, stream-table and global-table joins.

No side is broadcast by hint: table sizes grow with the data, so Spark broadcasts a side only
when its measured size is below the session's threshold, and otherwise shuffles it with
skewed partitions split at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.aggregate import latest_by_key
from tidelog.plans.ordered import ROWS_PER_CHUNK, KeyedOrder, micros, tiles


def _no_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def _near(left_ts: str, right_ts: str, before: int, after: int) -> Column:
    gap = micros(right_ts) - micros(left_ts)
    return (gap >= -before) & (gap <= after)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    before: int,
    after: int,
    how: str = "inner",
    extra: Column | None = None,
) -> DataFrame:
    """Rows of one key with ``right_ts`` in ``[left_ts - before, left_ts + after]``.

    Apart from the keys the two sides must use different column names. ``how`` is inner, left,
    full, semi or anti. A batch join also matches on a tile of time, so the rows of a hot key
    meet only their neighbours in time and spread over many tasks. The tile copies go to the
    right side; unmatched right rows of a full join come from a second, mirrored
    anti join, because copies must not be reported as unmatched. Streams need watermarks on
    both sides and keep the plain time condition, which bounds their state; they take no ``extra``.
    Rows with a null key belong to no key: they are dropped on both sides, in every mode.
    """
    left, right = _no_null_keys(left, keys), _no_null_keys(right, keys)
    if left.isStreaming or right.isStreaming:
        if extra is not None:
            raise ValueError("a stream join takes no extra condition; filter its result")
        return _stream_interval_join(left, right, keys, left_ts, right_ts, before, after, how)
    condition = _near(left_ts, right_ts, before, after)
    if extra is not None:
        condition = condition & extra
    length = max(2 * (before + after), 1)
    near = _tile_join(left, right, keys, left_ts, right_ts, length, before, after,
                      condition, "left" if how == "full" else how)
    if how != "full":
        return near
    alone = _tile_join(right, left, keys, right_ts, left_ts, length, after, before,
                       condition, "anti")
    return near.unionByName(alone, allowMissingColumns=True)


def _tile_join(left, right, keys, left_ts, right_ts, length, before, after, condition, how):
    home = left.withColumn("_tile", F.floor(micros(left_ts) / F.lit(length)))
    spread = tiles(right, micros(right_ts), length, before, after).drop("_own")
    spread = spread.select(*[F.col(c).alias(f"_r_{c}") if c in (*keys, "_tile") else F.col(c)
                             for c in spread.columns])
    on = condition
    for key in (*keys, "_tile"):
        on = on & (F.col(key) == F.col(f"_r_{key}"))
    return home.join(spread, on, how).drop("_tile", *[f"_r_{k}" for k in (*keys, "_tile")])


def _stream_interval_join(left, right, keys, left_ts, right_ts, before, after, how):
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns]
    )
    # Plain interval arithmetic: the watermark logic recognises it and drops old state.
    on = F.expr(
        f"{right_ts} >= {left_ts} - INTERVAL {before} MICROSECONDS "
        f"AND {right_ts} <= {left_ts} + INTERVAL {after} MICROSECONDS"
    )
    for key in keys:
        on = on & (F.col(key) == F.col(f"_r_{key}"))
    joined = left.join(renamed, on, {"full": "full_outer"}.get(how, how))
    if how in ("semi", "anti"):
        return joined
    kept = [F.coalesce(F.col(k), F.col(f"_r_{k}")).alias(k) for k in keys]
    rest = [c for c in joined.columns if c not in keys and c not in {f"_r_{k}" for k in keys}]
    return joined.select(*kept, *rest)


def interval_outer_eager(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    span: int,
    left_arrival: str,
    right_arrival: str,
) -> DataFrame:
    """Outer join that reports each row at once: with nulls while it has no partner yet, and
    again in every pair found later."""
    pairs = interval_join(left, right, keys, left_ts, right_ts, span, span)
    lonely_left = interval_join(
        left, right, keys, left_ts, right_ts, span, span, "anti",
        F.col(right_arrival) < F.col(left_arrival),
    )
    lonely_right = interval_join(
        right, left, keys, right_ts, left_ts, span, span, "anti",
        F.col(left_arrival) < F.col(right_arrival),
    )
    return pairs.unionByName(lonely_left, allowMissingColumns=True).unionByName(
        lonely_right, allowMissingColumns=True
    )


def table_table_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    left_value: str,
    right_value: str,
) -> DataFrame:
    """Inner join of the current rows of two changelogs; each side has one row per key."""
    a = latest_by_key(left, keys, order, left_value).select(*keys, left_value)
    b = latest_by_key(right, keys, order, right_value).select(*keys, right_value)
    return a.join(b, list(keys))


def table_table_changelog(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    arrival: str,
    left_value: str,
    right_value: str,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Every join result as updates of either table arrive; nothing while a side is missing."""
    a = left.select(*keys, arrival, F.struct(left_value).alias("_l"))
    b = right.select(*keys, arrival, F.struct(right_value).alias("_r"))
    both = a.unionByName(b, allowMissingColumns=True)
    joined = KeyedOrder.of(both, keys, [arrival], F.col(arrival), rows_per_chunk).running(
        {"_left": ("last", F.col("_l")), "_right": ("last", F.col("_r"))}
    )
    return (
        joined.result()
        .select(*keys, arrival, f"_left.{left_value}", f"_right.{right_value}")
        .filter(F.col(left_value).isNotNull() & F.col(right_value).isNotNull())
    )


def as_of_join(
    stream: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    stream_ts: str,
    table_ts: str,
    tie: tuple[str, str],
    how: str = "inner",
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Each stream row meets the table version current at its time.

    At equal instants the table row counts as earlier. ``tie`` names the columns that order
    rows of one instant. A table row whose values are all null deletes the version.
    One sort of both inputs by key and time replaces a range join.
    """
    s_rest = [c for c in stream.columns if c not in keys]
    t_rest = [c for c in table.columns if c not in keys and c not in (table_ts, tie[1])]
    s = stream.select(
        *keys, F.col(stream_ts).alias("_at"), F.lit(1).alias("_side"),
        F.col(tie[0]).alias("_tie"), F.struct(*s_rest).alias("_s"),
    )
    t = table.select(
        *keys, F.col(table_ts).alias("_at"), F.lit(0).alias("_side"),
        F.col(tie[1]).alias("_tie"), F.struct(*t_rest).alias("_t"),
    )
    both = s.unionByName(t, allowMissingColumns=True)
    seen = KeyedOrder.of(
        both, keys, ["_at", "_side", "_tie"], micros("_at"), rows_per_chunk
    ).running({"_now": ("last", F.col("_t"))})
    out = seen.result().filter("_side = 1").select(
        *keys, *[F.col(f"_s.{c}") for c in s_rest], *[F.col(f"_now.{c}") for c in t_rest]
    )
    if how == "left":
        return out
    return out.dropna(how="all", subset=t_rest)


def stream_table_join(
    stream: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join with a table of one current row per key; the stream may be unbounded."""
    return _no_null_keys(stream, keys).join(table, list(keys), how)


def stream_table_left_join(
    stream: DataFrame, table: DataFrame, keys: Sequence[str], defaults: Mapping[str, object]
) -> DataFrame:
    """Left form of ``stream_table_join`` with a default for missing table values."""
    joined = stream_table_join(stream, table, keys, "left")
    return joined.fillna(dict(defaults), subset=list(defaults))


def global_table_join(
    stream: DataFrame, table: DataFrame, stream_key: Column, table_key: Column, how: str = "inner"
) -> DataFrame:
    """Join on a key derived from the stream row; the stream is not re-keyed when the table
    is small enough for Spark to send it to every task."""
    return stream.join(table, stream_key == table_key, how)


def enrich_nested(parts: DataFrame, records: Mapping[str, Sequence[str]]) -> DataFrame:
    """Pack joined columns into one nested record per source."""
    return parts.select(*[F.struct(*cols).alias(name) for name, cols in records.items()])
