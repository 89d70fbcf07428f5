"""Joins of streams with changing tables. Both inputs meet as one tagged stream, in event-time order per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.streaming.stateful import Lateness, ddl, transform_state


def as_of_join_stream(
    stream: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    stream_ts: str,
    table_ts: str,
    tie: tuple[str, str],
    late: Lateness,
    how: str = "inner",
    keep: int | None = None,
) -> DataFrame:
    """Streaming form of ``as_of_join``: each stream row meets the table version current at its time.

    As rows are seen in order, only the newest version seen so far has to be kept; versions and stream rows that are not due wait
    by instant. ``keep`` forgets a key, and so its version, after so many microseconds without rows of either side; None keeps it for ever.
    """
    s_rest = [c for c in stream.columns if c not in keys]
    t_rest = [c for c in table.columns if c not in keys and c not in (table_ts, tie[1])]
    s = stream.select(
        *keys, F.col(stream_ts).alias("_at"), F.lit(1).alias("_side"), F.col(tie[0]).cast("bigint").alias("_tie"),
        *[F.col(c).alias(f"s_{c}") for c in s_rest],
    )
    t = table.select(
        *keys, F.col(table_ts).alias("_at"), F.lit(0).alias("_side"), F.col(tie[1]).cast("bigint").alias("_tie"),
        *[F.col(c).alias(f"t_{c}") for c in t_rest],
    )
    missing = (None,) * len(t_rest)

    def step(state, row):
        if row["_side"] == 0:
            return (tuple(row[f"t_{c}"] for c in t_rest),), []
        version = state[0]
        if version == missing and how != "left":
            return state, []
        return state, [(*[row[f"s_{c}"] for c in s_rest], *version)]

    columns = ", ".join(part for part in (ddl(stream, s_rest), ddl(table, t_rest)) if part)
    return transform_state(
        s.unionByName(t, allowMissingColumns=True), keys, step, columns, (missing,), ["_at", "_side", "_tie"], late, keep
    )


def table_table_join_stream(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    left_value: str,
    right_value: str,
    late: Lateness,
) -> DataFrame:
    """Changes of the inner join of two changelogs: keys, ``order``, ``side`` (0 left, 1 right: which changed), and both values.

    A null value deletes a side's row. An update of either side emits the joined row again; a row that ends is emitted once with
    nulls. Both inputs have the columns ``order``, which put their rows in one order; ties are the left side's first.
    """
    sides = [
        side.select(*keys, *order, F.lit(n).alias("_side"), F.col(value).alias(f"_v{n}"))
        for n, (side, value) in enumerate([(left, left_value), (right, right_value)])
    ]

    def step(state, row):
        now = (row["_v0"], state[1]) if row["_side"] == 0 else (state[0], row["_v1"])
        place = [*[row[c] for c in order], row["_side"]]
        if None not in now:
            return now, [(*place, *now)]
        return now, [] if None in state else [(*place, None, None)]

    output = f"{ddl(left, order)}, side int, {ddl(left, [left_value])}, {ddl(right, [right_value])}"
    return transform_state(
        sides[0].unionByName(sides[1], allowMissingColumns=True), keys, step, output, (None, None), [*order, "_side"], late
    )


def current_rows(changes: DataFrame, keys: Sequence[str], order: Sequence[str], *values: str) -> DataFrame:
    """The table that joined changes lead to: the last of each key, unless it is a deletion."""
    last = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in [*order, "side"]])
    newest = changes.withColumn("_n", F.row_number().over(last)).filter("_n = 1")
    return newest.select(*keys, *values).filter(F.col(values[0]).isNotNull())
