"""Streaming forms of batch queries: the same checks in SQL, on unbounded frames.

Each registered stream may be as late as its table is long, since the order of a table's files is unknown; a live stream knows its disorder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.catalog import aggregates, joins, orders, windows  # noqa: F401 - their checks are used again
from tidelog.catalog.registry import DAY, HOUR, MINUTE, SQL, Inputs, query
from tidelog.operators.orders import RULES
from tidelog.sources.sinks import run_available_now
from tidelog.streaming import charts, timed
from tidelog.streaming.joins import as_of_join_stream, current_rows, table_table_join_stream

USERS = ["user_id"]


def _as_of(i: Inputs, how: str) -> DataFrame:
    rows = i.stream("events")
    purchases = rows.filter("event_type = 'purchase'").select("user_id", "event_id", "ts", "value")
    views = i.stream("events").filter("event_type = 'view'").select(
        "user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_id"), F.col("event_id").alias("last_view")
    )
    late = i.late("events", "ts")
    found = as_of_join_stream(purchases, views, USERS, "ts", "view_ts", ("event_id", "view_id"), late, how)
    return run_available_now(found, "append", "as-of", late.end).drop("ts")


@query("stream_table_join_stream", SQL["stream_table_join"])
def stream_table_join_stream(i: Inputs) -> DataFrame:
    """Each purchase meets the view current at its time, both on streams."""
    return _as_of(i, "inner")


@query("stream_table_left_join_stream", SQL["stream_table_left_join"])
def stream_table_left_join_stream(i: Inputs) -> DataFrame:
    return _as_of(i, "left").fillna({"last_view": -1})


@query("table_table_join_stream", SQL["table_table_join"])
def table_table_join_stream_(i: Inputs) -> DataFrame:
    """The table that the changes of a join of two changelogs lead to."""
    rows = i.stream("events").withColumn("event_type", F.when(F.col("event_type") != "error", F.col("event_type")))
    logins = i.stream("events").filter("event_type = 'signup'").withColumnRenamed("value", "login")
    late, order = i.late("events", "ts"), ["ts", "event_id"]
    changes = table_table_join_stream(
        rows.select(*USERS, *order, "event_type"), logins.select(*USERS, *order, "login"), USERS, order, "event_type", "login", late
    )
    return current_rows(run_available_now(changes, "append", "tables", late.end), USERS, order, "event_type", "login")


@query("top_n_per_group_stream", SQL["top_n_per_group"])
def top_n_per_group_stream(i: Inputs) -> DataFrame:
    """The charts of brands while line items come in; the last ones are those of the whole table."""
    songs = i.part.select("p_partkey", F.lower("p_brand").alias("brand"))
    plays = i.stream("lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_quantity").join(songs, "p_partkey")
    emitted = run_available_now(
        charts.top_n_stream(plays, 5, ["brand"], "p_partkey", F.col("l_quantity")), "update", "charts"
    )
    return charts.latest_charts(emitted, 5, ["brand"], "p_partkey").withColumnRenamed("count", "plays")


@query("top_n_windowed_stream", SQL["top_n_windowed"])
def top_n_windowed_stream(i: Inputs) -> DataFrame:
    """The charts of each hour, once it is over."""
    late = i.late("events", "ts")
    rows = i.stream("events").filter("value > 5")
    closed = charts.top_n_windowed_stream(rows, 100, "ts", HOUR, ["event_type"], "user_id", late)
    found = charts.windowed_charts(run_available_now(closed, "append", "charts", late.end), 100, "event_type", "user_id")
    return found.select(F.timestamp_micros(F.col("window_end") - HOUR).alias("start"), "event_type", "top")


@query("punctuate_snapshot_stream", SQL["punctuate_snapshot"])
def punctuate_snapshot_stream(i: Inputs) -> DataFrame:
    """Daily counts by timers of the stream."""
    late = i.late("events", "ts")
    last = i.events.agg(F.max(F.unix_micros("ts"))).first()[0] or 0
    ticks = timed.punctuate_stream(i.stream("events"), ["event_type"], "ts", DAY, late, until=(last // DAY + 1) * DAY)
    return run_available_now(ticks, "append", "ticks", late.end)


@query("sliding_inverse_reduce_stream", SQL["sliding_inverse_reduce"])
def sliding_inverse_reduce_stream(i: Inputs) -> DataFrame:
    """Six hours advancing by ten minutes, panes added as rows come and subtracted by timers."""
    late = i.late("events", "ts")
    runs = timed.sliding_inverse_reduce_stream(i.stream("events"), USERS, "ts", 6 * HOUR, 10 * MINUTE, late)
    return run_available_now(runs, "append", "panes", late.end)


@query("late_split_stream", SQL["late_split"])
def late_split_stream(i: Inputs) -> DataFrame:
    """Late rows as a side output: both outputs are filters on the flag."""
    late = F.when(F.col("event_id") % 17 == 0, 40).otherwise(0)
    rows = i.stream("events").withColumn("arrival", F.col("event_id") + late).withColumn("lane", F.col("user_id") % 4)
    flagged = timed.late_flag_stream(rows.select("event_id", "ts", "arrival", "lane"), "ts", HOUR, ["lane"], ["arrival", "event_id"])
    return run_available_now(flagged.select("event_id", "late"), "append", "late")


@query("validation_aggregate_stream", SQL["validation_aggregate"])
def validation_aggregate_stream(i: Inputs) -> DataFrame:
    """Verdicts as soon as they are certain."""
    def requests() -> DataFrame:
        typed = i.stream("orders").selectExpr(*[c.strip() for c in orders._columns(orders.REQUEST)])
        return typed.withColumn("price", F.col("price").cast("double"))

    late = i.late("orders", "o_orderdate", 10 * MINUTE)
    verdicts = timed.validation_stream(orders.checks(requests()), requests(), late, 5 * MINUTE, RULES)
    return run_available_now(verdicts.select("id", "state"), "append", "verdicts", late.end)
