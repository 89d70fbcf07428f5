"""Joins of streams and tables, and deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.catalog.registry import (
    CHANGELOG_SQL,
    HOUR,
    MINUTE,
    REGIONS_SQL,
    Inputs,
    query,
)
from tidelog.operators import aggregate, dedup, joins, windows
from tidelog.sources.sinks import run_available_now
from tidelog.streaming import stateful

USERS = ["user_id"]
SPAN = 60 * MINUTE


def side(df: DataFrame, kind: str, name: str) -> DataFrame:
    return df.filter(F.col("event_type") == kind).select(
        "user_id", F.col("event_id").alias(f"{name}_id"), F.col("ts").alias(f"{name}_ts")
    )


def clicks(i: Inputs) -> DataFrame:
    return side(i.events, "click", "click")


def buys(i: Inputs) -> DataFrame:
    return side(i.events, "purchase", "buy")


SIDES_SQL = """c AS (SELECT user_id, event_id AS click_id, ts AS click_ts FROM events WHERE event_type = 'click'),
b AS (SELECT user_id, event_id AS buy_id, ts AS buy_ts FROM events WHERE event_type = 'purchase')"""
NEAR = "buy_ts BETWEEN click_ts - INTERVAL 60 MINUTE AND click_ts + INTERVAL 60 MINUTE"


@query("interval_join", f"""WITH {SIDES_SQL}
SELECT c.user_id, click_id, buy_id FROM c JOIN b ON c.user_id = b.user_id AND {NEAR}""")
def interval_join(i: Inputs) -> DataFrame:
    found = joins.interval_join(clicks(i), buys(i), USERS, "click_ts", "buy_ts", SPAN, SPAN)
    return found.select("user_id", "click_id", "buy_id")


@query("interval_join_stream", f"""WITH {SIDES_SQL}
SELECT c.user_id, click_id, buy_id FROM c JOIN b ON c.user_id = b.user_id AND {NEAR}""")
def interval_join_stream(i: Inputs) -> DataFrame:
    left = side(i.stream("events"), "click", "click").withWatermark("click_ts", i.span("events", "ts"))
    right = side(i.stream("events"), "purchase", "buy").withWatermark("buy_ts", i.span("events", "ts"))
    found = joins.interval_join(left, right, USERS, "click_ts", "buy_ts", SPAN, SPAN)
    return run_available_now(found.select("user_id", "click_id", "buy_id"), "append", "interval")


@query("interval_join_asym", f"""WITH {SIDES_SQL}
SELECT c.user_id, click_id, buy_id FROM c JOIN b ON c.user_id = b.user_id
AND buy_ts BETWEEN click_ts - INTERVAL 10 MINUTE AND click_ts + INTERVAL 120 MINUTE""")
def interval_join_asym(i: Inputs) -> DataFrame:
    found = joins.interval_join(
        clicks(i), buys(i), USERS, "click_ts", "buy_ts", 10 * MINUTE, 120 * MINUTE
    )
    return found.select("user_id", "click_id", "buy_id")


@query("interval_left_join", f"""WITH {SIDES_SQL}
SELECT c.user_id, click_id, buy_id FROM c LEFT JOIN b ON c.user_id = b.user_id AND {NEAR}""")
def interval_left_join(i: Inputs) -> DataFrame:
    found = joins.interval_join(
        clicks(i), buys(i), USERS, "click_ts", "buy_ts", SPAN, SPAN, "left"
    )
    return found.select("user_id", "click_id", "buy_id")


@query("interval_outer_join", f"""WITH {SIDES_SQL}
SELECT coalesce(c.user_id, b.user_id) AS user_id, click_id, buy_id
FROM c FULL JOIN b ON c.user_id = b.user_id AND {NEAR}""")
def interval_outer_join(i: Inputs) -> DataFrame:
    found = joins.interval_join(
        clicks(i), buys(i), USERS, "click_ts", "buy_ts", SPAN, SPAN, "full"
    )
    return found.select("user_id", "click_id", "buy_id")


EAGER_SQL = f"""WITH {SIDES_SQL}
SELECT c.user_id, click_id, buy_id FROM c JOIN b ON c.user_id = b.user_id AND {NEAR}
UNION ALL SELECT user_id, click_id, NULL FROM c WHERE NOT EXISTS (
  SELECT 1 FROM b WHERE b.user_id = c.user_id AND {NEAR} AND buy_id < click_id)
UNION ALL SELECT user_id, NULL, buy_id FROM b WHERE NOT EXISTS (
  SELECT 1 FROM c WHERE b.user_id = c.user_id AND {NEAR} AND click_id < buy_id)"""


@query("interval_outer_eager", EAGER_SQL)
def interval_outer_eager(i: Inputs) -> DataFrame:
    found = joins.interval_outer_eager(
        clicks(i), buys(i), USERS, "click_ts", "buy_ts", SPAN, "click_id", "buy_id"
    )
    return found.select("user_id", "click_id", "buy_id")


@query("interval_outer_eager_stream", EAGER_SQL)
def interval_outer_eager_stream(i: Inputs) -> DataFrame:
    def rows(kind: str, name: str) -> DataFrame:
        return i.stream("events").filter(F.col("event_type") == kind).select(
            "user_id", "ts", F.col("event_id").alias("arrival"), F.col("event_id").alias(name)
        )

    late = i.late("events", "event_id")
    found = stateful.interval_outer_eager_stream(
        rows("click", "click_id"), rows("purchase", "buy_id"), USERS, "ts", "arrival", SPAN,
        "click_id", "buy_id", late,
    )
    return run_available_now(found, "append", "eager", late.end)


LOGINS_SQL = f"""{CHANGELOG_SQL},
logins AS (SELECT user_id, event_id, ts, value AS login FROM events WHERE event_type = 'signup')"""


def _logins(i: Inputs) -> DataFrame:
    return i.kind("signup").select("user_id", "event_id", "ts", F.col("value").alias("login"))


@query("table_table_join", f"""WITH {LOGINS_SQL},
a AS (SELECT user_id, arg_max(struct_pack(v := event_type), event_id).v AS event_type FROM changelog GROUP BY 1),
l AS (SELECT user_id, arg_max(login, event_id) AS login FROM logins GROUP BY 1)
SELECT user_id, event_type, login FROM a JOIN l USING (user_id) WHERE event_type IS NOT NULL""")
def table_table_join(i: Inputs) -> DataFrame:
    kinds = i.changelog().select("user_id", "event_type", "ts", "event_id")
    return joins.table_table_join(
        kinds, _logins(i), USERS, ["ts", "event_id"], "event_type", "login"
    )


@query("table_table_changelog", f"""WITH {LOGINS_SQL},
u AS (SELECT user_id, event_id * 2 AS arrival, event_type, true AS k, NULL AS login, false AS l FROM changelog
      UNION ALL SELECT user_id, event_id * 2 + 1, NULL, false, login, true FROM logins),
s AS (SELECT user_id, arrival,
  last_value(CASE WHEN k THEN struct_pack(v := event_type) END IGNORE NULLS) OVER w AS a,
  last_value(CASE WHEN l THEN struct_pack(v := login) END IGNORE NULLS) OVER w AS b
  FROM u WINDOW w AS (PARTITION BY user_id ORDER BY arrival))
SELECT user_id, arrival, a.v AS event_type, b.v AS login FROM s WHERE a.v IS NOT NULL AND b.v IS NOT NULL""")
def table_table_changelog(i: Inputs) -> DataFrame:
    kinds = i.changelog().select("user_id", (F.col("event_id") * 2).alias("arrival"), "event_type")
    logins = _logins(i).select("user_id", (F.col("event_id") * 2 + 1).alias("arrival"), "login")
    return joins.table_table_changelog(kinds, logins, USERS, "arrival", "event_type", "login")


def _purchases(i: Inputs) -> DataFrame:
    return i.kind("purchase").select("user_id", "event_id", "ts", "value")


def _views(i: Inputs) -> DataFrame:
    return i.kind("view").select(
        "user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_id"),
        F.col("event_id").alias("last_view"),
    )


ASOF_SQL = """
SELECT p.user_id, p.event_id, p.value, v.last_view FROM
  (SELECT * FROM events WHERE event_type = 'purchase') p ASOF {how} JOIN
  (SELECT user_id, ts, event_id AS last_view FROM events WHERE event_type = 'view') v
  ON p.user_id = v.user_id AND p.ts >= v.ts"""


@query("stream_table_join", ASOF_SQL.format(how=""))
def stream_table_join(i: Inputs) -> DataFrame:
    """Each purchase meets the view current at its time."""
    found = joins.as_of_join(
        _purchases(i), _views(i), USERS, "ts", "view_ts", ("event_id", "view_id")
    )
    return found.drop("ts")


@query("stream_table_left_join", f"""SELECT * REPLACE (coalesce(last_view, -1) AS last_view)
FROM ({ASOF_SQL.format(how='LEFT')})""")
def stream_table_left_join(i: Inputs) -> DataFrame:
    found = joins.as_of_join(
        _purchases(i), _views(i), USERS, "ts", "view_ts", ("event_id", "view_id"), how="left"
    )
    return found.drop("ts").fillna({"last_view": -1})


@query("stream_static_join", f"""WITH {REGIONS_SQL}
SELECT event_id, events.user_id, coalesce(region, 'UNKNOWN') AS region
FROM events LEFT JOIN regions USING (user_id) WHERE event_type = 'view'""")
def stream_static_join(i: Inputs) -> DataFrame:
    """An unbounded stream against a table of current rows."""
    views = i.stream("events").filter("event_type = 'view'").select("event_id", "user_id")
    found = joins.stream_table_left_join(views, i.regions(), USERS, {"region": "UNKNOWN"})
    return run_available_now(found.select("event_id", "user_id", "region"), "append", "static")


@query("global_table_join", """
SELECT o_orderkey, c_name, n_name, p_name FROM orders
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN part ON (o_orderkey * 7) % 50 = p_partkey""")
def global_table_join(i: Inputs) -> DataFrame:
    """Orders with customer and nation, and a product whose key is derived from the order."""
    c = joins.global_table_join(i.orders, i.customer, F.col("o_custkey"), F.col("c_custkey"))
    n = joins.global_table_join(c, i.nation, F.col("c_nationkey"), F.col("n_nationkey"))
    product = (F.col("o_orderkey") * 7) % 50
    p = joins.global_table_join(n, i.part, product, F.col("p_partkey"))
    return p.select("o_orderkey", "c_name", "n_name", "p_name")


@query("enrich_nested", """
SELECT o_orderkey, o_totalprice, c_custkey, c_name, n_name FROM orders
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def enrich_nested(i: Inputs) -> DataFrame:
    """Nested order, customer and nation records, flattened for the check."""
    c = joins.global_table_join(i.orders, i.customer, F.col("o_custkey"), F.col("c_custkey"))
    n = joins.global_table_join(c, i.nation, F.col("c_nationkey"), F.col("n_nationkey"))
    nested = joins.enrich_nested(
        n,
        {
            "order": ["o_orderkey", "o_totalprice"],
            "customer": ["c_custkey", "c_name"],
            "nation": ["n_name"],
        },
    )
    return nested.select("order.*", "customer.*", "nation.*")


@query("page_views_by_region", f"""WITH {REGIONS_SQL},
v AS (SELECT coalesce(region, 'UNKNOWN') AS region, epoch_us(ts) // {HOUR} * {HOUR} AS pane
      FROM events LEFT JOIN regions USING (user_id) WHERE event_type = 'view')
SELECT region, make_timestamp(s) AS start, make_timestamp(s) + INTERVAL 4 HOUR AS "end", count(*) AS cnt
FROM (SELECT region, unnest(generate_series(pane - 3 * {HOUR}, pane, {HOUR})) AS s FROM v) GROUP BY ALL""")
def page_views_by_region(i: Inputs) -> DataFrame:
    """Views per region in windows of four hours advancing by one."""
    views = i.kind("view").select("user_id", "ts")
    placed = joins.stream_table_left_join(views, i.regions(), USERS, {"region": "UNKNOWN"})
    return windows.hopping_count(placed, ["region"], "ts", 4 * HOUR, HOUR)


@query("clicks_per_region", f"""WITH {REGIONS_SQL}
SELECT coalesce(region, 'UNKNOWN') AS region, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS clicks
FROM events LEFT JOIN regions USING (user_id) WHERE event_type = 'click' GROUP BY 1""")
def clicks_per_region(i: Inputs) -> DataFrame:
    rows = i.kind("click").select("user_id", F.floor("value").alias("n"))
    placed = joins.stream_table_left_join(rows, i.regions(), USERS, {"region": "UNKNOWN"})
    return aggregate.group_reduce(placed, ["region"], F.col("n"), "clicks")


IDS = ["user_id", "event_type"]
DEDUP_SQL = """
SELECT event_id, user_id, event_type FROM (
  SELECT *, lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS last_ts FROM events)
WHERE last_ts IS NULL OR last_ts < ts - INTERVAL 6 HOUR"""


@query("dedup_window", DEDUP_SQL)
def dedup_window(i: Inputs) -> DataFrame:
    rows = i.events.select("event_id", "ts", *IDS)
    return dedup.dedup_window(rows, IDS, "ts", ["event_id"], 12 * HOUR).drop("ts")


@query("dedup_window_stream", DEDUP_SQL)
def dedup_window_stream(i: Inputs) -> DataFrame:
    rows = i.stream("events").select("event_id", "ts", *IDS)
    late = i.late("events", "event_id")
    kept = stateful.dedup_stream(rows, IDS, "ts", ["event_id"], 12 * HOUR, late)
    return run_available_now(kept, "append", "dedup", late.end).drop("ts")


@query("dedup_out_of_order", """
WITH a AS (SELECT *, event_id + CASE WHEN event_id % 17 = 0 THEN 40 ELSE 0 END AS arrival FROM events)
SELECT event_id, user_id, event_type FROM a WHERE NOT EXISTS (
  SELECT 1 FROM a b WHERE b.user_id = a.user_id AND b.event_type = a.event_type
  AND (b.arrival, b.event_id) < (a.arrival, a.event_id)
  AND b.ts BETWEEN a.ts - INTERVAL 6 HOUR AND a.ts + INTERVAL 6 HOUR)""")
def dedup_out_of_order(i: Inputs) -> DataFrame:
    rows = i.arrivals().select("event_id", "ts", "arrival", *IDS)
    kept = dedup.dedup_window(
        rows, IDS, "ts", ["arrival", "event_id"], 12 * HOUR, in_order=False
    )
    return kept.select("event_id", *IDS)


@query("dedup_watermark", """
SELECT user_id, event_type FROM events GROUP BY ALL""")
def dedup_watermark(i: Inputs) -> DataFrame:
    """One row per id, as the watermark delay exceeds the data's span."""
    rows = i.stream("events").select("ts", *IDS)
    kept = dedup.dedup_watermark(rows, IDS, "ts", i.span("events", "ts"))
    return run_available_now(kept, "append", "dedup-wm").select(*IDS)
