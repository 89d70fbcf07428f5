"""Order validation, state queries and edit announcements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.catalog.registry import DAY, HOUR, MINUTE, Inputs, query
from tidelog.operators import orders, state, wiki, windows
from tidelog.sources.sinks import run_available_now
from tidelog.streaming import stateful

FRAUD_GAP = 60 * DAY

REQUEST = """o_orderkey AS id,
  CASE WHEN o_orderkey % 97 <> 0 THEN o_custkey END AS customer_id,
  CASE WHEN o_orderstatus = 'P' THEN 'PAID' ELSE 'CREATED' END AS state,
  CASE WHEN o_orderkey % 89 <> 0 THEN (o_orderkey * 7) % 400 END AS product,
  o_orderkey % 60 - 1 AS quantity, floor(o_totalprice / 10000) AS price, o_orderdate AS ts"""
REQUESTS_SQL = f"requests AS (SELECT {REQUEST} FROM orders), created AS (SELECT * FROM requests WHERE state = 'CREATED')"
STOCK_SQL = "stock AS (SELECT p_partkey AS product, p_size * 20 AS stock FROM part)"


def requests(i: Inputs) -> DataFrame:
    """Orders as validation requests; some lack fields or have a negative quantity."""
    typed = i.orders.selectExpr(*[_sql.strip() for _sql in _columns(REQUEST)])
    return typed.withColumn("price", F.col("price").cast("double"))


def _columns(text: str) -> list[str]:
    out, depth, last = [], 0, 0
    for pos, ch in enumerate(text):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            out.append(text[last:pos])
            last = pos + 1
    return [*out, text[last:]]


def stock(i: Inputs) -> DataFrame:
    return i.part.select(F.col("p_partkey").alias("product"), (F.col("p_size") * 20).alias("stock"))


DETAILS_SQL = """details AS (SELECT id, 'ORDER_DETAILS_CHECK' AS check_type,
  CASE WHEN customer_id IS NOT NULL AND quantity >= 0 AND price >= 0 AND product IS NOT NULL
       THEN 'PASS' ELSE 'FAIL' END AS result, ts FROM created)"""


@query("order_details_check", f"WITH {REQUESTS_SQL}, {DETAILS_SQL} SELECT * FROM details")
def order_details_check(i: Inputs) -> DataFrame:
    return orders.order_details_check(requests(i))


def fraud_sql(gap_days: float) -> str:
    return f"""f1 AS (SELECT *, CASE WHEN lag(ts) OVER w < ts - INTERVAL '{gap_days} days' THEN 1 ELSE 0 END AS opens
  FROM created WHERE customer_id IS NOT NULL WINDOW w AS (PARTITION BY customer_id ORDER BY ts, id)),
f2 AS (SELECT *, sum(opens) OVER (PARTITION BY customer_id ORDER BY ts, id) AS s FROM f1),
fraud AS (SELECT id, 'FRAUD_CHECK' AS check_type, ts,
  sum(quantity * price) OVER (PARTITION BY customer_id, s ORDER BY ts, id) AS session_total FROM f2)"""


@query("fraud_check", f"""WITH {REQUESTS_SQL}, {fraud_sql(60)}
SELECT id, check_type, CASE WHEN session_total < 2000 THEN 'PASS' ELSE 'FAIL' END AS result,
       session_total, ts FROM fraud""")
def fraud_check(i: Inputs) -> DataFrame:
    return orders.fraud_check(requests(i), FRAUD_GAP)


@query("fraud_check_stream", f"""WITH {REQUESTS_SQL}, {fraud_sql(60)}
SELECT customer_id, fraud.id, CASE WHEN session_total < 2000 THEN 'PASS' ELSE 'FAIL' END AS result, session_total
FROM fraud JOIN created USING (id)""")
def fraud_check_stream(i: Inputs) -> DataFrame:
    rows = i.stream("orders").selectExpr(*_columns(REQUEST))
    rows = rows.withColumn("price", F.col("price").cast("double"))
    late = i.late("orders", "o_orderdate")
    results = stateful.fraud_stream(rows, FRAUD_GAP, 2000, late)
    return run_available_now(results, "append", "fraud", late.end)


def reserve_sql(source: str) -> str:
    """Replay per product; ``source`` has id, product, quantity, rn and stock."""
    return f"""inv AS (
  SELECT id, product, rn, quantity, stock, quantity BETWEEN 0 AND stock AS ok,
         CASE WHEN quantity BETWEEN 0 AND stock THEN quantity ELSE 0 END AS reserved FROM {source} WHERE rn = 1
  UNION ALL
  SELECT n.id, n.product, n.rn, n.quantity, n.stock, n.quantity BETWEEN 0 AND n.stock - inv.reserved,
         inv.reserved + CASE WHEN n.quantity BETWEEN 0 AND n.stock - inv.reserved THEN n.quantity ELSE 0 END
  FROM inv JOIN {source} n ON n.product = inv.product AND n.rn = inv.rn + 1)"""


LINE_ORDER = ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"]


@query("inventory_reserve", f"""WITH RECURSIVE {STOCK_SQL},
n AS (SELECT l_orderkey AS id, l_partkey AS product, CAST(l_quantity AS BIGINT) AS quantity, stock,
  row_number() OVER (PARTITION BY l_partkey ORDER BY {', '.join(LINE_ORDER)}) AS rn
  FROM lineitem JOIN stock ON product = l_partkey),
{reserve_sql('n')}
SELECT id AS l_orderkey, product, quantity, CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS result FROM inv""")
def inventory_reserve(i: Inputs) -> DataFrame:
    lines = i.lineitem.select(
        *LINE_ORDER, F.col("l_partkey").alias("product"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )
    reserved = orders.inventory_reserve(lines, stock(i), LINE_ORDER, F.col("l_orderkey"))
    return reserved.select("l_orderkey", "product", "quantity", "result")


NUMBERED_SQL = f"""n AS (SELECT id, product, quantity, stock, row_number() OVER (PARTITION BY product ORDER BY ts, id) AS rn
  FROM created JOIN stock USING (product))"""


@query("inventory_stream", f"""WITH RECURSIVE {REQUESTS_SQL}, {STOCK_SQL}, {NUMBERED_SQL}, {reserve_sql('n')}
SELECT product, id, CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS result FROM inv""")
def inventory_stream(i: Inputs) -> DataFrame:
    rows = i.stream("orders").selectExpr(*_columns(REQUEST)).filter("state = 'CREATED'")
    late = i.late("orders", "o_orderdate")
    results = stateful.inventory_stream(rows, stock(i), ["ts", "id"], late)
    return run_available_now(results, "append", "inventory", late.end)


@query("validation_aggregate", f"""WITH {REQUESTS_SQL},
v AS (SELECT id, ts AS ots, ts + to_minutes(CAST(c + CASE WHEN id % 13 = 0 AND c = 2 THEN 8 ELSE 0 END AS INTEGER)) AS ts,
  CASE WHEN (id + c) % 11 = 0 THEN 'FAIL' ELSE 'PASS' END AS result FROM created, range(3) r(c)),
good AS (SELECT id FROM v WHERE result = 'PASS' GROUP BY id, epoch_us(ts) // {5 * MINUTE}
  HAVING count(*) >= 3),
bad AS (SELECT DISTINCT id FROM v WHERE result = 'FAIL' AND ts <= ots + INTERVAL 5 MINUTE)
SELECT id, 'VALIDATED' AS state FROM good UNION ALL SELECT id, 'FAILED' FROM bad""")
def validation_aggregate(i: Inputs) -> DataFrame:
    return orders.validation_aggregate(checks(requests(i)), requests(i)).select("id", "state")


def checks(requests: DataFrame) -> DataFrame:
    """Three results per order, a minute apart; some come too late for the window."""
    new = requests.filter("state = 'CREATED'")
    results = new.select("id", "ts", F.explode(F.array(*map(F.lit, range(3)))).alias("c"))
    late = F.when((F.col("id") % 13 == 0) & (F.col("c") == 2), 8).otherwise(0)
    at = F.timestamp_micros(F.unix_micros("ts") + (F.col("c") + late) * MINUTE)
    verdict = F.when((F.col("id") + F.col("c")) % 11 == 0, "FAIL").otherwise("PASS")
    return results.select("id", verdict.alias("result"), at.alias("ts"))


PAYMENTS_SQL = """payments AS (SELECT o_orderkey + 1000000 AS payment_id, o_orderkey AS order_id, o_totalprice AS amount,
  o_orderdate + to_seconds((o_orderkey % 5) * 20) AS ts FROM orders WHERE o_orderkey % 3 <> 0)"""


def payments(i: Inputs) -> DataFrame:
    delay = (F.col("o_orderkey") % 5) * 20_000_000
    return i.orders.filter("o_orderkey % 3 <> 0").select(
        (F.col("o_orderkey") + 1_000_000).alias("id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").alias("amount"),
        F.timestamp_micros(F.unix_micros("o_orderdate") + delay).alias("ts"),
    )


def customers(i: Inputs) -> DataFrame:
    return i.customer.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name")
    )


@query("notify_join", f"""WITH {REQUESTS_SQL}, {PAYMENTS_SQL}
SELECT r.id, payment_id, amount, c_name AS customer_name FROM requests r
JOIN payments p ON p.order_id = r.id AND p.ts BETWEEN r.ts - INTERVAL 1 MINUTE AND r.ts + INTERVAL 1 MINUTE
JOIN customer ON c_custkey = customer_id""")
def notify_join(i: Inputs) -> DataFrame:
    return orders.notify_join(requests(i), payments(i), customers(i)).select(
        "id", "payment_id", "amount", "customer_name"
    )


@query("order_end_to_end", f"""WITH RECURSIVE {REQUESTS_SQL}, {STOCK_SQL}, {PAYMENTS_SQL}, {DETAILS_SQL},
{fraud_sql(60 / 1440)}, {NUMBERED_SQL}, {reserve_sql('n')},
checks AS (SELECT id, result FROM details
  UNION ALL SELECT id, CASE WHEN session_total < 2000 THEN 'PASS' ELSE 'FAIL' END FROM fraud
  UNION ALL SELECT id, CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END FROM inv),
verdicts AS (SELECT id, CASE WHEN count(*) FILTER (result = 'FAIL') > 0 THEN 'FAILED' ELSE 'VALIDATED' END AS state
  FROM checks GROUP BY id HAVING count(*) FILTER (result = 'FAIL') > 0 OR count(*) >= 3),
mailed AS (SELECT v.id, payment_id, c_name AS customer_name FROM verdicts v JOIN created r USING (id)
  JOIN payments p ON p.order_id = v.id AND p.ts BETWEEN r.ts - INTERVAL 1 MINUTE AND r.ts + INTERVAL 1 MINUTE
  JOIN customer ON c_custkey = customer_id WHERE v.state = 'VALIDATED')
SELECT v.id, v.state, payment_id, customer_name FROM verdicts v LEFT JOIN mailed USING (id)""".replace(
    "INTERVAL '0.041666666666666664 days'", "INTERVAL 60 MINUTE"))
def order_end_to_end(i: Inputs) -> DataFrame:
    return orders.order_end_to_end(requests(i), stock(i), payments(i), customers(i))


def _counts(i: Inputs) -> DataFrame:
    return i.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("cnt"))


@query("state_get", "SELECT user_id, count(*) AS cnt FROM events WHERE user_id = 7 GROUP BY 1")
def state_get(i: Inputs) -> DataFrame:
    return state.state_get(_counts(i), "user_id", 7)


@query("state_all", "SELECT user_id, count(*) AS cnt FROM events GROUP BY 1")
def state_all(i: Inputs) -> DataFrame:
    return state.state_all(_counts(i))


@query("state_range", """
SELECT user_id, count(*) AS cnt FROM events WHERE user_id BETWEEN 3 AND 11 GROUP BY 1""")
def state_range(i: Inputs) -> DataFrame:
    return state.state_range(_counts(i), "user_id", 3, 11)


@query("state_window_fetch", f"""
SELECT 'view@' || (epoch_us(ts) // 3600000000 * 3600000) AS window_key, count(*) AS cnt FROM events
WHERE event_type = 'view' AND epoch_us(ts) // {HOUR} * {HOUR}
  BETWEEN epoch_us(TIMESTAMP '2024-01-05') AND epoch_us(TIMESTAMP '2024-01-10') GROUP BY 1""")
def state_window_fetch(i: Inputs) -> DataFrame:
    store = windows.tumbling_count(i.events, ["event_type"], "ts", HOUR)
    first, last = (F.lit(d).cast("timestamp") for d in ("2024-01-05", "2024-01-10"))
    return state.state_window_fetch(store, "event_type", "view", first, last).select(
        "window_key", "cnt"
    )


@query("state_session_fetch", """
WITH o AS (SELECT *, CASE WHEN lag(ts) OVER w < ts - INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS opens
  FROM events WHERE user_id = 7 WINDOW w AS (ORDER BY ts, event_id)),
n AS (SELECT *, sum(opens) OVER (ORDER BY ts, event_id) AS s FROM o)
SELECT user_id, min(ts) AS start, max(ts) AS "end", count(*) AS cnt FROM n GROUP BY user_id, s""")
def state_session_fetch(i: Inputs) -> DataFrame:
    # The key is known, so only its rows are made into sessions.
    asked = i.events.filter("user_id = 7")
    store = windows.session_count(asked, ["user_id"], "ts", 30 * MINUTE, tie=["event_id"])
    return state.state_session_fetch(store, "user_id", 7)


@query("await_state", """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'VALIDATED' ELSE 'FAILED' END AS state
FROM orders WHERE o_orderstatus <> 'O'""")
def await_state(i: Inputs) -> DataFrame:
    """Two versions of each order; open ones have not been decided."""
    first = i.orders.select(F.col("o_orderkey").alias("id"), F.lit("CREATED").alias("state"), F.lit(0).alias("version"))
    final = F.when(F.col("o_orderkey") % 2 == 0, "VALIDATED").otherwise("FAILED")
    decided = i.orders.filter("o_orderstatus <> 'O'").select(
        F.col("o_orderkey").alias("id"), final.alias("state"), F.lit(1).alias("version")
    )
    versions = first.unionByName(decided)
    return state.await_state(versions, "id", ["version"]).select("id", "state")


WIKI_TITLE = "CASE event_id % 7 WHEN 0 THEN 'Special:' WHEN 1 THEN 'Talk:' ELSE '' END || 'Page' || event_id % 50"
WIKI_FLAGS = "CASE event_id % 4 WHEN 0 THEN '!N' WHEN 1 THEN 'MB' WHEN 2 THEN '' ELSE 'M' END"
WIKI_SQL = f"""wiki AS (SELECT event_id, user_id, {WIKI_TITLE} AS title, {WIKI_FLAGS} AS flags FROM events WHERE event_id % 10 <> 9)"""


def wiki_lines(i: Inputs) -> DataFrame:
    """Edit announcements; every tenth line is malformed."""
    line = (
        f"CASE WHEN event_id % 10 = 9 THEN 'no announcement ' || event_id ELSE "
        f"'[[' || {WIKI_TITLE} || ']] ' || {WIKI_FLAGS} || ' http://d/' || event_id || ' * U' || user_id "
        f"|| ' * (+' || event_id % 90 || ') note ' || event_type END"
    )
    return i.wide("events").select("event_id", F.expr(line).alias("line"))


@query("wiki_parse", f"""WITH {WIKI_SQL}
SELECT event_id, title, 'http://d/' || event_id AS diff_url, 'U' || user_id AS "user",
  CAST(event_id % 90 AS INTEGER) AS byte_diff, 'note ' || event_type AS summary,
  contains(flags, 'N') AS is_new, contains(flags, 'M') AS is_minor,
  contains(flags, '!') AS is_unpatrolled, contains(flags, 'B') AS is_bot,
  CASE event_id % 7 WHEN 0 THEN 'SPECIAL' WHEN 1 THEN 'TALK' ELSE 'EDIT' END AS type
FROM wiki JOIN events USING (event_id, user_id)""")
def wiki_parse(i: Inputs) -> DataFrame:
    return wiki.wiki_parse(wiki_lines(i), "line").drop("line")


@query("wiki_edits_by_user", f"""WITH {WIKI_SQL}
SELECT 'U' || user_id AS "user", count(*) AS cnt FROM wiki WHERE event_id % 7 > 1 GROUP BY 1""")
def wiki_edits_by_user(i: Inputs) -> DataFrame:
    return wiki.wiki_edits_by_user(wiki_lines(i), "line")
