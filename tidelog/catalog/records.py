"""Projection, filtering, routing and batching."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidelog.catalog.registry import LOG_SQL, Inputs, query
from tidelog.functions import text
from tidelog.operators import batching, records, routing
from tidelog.sources.scratch import scratch_dir, through


def keyed(i: Inputs) -> DataFrame:
    """Events as plain key-value records."""
    return i.events.select("event_id", F.col("user_id").alias("key"), F.col("event_type").alias("value"))


@query("filter_rows", "SELECT event_id, value FROM events WHERE value > 20")
def filter_rows(i: Inputs) -> DataFrame:
    return records.filter_rows(i.events, F.col("value") > 20).select("event_id", "value")


@query("filter_not", """
SELECT event_id, value FROM events
WHERE NOT coalesce(CASE WHEN event_id % 7 = 0 THEN NULL ELSE value > 20 END, false)""")
def filter_not(i: Inputs) -> DataFrame:
    maybe = F.when(F.col("event_id") % 7 != 0, F.col("value") > 20)
    return records.filter_not(i.events, maybe).select("event_id", "value")


@query("branch", """
SELECT event_id, CASE WHEN event_type = 'view' THEN 0 WHEN value > 50 THEN 1
                      WHEN event_type = 'click' THEN 2 END AS branch
FROM events WHERE event_type IN ('view', 'click') OR value > 50""")
def branch(i: Inputs) -> DataFrame:
    kinds = [F.col("event_type") == "view", F.col("value") > 50, F.col("event_type") == "click"]
    return records.branch(i.events, kinds).select("event_id", "branch")


@query("map_values", "SELECT event_id, user_id AS key, upper(event_type) AS value FROM events")
def map_values(i: Inputs) -> DataFrame:
    return records.map_values(keyed(i), F.upper("value"))


@query("map_pairs", "SELECT event_type AS key, user_id AS value FROM events")
def map_pairs(i: Inputs) -> DataFrame:
    return records.map_pairs(keyed(i), F.col("value"), F.col("key"))


@query("flat_map_pairs", """
SELECT upper(event_type) AS key, 1000 AS value FROM events
UNION ALL SELECT lower(event_type), 9000 FROM events""")
def flat_map_pairs(i: Inputs) -> DataFrame:
    return records.flat_map_pairs(
        keyed(i), [(F.upper("value"), F.lit(1000)), (F.lower("value"), F.lit(9000))]
    )


@query("flat_map_values", r"""
SELECT doc_id AS key, w AS value FROM (
  SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^a-zA-Z0-9_]+'), lambda x: x <> '')) AS w
  FROM documents)""")
def flat_map_values(i: Inputs) -> DataFrame:
    docs = i.wide("documents").select(F.col("doc_id").alias("key"), F.col("text").alias("value"))
    return records.flat_map_values(docs, text.non_empty_words(F.col("value")))


@query("select_key", """
SELECT doc_id, split_part(lower(text), ' ', 1) AS key FROM documents""")
def select_key(i: Inputs) -> DataFrame:
    first = F.split_part(F.lower("text"), F.lit(" "), F.lit(1))
    return records.select_key(i.documents, first).select("doc_id", "key")


@query("peek_count", "SELECT count(*) AS passed, count(*) AS observed FROM events")
def peek_count(i: Inputs) -> DataFrame:
    seen = Observation("peek")
    counted = records.peek_count(i.events, seen).agg(F.count(F.lit(1)).alias("passed"))
    passed = through(counted, scratch_dir(i.spark, "peek"))  # one pass: the action and the result
    return passed.withColumn("observed", F.lit(seen.get["rows"]).cast("bigint"))


@query("prefix_values", "SELECT event_id, 'PREFIX:' || event_type AS event_type FROM events")
def prefix_values(i: Inputs) -> DataFrame:
    return records.prefix_values(i.events, "event_type").select("event_id", "event_type")


@query("anonymize_ip", r"""
SELECT event_id, regexp_replace('HIT ' || upper(event_type) || ' FROM 10.' || (user_id % 256) || '.'
  || (event_id % 256) || '.' || (event_id % 199) || ' VIA 192.168.1.' || (user_id % 100) || '!',
  '(\d{1,3}\.\d{1,3}\.\d{1,3}\.)\d{1,3}', '\1XXX', 'g') AS line FROM events""")
def anonymize_ip(i: Inputs) -> DataFrame:
    line = F.expr(
        "concat('hit ', event_type, ' from 10.', user_id % 256, '.', event_id % 256, '.', "
        "event_id % 199, ' via 192.168.1.', user_id % 100, '!')"
    )
    return i.events.select("event_id", text.anonymize_ip(F.upper(line)).alias("line"))


RAW_NUMBER = (
    "CASE WHEN event_id % 5 = 0 THEN 'n/a' WHEN event_id % 11 = 0 THEN '' "
    "ELSE CAST(CAST(floor(value) AS BIGINT) AS STRING) END"
)


@query("drop_corrupt", """
SELECT event_id, 2 * CAST(floor(value) AS BIGINT) AS doubled FROM events
WHERE event_id % 5 <> 0 AND event_id % 11 <> 0""")
def drop_corrupt(i: Inputs) -> DataFrame:
    raw = i.events.withColumn("raw", F.expr(RAW_NUMBER))
    good, _ = records.drop_corrupt(raw, text.parse_int(F.col("raw")), "number")
    return good.select("event_id", (F.col("number") * 2).alias("doubled"))


@query("drop_corrupt_dead_letters", """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'n/a' ELSE '' END AS raw FROM events
WHERE event_id % 5 = 0 OR event_id % 11 = 0""")
def drop_corrupt_dead_letters(i: Inputs) -> DataFrame:
    raw = i.events.withColumn("raw", F.expr(RAW_NUMBER))
    _, dead = records.drop_corrupt(raw, text.parse_int(F.col("raw")), "number")
    return dead.select("event_id", "raw")


@query("filter_tags", """
SELECT event_id, event_type AS tags FROM events WHERE event_type IN ('view', 'purchase')""")
def filter_tags(i: Inputs) -> DataFrame:
    tagged = i.events.select("event_id", F.col("event_type").alias("tags"))
    return routing.filter_tags(tagged, "view || purchase")


@query("filter_sql", """
SELECT event_id FROM events
WHERE event_type IN ('view', 'click') AND CAST(props->>'$.k' AS INTEGER) BETWEEN 0 AND 30""")
def filter_sql(i: Inputs) -> DataFrame:
    messages = i.events.select(
        "event_id", F.col("event_type").alias("tags"),
        F.from_json("props", "map<string,string>").alias("props"),
    )
    selector = "tags IN ('view', 'click') AND try_cast(props['k'] AS INT) BETWEEN 0 AND 30"
    return routing.filter_sql(messages, selector).select("event_id")


@query("filter_property", """
SELECT event_id FROM events WHERE event_id % 3 <> 0 AND event_id % 10 = 0 AND event_id > 100""")
def filter_property(i: Inputs) -> DataFrame:
    """Every third message lacks the property."""
    number = F.when(F.col("event_id") % 3 != 0, F.col("event_id").cast("string"))
    messages = i.events.withColumn("props", F.create_map(F.lit("seq"), number))
    return routing.filter_property(messages, F.col("props")["seq"]).select("event_id")


DIRECT = [("alerts", "error"), ("all", "error"), ("all", "view"), ("all", "info"), ("sales", "purchase")]


@query("route_direct", """
WITH m AS (SELECT event_id, CASE WHEN event_type = 'signup' THEN 'info' ELSE event_type END AS k FROM events)
SELECT event_id, queue FROM m JOIN (VALUES ('alerts', 'error'), ('all', 'error'), ('all', 'view'),
  ('all', 'info'), ('sales', 'purchase')) b(queue, bound) ON k = bound""")
def route_direct(i: Inputs) -> DataFrame:
    severity = F.when(F.col("event_type") != "signup", F.col("event_type"))
    messages = i.events.select("event_id", severity.alias("routing_key"))
    return routing.route_direct(messages, DIRECT).select("event_id", "queue")


TOPICS = [("q1", "*.odd.*"), ("q2", "view.#"), ("q2", "#.7"), ("q3", "#"), ("q4", "click.*"), ("q5", "*.*.3")]


@query("route_topic", r"""
WITH m AS (SELECT event_id, event_type || CASE WHEN event_id % 2 = 1 THEN '.odd' ELSE '' END
                  || '.' || (user_id % 10) AS k FROM events)
SELECT DISTINCT event_id, queue FROM m JOIN (VALUES
  ('q1', '[^.]+\.odd\.[^.]+'), ('q2', 'view(\.[^.]+)*'), ('q2', '([^.]+\.)*7'), ('q3', '.*'),
  ('q4', 'click\.[^.]+'), ('q5', '[^.]+\.[^.]+\.3')) b(queue, re) ON regexp_full_match(k, re)""")
def route_topic(i: Inputs) -> DataFrame:
    key = F.expr(
        "concat(event_type, CASE WHEN event_id % 2 = 1 THEN '.odd' ELSE '' END, '.', user_id % 10)"
    )
    messages = i.events.select("event_id", key.alias("routing_key"))
    return routing.route_topic(messages, TOPICS).select("event_id", "queue")


HEADERS = [("views", {"kind": "view"}), ("odd_views", {"kind": "view", "odd": "1"}), ("odd", {"odd": "1"})]


@query("route_headers", """
SELECT event_id, 'views' AS queue FROM events WHERE event_type = 'view'
UNION ALL SELECT event_id, 'odd_views' FROM events WHERE event_type = 'view' AND event_id % 2 = 1
UNION ALL SELECT event_id, 'odd' FROM events WHERE event_id % 2 = 1""")
def route_headers(i: Inputs) -> DataFrame:
    headers = F.create_map(
        F.lit("kind"), F.col("event_type"), F.lit("odd"), (F.col("event_id") % 2).cast("string")
    )
    messages = i.events.select("event_id", headers.alias("headers"))
    return routing.route_headers(messages, HEADERS).select("event_id", "queue")


@query("route_fanout", """
SELECT event_id, queue FROM events, (VALUES ('a'), ('b'), ('c')) q(queue)""")
def route_fanout(i: Inputs) -> DataFrame:
    return routing.route_fanout(i.events.select("event_id"), ["a", "b", "c"])


@query("retopic", f"""WITH {LOG_SQL}
SELECT 'copy.' || topic AS topic, partition, "offset", key, value FROM log""")
def retopic(i: Inputs) -> DataFrame:
    return routing.retopic(i.log(), "copy").drop("ts")


@query("partition_by_suffix", """
SELECT event_id, CAST(CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id % 4 END AS INTEGER) AS partition
FROM events""")
def partition_by_suffix(i: Inputs) -> DataFrame:
    """Every third key has no dot."""
    key = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(
        F.concat_ws(".", "event_type", "user_id")
    )
    rows = i.events.select("event_id", key.alias("key"))
    return routing.partition_by_suffix(rows, 4, move=True).select("event_id", "partition")


@query("ordered_queue", """
SELECT event_id, user_id, CAST(user_id % 4 AS INTEGER) AS queue FROM events""")
def ordered_queue(i: Inputs) -> DataFrame:
    return routing.ordered_queue(
        i.events.select("event_id", "user_id"), 4, "user_id", ["event_id"], move=True
    )


@query("key_partition_changes", """
WITH moved AS (SELECT user_id AS key, event_id AS arrival,
  CAST((user_id + CASE WHEN event_id >= 500 AND user_id % 5 = 0 THEN 1 ELSE 0 END) % 4 AS INTEGER) AS partition
  FROM events),
f AS (SELECT *, first_value(partition) OVER (PARTITION BY key ORDER BY arrival) AS first_partition FROM moved)
SELECT key, arrival, partition, first_partition FROM f WHERE partition <> first_partition""")
def key_partition_changes(i: Inputs) -> DataFrame:
    """Half-way some users move to the next partition."""
    shift = F.when((F.col("event_id") >= 500) & (F.col("user_id") % 5 == 0), 1).otherwise(0)
    moved = i.events.select(
        F.col("user_id").alias("key"),
        F.col("event_id").alias("arrival"),
        ((F.col("user_id") + shift) % 4).cast("int").alias("partition"),
    )
    return routing.key_partition_changes(moved)


@query("grouped", """
WITH n AS (SELECT user_id, event_id, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 10 AS batch
           FROM events)
SELECT user_id, batch, string_agg(event_id, ',' ORDER BY event_id) AS ids, count(*) AS size
FROM n GROUP BY ALL""")
def grouped(i: Inputs) -> DataFrame:
    batches = batching.grouped(
        i.events, 10, ["user_id"], ["event_id"], F.col("event_id"), "event_id"
    )
    return batches.select(
        "user_id", "batch", F.array_join("values", ",").alias("ids"),
        F.size("values").cast("bigint").alias("size"),
    )


@query("size_batches", """
WITH RECURSIVE l AS (
  SELECT source, doc_id, length('documents') + length(text) + 20 AS size,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents WHERE source IS NOT NULL),
r AS (
  SELECT source, rn, doc_id, size, CAST(0 AS BIGINT) AS batch, size AS used FROM l WHERE rn = 1
  UNION ALL
  SELECT l.source, l.rn, l.doc_id, l.size,
         CASE WHEN r.used + l.size > 20000 THEN r.batch + 1 ELSE r.batch END,
         CASE WHEN r.used + l.size > 20000 THEN l.size ELSE r.used + l.size END
  FROM r JOIN l ON l.source = r.source AND l.rn = r.rn + 1)
SELECT source, batch, doc_id, CAST(size AS BIGINT) AS size FROM r""")
def size_batches(i: Inputs) -> DataFrame:
    size = F.length(F.lit("documents")) + F.length("text") + 20
    return batching.size_batches(i.documents, 20_000, ["source"], ["doc_id"], F.col("doc_id"), size, "doc_id")


@query("fold", """
SELECT CAST(sum(2 * event_id) AS BIGINT) AS total FROM events WHERE event_id % 2 = 0""")
def fold(i: Inputs) -> DataFrame:
    even = records.filter_rows(i.events, F.col("event_id") % 2 == 0)
    return records.fold_sum(even, F.col("event_id") * 2)


@query("head", "SELECT event_id, user_id FROM events ORDER BY value DESC, event_id LIMIT 1")
def head(i: Inputs) -> DataFrame:
    return records.head(i.events, [F.col("value").desc(), F.col("event_id")]).select(
        "event_id", "user_id"
    )


@query("range_source", """
SELECT l_orderkey, CAST(sum(2 * n) AS BIGINT) AS total FROM
  (SELECT l_orderkey, unnest(generate_series(1, CAST(l_quantity AS BIGINT))) AS n FROM lineitem)
WHERE n % 2 = 0 GROUP BY 1""")
def range_source(i: Inputs) -> DataFrame:
    """Count up to each line's quantity, keep the even numbers, double and add them."""
    numbers = records.range_source(i.lineitem, F.col("l_quantity").cast("bigint"))
    return numbers.filter("n % 2 = 0").groupBy("l_orderkey").agg(F.sum(F.col("n") * 2).alias("total"))
