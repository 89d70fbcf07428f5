"""Keyed aggregation, tables, running values, charts and sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.catalog.registry import (
    CHANGELOG_SQL,
    DAY,
    HOUR,
    Inputs,
    bucket_sql,
    query,
)
from tidelog.functions import text
from tidelog.operators import aggregate, custom, sketch, topn
from tidelog.sources.sinks import run_available_now
from tidelog.streaming import stateful

USERS = ["user_id"]
ORDER = ["event_id"]


@query("group_count", "SELECT user_id, event_type, count(*) AS cnt FROM events GROUP BY ALL")
def group_count(i: Inputs) -> DataFrame:
    return aggregate.group_count(i.events, ["user_id", "event_type"])


@query("group_reduce", """
SELECT user_id, CAST(sum(event_id) AS BIGINT) AS total FROM events WHERE event_id % 2 = 1 GROUP BY 1""")
def group_reduce(i: Inputs) -> DataFrame:
    odd = i.events.filter("event_id % 2 = 1")
    return aggregate.group_reduce(odd, USERS, F.col("event_id"), "total")


@query("group_aggregate", """
SELECT source, CAST(sum(length(text)) AS BIGINT) AS total_length FROM documents GROUP BY 1""")
def group_aggregate(i: Inputs) -> DataFrame:
    return aggregate.group_aggregate(i.documents, ["source"], "text", "total_length")


@query("group_max", "SELECT user_id, max(value) AS max_value FROM events GROUP BY 1")
def group_max(i: Inputs) -> DataFrame:
    return aggregate.group_max(i.events, USERS, "value", "max_value")


@query("group_avg_parts", """
SELECT user_id, count(*) AS cnt, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS total,
       round(sum(CAST(floor(value) AS BIGINT)) / count(*), 6) AS avg
FROM events GROUP BY 1""")
def group_avg_parts(i: Inputs) -> DataFrame:
    """Parts of two halves, merged."""
    whole = F.floor("value")
    halves = [
        aggregate.group_avg_parts(i.events.filter(f"event_id % 2 = {half}"), USERS, whole)
        for half in (0, 1)
    ]
    merged = aggregate.merge_avg_parts(halves[0].unionByName(halves[1]), USERS)
    return merged.withColumn("avg", F.round("avg", 6))


@query("table_regroup_count", f"""WITH {CHANGELOG_SQL},
cur AS (SELECT user_id, arg_max(struct_pack(v := event_type), event_id).v AS g FROM changelog GROUP BY 1)
SELECT g.event_type, count(cur.user_id) AS cnt
FROM (SELECT DISTINCT event_type FROM changelog WHERE event_type IS NOT NULL) g
LEFT JOIN cur ON cur.g = g.event_type GROUP BY 1""")
def table_regroup_count(i: Inputs) -> DataFrame:
    return aggregate.table_regroup_count(i.changelog(), USERS, ["ts", "event_id"], "event_type")


@query("table_regroup_aggregate", f"""WITH {CHANGELOG_SQL},
cur AS (SELECT user_id, arg_max(struct_pack(v := event_type, n := event_id), event_id) AS s FROM changelog GROUP BY 1)
SELECT g.event_type, CAST(coalesce(sum(s.n), 0) AS BIGINT) AS total
FROM (SELECT DISTINCT event_type FROM changelog WHERE event_type IS NOT NULL) g
LEFT JOIN cur ON cur.s.v = g.event_type GROUP BY 1""")
def table_regroup_aggregate(i: Inputs) -> DataFrame:
    return aggregate.table_regroup_aggregate(
        i.changelog(), USERS, ["ts", "event_id"], "event_type", F.col("event_id"), "total"
    )


@query("table_regroup_stream", f"""WITH {CHANGELOG_SQL},
cur AS (SELECT user_id, arg_max(struct_pack(v := event_type), event_id).v AS g FROM changelog GROUP BY 1)
SELECT g.event_type AS grp, count(cur.user_id) AS cnt
FROM (SELECT DISTINCT event_type FROM changelog WHERE event_type IS NOT NULL) g
LEFT JOIN cur ON cur.g = g.event_type GROUP BY 1""")
def table_regroup_stream(i: Inputs) -> DataFrame:
    """The regrouped table as a stream of additions and subtractions, then summed."""
    value = F.when(F.col("event_type") != "error", F.col("event_type"))
    changes = i.stream("events").select("user_id", value.alias("event_type"), "event_id")
    late = i.late("events", "event_id")
    moves = stateful.table_regroup_stream(changes, USERS, ORDER, "event_type", F.lit(1), late)
    return run_available_now(moves, "append", "regroup", late.end).groupBy("grp").agg(
        F.sum("delta").alias("cnt")
    )


@query("having_filter", """
SELECT user_id, count(*) AS cnt FROM events WHERE event_type = 'purchase' GROUP BY 1 HAVING count(*) > 12""")
def having_filter(i: Inputs) -> DataFrame:
    counts = aggregate.group_count(i.kind("purchase"), USERS)
    return aggregate.having_filter(counts, F.col("cnt") > 12)


def _words(i: Inputs, tokens) -> DataFrame:
    return aggregate.word_count(i.wide("documents").select("text"), tokens(F.col("text")))


# A trailing run of separators is cut off before splitting: only trailing empty tokens vanish.
def _split_sql(source: str, sep: str) -> str:
    rest = f"regexp_replace({source}, '({sep})+$', '')"
    return f"""
SELECT word, count(*) AS cnt FROM (SELECT unnest(
  CASE WHEN {source} = '' THEN [''] WHEN {rest} = '' THEN []
       ELSE regexp_split_to_array({rest}, '{sep}') END) AS word FROM documents) GROUP BY 1"""


@query("word_count_space", _split_sql("lower(text)", " "))
def word_count_space(i: Inputs) -> DataFrame:
    return _words(i, text.space_tokens)


@query("word_count_ascii", _split_sql("lower(text)", "[^a-zA-Z0-9_]+"))
def word_count_ascii(i: Inputs) -> DataFrame:
    return _words(i, text.ascii_words)


@query("word_count_unicode", _split_sql("lower(text)", r"[^\p{L}\p{N}\p{M}_]+"))
def word_count_unicode(i: Inputs) -> DataFrame:
    return _words(i, text.unicode_words)


@query("word_count_non_empty", """
SELECT word, count(*) AS cnt FROM (
  SELECT unnest(regexp_split_to_array(lower(text), '[^a-zA-Z0-9_]+')) AS word FROM documents)
WHERE word <> '' GROUP BY 1""")
def word_count_non_empty(i: Inputs) -> DataFrame:
    return _words(i, text.non_empty_words)


@query("character_count", """
SELECT word, count(*) AS cnt FROM (
  SELECT unnest(string_split(text, '')) AS word FROM documents) WHERE word <> '' GROUP BY 1""")
def character_count(i: Inputs) -> DataFrame:
    return _words(i, text.characters)


@query("word_count_stream", """
SELECT word, count(*) AS cnt FROM (
  SELECT unnest(regexp_split_to_array(lower(text), '[^a-zA-Z0-9_]+')) AS word FROM documents)
WHERE word <> '' GROUP BY 1""")
def word_count_stream(i: Inputs) -> DataFrame:
    lines = i.stream("documents").select("text")
    counts = aggregate.word_count(lines, text.non_empty_words(F.col("text")))
    return run_available_now(counts, "complete", "words")


RUNNING_SQL = """
SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS cnt
FROM events"""


@query("user_mapper", "SELECT event_id, event_type || '!' AS value FROM events")
def user_mapper(i: Inputs) -> DataFrame:
    """A vectorised Python function as value mapper."""
    rows = i.events.select("event_id", "event_type")
    return custom.map_values_with(rows, "event_type", lambda s: s + "!", "string", "value").select(
        "event_id", "value"
    )


@query("user_aggregate", """
SELECT user_id, count(*) AS cnt, max(event_id) - min(event_id) AS reach,
       CAST(max(event_id) AS BIGINT) AS high, min(event_id) AS low FROM events GROUP BY 1""")
def user_aggregate(i: Inputs) -> DataFrame:
    """Initializer, adder and merger written in Python: count, lowest and highest id."""
    totals = custom.aggregate_with(
        i.events.select("user_id", "event_id"),
        ["user_id"],
        lambda: (0, 1 << 62, -1),
        lambda s, row: (s[0] + 1, min(s[1], row["event_id"]), max(s[2], row["event_id"])),
        lambda a, b: (a[0] + b[0], min(a[1], b[1]), max(a[2], b[2])),
        [("cnt", "bigint"), ("low", "bigint"), ("high", "bigint")],
    )
    return totals.withColumn("reach", F.col("high") - F.col("low"))


@query("running_count", RUNNING_SQL)
def running_count(i: Inputs) -> DataFrame:
    return aggregate.running_count(
        i.events.select("event_type", "event_id"), ["event_type"], ORDER, F.col("event_id")
    )


@query("table_view", "SELECT event_type, count(*) AS cnt FROM events GROUP BY 1")
def table_view(i: Inputs) -> DataFrame:
    """The counts as a table: the last value of each."""
    return aggregate.group_count(i.events, ["event_type"])


@query("stream_view", RUNNING_SQL)
def stream_view(i: Inputs) -> DataFrame:
    """The same counts as a stream: each value they went through."""
    return running_count(i)


LATEST_SQL = """
SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id
FROM events GROUP BY 1"""


@query("latest_reduce", LATEST_SQL)
def latest_reduce(i: Inputs) -> DataFrame:
    rows = i.events.select("user_id", "event_type", "event_id", "ts")
    return aggregate.latest_reduce(rows, USERS, ["ts", "event_id"]).drop("ts")


@query("first_reduce", """
SELECT user_id, arg_min(event_type, event_id) AS event_type, min(event_id) AS event_id
FROM events GROUP BY 1""")
def first_reduce(i: Inputs) -> DataFrame:
    rows = i.events.select("user_id", "event_type", "event_id", "ts")
    return aggregate.first_reduce(rows, USERS, ["ts", "event_id"]).drop("ts")


@query("latest_by_key", f"""WITH {CHANGELOG_SQL},
cur AS (SELECT user_id, arg_max(struct_pack(v := event_type, n := event_id), event_id) AS s FROM changelog GROUP BY 1)
SELECT user_id, s.v AS event_type, s.n AS event_id FROM cur WHERE s.v IS NOT NULL""")
def latest_by_key(i: Inputs) -> DataFrame:
    return aggregate.latest_by_key(
        i.changelog().drop("value"), USERS, ["ts", "event_id"], "event_type"
    ).drop("ts")


@query("transform_state", RUNNING_SQL)
def transform_state(i: Inputs) -> DataFrame:
    """The running count kept in a per-key store of a stream."""
    late = i.late("events", "event_id")
    counts = stateful.running_count_stream(i.stream("events"), ["event_type"], ORDER, late)
    return run_available_now(counts, "append", "running", late.end)


@query("punctuate_snapshot", f"""
WITH t AS (SELECT event_type, user_id, (epoch_us(ts) // {DAY} + 1) * {DAY} AS tick FROM events),
ticks AS (SELECT DISTINCT tick FROM t)
SELECT t.event_type, make_timestamp(k.tick) AS tick, count(*) AS cnt
FROM t JOIN ticks k ON t.tick <= k.tick GROUP BY ALL""")
def punctuate_snapshot(i: Inputs) -> DataFrame:
    return aggregate.punctuate_snapshot(i.events, ["event_type"], "ts", DAY)


@query("json_pojo", """
SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS missing,
       '{"id":' || event_id || ',"k":' || (props->>'$.k') || '}' AS line FROM events""")
def json_pojo(i: Inputs) -> DataFrame:
    record = text.json_fields(F.col("props"), {"k": "int", "missing": "string"})
    parsed = i.events.select("event_id", record.alias("r"))
    line = text.json_text(F.struct(F.col("event_id").alias("id"), F.col("r.k").alias("k")))
    return parsed.select("event_id", "r.k", "r.missing", line.alias("line"))


@query("moving_average", """
WITH r AS (SELECT user_id, event_id, CASE WHEN event_id % 5 <> 0 THEN CAST(floor(value) AS BIGINT) END AS num FROM events),
v AS (SELECT *, count(num) OVER (PARTITION BY user_id ORDER BY event_id) AS valid FROM r)
SELECT user_id, event_id,
  CAST((SELECT sum(x.num) // least(v.valid, 10) FROM v x WHERE x.user_id = v.user_id AND x.num IS NOT NULL
        AND x.valid > v.valid - 10 AND x.valid <= v.valid) AS BIGINT) AS avg
FROM v WHERE valid > 0""")
def moving_average(i: Inputs) -> DataFrame:
    raw = i.events.select(
        "user_id", "event_id",
        F.expr("CASE WHEN event_id % 5 = 0 THEN 'n/a' ELSE CAST(CAST(floor(value) AS BIGINT) AS STRING) END").alias("raw"),
    )
    return aggregate.moving_average(
        raw, 10, USERS, ORDER, F.col("event_id"), text.parse_int(F.col("raw"))
    ).drop("raw")


@query("message_rate_stats", f"""
SELECT {bucket_sql('ts', HOUR)} AS start, count(*) AS messages, round(count(*) / 3600, 6) AS tps,
       round(avg(value), 6) AS avg_latency, max(value) AS max_latency,
       count(*) FILTER (event_type = 'error') AS failures
FROM events GROUP BY 1""")
def message_rate_stats(i: Inputs) -> DataFrame:
    return aggregate.message_rate_stats(
        i.events, "ts", 3600, F.col("value"), F.col("event_type") == "error"
    )


PLAYS_SQL = "plays AS (SELECT l_partkey AS p_partkey, CAST(sum(l_quantity) AS BIGINT) AS plays FROM lineitem GROUP BY 1)"


def _plays(i: Inputs) -> DataFrame:
    return i.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.sum("l_quantity").cast("bigint").alias("plays")
    )


@query("top_n_per_group", f"""WITH {PLAYS_SQL}
SELECT lower(p_brand) AS brand, p_partkey, plays,
       CAST(row_number() OVER (PARTITION BY lower(p_brand) ORDER BY plays DESC, p_partkey) AS INTEGER) AS rank
FROM plays JOIN part USING (p_partkey) QUALIFY rank <= 5""")
def top_n_per_group(i: Inputs) -> DataFrame:
    songs = i.part.select("p_partkey", F.lower("p_brand").alias("brand"))
    charts = _plays(i).join(songs, "p_partkey")
    return topn.top_n_per_group(
        charts, 5, ["brand"], [F.col("plays").desc(), F.col("p_partkey").asc()]
    ).select("brand", "p_partkey", "plays", "rank")


@query("top_n_global", f"""WITH {PLAYS_SQL}
SELECT p_partkey, plays FROM plays ORDER BY plays DESC, p_partkey LIMIT 5""")
def top_n_global(i: Inputs) -> DataFrame:
    return topn.top_n_global(_plays(i), 5, [F.col("plays").desc(), F.col("p_partkey").asc()])


@query("top_n_windowed", f"""
WITH c AS (SELECT {bucket_sql('ts', HOUR)} AS start, event_type, user_id, count(*) AS n FROM events
           WHERE value > 5 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY start, event_type ORDER BY n DESC, user_id) AS r FROM c QUALIFY r <= 100)
SELECT start, event_type, string_agg(user_id, chr(10) ORDER BY r) AS top FROM r GROUP BY ALL""")
def top_n_windowed(i: Inputs) -> DataFrame:
    return topn.top_n_windowed(
        i.events.filter("value > 5"), 100, "ts", "60 minutes", "event_type", "user_id"
    )


@query("chart_enrich", f"""WITH {PLAYS_SQL}
SELECT p_partkey, plays, p_name, p_brand, p_type FROM
  (SELECT * FROM plays ORDER BY plays DESC, p_partkey LIMIT 5) JOIN part USING (p_partkey)""")
def chart_enrich(i: Inputs) -> DataFrame:
    chart = topn.top_n_global(_plays(i), 5, [F.col("plays").desc(), F.col("p_partkey").asc()])
    songs = i.part.select("p_partkey", "p_name", "p_brand", "p_type")
    return topn.chart_enrich(chart, songs, "p_partkey")


@query("chartable_plays", """
SELECT p_partkey, count(*) AS plays FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_quantity >= 30 GROUP BY 1""")
def chartable_plays(i: Inputs) -> DataFrame:
    plays = i.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_quantity")
    return topn.chartable_plays(
        plays, i.part.select("p_partkey"), "p_partkey", F.col("l_quantity"), 30
    )


def _sketch(i: Inputs) -> DataFrame:
    return sketch.cms_build(i.events, "user_id")


@query("cms_count", """
WITH n AS (SELECT count(*) AS total FROM events)
SELECT user_id, true AS within_bounds FROM events, n GROUP BY 1""")
def cms_count(i: Inputs) -> DataFrame:
    """Each estimate lies between the true count and that plus eps times all rows."""
    shape = sketch.SketchShape()
    estimates = sketch.cms_count(_sketch(i), i.events, "user_id")
    true = aggregate.group_count(i.events, USERS)
    slack = i.events.agg(F.count(F.lit(1)) * F.lit(shape.eps)).scalar()
    ok = F.col("estimate").between(F.col("cnt"), F.col("cnt") + slack)
    return estimates.join(true, "user_id").select("user_id", ok.alias("within_bounds"))


@query("cms_heavy_hitters", """
SELECT event_type, count(*) AS estimate FROM events GROUP BY 1
HAVING count(*) >= 0.01 * (SELECT count(*) FROM events)""")
def cms_heavy_hitters(i: Inputs) -> DataFrame:
    cells = sketch.cms_build(i.events, "event_type")
    return sketch.cms_heavy_hitters(cells, i.events, "event_type")


@query("cms_heavy_hitters_parts", """
WITH n AS (SELECT l_partkey, count(*) AS cnt, sum(count(*)) OVER () AS total FROM lineitem GROUP BY 1)
SELECT l_partkey, true AS found FROM n WHERE cnt >= 0.0005 * total""")
def cms_heavy_hitters_parts(i: Inputs) -> DataFrame:
    """No heavy part is missed among thousands; estimates never lie below the counts."""
    shape = sketch.SketchShape(heavy=0.0005)
    found = sketch.cms_heavy_hitters(sketch.cms_build(i.lineitem, "l_partkey", shape), i.lineitem, "l_partkey", shape)
    true, total = aggregate.group_count(i.lineitem, ["l_partkey"]), i.lineitem.agg(F.count(F.lit(1)).alias("total"))
    heavy = true.join(F.broadcast(total), F.col("cnt") >= 0.0005 * F.col("total"))
    kept = heavy.join(found, "l_partkey", "left")
    return kept.select("l_partkey", (F.coalesce("estimate", F.lit(0)) >= F.col("cnt")).alias("found"))


@query("cms_stream", """
WITH n AS (SELECT count(*) AS total FROM events)
SELECT user_id, true AS within_bounds FROM events, n GROUP BY 1""")
def cms_stream(i: Inputs) -> DataFrame:
    """The sketch kept by a stream in complete mode, asked for every user."""
    shape = sketch.SketchShape()
    cells = run_available_now(sketch.cms_build(i.stream("events"), "user_id", shape), "complete", "sketch")
    estimates = sketch.cms_count(cells, i.events, "user_id", shape)
    true = aggregate.group_count(i.events, USERS)
    slack = i.events.agg(F.count(F.lit(1)) * F.lit(shape.eps)).scalar()
    ok = F.col("estimate").between(F.col("cnt"), F.col("cnt") + slack)
    return estimates.join(true, "user_id").select("user_id", ok.alias("within_bounds"))


@query("cms_merge", "SELECT l_partkey, true AS within_bounds FROM lineitem GROUP BY 1")
def cms_merge(i: Inputs) -> DataFrame:
    """Estimates of all parts from the merged sketches of two halves, against the true counts."""
    halves = [
        sketch.cms_build(i.lineitem.filter(f"l_orderkey % 2 = {half}"), "l_partkey")
        for half in (0, 1)
    ]
    estimates = sketch.cms_count(sketch.cms_merge(*halves), i.lineitem, "l_partkey")
    true = aggregate.group_count(i.lineitem, ["l_partkey"])
    slack = i.lineitem.agg(F.count(F.lit(1)) * F.lit(sketch.SketchShape().eps)).scalar()
    ok = F.col("estimate").between(F.col("cnt"), F.col("cnt") + slack)
    return estimates.join(true, "l_partkey").select("l_partkey", ok.alias("within_bounds"))
