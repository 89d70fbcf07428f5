"""Time windows, sessions and late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.catalog.registry import (
    ARRIVALS_SQL,
    DAY,
    HOUR,
    MINUTE,
    Inputs,
    bucket_sql,
    query,
)
from tidelog.functions import text
from tidelog.operators import windows
from tidelog.plans.ordered import micros
from tidelog.sources.sinks import run_available_now
from tidelog.streaming import stateful

GAP = 30 * MINUTE
USERS = ["user_id"]
KINDS = ["event_type"]


def window_sql(keys: str, size: int, value: str, source: str = "events") -> str:
    start = bucket_sql("ts", size)
    return f"""
SELECT {keys}, {start} AS start, {start} + to_microseconds({size}) AS "end", {value}
FROM {source} GROUP BY ALL"""


@query("tumbling_count", window_sql("event_type", HOUR, "count(*) AS cnt"))
def tumbling_count(i: Inputs) -> DataFrame:
    return windows.tumbling_count(i.events, KINDS, "ts", HOUR)


@query("tumbling_count_stream", window_sql("event_type", HOUR, "count(*) AS cnt"))
def tumbling_count_stream(i: Inputs) -> DataFrame:
    counts = windows.tumbling_count(i.stream("events"), KINDS, "ts", HOUR)
    return run_available_now(counts, "complete", "tumbling")


@query("tumbling_aggregate", window_sql(
    "user_id", 5 * MINUTE, "CAST(sum(length(event_type)) AS BIGINT) AS total_length"))
def tumbling_aggregate(i: Inputs) -> DataFrame:
    return windows.tumbling_aggregate(
        i.events, USERS, "ts", 5 * MINUTE, F.sum(F.length("event_type")).alias("total_length")
    )


@query("tumbling_reduce", window_sql("event_type", 6 * HOUR, "CAST(sum(event_id) AS BIGINT) AS total"))
def tumbling_reduce(i: Inputs) -> DataFrame:
    return windows.tumbling_reduce(i.events, KINDS, "ts", 6 * HOUR, F.sum("event_id").alias("total"))


SEEN_SQL = f"""WITH {ARRIVALS_SQL},
seen AS (SELECT *, max(ts) OVER (PARTITION BY user_id % 4 ORDER BY arrival, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM arrivals)"""


def _lanes(i: Inputs) -> DataFrame:
    return i.arrivals().withColumn("lane", F.col("user_id") % 4)


@query("tumbling_max_retained", f"""{SEEN_SQL},
kept AS (SELECT * FROM seen WHERE newest IS NULL OR ts >= newest - INTERVAL 1 HOUR)
{window_sql('event_type', 10 * MINUTE, 'max(value) AS max_value', 'kept')}""")
def tumbling_max_retained(i: Inputs) -> DataFrame:
    return windows.tumbling_max_retained(
        _lanes(i), KINDS, "ts", 10 * MINUTE, HOUR, "value",
        lane=["lane"], arrival=["arrival", "event_id"], position=F.col("arrival"),
    )


@query("anomaly_users", window_sql("user_id", HOUR, "count(*) AS cnt") + " HAVING count(*) >= 2")
def anomaly_users(i: Inputs) -> DataFrame:
    return windows.anomaly_users(i.events, "user_id", "ts", HOUR, 2)


@query("hopping_count", f"""
SELECT event_type, make_timestamp(s) AS start, make_timestamp(s) + INTERVAL 4 HOUR AS "end", count(*) AS cnt
FROM (SELECT event_type, unnest(generate_series(epoch_us(ts) // {HOUR} * {HOUR} - 3 * {HOUR},
      epoch_us(ts) // {HOUR} * {HOUR}, {HOUR})) AS s FROM events) GROUP BY ALL""")
def hopping_count(i: Inputs) -> DataFrame:
    return windows.hopping_count(i.events, KINDS, "ts", 4 * HOUR, HOUR)


def runs_sql(keys: str, size: int, step: int, keep: str) -> str:
    """Change points: rows enter at their first covering start and leave after the last."""
    return f"""
WITH m AS (
  SELECT {keys}, CAST((floor((epoch_us(ts) - {size}) / {step}) + 1) * {step} AS BIGINT) AS pos, 1 AS d FROM events
  UNION ALL SELECT {keys}, (epoch_us(ts) // {step} + 1) * {step}, -1 FROM events),
s AS (SELECT {keys}, pos, sum(d) AS d FROM m GROUP BY ALL),
r AS (SELECT {keys}, pos, lead(pos) OVER w - {step} AS til, CAST(sum(d) OVER w AS BIGINT) AS cnt FROM s
      WINDOW w AS (PARTITION BY {keys} ORDER BY pos))
SELECT {keys}, make_timestamp(pos) AS start_from, make_timestamp(til) AS start_to, cnt FROM r
WHERE til IS NOT NULL AND {keep}"""


@query("hopping_count_dense", runs_sql("event_type", 7 * DAY, 1_000_000, "cnt > 0"))
def hopping_count_dense(i: Inputs) -> DataFrame:
    return windows.hopping_count_dense(i.events, KINDS, "ts", 7 * DAY, 1_000_000)


@query("sliding_inverse_reduce", runs_sql("user_id", 6 * HOUR, 10 * MINUTE, "true"))
def sliding_inverse_reduce(i: Inputs) -> DataFrame:
    return windows.sliding_inverse_reduce(i.events, USERS, "ts", 6 * HOUR, 10 * MINUTE)


SESSION_SQL = """WITH o AS (SELECT *, CASE WHEN lag(ts) OVER w < ts - INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS opens
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
n AS (SELECT *, CAST(sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session_id FROM o)"""


@query("session_count", f"""{SESSION_SQL}
SELECT user_id, min(ts) AS start, max(ts) AS "end", count(*) AS cnt FROM n GROUP BY user_id, session_id""")
def session_count(i: Inputs) -> DataFrame:
    return windows.session_count(i.events, USERS, "ts", GAP, tie=["event_id"])


@query("session_count_stream", f"""{SESSION_SQL}
SELECT user_id, min(ts) AS start, max(ts) AS "end", count(*) AS cnt FROM n GROUP BY user_id, session_id""")
def session_count_stream(i: Inputs) -> DataFrame:
    counts = windows.session_count(i.stream("events"), USERS, "ts", GAP)
    return run_available_now(counts, "complete", "sessions")


@query("session_aggregate", f"""{SESSION_SQL}
SELECT user_id, min(ts) AS start, max(ts) AS "end", CAST(sum(length(event_type)) AS BIGINT) AS total_length,
       max(value) AS max_value FROM n GROUP BY user_id, session_id""")
def session_aggregate(i: Inputs) -> DataFrame:
    return windows.session_aggregate(
        i.events, USERS, "ts", GAP,
        F.sum(F.length("event_type")).alias("total_length"), F.max("value").alias("max_value"),
        tie=["event_id"],
    )


@query("session_reduce", f"""{SESSION_SQL}
SELECT user_id, min(ts) AS start, max(ts) AS "end", CAST(sum(event_id) AS BIGINT) AS total
FROM n GROUP BY user_id, session_id""")
def session_reduce(i: Inputs) -> DataFrame:
    return windows.session_reduce(
        i.events, USERS, "ts", GAP, F.sum("event_id").alias("total"), tie=["event_id"]
    )


@query("session_changelog", """
WITH m AS (SELECT user_id, epoch_us(ts) // 1000 AS ms FROM events),
o AS (SELECT *, CASE WHEN lag(ms) OVER (PARTITION BY user_id ORDER BY ms) < ms - 21600000 THEN 1 ELSE 0 END AS opens FROM m),
n AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ms ROWS UNBOUNDED PRECEDING) AS s FROM o)
SELECT user_id, min(ms) AS start_ms, max(ms) AS end_ms, count(*) AS cnt FROM n GROUP BY user_id, s""")
def session_changelog(i: Inputs) -> DataFrame:
    """Rows arrive out of order, so sessions are deleted and merged; what is left are the sessions.

    A session is left when it was added more often than deleted. Rows at the very instant of a
    one-row session add it again without a deletion, so such a session is left if never deleted.
    """
    behind = F.when(F.col("event_id") % 17 == 0, 40).otherwise(0)
    rows = i.stream("events").withColumn("arrival", F.col("event_id") + behind)
    late = i.late("events", "event_id", more=40)
    changes = stateful.session_changelog(rows, USERS, ["arrival", "event_id"], "ts", 6 * HOUR, late)
    emitted = run_available_now(changes, "append", "session-changes", late.end)
    gone, added = F.count_if(F.col("cnt").isNull()), F.count("cnt")
    one = F.col("start_ms") == F.col("end_ms")
    last = emitted.groupBy("user_id", "start_ms", "end_ms").agg(
        F.max("cnt").alias("cnt"), gone.alias("_gone"), added.alias("_added")
    )
    left = last.filter((one & (F.col("_gone") == 0)) | (~one & (F.col("_added") > F.col("_gone"))))
    return left.drop("_gone", "_added")


@query("sessionize", f"""{SESSION_SQL}
SELECT user_id, event_id, session_id FROM n""")
def sessionize(i: Inputs) -> DataFrame:
    return windows.sessionize(
        i.events, USERS, ["ts", "event_id"], micros("ts"), "ts", GAP
    ).select("user_id", "event_id", "session_id")


@query("sessionize_stream", f"""{SESSION_SQL}
SELECT user_id, event_id, session_id FROM n""")
def sessionize_stream(i: Inputs) -> DataFrame:
    late = i.late("events", "event_id")
    rows = stateful.sessionize_stream(i.stream("events"), USERS, ["event_id"], "ts", GAP, late)
    return run_available_now(rows, "append", "sessionize", late.end)


@query("windowed_key_string", f"""
SELECT event_type || '@' || (epoch_us(ts) // 3600000000 * 3600000) || '->'
       || (epoch_us(ts) // 3600000000 * 3600000 + 3600000) AS window_key, count(*) AS cnt
FROM events GROUP BY 1""")
def windowed_key_string(i: Inputs) -> DataFrame:
    counts = windows.tumbling_count(i.events, KINDS, "ts", HOUR)
    key = text.windowed_key(F.col("event_type"), F.col("start"), F.col("end"))
    return counts.select(key.alias("window_key"), "cnt")


@query("event_time", """
SELECT event_id, make_timestamp(epoch_us(ts) // 1000 * 1000) AS extracted FROM events""")
def event_time(i: Inputs) -> DataFrame:
    payload = F.to_json(F.struct(F.unix_millis("ts").alias("timestamp"), "user_id"))
    rows = i.events.select("event_id", payload.alias("payload"))
    return rows.select("event_id", text.event_time(F.col("payload"), "timestamp").alias("extracted"))


@query("late_split", f"""{SEEN_SQL}
SELECT event_id, coalesce(ts < newest - INTERVAL 1 HOUR, false) AS late FROM seen""")
def late_split(i: Inputs) -> DataFrame:
    flagged = windows.late_flag(
        _lanes(i), "ts", HOUR, ["lane"], ["arrival", "event_id"], F.col("arrival")
    )
    return flagged.select("event_id", "late")
