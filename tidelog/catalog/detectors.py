"""Event detectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.catalog.registry import ARRIVALS_SQL, HOUR, Inputs, query
from tidelog.operators import detectors

FRAME = 12 * HOUR
IDS = ["user_id", "day"]
KINDS = ["event_type"]
NAMES = ["click", "view", "purchase"]

FIRST_SQL = f"""f AS (SELECT user_id, CAST(epoch_us(ts) // 86400000000 AS BIGINT) AS day, event_type AS k,
  min(ts) AS t, arg_min(value, event_id) AS v FROM events WHERE event_type IN ('click', 'view', 'purchase') GROUP BY ALL),
g AS (SELECT user_id, day, min(t) AS ts FROM f GROUP BY ALL),
c AS (SELECT g.user_id, g.day, g.ts,
  {', '.join(f"max(CASE WHEN k = '{n}' AND epoch_us(t) - epoch_us(ts) <= {FRAME} THEN v END) AS {n}_value" for n in NAMES)}
  FROM g JOIN f USING (user_id, day) GROUP BY ALL),
composite AS (SELECT *, click_value IS NOT NULL AND view_value IS NOT NULL AND purchase_value IS NOT NULL AS complete FROM c)"""


def composites(i: Inputs) -> DataFrame:
    """Click, view and purchase of a user on one day."""
    day = F.floor(F.unix_micros("ts") / 86_400_000_000)
    return detectors.composite_event(
        i.events.withColumn("day", day), IDS,
        {n: F.col("event_type") == n for n in NAMES}, "ts", "value", ["ts", "event_id"], FRAME,
    )


@query("composite_event", f"""WITH {FIRST_SQL}
SELECT user_id, day, ts, click_value, view_value, purchase_value, complete,
  (click_value IS NOT NULL)::INT || ',' || (view_value IS NOT NULL)::INT || ',' || (purchase_value IS NOT NULL)::INT AS bits
FROM composite""")
def composite_event(i: Inputs) -> DataFrame:
    bits = F.array_join(F.transform("bits", lambda b: b.cast("int").cast("string")), ",")
    return composites(i).withColumn("bits", bits)


@query("expired_event", f"""WITH {FIRST_SQL}, m AS (SELECT max(ts) AS now FROM events)
SELECT user_id, day, composite.ts, (epoch_us(now) - epoch_us(composite.ts)) // 1000 AS age_ms FROM composite, m
WHERE NOT complete AND epoch_us(now) - epoch_us(composite.ts) > {FRAME * 5 // 4}""")
def expired_event(i: Inputs) -> DataFrame:
    now = i.events.agg(F.max("ts")).scalar()
    return detectors.expired_event(composites(i), FRAME, now).select("user_id", "day", "ts", "age_ms")


@query("sequence_event", f"""WITH {FIRST_SQL}, w AS (SELECT 4 * 86400 AS w),
s AS (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS sec, count(*) AS n FROM composite WHERE complete GROUP BY ALL),
z AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 345600 PRECEDING AND 1 PRECEDING) AS size FROM s),
r AS (SELECT user_id, sec, (SELECT arg_max(b.size, b.sec) FROM z b WHERE b.user_id = z.user_id AND b.size >= 2
      AND b.sec BETWEEN z.sec + 1 AND z.sec + 345600) AS size FROM z)
SELECT c.user_id, c.day, CAST(r.size AS BIGINT) AS size FROM composite c
JOIN r ON r.user_id = c.user_id AND r.sec = CAST(floor(epoch(c.ts)) AS BIGINT)
WHERE c.complete AND r.size IS NOT NULL""")
def sequence_event(i: Inputs) -> DataFrame:
    """At least two complete days within four days."""
    complete = composites(i).filter("complete")
    return detectors.sequence_event(complete, ["user_id"], "ts", 4 * 86400, 2).select(
        "user_id", "day", "size"
    )


def moments_sql(buckets: str, seconds: int) -> str:
    """The fold over the listed frame, written out element by element."""
    return f"""fr AS (SELECT *, list({{'s': sec, 'v': v}}) OVER (PARTITION BY event_type ORDER BY sec
  RANGE BETWEEN {seconds} PRECEDING AND 1 PRECEDING) AS l FROM {buckets}),
st AS (SELECT event_type, sec, l, l[1].v AS v1, l[2].v AS v2, l[2].s - l[1].s AS k2,
  1 + l[len(l)].s - l[1].s AS n, list_sum([x.v for x in l]) AS window_sum FROM fr WHERE len(l) > 0),
mo AS (SELECT event_type, sec, n, window_sum, coalesce(CASE WHEN len(l) = 1 THEN v1
    WHEN v1 > 0 THEN (v1 + v2) / 2 * (k2 + 1) + coalesce(list_sum([l[i].v * (l[i].s - l[i-1].s) for i in range(3, len(l) + 1)]), 0)
    ELSE v1 + list_sum([l[i].v * (l[i].s - l[i-1].s) for i in range(2, len(l) + 1)]) END, 0) AS s1,
  CASE WHEN len(l) = 1 THEN v1 * v1
    WHEN v1 > 0 THEN (v1 * v1 + v2 * v2) * (k2 // 2 + 1) + coalesce(list_sum([l[i].v * l[i].v * (l[i].s - l[i-1].s) for i in range(3, len(l) + 1)]), 0)
    ELSE v1 * v1 + list_sum([l[i].v * l[i].v * (l[i].s - l[i-1].s) for i in range(2, len(l) + 1)]) END AS s2
  FROM st),
moments AS (SELECT event_type, sec, n, s1 / n AS mean, s2 / n - (s1 / n) * (s1 / n) AS variance, window_sum FROM mo)"""


BUCKETS_SQL = "b AS (SELECT event_type, CAST(floor(epoch(ts)) AS BIGINT) AS sec, sum(value) AS v FROM events GROUP BY ALL)"


@query("time_weighted_moments", f"""WITH {BUCKETS_SQL}, {moments_sql('b', 4 * 3600)}
SELECT event_type, sec, CAST(n AS BIGINT) AS n, round(mean, 4) AS mean, round(variance, 4) AS variance FROM moments""")
def time_weighted_moments(i: Inputs) -> DataFrame:
    buckets = detectors.second_buckets(i.events, KINDS, "ts", F.col("value"))
    return detectors.time_weighted_moments(buckets, KINDS, 4 * 3600).select(
        "event_type", "sec", "n", F.round("mean", 4).alias("mean"),
        F.round("variance", 4).alias("variance"),
    )


@query("rate_event", f"""WITH
b AS (SELECT event_type, CAST(floor(epoch(ts)) AS BIGINT) - 7200 AS sec, CAST(count(*) AS DOUBLE) AS v FROM events GROUP BY ALL),
{moments_sql('b', 4 * 3600)}
SELECT event_type, CAST(sec // 7200 * 7200000 AS BIGINT) AS frame_id, round(arg_max(mean, sec), 6) AS mean,
       arg_max(window_sum, sec) / 2 AS rate_sum FROM moments GROUP BY ALL""")
def rate_event(i: Inputs) -> DataFrame:
    return detectors.rate_event(i.events, KINDS, "ts", 7200).withColumn("mean", F.round("mean", 6))


@query("value_aggregate", f"""WITH {FIRST_SQL}
SELECT user_id, day, round(click_value + view_value + purchase_value, 6) AS value FROM composite WHERE complete""")
def value_aggregate(i: Inputs) -> DataFrame:
    return detectors.value_aggregate(composites(i), NAMES).select(
        "user_id", "day", F.round("value", 6).alias("value")
    )


@query("value_log_ratio", f"""WITH {FIRST_SQL}
SELECT user_id, day, round(ln(click_value / view_value), 6) AS value FROM composite
WHERE complete AND abs(ln(click_value / view_value)) > 1.0""")
def value_log_ratio(i: Inputs) -> DataFrame:
    return detectors.value_log_ratio(composites(i), "click", "view", 1.0).select(
        "user_id", "day", F.round("value", 6).alias("value")
    )


@query("value_stdev", f"""WITH {BUCKETS_SQL}, {moments_sql('b', 4 * 3600)}
SELECT event_id, e.event_type, round(abs(value - mean) / sqrt(variance), 4) AS deviation
FROM events e JOIN moments m ON m.event_type = e.event_type AND m.sec = CAST(floor(epoch(ts)) AS BIGINT)
WHERE CASE WHEN variance > 0 AND n > 2 THEN abs(value - mean) / sqrt(variance) > 2.0 ELSE false END""")
def value_stdev(i: Inputs) -> DataFrame:
    return detectors.value_stdev(i.events, KINDS, "ts", "value", 4 * 3600, 2.0).select(
        "event_id", "event_type", F.round("deviation", 4).alias("deviation")
    )


@query("sliding_sum", f"""WITH {ARRIVALS_SQL},
seen AS (SELECT *, max(ts) OVER (PARTITION BY event_type ORDER BY arrival, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM arrivals),
b AS (SELECT event_type, CAST(floor(epoch(ts)) AS BIGINT) AS sec, sum(value) AS v FROM seen
      WHERE newest IS NULL OR ts >= newest - INTERVAL 2 HOUR GROUP BY ALL)
SELECT event_type, sec, round(coalesce(sum(v) OVER (PARTITION BY event_type ORDER BY sec
  RANGE BETWEEN 7200 PRECEDING AND 1 PRECEDING), 0), 4) AS window_sum FROM b""")
def sliding_sum(i: Inputs) -> DataFrame:
    return detectors.sliding_sum(
        i.arrivals(), KINDS, "ts", F.col("value"), 7200, ["arrival", "event_id"], F.col("arrival")
    ).withColumn("window_sum", F.round("window_sum", 4))
