"""Sources, sinks and offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.catalog.registry import LOG_SQL, Inputs, query
from tidelog.operators import aggregate, records
from tidelog.sources import log, sinks
from tidelog.sources.scratch import scratch_dir, through

EVENTS_SQL = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
RANGES = {0: (10, 50), 1: (10, 50), 2: (0, 0), 3: (45, 10_000_000)}


@query("source_scan", EVENTS_SQL)
def source_scan(i: Inputs) -> DataFrame:
    return i.events


@query("read_stream", EVENTS_SQL)
def read_stream(i: Inputs) -> DataFrame:
    return sinks.run_available_now(i.stream("events"), "append", "read-stream")


@query("read_table", """
SELECT user_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id""")
def read_table(i: Inputs) -> DataFrame:
    rows = i.events.select("user_id", "ts", "event_id", "value")
    return aggregate.read_table(rows, ["user_id"], ["ts", "event_id"], "value").select(
        "user_id", "value"
    )


@query("log_table", f"""WITH {LOG_SQL}
SELECT topic, partition, "offset", ts, key, value FROM log""")
def log_table(i: Inputs) -> DataFrame:
    return i.log()


@query("offset_range_scan", f"""WITH {LOG_SQL}
SELECT topic, partition, "offset", ts, key, value FROM log
WHERE (partition IN (0, 1) AND "offset" >= 10 AND "offset" < 50)
   OR (partition = 3 AND "offset" >= 45)""")
def offset_range_scan(i: Inputs) -> DataFrame:
    return log.offset_range_scan(i.log(), RANGES, expected={0, 1, 2, 3})


@query("offset_bounds", f"""WITH {LOG_SQL}
SELECT partition, min("offset") AS earliest, max("offset") + 1 AS latest FROM log GROUP BY 1""")
def offset_bounds(i: Inputs) -> DataFrame:
    return log.offset_bounds(i.log())


@query("resume_from_offset", f"""WITH {LOG_SQL},
saved AS (SELECT partition, max("offset") AS saved_offset FROM log
          WHERE partition <> 2 AND ts < TIMESTAMP '2024-01-20' GROUP BY 1)
SELECT log.* FROM log LEFT JOIN saved USING (partition)
WHERE "offset" >= coalesce(saved_offset + 1, 0)""")
def resume_from_offset(i: Inputs) -> DataFrame:
    whole = i.log()
    done = whole.filter("partition <> 2 AND ts < TIMESTAMP '2024-01-20'")
    saved = done.groupBy("partition").agg(F.max("offset").alias("saved_offset"))
    return log.resume_from_offset(whole, saved).select(*whole.columns)


@query("drop_replayed", f"""WITH {LOG_SQL},
sent AS (SELECT *, "offset" * 2 AS arrival FROM log
         UNION ALL SELECT *, ("offset" + 7) * 2 + 1 AS arrival FROM log WHERE "offset" % 10 < 3),
seen AS (SELECT *, max("offset") OVER (PARTITION BY partition ORDER BY arrival
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM sent)
SELECT partition, "offset", arrival, key FROM seen WHERE high IS NULL OR "offset" >= high""")
def drop_replayed(i: Inputs) -> DataFrame:
    """Some offsets are sent a second time, seven places later."""
    first = i.log().withColumn("arrival", F.col("offset") * 2)
    again = i.log().filter("offset % 10 < 3").withColumn("arrival", (F.col("offset") + 7) * 2 + 1)
    return log.drop_replayed(first.unionByName(again)).select(
        "partition", "offset", "arrival", "key"
    )


@query("pipe", EVENTS_SQL)
def pipe(i: Inputs) -> DataFrame:
    out, chk = scratch_dir(i.spark, "pipe"), scratch_dir(i.spark, "pipe-chk")
    source = i.stream("events")
    sinks.pipe(source, out, chk)
    return i.spark.read.schema(source.schema).parquet(out)


@query("through", """
SELECT event_type, count(*) AS cnt FROM events GROUP BY 1""")
def through_table(i: Inputs) -> DataFrame:
    kept = through(i.events, scratch_dir(i.spark, "through"))
    return aggregate.group_count(kept, ["event_type"])


@query("sink_append", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders""")
def sink_append(i: Inputs) -> DataFrame:
    out, chk = scratch_dir(i.spark, "append"), scratch_dir(i.spark, "append-chk")
    done = i.stream("orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"
    )
    sinks.sink_append(done, out, chk)
    return i.spark.read.schema(done.schema).parquet(out)


@query("sink_upsert", """
SELECT user_id, arg_max(event_id, event_id) AS event_id, arg_max(value, event_id) AS value
FROM events GROUP BY 1""")
def sink_upsert(i: Inputs) -> DataFrame:
    out, chk = scratch_dir(i.spark, "upsert"), scratch_dir(i.spark, "upsert-chk")
    rows = i.stream("events").select("user_id", "event_id", "value")
    sinks.sink_upsert(rows, out, chk, ["user_id"], ["event_id"])
    return sinks.read_upserted(i.spark, out, rows.schema, ["user_id"], ["event_id"])


@query("sink_complete", "SELECT event_type, count(*) AS cnt FROM events GROUP BY 1")
def sink_complete(i: Inputs) -> DataFrame:
    counts = aggregate.group_count(i.stream("events"), ["event_type"])
    return sinks.run_available_now(counts, "complete", "complete")


@query("sink_fanout", """
SELECT event_id, upper(event_type) AS value, 'upper' AS "out" FROM events
UNION ALL SELECT event_id, lower(event_type), 'lower' FROM events""")
def sink_fanout(i: Inputs) -> DataFrame:
    return records.fanout_values(
        i.events,
        {
            "upper": [F.col("event_id"), F.upper("event_type").alias("value")],
            "lower": [F.col("event_id"), F.lower("event_type").alias("value")],
        },
    )


@query("sink_idempotent", "SELECT event_id, user_id FROM events")
def sink_idempotent(i: Inputs) -> DataFrame:
    """Run twice from one checkpoint and write the first batch again: nothing is doubled."""
    out, chk = scratch_dir(i.spark, "once"), scratch_dir(i.spark, "once-chk")
    for _ in range(2):
        sinks.sink_idempotent(i.stream("events").select("event_id", "user_id"), out, chk)
    schema = i.events.select("event_id", "user_id").schema
    batches = sinks.read_batches(i.spark, out, schema)
    first = through(batches.filter("batch = 0").drop("batch"), scratch_dir(i.spark, "once-first"))
    sinks.write_batch(first, out, 0)
    return sinks.read_batches(i.spark, out, schema).drop("batch")


@query("delivery_at_least_once", f"""WITH {LOG_SQL}
SELECT partition, "offset", CAST(2 AS BIGINT) AS times FROM log""")
def delivery_at_least_once(i: Inputs) -> DataFrame:
    return _delivered_with_crash(i, "at_least_once")


@query("delivery_at_most_once", f"""WITH {LOG_SQL}
SELECT partition, "offset", CAST(1 AS BIGINT) AS times FROM log""")
def delivery_at_most_once(i: Inputs) -> DataFrame:
    return _delivered_with_crash(i, "at_most_once")


def _delivered_with_crash(i: Inputs, mode: str) -> DataFrame:
    """How often each row was delivered when the first run stops right after its work.

    Committing after the work repeats the rows; committing before it does not.
    """
    rows = through(i.log(), scratch_dir(i.spark, "log"))
    out, store = scratch_dir(i.spark, "sent"), scratch_dir(i.spark, "offsets")
    nothing = log.offset_bounds(rows).filter("false").selectExpr(
        "partition", "latest AS saved_offset"
    )
    runs = iter((0, 1))

    def work(batch: DataFrame) -> None:
        sinks.write_batch(batch.select("partition", "offset"), out, run)
        if run == 0:
            raise ConnectionError("stopped after the work")

    saved = nothing
    for run in runs:
        try:
            sinks.deliver(rows, saved, store, run, work, mode)
        except ConnectionError:
            if mode == "at_most_once":
                saved = i.spark.read.schema(nothing.schema).parquet(f"{store}/version={run}")
    sent = sinks.read_batches(i.spark, out, rows.select("partition", "offset").schema)
    return sent.groupBy("partition", "offset").agg(F.count(F.lit(1)).alias("times"))


@query("restart_from_scratch", """
SELECT event_type, count(*) AS cnt, run FROM events, (VALUES ('first'), ('second')) t(run)
GROUP BY ALL""")
def restart_from_scratch(i: Inputs) -> DataFrame:
    first, second = sinks.restart_from_scratch(
        lambda: aggregate.group_count(i.stream("events"), ["event_type"]), "complete"
    )
    return first.withColumn("run", F.lit("first")).unionByName(
        second.withColumn("run", F.lit("second"))
    )
