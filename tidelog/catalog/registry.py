"""Registration of queries and the frames they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.sources import tables
from tidelog.sources.log import as_log
from tidelog.sources.scratch import scratch_dir
from tidelog.streaming.stateful import Lateness

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
SQL: dict[str, str] = {}

MINUTE, HOUR, DAY = 60_000_000, 3_600_000_000, 86_400_000_000


class Inputs:
    """Lazy access to the tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in tables.SCHEMAS:
            raise AttributeError(name)
        return tables.load(self.spark, self.sf_dir, name)

    def wide(self, name: str) -> DataFrame:
        return tables.load_wide(self.spark, self.sf_dir, name)

    def stream(self, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
        return tables.load_stream(self.spark, self.sf_dir, name, max_files_per_trigger)

    def span(self, name: str, ts: str) -> str:
        """A watermark delay that covers a whole table, however its files are ordered."""
        ends = F.unix_micros(F.max(ts)) - F.unix_micros(F.min(ts))
        micros = getattr(self, name).agg(ends).first()[0] or 0
        return f"{micros // 1_000_000 + 1} seconds"

    def late(self, name: str, position: str, more: int = 0) -> Lateness:
        """Rows may be as late as the table is long, however its files are ordered. A live stream
        knows its disorder and passes that."""
        table = getattr(self, name)
        stamped = isinstance(table.schema[position].dataType, T.TimestampType)
        at = F.unix_micros(position) if stamped else F.col(position)
        length = table.agg(F.max(at) - F.min(at)).first()[0] or 0
        return Lateness(length + more, scratch_dir(self.spark, "end"))

    def kind(self, event_type: str) -> DataFrame:
        return self.events.filter(F.col("event_type") == event_type)

    def log(self) -> DataFrame:
        """The events as a broker log of four partitions."""
        return as_log(
            self.events,
            topic="events",
            partitions=4,
            partition_key=F.col("user_id"),
            arrival="event_id",
            key=F.col("user_id").cast("string"),
            value=F.col("event_type"),
        )

    def arrivals(self) -> DataFrame:
        """Events where every 17th arrives 40 places late."""
        late = F.when(F.col("event_id") % 17 == 0, 40).otherwise(0)
        return self.events.withColumn("arrival", F.col("event_id") + late)

    def changelog(self) -> DataFrame:
        """Last event type per user as a table changelog; an error deletes the user."""
        value = F.when(F.col("event_type") != "error", F.col("event_type"))
        return self.events.select("user_id", value.alias("event_type"), "ts", "event_id", "value")

    def regions(self) -> DataFrame:
        """Region of each user, through customer and nation."""
        return (
            self.customer.join(self.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("c_custkey").alias("user_id"), F.col("r_name").alias("region"))
        )


# The same frames for the checks.
LOG_SQL = """log AS (
  SELECT 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS partition,
         row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS "offset",
         ts, CAST(user_id AS VARCHAR) AS key, event_type AS value
  FROM events)"""
ARRIVALS_SQL = """arrivals AS (
  SELECT *, event_id + CASE WHEN event_id % 17 = 0 THEN 40 ELSE 0 END AS arrival FROM events)"""
CHANGELOG_SQL = """changelog AS (
  SELECT user_id, CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
         ts, event_id, value FROM events)"""
REGIONS_SQL = """regions AS (
  SELECT c_custkey AS user_id, r_name AS region FROM customer
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def bucket_sql(ts: str, micros: int) -> str:
    """Start of the epoch-aligned window of an instant."""
    return f"make_timestamp(epoch_us({ts}) // {micros} * {micros})"


def wall_clock(df: DataFrame) -> DataFrame:
    """Instants as wall-clock timestamps, the type the input tables use."""
    cols = [
        F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.TimestampType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*cols)


def query(name: str, sql: str | None = None):
    """Register ``fn(inputs) -> DataFrame`` under ``name``."""

    def add(fn: Callable[[Inputs], DataFrame]):
        REGISTRY[name] = lambda spark, sf_dir: wall_clock(fn(Inputs(spark, sf_dir)))
        if sql is not None:
            SQL[name] = sql
        return fn

    return add
