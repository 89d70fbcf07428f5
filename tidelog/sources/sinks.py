"""Streaming and batch sinks.

Every ``foreachBatch`` sink writes below ``batch=<id>`` with overwrite. A batch that is retried
after a failure therefore replaces its own earlier output and never adds to it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.aggregate import latest_rows
from tidelog.sources.log import offset_bounds, resume_from_offset
from tidelog.sources.scratch import scratch_dir, through


SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
# A stream's shuffles have so many partitions a core, and at least the second number of them, but no more than the session sets.
PARTITIONS_PER_CORE, LEAST_PARTITIONS = 2, 32


def _run(spark: SparkSession, writer, checkpoint: str) -> None:
    """Process all there is. Each trigger opens the state of each partition and starts its worker, whether it has rows or not, and Spark
    does not merge such partitions; so a new stream gets as many as keep the cores busy."""
    wanted = spark.conf.get(SHUFFLE_PARTITIONS)
    enough = max(LEAST_PARTITIONS, PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism)
    spark.conf.set(SHUFFLE_PARTITIONS, str(min(int(wanted), enough)))
    try:
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(SHUFFLE_PARTITIONS, wanted)
    query.awaitTermination()


def sink_append(df: DataFrame, path: str, checkpoint: str) -> None:
    """Append a stream to a typed table; the file sink commits each micro-batch once."""
    _run(df.sparkSession, df.writeStream.outputMode("append").format("parquet").option("path", path), checkpoint)


def pipe(df: DataFrame, path: str, checkpoint: str) -> None:
    """Copy a stream unchanged."""
    sink_append(df, path, checkpoint)


def write_batch(batch: DataFrame, path: str, batch_id: int) -> None:
    batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def sink_idempotent(
    df: DataFrame, path: str, checkpoint: str, mode: str = "append"
) -> None:
    """Exactly-once output: each micro-batch owns one folder and overwrites it on retry."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id)

    _run(df.sparkSession, df.writeStream.outputMode(mode).foreachBatch(write), checkpoint)


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All micro-batches written so far, with their number in ``batch``."""
    with_batch = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(with_batch).parquet(path)


def sink_complete(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Write the whole result at each trigger and return the newest one."""
    sink_idempotent(df, path, checkpoint, mode="complete")
    written = read_batches(df.sparkSession, path, df.schema)
    # The batch number is a folder name: finding and reading the newest prunes all others.
    newest = written.agg(F.max("batch")).scalar()
    return written.filter(F.col("batch") == newest).drop("batch")


def sink_upsert(
    df: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: Sequence[str]
) -> None:
    """Last write wins by key. Each micro-batch stores the newest row per key it saw; readers
    merge the batches, so a write costs as much as its batch and not as the whole table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(latest_rows(batch, keys, order), path, batch_id)

    _run(df.sparkSession, df.writeStream.outputMode("append").foreachBatch(write), checkpoint)


def read_upserted(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Current row per key of an upsert sink."""
    return latest_rows(read_batches(spark, path, schema).drop("batch"), keys, order)


def compact_upserted(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    order: Sequence[str],
    target: str,
) -> None:
    """Write the merged state as the first batch of a new folder."""
    write_batch(read_upserted(spark, path, schema, keys, order), target, 0)


def end_of_input(spark: SparkSession, end: str) -> DataFrame:
    """A stream of one column, ``_time``, that is empty until ``close_input`` is called."""
    spark.range(0).select(F.timestamp_micros("id").alias("_time")).write.mode("ignore").parquet(end)
    return spark.readStream.schema("_time timestamp").parquet(end)


def close_input(spark: SparkSession, end: str) -> None:
    """Say that no more rows come: a last instant moves the watermark over all rows that wait."""
    last = spark.range(1).select(F.to_timestamp(F.lit("2262-01-01")).alias("_time"))
    last.write.mode("append").parquet(end)


def run_available_now(
    df: DataFrame, mode: str, label: str = "run", end: str | None = None
) -> DataFrame:
    """Process everything a stream has now and return what it emitted.

    ``append`` and ``update`` return every emitted row, ``complete`` the last result. ``end`` is
    the folder of ``Lateness``: the input is then taken as finished, and the query resumed once more.
    """
    spark = df.sparkSession
    path, checkpoint = scratch_dir(spark, f"{label}-out"), scratch_dir(spark, f"{label}-chk")
    if mode == "complete":
        return sink_complete(df, path, checkpoint)
    sink_idempotent(df, path, checkpoint, mode)
    if end:
        close_input(spark, end)
        sink_idempotent(df, path, checkpoint, mode)
    return read_batches(spark, path, df.schema).drop("batch")


def restart_from_scratch(build: Callable[[], DataFrame], mode: str) -> tuple[DataFrame, DataFrame]:
    """Run the same query twice with fresh state and offsets."""
    return (
        run_available_now(build(), mode, "first"),
        run_available_now(build(), mode, "second"),
    )


def save_offsets(bounds: DataFrame, store: str, version: int) -> None:
    bounds.select("partition", (F.col("latest") - 1).alias("saved_offset")).write.mode(
        "overwrite"
    ).parquet(f"{store}/version={version}")


def deliver(
    log: DataFrame,
    saved: DataFrame,
    store: str,
    version: int,
    work: Callable[[DataFrame], None],
    mode: str,
) -> None:
    """Process the rows after the saved offsets.

    ``at_least_once`` commits after the work: a crash in between repeats rows.
    ``at_most_once`` commits before it: a crash in between loses rows.
    The offsets committed are those of the rows handed to ``work``, even while the log grows.
    """
    pending = resume_from_offset(log, saved)
    bounds = through(offset_bounds(pending), scratch_dir(log.sparkSession, "bounds"))
    fixed = (
        pending.join(bounds.select("partition", "latest"), "partition")
        .filter(F.col("offset") < F.col("latest"))
        .drop("latest")
    )
    if mode == "at_least_once":
        work(fixed)
        save_offsets(bounds, store, version)
    elif mode == "at_most_once":
        save_offsets(bounds, store, version)
        work(fixed)
    else:
        raise ValueError(f"unknown delivery mode {mode!r}")
