"""Session factory and the settings every query relies on."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

RUNTIME_SETTINGS = {
    # Timestamps are instants; every epoch-aligned window assumes UTC.
    "spark.sql.session.timeZone": "UTC",
    # Partition counts and join strategies are re-planned from real sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for name, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Workers import it to run patterns and per-key state, also where it is not installed.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tidelog-"), "tidelog.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    packed.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def build_session(
    app: str = "tidelog",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    initial_partitions: int | None = None,
) -> SparkSession:
    """Create a session. On a cluster leave ``master`` unset and let spark-submit choose it.

    Spark merges small shuffle partitions but never splits them for an aggregate, so
    ``initial_partitions`` should be about the largest shuffle in bytes over 128 MB.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if initial_partitions:
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(initial_partitions)
        )
    for name, value in {**RUNTIME_SETTINGS, **(extra or {})}.items():
        builder = builder.config(name, value)
    return prepare(builder.getOrCreate())
