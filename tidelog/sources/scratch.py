"""Shared scratch space for written intermediates and streaming checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the session names in ``spark.checkpoint.dir``.

    A local session without the setting gets a fresh temporary folder. On a cluster a
    machine-local folder would lose data with the machine, so an unset folder is an error.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_SETTING
    )
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="tidelog-")
    spark.conf.set(CHECKPOINT_SETTING, root)
    return root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def through(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate table and continue from it, which also cuts the lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
