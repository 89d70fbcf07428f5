"""Declared table schemas and loaders (no schema inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidelog.session import prepare

# Wall-clock columns are declared TIMESTAMP: watermarks need instants, and declaring the type
# in the read schema (instead of casting) keeps time predicates pushable to the scan.
SCHEMAS: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, "
    "props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Batch scan of one table."""
    return prepare(spark).read.schema(SCHEMAS[name]).parquet(table_path(sf_dir, name))


def load_wide(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Batch scan for costly work per row.

    A file with one row group is read by one task, and everything up to the next shuffle would
    run on one core. A table with at least as many partitions as cores is left as it is.
    """
    df = load(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


# Keeps the rows of one key within what a task can sort, whatever the table's size.
BYTES_PER_TRIGGER = 1 << 30


def load_stream(
    spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same table as an unbounded stream of files, a bounded number of bytes at a time."""
    # A glob accepts a table stored as one file as well as one stored as a folder of parts.
    path = f"{sf_dir.rstrip('/')}/{{{name}}}.parquet"
    return read_stream(prepare(spark), path, SCHEMAS[name], max_files_per_trigger)


def read_stream(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Follow a folder of parquet files from its earliest file."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    else:
        reader = reader.option("maxBytesPerTrigger", BYTES_PER_TRIGGER)
    return reader.parquet(path)


def read_broker(
    spark: SparkSession,
    servers: str,
    *,
    subscribe: str | None = None,
    pattern: str | None = None,
    assign: str | None = None,
    starting: str = "earliest",
    ending: str | None = None,
    streaming: bool = True,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Subscribe to broker topics by list, pattern or explicit partitions.

    Needs Spark's broker connector on the class path. TLS and SASL are plain ``options``.
    """
    chosen = {"subscribe": subscribe, "subscribePattern": pattern, "assign": assign}
    given = {k: v for k, v in chosen.items() if v is not None}
    if len(given) != 1:
        raise ValueError("give exactly one of subscribe, pattern, assign")
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    reader = reader.option("kafka.bootstrap.servers", servers).option("startingOffsets", starting)
    if ending is not None:
        reader = reader.option("endingOffsets", ending)
    return reader.options(**given, **(options or {})).load().selectExpr(
        "topic",
        "partition",
        "offset",
        "timestamp AS ts",
        "CAST(key AS STRING) AS key",
        "CAST(value AS STRING) AS value",
    )
