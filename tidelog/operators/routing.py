"""Subscriptions and exchanges: tags, selectors, routing keys, headers, partitions.

Bindings are configuration given in code, so they are compiled into one expression per frame.
No join and no shuffle is needed to deliver a message.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_tags(df: DataFrame, subscription: str, column: str = "tags") -> DataFrame:
    """Keep rows whose tag is named in ``a || b``; ``*`` keeps all."""
    if subscription.strip() == "*":
        return df
    return df.filter(F.col(column).isin([t.strip() for t in subscription.split("||")]))


def filter_sql(df: DataFrame, selector: str) -> DataFrame:
    """Keep rows for which the SQL selector over the columns is true."""
    return df.filter(F.expr(selector))


def filter_property(df: DataFrame, prop: Column, divisor: int = 10, above: int = 100) -> DataFrame:
    """Keep rows whose numeric property is a multiple of ``divisor`` and above ``above``."""
    number = prop.try_cast("int")
    return df.filter(F.coalesce((number % divisor == 0) & (number > above), F.lit(False)))


def _deliver(df: DataFrame, matches: Sequence[tuple[str, Column]]) -> DataFrame:
    """One output row per distinct queue with a true condition."""
    names = [F.when(F.coalesce(cond, F.lit(False)), F.lit(queue)) for queue, cond in matches]
    return df.withColumn("queue", F.explode(F.array_distinct(F.array_compact(F.array(*names)))))


def route_direct(
    df: DataFrame,
    bindings: Sequence[tuple[str, str]],
    routing_key: str = "routing_key",
    default: str = "info",
) -> DataFrame:
    """Deliver to the queues bound to exactly the message's routing key."""
    key = F.coalesce(F.col(routing_key), F.lit(default))
    return _deliver(df, [(queue, key == bound) for queue, bound in bindings])


def topic_regex(pattern: str) -> str:
    """Dot-separated words where ``*`` stands for one word and ``#`` for any number."""
    words = pattern.split(".")
    if set(words) == {"#"}:
        return "^.*$"
    out, need_dot = "^", False
    for word in words:
        if word == "#":
            out += r"(\.[^.]+)*" if need_dot else r"([^.]+\.)*"
        else:
            out += (r"\." if need_dot else "") + ("[^.]+" if word == "*" else re.escape(word))
            need_dot = True
    return out + "$"


def route_topic(
    df: DataFrame, bindings: Sequence[tuple[str, str]], routing_key: str = "routing_key"
) -> DataFrame:
    """Deliver by word patterns; a queue with several matching patterns gets one copy."""
    key = F.col(routing_key)
    return _deliver(df, [(queue, key.rlike(topic_regex(p))) for queue, p in bindings])


def route_headers(
    df: DataFrame, bindings: Sequence[tuple[str, Mapping[str, str]]], headers: str = "headers"
) -> DataFrame:
    """Deliver where every bound header has the bound value in the message."""
    matches = []
    for queue, bound in bindings:
        cond = F.lit(True)
        for name, value in bound.items():
            cond = cond & (F.col(headers)[name] == value)
        matches.append((queue, cond))
    return _deliver(df, matches)


def route_fanout(df: DataFrame, queues: Sequence[str]) -> DataFrame:
    """Copy to every queue."""
    return df.withColumn("queue", F.explode(F.array(*[F.lit(q) for q in queues])))


def retopic(df: DataFrame, prefix: str) -> DataFrame:
    """Send on to ``prefix.topic``, keeping partition, key and value."""
    return df.withColumn("topic", F.concat(F.lit(prefix + "."), F.col("topic")))


def suffix_partition(key: Column, partitions: int) -> Column:
    """Number after the last dot modulo ``partitions``; 0 without a dot after the first place."""
    suffix = F.substring_index(key, ".", -1).try_cast("int")
    dotted = F.length(key) - F.length(F.substring_index(key, ".", -1)) > 1
    return F.when(dotted, suffix % F.lit(partitions)).otherwise(F.lit(0)).cast("int")


def partition_by_suffix(
    df: DataFrame, partitions: int, key: str = "key", *, move: bool = False
) -> DataFrame:
    """Assign the partition; ``move`` also brings its rows together.

    A partition may hold any share of the table, so it is spread over tasks by key: rows of one
    key stay in one task.
    """
    placed = df.withColumn("partition", suffix_partition(F.col(key), partitions))
    return placed.repartition("partition", key) if move else placed


def ordered_queue(
    df: DataFrame, queues: int, key: str, order: Sequence[str] = (), *, move: bool = False
) -> DataFrame:
    """Queue ``key % queues``: one key always uses one queue and so keeps its order.

    ``move`` sorts each queue over as many tasks as it needs: tasks hold ranges of the order, one
    after another.
    """
    placed = df.withColumn("queue", F.pmod(F.col(key), F.lit(queues)).cast("int"))
    if not move:
        return placed
    return placed.repartitionByRange("queue", *order).sortWithinPartitions("queue", *order)


def key_partition_changes(log: DataFrame, arrival: str = "arrival") -> DataFrame:
    """Rows found on another partition than the first row of their key.

    The first partition is one aggregated row per key, so a long key is never sorted.
    """
    first = log.groupBy("key").agg(F.min_by("partition", arrival).alias("first_partition"))
    return log.join(first, "key").filter(F.col("partition") != F.col("first_partition"))
