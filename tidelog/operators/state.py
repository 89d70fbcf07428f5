"""Questions to a materialised table of state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.aggregate import latest_rows
from tidelog.operators.orders import FAILED, VALIDATED


def state_get(store: DataFrame, key: str, wanted) -> DataFrame:
    """Point lookup."""
    return store.filter(F.col(key) == wanted)


def state_all(store: DataFrame) -> DataFrame:
    return store


def state_range(store: DataFrame, key: str, low, high) -> DataFrame:
    """Keys from ``low`` to ``high``, both included."""
    return store.filter(F.col(key).between(low, high))


def state_window_fetch(
    store: DataFrame, key: str, wanted, first: Column, last: Column
) -> DataFrame:
    """Windows of one key starting in ``[first, last]``, named ``key@startMillis``."""
    found = store.filter((F.col(key) == wanted) & F.col("start").between(first, last))
    name = F.concat(F.col(key).cast("string"), F.lit("@"), F.unix_millis("start").cast("string"))
    return found.withColumn("window_key", name)


def state_session_fetch(store: DataFrame, key: str, wanted) -> DataFrame:
    return store.filter(F.col(key) == wanted)


def await_state(
    orders: DataFrame, key: str, order: Sequence[str], states: Sequence[str] = (VALIDATED, FAILED)
) -> DataFrame:
    """Newest version of each order, once it has reached a final state."""
    return latest_rows(orders, [key], order).filter(F.col("state").isin(*states))
