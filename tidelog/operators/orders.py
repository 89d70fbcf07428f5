"""Order validation: detail checks, fraud, inventory, the verdict and the notification."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from tidelog.operators.aggregate import first_rows
from tidelog.operators.joins import interval_join
from tidelog.operators.windows import MINUTE
from tidelog.plans.ordered import ROWS_PER_CHUNK, KeyedOrder, micros

# States, results, check names and limits of the validation services.
CREATED, VALIDATED, FAILED = "CREATED", "VALIDATED", "FAILED"
PASS, FAIL = "PASS", "FAIL"
ORDER_DETAILS_CHECK, FRAUD_CHECK, INVENTORY_CHECK = (
    "ORDER_DETAILS_CHECK",
    "FRAUD_CHECK",
    "INVENTORY_CHECK",
)
FRAUD_LIMIT = 2000
RULES = 3

ORDER_COLUMNS = ["id", "customer_id", "state", "product", "quantity", "price", "ts"]


def _created(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("state") == CREATED)


def _verdict(ok: Column) -> Column:
    return F.when(ok, F.lit(PASS)).otherwise(F.lit(FAIL))


def order_details_check(orders: DataFrame) -> DataFrame:
    """Valid fields of new orders: customer and product set, quantity and price not negative."""
    ok = (
        F.col("customer_id").isNotNull()
        & F.col("product").isNotNull()
        & F.coalesce(F.col("quantity") >= 0, F.lit(False))
        & F.coalesce(F.col("price") >= 0, F.lit(False))
    )
    return _created(orders).select(
        "id", F.lit(ORDER_DETAILS_CHECK).alias("check_type"), _verdict(ok).alias("result"), "ts"
    )


def exact_amount() -> Column:
    """Quantity times price in decimals of twelve places, the same in batch and stream."""
    return (F.col("quantity").cast("decimal(10,0)") * F.col("price").cast("decimal(24,12)")).cast("decimal(38,12)")


def fraud_check(
    orders: DataFrame,
    gap: int = 60 * MINUTE,
    limit: float = FRAUD_LIMIT,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Spending so far in the customer's session; an order reaching the limit fails.

    The session total is the customer's total so far minus that at the session's start, so one
    ordering of the customer's orders serves both. Decimal sums keep the difference exact.
    """
    at = micros("ts")
    created = _created(orders).withColumn("_amount", exact_amount())
    seen = KeyedOrder.of(created, ["customer_id"], ["ts", "id"], at, rows_per_chunk).running(
        {"_last": ("max", at)}, inclusive=False
    )
    seen = seen.running({"_total": ("sum", F.col("_amount"))})
    opens = F.col("_last").isNull() | (F.col("_last") < at - F.lit(gap))
    base = F.when(opens, F.col("_total") - F.coalesce("_amount", F.lit(0)))
    seen = seen.running({"_base": ("last", base)})
    total = (F.col("_total") - F.col("_base")).cast("double")
    return seen.result().select(
        "id",
        F.lit(FRAUD_CHECK).alias("check_type"),
        _verdict(total < limit).alias("result"),
        total.alias("session_total"),
        "ts",
    )


def inventory_reserve(
    orders: DataFrame,
    stock: DataFrame,
    order: Sequence[str],
    position: Column,
    product: str = "product",
    quantity: str = "quantity",
    available: str = "stock",
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Reserve stock in order of arrival; an order that does not fit reserves nothing.

    Quantities are whole numbers; ``order`` is total, ``position`` its leading number. A
    negative quantity fails and reserves nothing, and orders for unknown products are dropped.

    One product may have any number of orders, so they are not replayed one by one:

    1. Orders above the whole stock fail. While the running sum of the others stays within
       the stock, they pass; this is a chunked running sum.
    2. From the first order that does not fit, ``r`` units are left. Orders above ``r`` fail.
       Once an order of quantity ``q`` has failed, every later order of that quantity fails,
       so only the first ``r div q`` of them can pass. At most about ``r * ln(r)`` candidates
       remain per product, a bound set by the largest order and not by the number of orders.
    3. Those candidates are replayed in one sorted pass that holds what is left of one product.
    """
    named = stock.select(F.col(product), F.col(available).cast("bigint").alias("_stock"))
    asked = orders.join(named, product).withColumn("_q", F.col(quantity).cast("bigint"))
    fits = F.when(F.col("_q").between(0, F.col("_stock")), F.col("_q"))
    keyed = KeyedOrder.of(asked, [product], order, position, rows_per_chunk)
    keyed = keyed.running({"_n": ("count", F.lit(1)), "_sum": ("sum", fits)})
    # Sums never fall: the largest within the stock is what went out before the first that is not.
    within = F.coalesce(F.col("_sum") <= F.greatest("_stock", F.lit(0)), F.lit(True))
    sums = keyed.running({"_out": ("max", F.when(within, F.col("_sum")))}).result()
    left = F.col("_stock") - F.coalesce("_out", F.lit(0))
    candidate = F.coalesce(~within & F.col("_q").between(1, left), F.lit(False))
    ok = F.when(within, fits.isNotNull()).otherwise(F.col("_q").eqNullSafe(0))
    verdict = [*orders.columns, _verdict(ok).alias("result")]
    decided = sums.filter(~candidate).select(*verdict)
    candidates = sums.filter(candidate).withColumn("_left", left)
    by_quantity = ((product, "_q"), ("_n",))
    if keyed.cut:
        lines = KeyedOrder.of(candidates, *by_quantity, F.col("_n"), rows_per_chunk)
    else:
        # Parts of a product cannot be hot when no product is.
        lines = KeyedOrder(candidates, *by_quantity, False)
    ranked = lines.number("_rank").result()
    possible = F.col("_rank") <= F.expr("_left div _q")
    late = ranked.filter(~possible).select(*orders.columns, _verdict(F.lit(False)).alias("result"))
    served = _served(ranked.filter(possible), product)
    replayed = served.select(*orders.columns, _verdict(F.col("_ok")).alias("result"))
    return decided.unionByName(late).unionByName(replayed)


def _served(waiting: DataFrame, product: str) -> DataFrame:
    """First come, first served from what is left of each product; adds ``_ok``."""
    ordered = waiting.repartition(product).sortWithinPartitions(product, "_n")
    schema = StructType([*ordered.schema.fields, StructField("_ok", BooleanType())])

    def serve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, left = None, 0
        for batch in batches:
            verdicts = []
            columns = (batch.column(c).to_pylist() for c in (product, "_left", "_q"))
            for name, rest, asked in zip(*columns):
                if name != current:
                    current, left = name, rest
                verdicts.append(asked <= left)
                left -= asked if asked <= left else 0
            yield batch.append_column("_ok", pa.array(verdicts, pa.bool_()))

    return ordered.mapInArrow(serve, schema)


def inventory_check(orders: DataFrame, stock: DataFrame, **kw) -> DataFrame:
    """Inventory results in the shape of the other checks."""
    reserved = inventory_reserve(
        _created(orders), stock, ["ts", "id"], micros("ts"), **kw
    )
    return reserved.select(
        "id", F.lit(INVENTORY_CHECK).alias("check_type"), "result", "ts"
    )


def validation_aggregate(
    validations: DataFrame, orders: DataFrame, window: int = 5 * MINUTE, rules: int = RULES
) -> DataFrame:
    """New orders with a verdict: VALIDATED when all rules passed within one window, FAILED
    once when any rule failed. Both need the order within ``window`` of the result."""
    slot = F.floor(micros("ts") / F.lit(window))
    passed = (
        validations.filter(F.col("result") == PASS)
        .groupBy("id", slot.alias("_slot"))
        .agg(F.count(F.lit(1)).alias("_n"), F.max("ts").alias("result_ts"))
        .filter(F.col("_n") >= rules)
        .select("id", "result_ts")
    )
    failed = validations.filter(F.col("result") == FAIL).select("id", F.col("ts").alias("result_ts"))
    created = _created(orders)
    near = dict(keys=["id"], left_ts="result_ts", right_ts="ts", before=window, after=window)
    good = interval_join(passed, created, **near).withColumn("state", F.lit(VALIDATED))
    bad = first_rows(
        interval_join(failed, created, **near), ["id"], ["ts", "result_ts"]
    ).withColumn("state", F.lit(FAILED))
    return good.select(*ORDER_COLUMNS).unionByName(bad.select(*ORDER_COLUMNS))


def notify_join(
    orders: DataFrame, payments: DataFrame, customers: DataFrame, span: int = MINUTE
) -> DataFrame:
    """Order with its payment at most ``span`` apart, then the customer's address."""
    paid = payments.select(
        F.col("order_id").alias("id"),
        F.col("id").alias("payment_id"),
        "amount",
        F.col("ts").alias("payment_ts"),
    )
    return interval_join(orders, paid, ["id"], "ts", "payment_ts", span, span).join(
        customers, "customer_id"
    )


def order_end_to_end(
    orders: DataFrame, stock: DataFrame, payments: DataFrame, customers: DataFrame
) -> DataFrame:
    """All checks, the verdict, and a notification for each validated order."""
    checks = (
        order_details_check(orders)
        .unionByName(fraud_check(orders).drop("session_total"))
        .unionByName(inventory_check(orders, stock))
    )
    verdicts = validation_aggregate(checks, orders)
    mailed = notify_join(
        verdicts.filter(F.col("state") == VALIDATED), payments, customers
    ).select("id", "payment_id", "customer_name")
    return verdicts.select("id", "state").join(mailed, "id", "left")
