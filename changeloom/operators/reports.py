"""The five reports, top-k lists and table statistics.

Inputs are typed rows (orders: ``customer_id, total_amount, event_ts``; items: ``product_id,
quantity, price``) after the operation filter of the report.  All aggregates combine map-side.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.times import as_timestamp
from .state import order_status_distribution

TOP_N = 100  # fixed value: length of the top lists


def daily_sales(orders: DataFrame, day: Column | str = "created_at") -> DataFrame:
    day = F.col(day) if isinstance(day, str) else day
    return orders.groupBy(F.to_date(day).alias("date")).agg(
        F.sum("total_amount").alias("total_amount"), F.count(F.lit(1)).alias("order_count")
    )


def product_sales(items: DataFrame) -> DataFrame:
    return items.groupBy("product_id").agg(
        F.sum(F.col("quantity").cast("bigint")).alias("quantity_sold"),
        F.sum(F.col("price") * F.col("quantity")).alias("total_revenue"),
    )


def customer_metrics(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("total_amount").alias("total_spent")
    )


def top_products(items: DataFrame, n: int = TOP_N) -> DataFrame:
    """Best sellers by revenue; ties by ascending id."""
    return product_sales(items).orderBy(F.desc("total_revenue"), F.asc("product_id")).limit(n)


def top_customers(orders: DataFrame, n: int = TOP_N) -> DataFrame:
    """Best customers by spend; ties by ascending id."""
    return customer_metrics(orders).orderBy(F.desc("total_spent"), F.asc("customer_id")).limit(n)


def _numbers(orders: DataFrame, items: DataFrame) -> DataFrame:
    by_customer = customer_metrics(orders).agg(
        F.sum("order_count").alias("total_orders"),
        F.sum("total_spent").alias("total_revenue"),
        F.count(F.lit(1)).alias("unique_customers"),
    )
    by_product = items.groupBy("product_id").count().agg(
        F.count(F.lit(1)).alias("unique_products_sold")
    )
    # Both sides are one row, so they can be united and folded instead of joined.
    return by_customer.unionByName(by_product, allowMissingColumns=True).agg(
        F.coalesce(F.max("total_orders"), F.lit(0)).alias("total_orders"),
        F.coalesce(F.max("total_revenue"), F.lit(0)).alias("total_revenue"),
        F.max("unique_customers").alias("unique_customers"),
        F.max("unique_products_sold").alias("unique_products_sold"),
    )


def summary(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row: orders, revenue, distinct customers and products."""
    return _numbers(orders, items)


def summary_with_status(
    orders: DataFrame, items: DataFrame, events: DataFrame, ordering: Sequence[str] | None = None
) -> DataFrame:
    """Summary as rows ``metric, value``, with one ``status:<name>`` row per order status."""
    numbers = _numbers(orders, items)
    named = numbers.select(
        F.explode(
            F.array(*[
                F.struct(F.lit(c).alias("metric"), F.col(c).cast("decimal(38,2)").alias("value"))
                for c in numbers.columns
            ])
        ).alias("m")
    ).select("m.*")
    by_status = order_status_distribution(events, ordering=ordering).select(
        F.concat(F.lit("status:"), "status").alias("metric"),
        F.col("order_count").cast("decimal(38,2)").alias("value"),
    )
    return named.unionByName(by_status)


def table_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(name).alias("table_name"), "record_count"
        )
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def recent_changes(
    frames: Mapping[str, tuple[DataFrame, str]], as_of: datetime | str, minutes: int = 5
) -> DataFrame:
    """Rows per table, and how many changed in the last ``minutes``; the tuple names the time."""
    since = as_timestamp(as_of) - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("total_records"),
            F.count_if(F.col(ts) > since).alias("recent_changes"),
        ).select(F.lit(name).alias("table_name"), "total_records", "recent_changes")
        for name, (df, ts) in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def op_counts(df: DataFrame) -> DataFrame:
    """Events per table and operation."""
    return df.groupBy("table", "operation").agg(F.count(F.lit(1)).alias("events"))
