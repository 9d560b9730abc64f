"""Joins between orders, items and products.

No side is broadcast by hint: adaptive execution measures both and broadcasts what is small,
and splits skewed partitions of a sort-merge join otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def enrich_items(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items with the product's name and list price."""
    listed = products.select(
        F.col("id").alias("product_id"),
        F.col("name").alias("product_name"),
        F.col("price").alias("list_price"),
    )
    return items.join(listed, "product_id", "inner")


def order_lines(
    orders: DataFrame, items: DataFrame, products: DataFrame, how: str = "inner"
) -> DataFrame:
    """Order, item and product in one row; ``how='left'`` keeps orders without items."""
    o = orders.select(F.col("id").alias("order_id"), "customer_id", "status")
    p = products.select(F.col("id").alias("product_id"), F.col("name").alias("product_name"))
    i = items.select("order_id", "line_number", "product_id", "quantity", "price")
    return o.join(i, "order_id", how).join(p, "product_id", how)


def item_totals(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.sum(F.col("quantity") * F.col("price")).alias("item_total")
    )


def recompute_order_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with ``total_amount`` set to the sum of their items, 0 without items."""
    joined = orders.join(item_totals(items).withColumnRenamed("order_id", "id"), "id", "left")
    total = F.coalesce(F.col("item_total"), F.lit(0)).cast("decimal(38,2)")
    return joined.withColumn("total_amount", total).drop("item_total")


def reconcile_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders whose header total differs from their items."""
    joined = orders.join(item_totals(items).withColumnRenamed("order_id", "id"), "id", "left")
    total = F.coalesce(F.col("item_total"), F.lit(0)).cast("decimal(38,2)")
    return (
        joined.withColumn("item_total", total)
        .filter(F.col("total_amount") != F.col("item_total"))
        .select("id", "total_amount", "item_total")
    )


def orphans(items: DataFrame, parents: DataFrame, key: str, parent_key: str = "id") -> DataFrame:
    """Items whose parent row does not exist."""
    known = parents.select(F.col(parent_key).alias(key))
    return items.join(known, key, "left_anti")


def latest_order(orders: DataFrame) -> DataFrame:
    """Each customer's newest order; ties by the higher id."""
    last = F.max_by(
        F.struct("id", "created_at", "total_amount", "status"), F.struct("created_at", "id")
    )
    return orders.groupBy("customer_id").agg(last.alias("o")).select("customer_id", "o.*")
