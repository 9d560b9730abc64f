"""The shop's seed rows, as typed tables and as logs."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

DAY = datetime(2025, 1, 15, 10, 0)

PRODUCTS = [
    (1, "Laptop", "High-performance laptop", "1299.99", 50),
    (2, "Mouse", "Wireless mouse", "29.99", 200),
    (3, "Keyboard", "Mechanical keyboard", "89.99", 150),
    (4, "Monitor", "27-inch 4K monitor", "399.99", 75),
    (5, "Headphones", "Noise-cancelling headphones", "249.99", 120),
]
ORDERS = [
    (1, 1001, "1299.99", "completed"),
    (2, 1002, "119.98", "pending"),
    (3, 1003, "399.99", "processing"),
]
ITEMS = [(1, 1, 1, 1, "1299.99"), (2, 2, 2, 2, "29.99"), (3, 2, 3, 1, "89.99"), (4, 3, 4, 1, "399.99")]


def products(spark):
    return spark.createDataFrame(
        [(i, n, d, Decimal(p), s, DAY, DAY, DAY) for i, n, d, p, s in PRODUCTS],
        "id bigint, name string, description string, price decimal(12,2), stock_quantity int, "
        "created_at timestamp, updated_at timestamp, event_ts timestamp",
    )


def orders(spark):
    return spark.createDataFrame(
        [(i, c, Decimal(a), s, DAY, DAY, DAY) for i, c, a, s in ORDERS],
        "id bigint, customer_id bigint, total_amount decimal(12,2), status string, "
        "created_at timestamp, updated_at timestamp, event_ts timestamp",
    )


def items(spark):
    return spark.createDataFrame(
        [(i, o, p, q, Decimal(a), DAY, DAY, 1) for i, o, p, q, a in ITEMS],
        "id bigint, order_id bigint, product_id bigint, quantity int, price decimal(12,2), "
        "created_at timestamp, event_ts timestamp, line_number bigint",
    )


def order_times(spark, rows):
    """Orders from (id, customer, amount, ms after a start)."""
    df = spark.createDataFrame(
        [(i, c, Decimal(str(a)), ms) for i, c, a, ms in rows],
        "id bigint, customer_id bigint, total_amount decimal(12,2), ms bigint",
    )
    return df.withColumn("event_ts", F.timestamp_millis(F.lit(1_736_935_200_000) + F.col("ms"))).drop("ms")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
