"""Recency, frequency and spend per customer."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.rules import average, recency_days, segment
from ..functions.times import as_timestamp
from .envelope import require_key
from .ordered import per_key


def _finish(df: DataFrame, as_of: Column, *extra: str) -> DataFrame:
    df = df.withColumn("recency_days", recency_days(F.col("last_order_date"), as_of))
    return df.select(
        "customer_id",
        *extra,
        segment(F.col("recency_days"), F.col("total_orders"), F.col("total_spent")).alias("segment"),
        "recency_days",
        F.col("total_orders").alias("frequency"),
        F.col("total_spent").alias("monetary_value"),
        "total_orders",
        "total_spent",
        "first_order_date",
        "last_order_date",
        average(F.col("total_spent"), F.col("total_orders")).alias("avg_order_value"),
    )


def rfm_totals(orders: DataFrame, ts: str = "event_ts") -> DataFrame:
    """The mergeable part: count, spend, first and last order per customer."""
    return require_key(orders, "customer_id").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("total_amount").alias("total_spent"),
        F.min(ts).alias("first_order_date"),
        F.max(ts).alias("last_order_date"),
    )


def rfm_segments(orders: DataFrame, as_of: datetime | str | Column, ts: str = "event_ts") -> DataFrame:
    """One row per customer as of a point in time."""
    return finish_totals(rfm_totals(orders, ts), as_of)


def finish_totals(totals: DataFrame, as_of: datetime | str | Column) -> DataFrame:
    return _finish(totals, as_timestamp(as_of))


def rfm_history(
    orders: DataFrame, as_of: datetime | str | None = None, ts: str = "event_ts",
    order: Sequence[str] = ("event_ts", "id"), max_rows: int | None = None,
) -> DataFrame:
    """One row per order: the customer's metrics right after it.

    Recency is measured at the order's own time unless ``as_of`` is given.
    """
    rows = require_key(orders, "customer_id").select(
        "customer_id", "total_amount", *dict.fromkeys(["id", *order]), F.col(ts).alias("_ts")
    )

    def body(d: DataFrame, scan) -> DataFrame:
        return scan.running(
            d,
            sums={"total_orders": F.lit(1), "total_spent": F.col("total_amount")},
            firsts={"first_order_date": F.col("_ts")},
        )

    running = per_key(rows, "customer_id", order, body, max_rows)
    running = running.withColumn("last_order_date", F.col("_ts"))
    now = F.col("_ts") if as_of is None else as_timestamp(as_of)
    return _finish(running, now, "id")
