"""Sales over sliding and tumbling windows, and customer sessions."""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.rules import average
from ..functions.times import duration_micros, micros
from .envelope import require_key

# Window labels.
SLIDING_LABEL, HOURLY_LABEL, DAILY_LABEL = "sliding_1h_5m", "tumbling_1h", "tumbling_1d"
#: Relative standard error of the customers' sketch.  Every 370th estimate is off by three standard errors, so the error that all
#: windows must keep, 15 %, is nine of them.
APPROX_ERROR = 0.0163


def _label(size: str, slide: str) -> str:
    fixed = {
        ("1 hour", "5 minutes"): SLIDING_LABEL,
        ("1 hour", "1 hour"): HOURLY_LABEL,
        ("1 day", "1 day"): DAILY_LABEL,
    }
    kind = "tumbling" if size == slide else "sliding"
    return fixed.get((size, slide), f"{kind}_{size}_{slide}".replace(" ", ""))


def _floor_to(us: Column, width: int) -> Column:
    return us - F.pmod(us, F.lit(width))


def window_metrics(df: DataFrame, start_us: Column, size_us: int, label: str) -> DataFrame:
    """Output row of a window from ``total_revenue, order_count, unique_customers``."""
    start_ms = (start_us / 1000).cast("bigint")
    end_ms = ((start_us + size_us) / 1000).cast("bigint")
    return df.select(
        F.concat_ws("_", F.lit("sales"), start_ms, end_ms).alias("metric_id"),
        F.timestamp_micros(start_us).alias("window_start"),
        F.timestamp_micros(start_us + size_us).alias("window_end"),
        F.lit(label).alias("window_type"),
        "total_revenue",
        "order_count",
        average(F.col("total_revenue"), F.col("order_count")).alias("avg_order_value"),
        "unique_customers",
    )


def sales_windows(
    orders: DataFrame, size: str = "1 hour", slide: str | None = None, ts: str = "event_ts",
    approx: bool = False,
) -> DataFrame:
    """Revenue, orders, average and distinct customers per window.

    Rows are first folded into one row per (customer, pane), where panes tile every window, so a
    busy customer shrinks before the shuffle.  Each pane then feeds the windows over it; a
    customer counts as new only in windows that their previous pane did not reach, which makes
    the distinct count a plain sum.  A customer has at most one row per pane in that step.
    """
    slide = slide or size
    size_us, slide_us = duration_micros(size), duration_micros(slide)
    label = _label(size, slide)
    at = micros(F.col(ts))
    revenue = F.sum("total_amount").alias("total_revenue")
    count = F.count(F.lit(1)).alias("order_count")

    if approx:
        # One sketch per window and task: rows are spread in memory and combined map-side.
        last = _floor_to(at, slide_us)
        first = _floor_to(at - size_us, slide_us) + slide_us
        starts = F.explode_outer(F.sequence(first, last, F.lit(slide_us)))
        rows = orders.select("total_amount", "customer_id", starts.alias("_start"))
        sketched = rows.groupBy("_start").agg(
            revenue, count, F.approx_count_distinct("customer_id", APPROX_ERROR).alias("unique_customers")
        )
        return window_metrics(sketched, F.col("_start"), size_us, label)

    pane_us = gcd(size_us, slide_us)
    panes = (
        orders.groupBy("customer_id", _floor_to(at, pane_us).alias("_pane"))
        .agg(revenue, count)
    )
    pane = F.col("_pane")
    last = _floor_to(pane, slide_us)
    if size_us == slide_us:
        spread = panes.withColumn("_start", last).withColumn("_new", F.lit(True))
    else:
        first = _floor_to(pane + pane_us - size_us + slide_us - 1, slide_us)
        previous = F.lag("_pane").over(Window.partitionBy("customer_id").orderBy("_pane"))
        spread = (
            panes.withColumn("_reach", _floor_to(previous, slide_us))
            .withColumn("_start", F.explode_outer(F.sequence(first, last, F.lit(slide_us))))
            .withColumn("_new", F.col("_reach").isNull() | (F.col("_start") > F.col("_reach")))
        )
    folded = spread.groupBy("_start").agg(
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("order_count").alias("order_count"),
        F.count_if(F.col("_new") & F.col("customer_id").isNotNull()).alias("unique_customers"),
    )
    return window_metrics(folded, F.col("_start"), size_us, label)


def customer_sessions(orders: DataFrame, gap: str = "30 minutes", ts: str = "event_ts") -> DataFrame:
    """A customer's orders grouped by inactivity: a pause longer than ``gap`` starts a new session.

    Orders without a customer are in no session.  Orders within one gap-wide slot always share a session, so each customer is first reduced to
    one row per slot, map-side; sessions are then islands of slots.
    """
    gap_us = duration_micros(gap)
    at = micros(F.col(ts))
    slots = require_key(orders, "customer_id").groupBy("customer_id", F.floor(at / gap_us).alias("_slot")).agg(
        F.min(at).alias("_first"),
        F.max(at).alias("_last"),
        F.count(F.lit(1)).alias("order_count"),
        F.sum("total_amount").alias("total_amount"),
    )
    by_time = Window.partitionBy("customer_id").orderBy("_slot")
    starts = F.col("_first") - F.lag("_last").over(by_time) > gap_us
    islands = slots.withColumn(
        "_starts", F.coalesce(starts, F.lit(True)).cast("int")
    ).withColumn(
        "_session", F.sum("_starts").over(by_time.rowsBetween(Window.unboundedPreceding, 0))
    )
    return (
        islands.groupBy("customer_id", "_session")
        .agg(
            F.timestamp_micros(F.min("_first")).alias("session_start"),
            F.timestamp_micros(F.max("_last") + gap_us).alias("session_end"),
            F.sum("order_count").alias("order_count"),
            F.sum("total_amount").alias("total_amount"),
        )
        .drop("_session")
    )
