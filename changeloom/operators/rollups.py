"""Summaries that are kept per pane of time and merged for any longer period, without the rows they came from.

Three kinds: exact sets of customers as bitmaps, estimated numbers of customers as HLL sketches, and quantiles as KLL
sketches.  A pane is folded map-side; a period, a window or a group of services is a merge of its panes, whose number does
not depend on the number of events.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.times import as_timestamp, duration_micros, micros
from .windows import _floor_to, _label, window_metrics

#: lg of a HLL sketch's registers: a relative standard error of 1.04 / sqrt(2^lg), 1.6 %.
HLL_LG = 12
#: Size parameter of a KLL sketch.
KLL_K = 200
#: Rank error of one quantile of a KLL sketch of 200 with 99 % confidence, after its authors.
KLL_RANK_ERROR = 0.0133

PERIODS = ("hour", "day", "week", "month", "quarter", "year")


def hll_error(lg: int = HLL_LG) -> float:
    """Relative standard error of an HLL estimate."""
    return 1.04 / math.sqrt(1 << lg)


# ---- exact customers: bitmaps

def customer_bits(customer: Column) -> list[Column]:
    """The bitmap that holds a customer, and the set of customers in it; ids may be any BIGINT, dense ids make few bitmaps."""
    return [
        F.bitmap_bucket_number(customer).alias("bucket"), F.bitmap_construct_agg(F.bitmap_bit_position(customer)).alias("customers"),
    ]


def sales_panes(orders: DataFrame, period: str = "hour", ts: str = "event_ts", by: Sequence[str] = ()) -> DataFrame:
    """``period_start, bucket, total_revenue, order_count, customers`` (and ``by``): sums, and the customers as bitmaps.

    Orders without a time are left out; those without a customer count, but are nobody.
    """
    bucket, customers = customer_bits(F.col("customer_id").cast("bigint"))
    start = F.date_trunc(period, F.col(ts)).alias("period_start")
    return orders.filter(F.col(ts).isNotNull()).groupBy(*by, start, bucket).agg(
        F.sum("total_amount").alias("total_revenue"), F.count(F.lit(1)).alias("order_count"), customers
    )


def roll_up(panes: DataFrame, period: str, by: Sequence[str] = ()) -> DataFrame:
    """The same table for a longer period: rows are merged, none of the orders is read."""
    if period not in PERIODS:
        raise ValueError(f"unknown period: {period}")
    start = F.date_trunc(period, F.col("period_start")).alias("period_start")
    return panes.groupBy(*by, start, "bucket").agg(
        F.sum("total_revenue").alias("total_revenue"), F.sum("order_count").alias("order_count"), F.bitmap_or_agg("customers").alias("customers")
    )


def counted(panes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Revenue, orders and the exact number of customers per period."""
    return panes.groupBy(*by, "period_start").agg(
        F.sum("total_revenue").alias("total_revenue"), F.sum("order_count").alias("order_count"),
        F.sum(F.bitmap_count("customers")).alias("unique_customers"),
    )


# ---- estimated customers: one sketch a pane, united per window

def sketch_panes(orders: DataFrame, pane: str = "5 minutes", ts: str = "event_ts", lg: int = HLL_LG) -> DataFrame:
    """``pane_us, total_revenue, order_count, customers``: each order is read once, whatever the windows above."""
    start = _floor_to(micros(F.col(ts)), duration_micros(pane)).alias("pane_us")
    return orders.filter(F.col(ts).isNotNull()).groupBy(start).agg(
        F.sum("total_amount").alias("total_revenue"), F.count(F.lit(1)).alias("order_count"),
        F.hll_sketch_agg(F.col("customer_id").cast("bigint"), lg).alias("customers"),
    )


def sketched_windows(panes: DataFrame, pane: str = "5 minutes", size: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Windows over stored panes; ``unique_customers`` is an estimate."""
    slide = slide or size
    pane_us, size_us, slide_us = (duration_micros(d) for d in (pane, size, slide))
    if size_us % pane_us or slide_us % pane_us:
        raise ValueError("windows must begin and end with a pane")
    at = F.col("pane_us")
    last = _floor_to(at, slide_us)
    first = _floor_to(at - size_us, slide_us) + slide_us
    # A fixed number of copies of each pane, not of each order.
    spread = panes.withColumn("_start", F.explode(F.sequence(first, last, F.lit(slide_us))))
    merged = spread.groupBy("_start").agg(
        F.sum("total_revenue").alias("total_revenue"), F.sum("order_count").alias("order_count"),
        F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("unique_customers"),
    )
    return window_metrics(merged, F.col("_start"), size_us, _label(size, slide))


# ---- quantiles: one sketch per interval, merged for any range and service

def latency_sketches(
    df: DataFrame, event_ts: str, processed_ts: str, interval: str = "1 hour", by: Sequence[str] = (), k: int = KLL_K,
) -> DataFrame:
    """``by, interval_us, messages, micros_sum, sketch`` of the time from event to processing, in microseconds."""
    took = (micros(F.col(processed_ts)) - micros(F.col(event_ts))).alias("_took")
    rows = df.select(*by, _floor_to(micros(F.col(event_ts)), duration_micros(interval)).alias("interval_us"), took)
    return rows.filter("_took IS NOT NULL").groupBy(*by, "interval_us").agg(
        F.count(F.lit(1)).alias("messages"), F.sum("_took").alias("micros_sum"), F.kll_sketch_agg_bigint("_took", k).alias("sketch")
    )


def latency_quantiles(
    sketches: DataFrame, by: Sequence[str] = (), quantiles: Sequence[float] = (0.5, 0.95, 0.99), start: Column | str | None = None,
    end: Column | str | None = None, k: int = KLL_K,
) -> DataFrame:
    """Quantiles in seconds over the intervals in [start, end), per ``by`` (any of the kept columns): ``p50, p95, p99``.

    The rank of an answer among all values is off by at most ``KLL_RANK_ERROR`` with 99 % confidence; up to
    ``k`` values it is exact.
    """
    at = F.timestamp_micros("interval_us")
    if start is not None:
        sketches = sketches.filter(at >= as_timestamp(start))
    if end is not None:
        sketches = sketches.filter(at < as_timestamp(end))
    merged = sketches.groupBy(*by).agg(
        F.sum("messages").alias("messages"), (F.sum("micros_sum") / F.lit(1e6)).alias("seconds_sum"),
        F.kll_merge_agg_bigint("sketch", k).alias("_sketch"),
    )
    answers = [
        (F.kll_sketch_get_quantile_bigint("_sketch", F.lit(float(q))) / F.lit(1e6)).alias(f"p{100 * q:g}".replace(".", "_")) for q in quantiles
    ]
    return merged.filter("messages > 0").select(*by, "messages", "seconds_sum", *answers)
