"""Dead letters, message counts and pipeline metrics."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.times import as_timestamp, duration_micros, micros
from ..schemas import OPS_ITEM_SALE, OPS_UPSERT, DELETE
from .envelope import read_metadata
from .ordered import per_key

# Histogram bounds.
BATCH_BOUNDS = (1, 5, 10, 25, 50, 100, 250, 500, 1000)

DECODE_ERROR, HANDLER_ERROR = "JSON decode error", "Processing failed"


def _outcome(value: str = "value") -> Column:
    """``tombstone``, ``ok`` or an error class, from the metadata of a message."""
    product = (F.col("table") == "products") & F.col("operation").isin(*OPS_UPSERT, DELETE)
    item = (F.col("table") == "order_items") & F.col("operation").isin(*OPS_ITEM_SALE)
    return (
        F.when(F.col(value).isNull(), "tombstone")
        .when(F.col("corrupt"), DECODE_ERROR)
        .when(product | item, "ok")
        .otherwise(HANDLER_ERROR)
    )


def classify(df: DataFrame, value: str = "value") -> DataFrame:
    """Messages of the inventory service with their ``outcome``."""
    return read_metadata(df, value).withColumn("outcome", _outcome(value))


def dead_letters(
    df: DataFrame, service: str, at: datetime | str | Column, value: str = "value"
) -> DataFrame:
    """Dead-letter rows ``topic, message, error, timestamp, service`` of failed messages."""
    failed = classify(df, value).filter(F.col("outcome").isin(DECODE_ERROR, HANDLER_ERROR))
    return letters(failed.withColumn("error", F.col("outcome")), service, at, value)


def letters(
    bad: DataFrame, service: str, at: datetime | str | Column, value: str = "value"
) -> DataFrame:
    """Rows with ``topic``, the message and ``error`` as dead letters."""
    stamp = F.date_format(as_timestamp(at), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return bad.select(
        "topic",
        F.col(value).alias("message"),
        "error",
        stamp.alias("timestamp"),
        F.lit(service).alias("service"),
    )


def message_counts(df: DataFrame, service: str, value: str = "value") -> DataFrame:
    """Messages per topic and outcome."""
    return (
        classify(df, value)
        .groupBy("topic", F.lit(service).alias("service"), "outcome")
        .agg(F.count(F.lit(1)).alias("messages"))
    )


def bucket_counts(
    df: DataFrame, column: str, bounds: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Cumulative histogram: rows at most ``le``, one row per bound and one for +Inf (null).

    All bounds are counted in one map-side aggregate; only its short rows are unfolded.
    """
    value = F.col(column)
    counts = df.groupBy(*by).agg(
        F.array(*[
            F.struct(F.lit(float(b)).alias("le"), F.count_if(value <= b).alias("n")) for b in bounds
        ], F.struct(F.lit(None).cast("double").alias("le"), F.count(value).alias("n"))).alias("_b")
    )
    return counts.select(*by, F.explode("_b").alias("b")).select(
        *by, "b.le", F.col("b.n").alias("cumulative_count")
    )


def latency(df: DataFrame, event_ts: str, processed_ts: str, by: Sequence[str] = ()) -> DataFrame:
    """Seconds from event to processing: count, sum and percentiles."""
    seconds = (micros(F.col(processed_ts)) - micros(F.col(event_ts))) / F.lit(1e6)
    return df.groupBy(*by).agg(
        F.count(seconds).alias("messages"),
        F.sum(seconds).alias("seconds_sum"),
        F.percentile_approx(seconds, [0.5, 0.95, 0.99], 10_000).alias("_p"),
    ).select(
        *by, "messages", "seconds_sum",
        F.col("_p")[0].alias("p50"), F.col("_p")[1].alias("p95"), F.col("_p")[2].alias("p99"),
    )


def lag_by_partition(ends: DataFrame, commits: DataFrame) -> DataFrame:
    """Messages behind, per topic and partition; a partition without commits starts at 0."""
    keys = ["topic", "partition"]
    lag = F.col("end_offset") - F.coalesce("committed_offset", F.lit(0))
    return ends.join(commits, keys, "left").select(*keys, lag.alias("consumer_lag"))


def sustained(
    df: DataFrame, condition: Column, duration: str, series: str, ts: str,
    order: Sequence[str] = (), max_rows: int | None = None,
) -> DataFrame:
    """Stretches in which a condition held for at least ``duration``, per series.

    A stretch is a run of samples without a false one between them; the number of false samples
    so far names it.
    """
    keys = [ts, *order]
    rows = df.select(series, *keys, F.coalesce(condition, F.lit(False)).alias("_on"))

    def body(d: DataFrame, scan) -> DataFrame:
        return scan.running(d, {"_island": F.when(F.col("_on"), 0).otherwise(1)})

    runs = per_key(rows, series, keys, body, max_rows).filter("_on")
    at = micros(F.col(ts))
    return (
        runs.groupBy(series, "_island")
        .agg(F.min(at).alias("_from"), F.max(at).alias("_to"), F.count(F.lit(1)).alias("samples"))
        .filter(F.col("_to") - F.col("_from") >= duration_micros(duration))
        .select(
            series,
            F.timestamp_micros("_from").alias("started_at"),
            F.timestamp_micros("_to").alias("ended_at"),
            "samples",
        )
    )


#: States of an alert.
INACTIVE, PENDING, FIRING, RESOLVED = "inactive", "pending", "firing", "resolved"


def alert_states(
    df: DataFrame, condition: Column, wait: str, series: str, ts: str, until: Column | str | None = None, order: Sequence[str] = (),
    max_rows: int | None = None,
) -> DataFrame:
    """``series, state, at``: when each series' alert became pending, firing, resolved, or inactive again.

    The condition makes an alert pending; if no false sample comes within ``wait``, it fires then, samples or not, as long as
    that is not after ``until`` (the newest sample of all, by default).  A false sample resolves it, or ends it while pending.
    Samples without a series or a time are left out.
    """
    width, keys = duration_micros(wait), ["_at", *order]
    rows = df.filter(F.col(series).isNotNull() & F.col(ts).isNotNull()).select(
        series, micros(F.col(ts)).alias("_at"), *order, F.coalesce(condition, F.lit(False)).alias("_on")
    )

    def turns(d: DataFrame, scan) -> DataFrame:
        return scan.running(d, lasts={"_before": F.col("_on")})

    # Only samples that turn the condition matter: far fewer rows than samples.
    turned = per_key(rows, series, keys, turns, max_rows).filter(F.col("_on") != F.coalesce("_before", F.lit(False)))
    back = {f"_back_{i}": -F.col(k).cast("bigint") for i, k in enumerate(keys)}

    def ends(d: DataFrame, scan) -> DataFrame:
        return scan.running(d, lasts={"_end": F.col("_at")})

    stretches = per_key(turned.withColumns(back), series, list(back), ends, max_rows).filter("_on")
    if until is None:
        edge = F.lit(rows.agg(F.max("_at")).first()[0]).cast("bigint")
    else:
        edge = micros(as_timestamp(until))
    fires, end = F.col("_at") + width, F.col("_end")
    # A false sample at the very end of the waiting time comes first.
    fired = (fires <= edge) & (end.isNull() | (end > fires)) if width else F.lit(True)

    def move(state: str, at: Column, hit: Column) -> Column:
        return F.when(hit & (at <= edge), F.struct(F.lit(state).alias("state"), at.alias("at")))

    moves = F.array_compact(F.array(
        move(PENDING, F.col("_at"), F.lit(True)), move(FIRING, fires, fired), move(RESOLVED, end, end.isNotNull() & fired),
        move(INACTIVE, end, end.isNotNull() & ~fired),
    ))
    return stretches.select(series, F.explode(moves).alias("m")).select(series, "m.state", F.timestamp_micros("m.at").alias("at"))


def rate(
    df: DataFrame, counter: str, window: str, series: str, ts: str, order: Sequence[str] = (),
    max_rows: int | None = None,
) -> DataFrame:
    """Per-second increase of a counter over the trailing window at every sample.

    A drop is a reset: the counter restarted at 0 and its new value is all increase.
    """
    width = duration_micros(window)
    keys = ["_us", *order]
    rows = df.select(
        series, micros(F.col(ts)).alias("_us"), *order, F.col(counter).cast("decimal(20,4)").alias("_c")
    )

    def body(d: DataFrame, scan) -> DataFrame:
        d = scan.running(d, lasts={"_before": F.col("_c")})
        grown = F.when(F.col("_before").isNull(), F.lit(0)).when(
            F.col("_c") >= F.col("_before"), F.col("_c") - F.col("_before")
        ).otherwise(F.col("_c"))
        d = d.withColumn("_grown", grown.cast("decimal(20,4)"))
        return scan.rolling(d, "_us", {"_increase": (F.col("_grown"), width)}, signed=False)

    found = per_key(rows, series, keys, body, max_rows)
    return found.select(
        series,
        F.timestamp_micros("_us").alias("ts"),
        *order,
        (F.col("_increase").cast("double") / (width / 1e6)).alias("rate_per_second"),
    )


def slope(
    df: DataFrame, value: str, window: str, series: str, ts: str, order: Sequence[str] = (),
    max_rows: int | None = None,
) -> DataFrame:
    """Least-squares slope per second over the trailing window at every sample.

    Sums run over whole milliseconds and exact decimals, relative to a fixed day, so differences
    of running totals lose nothing.
    """
    width = duration_micros(window)
    keys = ["_us", *order]
    us = micros(F.col(ts))
    rows = df.select(series, us.alias("_us"), *order, F.col(value).cast("decimal(14,2)").alias("_y"))
    # Milliseconds since 2000-01-01 keep products inside 38 digits.
    x = (F.floor((F.col("_us") - F.lit(946_684_800_000_000)) / 1000)).cast("decimal(14,0)")
    y = F.col("_y")

    def body(d: DataFrame, scan) -> DataFrame:
        return scan.rolling(
            d,
            "_us",
            {
                "_n": (F.lit(1), width),
                "_sx": (x, width),
                "_sy": (y, width),
                "_sxy": ((x * y).cast("decimal(28,2)"), width),
                "_sxx": ((x * x).cast("decimal(28,0)"), width),
            },
        )

    found = per_key(rows, series, keys, body, max_rows)
    # Shift the window's sums to its last sample first; this keeps every product small and exact.
    n, shift = F.col("_n"), x
    sx = (F.col("_sx") - n * shift).cast("decimal(24,0)")
    sxy = (F.col("_sxy") - shift * F.col("_sy").cast("decimal(20,2)")).cast("decimal(36,2)")
    sxx = (
        F.col("_sxx") - (F.lit(2) * shift * (F.col("_sx").cast("decimal(22,0)"))).cast("decimal(38,0)")
        + (n * (shift * shift).cast("decimal(28,0)")).cast("decimal(38,0)")
    ).cast("decimal(38,0)")
    top = n.cast("double") * sxy.cast("double") - sx.cast("double") * F.col("_sy").cast("double")
    bottom = n.cast("double") * sxx.cast("double") - sx.cast("double") * sx.cast("double")
    return found.select(
        series,
        F.timestamp_micros("_us").alias("ts"),
        *order,
        F.when(bottom > 0, top / bottom * 1000.0).alias("slope_per_second"),
    )


def check_full_images(parsed: DataFrame) -> DataFrame:
    """Updates and deletes per table that lack the old row image."""
    needs = F.col("operation").isin("u", "d")
    return parsed.filter(needs).groupBy("table", "operation").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("before").isNull()).alias("without_old_image"),
    )
