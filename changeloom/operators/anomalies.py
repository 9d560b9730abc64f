"""Order anomalies per customer: spikes, rapid orders, statistical outliers, large orders."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import money_text
from ..functions.times import duration_micros, micros
from .envelope import require_key
from .ordered import per_key


@dataclass(frozen=True)
class Limits:
    """Thresholds of the four rules."""

    spike_orders: int = 5  # more than this many
    spike_window: str = "1 hour"
    rapid_orders: int = 2  # at least this many
    rapid_window: str = "5 minutes"
    z_score: float = 3.0
    z_rows: int = 100
    z_min_rows: int = 3
    large_amount: float = 1000.0
    kept: str = "24 hours"  # order times a stream keeps, back from the last order handled


SPIKE, RAPID, OUTLIER, LARGE = "order_spike", "rapid_orders", "statistical_outlier", "large_order"

ORDER = ("event_us", "id")


def order_features(
    orders: DataFrame, limits: Limits = Limits(), order: Sequence[str] = ORDER,
    max_rows: int | None = None,
) -> DataFrame:
    """Per order: orders in both windows, mean, deviation and z-score of recent amounts, totals.

    Windows are (now − width, now] in event order; sums are exact integers of cents, so the
    deviation is zero exactly when all amounts are equal.
    """
    if "event_us" not in orders.columns:
        orders = orders.withColumn("event_us", micros(F.col("event_ts")))
    rows = require_key(orders, "customer_id").select("customer_id", "total_amount", *dict.fromkeys(["event_us", "id", *order]))
    cents = (F.col("total_amount") * 100).cast("bigint")
    squared = cents.cast("decimal(14,0)") * cents.cast("decimal(14,0)")

    def body(d: DataFrame, scan) -> DataFrame:
        return scan.history(
            d,
            {"total_customer_orders": F.lit(1), "total_customer_amount": F.col("total_amount")},
            "event_us",
            {
                "spike_count": (F.lit(1), duration_micros(limits.spike_window)),
                "rapid_count": (F.lit(1), duration_micros(limits.rapid_window)),
            },
            limits.z_rows,
            {"_n": F.lit(1), "_s": cents, "_q": squared},
        )

    found = per_key(rows, "customer_id", order, body, max_rows)
    n, s, q = F.col("_n"), F.col("_s"), F.col("_q")
    whole = s.cast("decimal(19,0)")
    spread = (n * q).cast("decimal(38,0)") - (whole * whole).cast("decimal(38,0)")
    deviation = F.when(
        n > 1, F.sqrt(spread.cast("double") / (n * (n - 1)).cast("double")) / 100.0
    )
    return found.withColumns({
        "mean_amount": s.cast("double") / n.cast("double") / 100.0,
        "stddev_amount": deviation,
    }).withColumn(
        "z_score",
        F.when(
            (n >= limits.z_min_rows) & (F.col("stddev_amount") > 0),
            (F.col("total_amount").cast("double") - F.col("mean_amount")) / F.col("stddev_amount"),
        ),
    ).drop("_n", "_s", "_q")


@dataclass(frozen=True)
class _Rule:
    severity: str
    hit: Column
    text: Column
    details: Column


def _alert(severity: str, hit: Column, text: Column, **details: Column) -> _Rule:
    return _Rule(severity, hit, text, F.struct(*[
        details.get(name, F.lit(None)).cast(kind).alias(name)
        for name, kind in (
            ("order_count", "bigint"), ("threshold", "double"), ("window_minutes", "bigint"),
            ("order_amount", "double"), ("mean_amount", "double"), ("z_score", "double"),
        )
    ]))


def alert_rules(limits: Limits = Limits()) -> dict[str, _Rule]:
    """The four rules over the columns of ``order_features``."""
    amount, z = F.col("total_amount"), F.col("z_score")
    dollars = F.concat(F.lit("$"), money_text(amount))
    minutes = duration_micros(limits.rapid_window) // 60_000_000
    return {
        SPIKE: _alert(
            "high", F.col("spike_count") > limits.spike_orders,
            F.concat(F.lit("Customer placed "), F.col("spike_count"), F.lit(" orders in the last hour")),
            order_count=F.col("spike_count"), threshold=F.lit(limits.spike_orders),
        ),
        RAPID: _alert(
            "medium", F.col("rapid_count") >= limits.rapid_orders,
            F.concat(
                F.lit("Customer placed "), F.col("rapid_count"), F.lit(f" orders within {minutes} minutes")
            ),
            order_count=F.col("rapid_count"), window_minutes=F.lit(minutes),
        ),
        OUTLIER: _alert(
            "medium", z > limits.z_score,
            F.concat(
                F.lit("Order amount "), dollars, F.lit(" is "),
                F.round(z, 2).cast("decimal(12,2)").cast("string"), F.lit(" std devs above mean"),
            ),
            order_amount=amount, mean_amount=F.col("mean_amount"), z_score=z,
        ),
        LARGE: _alert(
            "low", amount > limits.large_amount,
            F.concat(F.lit("Large order amount: "), dollars),
            order_amount=amount, threshold=F.lit(limits.large_amount),
        ),
    }


def alerts_from_features(
    features: DataFrame, limits: Limits = Limits(), kinds: Sequence[str] | None = None
) -> DataFrame:
    """One row per triggered rule."""
    rules = {k: r for k, r in alert_rules(limits).items() if kinds is None or k in kinds}
    # Hits are rare: text and details are made for them only.
    names = F.array_compact(F.array(*[F.when(r.hit, F.lit(k)) for k, r in rules.items()]))
    hits = features.withColumn("anomaly_type", F.explode(names))

    def of_kind(value: Callable[[_Rule], Column]) -> Column:
        return F.coalesce(*[F.when(F.col("anomaly_type") == k, value(r)) for k, r in rules.items()])

    return hits.select(
        F.concat_ws("_", "customer_id", "id", "anomaly_type").alias("alert_id"),
        "customer_id",
        F.col("id").alias("order_id"),
        "anomaly_type",
        of_kind(lambda r: F.lit(r.severity)).alias("severity"),
        of_kind(lambda r: r.text).alias("description"),
        of_kind(lambda r: r.details).alias("details"),
        F.col("total_amount").alias("order_amount"),
        F.timestamp_micros("event_us").alias("timestamp"),
        "total_customer_orders",
    )


def anomalies(
    orders: DataFrame, limits: Limits = Limits(), kinds: Sequence[str] | None = None,
    order: Sequence[str] = ORDER, max_rows: int | None = None,
) -> DataFrame:
    """Alerts of all rules, or of the named ones.

    ``orders`` has ``id, customer_id, total_amount`` and ``event_ts`` (or ``event_us``), after the
    operation filter.
    """
    return alerts_from_features(order_features(orders, limits, order, max_rows), limits, kinds)


def large_orders(orders: DataFrame, threshold: float = Limits.large_amount) -> DataFrame:
    """Orders above the limit; a plain filter that reaches the scan."""
    return orders.filter(F.col("total_amount") > threshold)


def recent_history(
    orders: DataFrame, hours: int = 24, order: Sequence[str] = ORDER, max_rows: int | None = None
) -> DataFrame:
    """Per order: how many orders and how much spend its last ``hours`` hold."""
    if "event_us" not in orders.columns:
        orders = orders.withColumn("event_us", micros(F.col("event_ts")))
    width = duration_micros(f"{hours} hours")
    frames = {
        "recent_orders": (F.lit(1), width),
        "recent_amount": (F.col("total_amount"), width),
    }
    rows = require_key(orders, "customer_id").select("customer_id", "total_amount", *dict.fromkeys(["event_us", "id", *order]))
    return per_key(
        rows, "customer_id", order, lambda d, scan: scan.rolling(d, "event_us", frames), max_rows
    )


def order_bursts(
    orders: DataFrame, k: int = 3, gap: str = "1 hour", order: Sequence[str] = ORDER,
    max_rows: int | None = None,
) -> DataFrame:
    """Orders that complete a sequence of at least ``k`` orders, each within ``gap`` of the last."""
    if "event_us" not in orders.columns:
        orders = orders.withColumn("event_us", micros(F.col("event_ts")))
    rows = require_key(orders, "customer_id").select("customer_id", *dict.fromkeys(["event_us", "id", *order]))
    width = duration_micros(gap)

    def body(d: DataFrame, scan) -> DataFrame:
        d = scan.running(d, {"_pos": F.lit(1)}, {"_prev": F.col("event_us")})
        far = F.col("_prev").isNull() | (F.col("event_us") - F.col("_prev") > width)
        # The number of the row that opened the current sequence, once per row from there on.
        d = d.withColumn("_opens", F.when(far, F.col("_pos")))
        d = scan.running(d, lasts={"_opened": F.col("_opens")})
        first = F.coalesce(F.col("_opens"), F.col("_opened"))
        return d.withColumn("burst_length", F.col("_pos") - first + 1)

    found = per_key(rows, "customer_id", order, body, max_rows)
    return found.filter(F.col("burst_length") >= k).select(
        "customer_id", "id", "event_us", "burst_length"
    )
