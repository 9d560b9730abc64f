"""Queries over stored panes, sketches and bitmaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.times import micros
from ..operators import rollups, windows
from ..session import written
from ..sources import fixtures
from .analytics_plans import sale_events
from .catalog import query, ts_text


def _period_sql(period: str) -> str:
    return f"""
    SELECT '{period}' AS period, {ts_text(f"CAST(date_trunc('{period}', event_ts) AS TIMESTAMP)")} AS period_start, status,
           CAST(sum(total_amount) AS DOUBLE) AS total_revenue, count(*) AS order_count, count(DISTINCT customer_id) AS unique_customers
    FROM ev WHERE operation <> 'd' GROUP BY 2, 3"""


@query("customers_rolled_up", "+ up AS (" + " UNION ALL ".join(_period_sql(p) for p in ("hour", "day", "month")) + ") SELECT * FROM up", ("ev",))
def _rolled_up(spark, sf):
    """Exact customers per hour, day and month; each period is merged from the table of the one below."""
    by, table, out = ["status"], None, None
    for period in ("hour", "day", "month"):
        table = rollups.sales_panes(sale_events(spark, sf), period, by=by) if table is None else rollups.roll_up(table, period, by)
        table = written(table, f"panes-{period}")
        rows = rollups.counted(table, by).select(
            F.lit(period).alias("period"), "period_start", "status", "total_revenue", "order_count", "unique_customers"
        )
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "sales_sliding_sketched",
    """
    + w AS (
        SELECT (CAST(floor(event_us / 300e6) AS BIGINT) - k.k) * 300000 AS start_ms, *
        FROM ev, range(12) AS k(k) WHERE operation <> 'd')
    SELECT start_ms, count(*) AS order_count, count(DISTINCT customer_id) AS unique_customers, true AS estimate_is_near
    FROM w GROUP BY 1
    """,
    ("ev",),
)
def _sliding_sketched(spark, sf):
    """Every window's estimate from stored panes lies within four standard errors of the exact count, in whole customers."""
    panes = written(rollups.sketch_panes(sale_events(spark, sf)), "sketches")
    estimated = rollups.sketched_windows(panes, slide="5 minutes")
    exact = windows.sales_windows(sale_events(spark, sf), "1 hour", "5 minutes").select("window_start", F.col("unique_customers").alias("_exact"))
    near = F.abs(F.col("unique_customers") - F.col("_exact")) <= 1 + F.ceil(4 * rollups.hll_error() * F.col("_exact"))
    return estimated.join(exact, "window_start").select(
        F.unix_millis("window_start").alias("start_ms"), "order_count", F.col("_exact").alias("unique_customers"), near.alias("estimate_is_near")
    )


@query(
    "latency_quantiles",
    """
    SELECT status, count(*) AS messages, CAST(sum((id * 7919) % 86400) AS DOUBLE) AS seconds_sum, true AS p50_is_near, true AS p95_is_near,
           true AS p99_is_near
    FROM ev WHERE event_ts >= TIMESTAMP '2024-01-05' AND event_ts < TIMESTAMP '2024-01-25' GROUP BY 1
    """,
    ("ev",),
)
def _latency_quantiles(spark, sf):
    """Quantiles of a range of days from stored hourly sketches; the exact rank of each answer lies within the stated error."""
    events = fixtures.order_events(spark, sf)
    took = (F.col("id") * 7919) % 86400
    done = events.withColumn("done_ts", F.timestamp_micros(micros(F.col("event_ts")) + took * 1_000_000))
    stored = written(rollups.latency_sketches(done, "event_ts", "done_ts", by=["status"]), "latency-sketches")
    found = rollups.latency_quantiles(stored, ["status"], start="2024-01-05", end="2024-01-25")
    inside = done.filter("event_ts >= '2024-01-05' AND event_ts < '2024-01-25'").select("status", took.alias("_took"))
    near = []
    for q, name in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99")):
        # The answer is right if its rank range, from values below it to values up to it, comes within the error of q.
        below, upto = F.count_if(F.col("_took") < F.col(name)), F.count_if(F.col("_took") <= F.col(name))
        n, slack = F.count(F.lit(1)), rollups.KLL_RANK_ERROR * 1.5
        near.append(((below / n <= q + slack) & (upto / n >= q - slack)).alias(f"{name}_is_near"))
    joined = inside.join(found, "status")
    return joined.groupBy("status", "messages", "seconds_sum").agg(*near)
