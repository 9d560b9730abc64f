"""Queries over event histories: windows, segments, anomalies, inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


from ..operators import anomalies, envelope, inventory, patterns, rfm, state, windows
from ..schemas import OPS_SALES
from ..sources import fixtures
from .catalog import query, ts_text

# The test data never reaches six orders an hour or an amount of 1000, so the rules are tried with
# limits that it does reach.
LIMITS = anomalies.Limits(spike_orders=2, large_amount=200.0)
RFM_AS_OF = "2001-08-02 00:00:00"
STOCK_AS_OF = "2001-09-01 00:00:00"


def sale_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events the sales programs count: every operation but deletes."""
    return envelope.with_ops(fixtures.order_events(spark, sf), OPS_SALES)


_SEGMENT = """
    CASE WHEN recency_days > 90 THEN 'Churned'
         WHEN total_orders >= 5 AND total_spent >= 500 THEN 'VIP'
         WHEN recency_days > 30 AND total_orders >= 3 THEN 'At-Risk'
         WHEN total_orders <= 2 THEN 'New' ELSE 'Regular' END
"""


def _rfm_events_sql(customer: str) -> str:
    """Segments of the sale events under another customer column."""
    return f"""
    + k AS (SELECT {customer} AS customer_id, total_amount, event_ts FROM ev WHERE operation <> 'd'),
    t AS (SELECT customer_id, count(*) AS total_orders, sum(total_amount) AS total_spent,
                 date_diff('day', CAST(max(event_ts) AS DATE), CAST('{RFM_AS_OF}' AS DATE)) AS days,
                 CAST(floor(epoch(TIMESTAMP '{RFM_AS_OF}' - max(event_ts)) / 86400) AS BIGINT) AS recency_days
          FROM k WHERE customer_id IS NOT NULL GROUP BY 1)
    SELECT customer_id, total_orders AS frequency, CAST(total_spent AS DOUBLE) AS monetary_value, {_SEGMENT} AS segment FROM t
    """


# ---- windows


def _window_sql(size_s: int, slide_s: int, label: str) -> str:
    n = size_s // slide_s
    return f"""
    + w AS (
        SELECT (CAST(floor(event_us / {slide_s}e6) AS BIGINT) - k.k) * {slide_s} AS s, *
        FROM ev, range({n}) AS k(k) WHERE operation <> 'd')
    SELECT 'sales_' || (s * 1000) || '_' || ((s + {size_s}) * 1000) AS metric_id,
           {ts_text("make_timestamp(s * 1000000)")} AS window_start,
           {ts_text(f"make_timestamp((s + {size_s}) * 1000000)")} AS window_end,
           '{label}' AS window_type,
           CAST(sum(total_amount) AS DOUBLE) AS total_revenue, count(*) AS order_count,
           CAST(sum(total_amount) AS DOUBLE) / count(*) AS avg_order_value,
           count(DISTINCT customer_id) AS unique_customers
    FROM w GROUP BY s
    """


@query("sales_sliding_1h_5m", _window_sql(3600, 300, "sliding_1h_5m"), ("ev",))
def _sliding(spark, sf):
    return windows.sales_windows(sale_events(spark, sf), "1 hour", "5 minutes")


@query("sales_hourly", _window_sql(3600, 3600, "tumbling_1h"), ("ev",))
def _hourly(spark, sf):
    return windows.sales_windows(sale_events(spark, sf), "1 hour")


@query("sales_daily", _window_sql(86400, 86400, "tumbling_1d"), ("ev",))
def _daily(spark, sf):
    return windows.sales_windows(sale_events(spark, sf), "1 day")


@query(
    "sales_hourly_approx",
    """
    SELECT CAST(floor(event_us / 3600e6) * 3600000 AS BIGINT) AS start_ms, count(*) AS order_count,
           count(DISTINCT customer_id) AS unique_customers, true AS estimate_is_near
    FROM ev WHERE operation <> 'd' GROUP BY 1
    """,
    ("ev",),
)
def _hourly_approx(spark, sf):
    """Beside the exact count, whether the sketch's estimate lies within three times its stated error (5 %), in whole
    customers."""
    approx = windows.sales_windows(sale_events(spark, sf), "1 hour", approx=True)
    exact = windows.sales_windows(sale_events(spark, sf), "1 hour").select(
        "window_start", F.col("unique_customers").alias("_exact")
    )
    near = F.abs(F.col("unique_customers") - F.col("_exact")) <= 1 + F.ceil(0.15 * F.col("_exact"))
    return approx.join(exact, "window_start").select(
        F.unix_millis("window_start").alias("start_ms"), "order_count", F.col("_exact").alias("unique_customers"),
        near.alias("estimate_is_near"),
    )


@query(
    "customer_sessions",
    f"""
    + g AS (
        SELECT *, CASE WHEN event_us - lag(event_us) OVER (PARTITION BY customer_id ORDER BY event_us)
                            <= 7200000000 THEN 0 ELSE 1 END AS opens
        FROM ev WHERE operation <> 'd'),
    h AS (SELECT *, sum(opens) OVER (PARTITION BY customer_id ORDER BY event_us) AS n FROM g)
    SELECT customer_id, {ts_text("min(event_ts)")} AS session_start,
           {ts_text("max(event_ts) + INTERVAL 2 HOURS")} AS session_end,
           count(*) AS order_count, CAST(sum(total_amount) AS DOUBLE) AS total_amount
    FROM h GROUP BY customer_id, n
    """,
    ("ev",),
)
def _sessions(spark, sf):
    return windows.customer_sessions(sale_events(spark, sf), "2 hours")


# ---- segments

_RFM_OUT = f"""
    {_SEGMENT} AS segment, recency_days, total_orders AS frequency,
    CAST(total_spent AS DOUBLE) AS monetary_value, total_orders,
    CAST(total_spent AS DOUBLE) AS total_spent, {ts_text("first_ts")} AS first_order_date,
    {ts_text("last_ts")} AS last_order_date,
    CAST(total_spent AS DOUBLE) / total_orders AS avg_order_value
"""

RFM_SQL = f"""
    + r AS (
        SELECT customer_id, count(*) AS total_orders, sum(total_amount) AS total_spent,
               min(event_ts) AS first_ts, max(event_ts) AS last_ts,
               CAST(floor(epoch(TIMESTAMP '{RFM_AS_OF}' - max(event_ts)) / 86400) AS BIGINT) AS recency_days
        FROM ord GROUP BY 1)
    SELECT customer_id, {_RFM_OUT} FROM r
"""


@query("rfm_segments", RFM_SQL, ("ord",))
def _rfm_segments(spark, sf):
    return rfm.rfm_segments(fixtures.orders(spark, sf), RFM_AS_OF)


@query(
    "rfm_history",
    f"""
    + r AS (
        SELECT customer_id, id, event_ts AS last_ts, CAST(0 AS BIGINT) AS recency_days,
               count(*) OVER w AS total_orders, sum(total_amount) OVER w AS total_spent,
               min(event_ts) OVER w AS first_ts
        FROM ord
        WINDOW w AS (PARTITION BY customer_id ORDER BY event_ts, id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT customer_id, id, {_RFM_OUT} FROM r
    """,
    ("ord",),
)
def _rfm_history(spark, sf):
    return rfm.rfm_history(fixtures.orders(spark, sf))


# ---- anomalies

_FEATURES = """
    + sale AS (SELECT * FROM ev WHERE operation <> 'd'),
    f AS (
        SELECT *, count(*) OVER hour AS spikes, count(*) OVER five AS rapids,
               avg(CAST(total_amount AS DOUBLE)) OVER hundred AS mean,
               stddev_samp(CAST(total_amount AS DOUBLE)) OVER hundred AS sd,
               count(*) OVER hundred AS n,
               count(*) OVER every AS total_orders
        FROM sale
        WINDOW hour AS (PARTITION BY customer_id ORDER BY event_us
                        RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW),
               five AS (PARTITION BY customer_id ORDER BY event_us
                        RANGE BETWEEN 299999999 PRECEDING AND CURRENT ROW),
               hundred AS (PARTITION BY customer_id ORDER BY event_us, id
                           ROWS BETWEEN 99 PRECEDING AND CURRENT ROW),
               every AS (PARTITION BY customer_id ORDER BY event_us, id
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    z AS (SELECT *, CASE WHEN n >= 3 AND sd > 0 THEN (CAST(total_amount AS DOUBLE) - mean) / sd END AS z FROM f)
"""

_ALERTS = {
    "order_spike": (
        "high", "spikes > 2",
        "'Customer placed ' || spikes || ' orders in the last hour'",
        "spikes, 2.0, NULL, NULL, NULL, NULL",
    ),
    "rapid_orders": (
        "medium", "rapids >= 2",
        "'Customer placed ' || rapids || ' orders within 5 minutes'",
        "rapids, NULL, 5, NULL, NULL, NULL",
    ),
    "statistical_outlier": (
        "medium", "z > 3",
        "'Order amount $' || total_amount || ' is ' || CAST(round(z, 2) AS DECIMAL(12,2)) || ' std devs above mean'",
        "NULL, NULL, NULL, CAST(total_amount AS DOUBLE), mean, z",
    ),
    "large_order": (
        "low", "total_amount > 200",
        "'Large order amount: $' || total_amount",
        "NULL, 200.0, NULL, CAST(total_amount AS DOUBLE), NULL, NULL",
    ),
}


def _alert_sql(*kinds: str) -> str:
    parts = []
    for kind in kinds:
        severity, hit, text, details = _ALERTS[kind]
        parts.append(f"""
        SELECT *, '{kind}' AS kind, '{severity}' AS severity, {text} AS description,
               [{", ".join(f"CAST({d.strip()} AS DOUBLE)" for d in details.split(", "))}] AS d
        FROM z WHERE {hit}""")
    return _FEATURES + f""", a AS ({" UNION ALL ".join(parts)})
    SELECT customer_id || '_' || id || '_' || kind AS alert_id, customer_id, id AS order_id,
           kind AS anomaly_type, severity, description,
           CAST(coalesce(d[1], -1) AS BIGINT) AS order_count, d[2] AS threshold,
           CAST(coalesce(d[3], -1) AS BIGINT) AS window_minutes,
           d[4] AS detail_amount, round(d[5], 4) AS mean_amount, round(d[6], 4) AS z_score,
           CAST(total_amount AS DOUBLE) AS order_amount, {ts_text("event_ts")} AS "timestamp",
           total_orders AS total_customer_orders
    FROM a
    """


ANOMALY_SQL = _alert_sql(*_ALERTS)


def flat_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        "alert_id", "customer_id", "order_id", "anomaly_type", "severity", "description",
        F.coalesce("details.order_count", F.lit(-1)).alias("order_count"),
        "details.threshold",
        F.coalesce("details.window_minutes", F.lit(-1)).alias("window_minutes"),
        F.col("details.order_amount").alias("detail_amount"),
        F.round("details.mean_amount", 4).alias("mean_amount"),
        F.round("details.z_score", 4).alias("z_score"),
        "order_amount", "timestamp", "total_customer_orders",
    )


@query("anomaly_alerts", ANOMALY_SQL, ("ev",))
def _anomaly_alerts(spark, sf):
    return flat_alerts(anomalies.anomalies(sale_events(spark, sf), LIMITS))


for _name, _kind in (
    ("order_spikes", anomalies.SPIKE),
    ("rapid_orders", anomalies.RAPID),
    ("amount_outliers", anomalies.OUTLIER),
):
    query(_name, _alert_sql(_kind), ("ev",))(
        lambda spark, sf, kind=_kind: flat_alerts(
            anomalies.anomalies(sale_events(spark, sf), LIMITS, [kind])
        )
    )


@query(
    "large_orders",
    """
    SELECT id, customer_id, CAST(total_amount AS DOUBLE) AS total_amount FROM ord WHERE total_amount > 150000
    """,
    ("ord",),
)
def _large_orders(spark, sf):
    orders = fixtures.orders(spark, sf).select("id", "customer_id", "total_amount")
    return anomalies.large_orders(orders, 150_000.0)


@query(
    "recent_history",
    """
    SELECT customer_id, id, count(*) OVER w AS recent_orders,
           CAST(sum(total_amount) OVER w AS DOUBLE) AS recent_amount
    FROM ev WHERE operation <> 'd'
    WINDOW w AS (PARTITION BY customer_id ORDER BY event_us
                 RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW)
    """,
    ("ev",),
)
def _recent_history(spark, sf):
    found = anomalies.recent_history(sale_events(spark, sf))
    return found.select("customer_id", "id", "recent_orders", "recent_amount")


@query(
    "order_bursts",
    """
    + g AS (
        SELECT *, row_number() OVER w AS pos,
               CASE WHEN event_us - lag(event_us) OVER w <= 3600000000 THEN 0 ELSE 1 END AS opens
        FROM ev WHERE operation <> 'd'
        WINDOW w AS (PARTITION BY customer_id ORDER BY event_us, id)),
    h AS (SELECT *, max(CASE WHEN opens = 1 THEN pos END)
                    OVER (PARTITION BY customer_id ORDER BY event_us, id) AS first FROM g)
    SELECT customer_id, id, event_us, pos - first + 1 AS burst_length FROM h WHERE pos - first + 1 >= 2
    """,
    ("ev",),
)
def _order_bursts(spark, sf):
    return anomalies.order_bursts(sale_events(spark, sf), k=2, gap="1 hour")


# ---- inventory


def _stock(spark, sf):
    return product_events(spark, sf), fixtures.order_items(spark, sf)


def product_events(spark: SparkSession, sf: str) -> DataFrame:
    """Opening stock, a recount in 1998 for every third product, and one in 2000 for every fifth."""
    products = fixtures.products(spark, sf)

    def recount(every: int, at: str, stock: int) -> DataFrame:
        return products.filter(F.col("id") % every == 0).withColumns({
            "event_ts": F.lit(at).cast("timestamp"), "stock_quantity": F.lit(stock),
        })

    return products.unionByName(recount(3, "1998-03-01", 300)).unionByName(
        recount(5, "2000-06-15", 40)
    )


_PROD_EVENTS = """
    + pe AS (
        SELECT id, name, price, CAST(stock_quantity AS BIGINT) AS stock, event_ts FROM prod
        UNION ALL SELECT id, name, price, 300, TIMESTAMP '1998-03-01' FROM prod WHERE id % 3 = 0
        UNION ALL SELECT id, name, price, 40, TIMESTAMP '2000-06-15' FROM prod WHERE id % 5 = 0),
    lastp AS (SELECT * FROM pe QUALIFY row_number() OVER (PARTITION BY id ORDER BY event_ts DESC) = 1),
    sold AS (
        SELECT i.product_id, sum(i.quantity) AS q
        FROM item i LEFT JOIN lastp p ON p.id = i.product_id
        WHERE p.event_ts IS NULL OR i.event_ts >= p.event_ts GROUP BY 1),
    inv AS (
        SELECT coalesce(p.id, s.product_id) AS product_id, p.name AS product_name,
               CAST(p.price AS DOUBLE) AS price,
               CAST(coalesce(p.stock, 0) - coalesce(s.q, 0) AS BIGINT) AS stock_quantity
        FROM lastp p FULL JOIN sold s ON s.product_id = p.id)
"""


@query("current_inventory", _PROD_EVENTS + "SELECT * FROM inv", ("prod", "item"))
def _current_inventory(spark, sf):
    return inventory.current_inventory(*_stock(spark, sf))


@query("low_stock", _PROD_EVENTS + "SELECT * FROM inv WHERE stock_quantity < 10", ("prod", "item"))
def _low_stock(spark, sf):
    return inventory.low_stock(inventory.current_inventory(*_stock(spark, sf)))


@query(
    "optimizer_stock",
    _PROD_EVENTS + "SELECT product_id, greatest(0, stock_quantity) AS current_stock FROM inv",
    ("prod", "item"),
)
def _optimizer_stock(spark, sf):
    return inventory.optimizer_stock(*_stock(spark, sf))


@query(
    "stock_deltas",
    """
    SELECT p.id AS product_id, CAST(p.stock_quantity - coalesce(q, 0) AS BIGINT) AS stock_quantity
    FROM prod p LEFT JOIN (SELECT product_id, sum(quantity) AS q FROM item GROUP BY 1) s ON s.product_id = p.id
    """,
    ("prod", "item"),
)
def _stock_deltas(spark, sf):
    snapshot = fixtures.products(spark, sf).select(F.col("id").alias("product_id"), "stock_quantity")
    sold = fixtures.order_items(spark, sf).select("product_id", (-F.col("quantity")).alias("delta"))
    return inventory.apply_deltas(snapshot, sold, "product_id", "stock_quantity")


# Stock by segments between product events, independent of the ceiling form used in Spark.
_STOCK_LOG = _PROD_EVENTS + """,
    log AS (
        SELECT id AS product_id, 0 AS kind, stock, 0 AS qty, event_ts, epoch_us(event_ts) AS us,
               CAST(NULL AS BIGINT) AS order_id, CAST(NULL AS BIGINT) AS line_number,
               CAST(NULL AS BIGINT) AS quantity
        FROM pe
        UNION ALL SELECT product_id, 1, NULL, quantity, event_ts, epoch_us(event_ts), order_id,
                         line_number, quantity FROM item),
    seg AS (
        SELECT *, sum(1 - kind) OVER (PARTITION BY product_id ORDER BY us, kind) AS segment FROM log),
    run AS (
        SELECT *, max(stock) OVER s AS opening, sum(qty) OVER o AS gone,
               sum(qty) OVER (PARTITION BY product_id ORDER BY us, kind, order_id, line_number, quantity
                              ROWS UNBOUNDED PRECEDING) AS all_sold
        FROM seg
        WINDOW s AS (PARTITION BY product_id, segment),
               o AS (PARTITION BY product_id, segment ORDER BY us, kind, order_id, line_number, quantity
                     ROWS UNBOUNDED PRECEDING)),
    stk AS (
        SELECT *, CASE WHEN segment = 0 THEN 0 ELSE greatest(0, opening - gone) END AS after_stock FROM run),
    prev AS (
        SELECT *, coalesce(lag(after_stock) OVER (PARTITION BY product_id
                     ORDER BY us, kind, order_id, line_number, quantity), 0) AS before_stock FROM stk)
"""


@query(
    "restock_events",
    _STOCK_LOG + f"""
    SELECT product_id, {ts_text("event_ts")} AS restocked_at, CAST(before_stock AS BIGINT) AS stock_before,
           stock AS stock_after
    FROM prev WHERE kind = 0 AND stock > before_stock
    """,
    ("prod", "item"),
)
def _restock_events(spark, sf):
    return inventory.restock_events(*_stock(spark, sf))


_INSIGHT_OUT = f"""
    CAST(cur AS BIGINT) AS current_stock,
    CASE WHEN cur = 0 THEN 'out_of_stock' WHEN days > 60 THEN 'healthy' WHEN days <= 7 THEN 'critical'
         WHEN cur < 10 THEN 'low' WHEN days < 30 THEN 'low' ELSE 'healthy' END AS stock_status,
    round(v, 2) AS velocity_units_per_day,
    CASE WHEN days < 999 THEN round(days, 1) END AS days_until_stockout,
    last_sale IS NULL OR floor(epoch(now_ts - last_sale) / 86400) > 30 AS is_dead_stock,
    CASE WHEN days <= 30 AND v > 0 AND greatest(0, v * 30 - cur) >= 5
         THEN CAST(floor(v * 30 - cur) AS BIGINT) ELSE -1 END AS restock_quantity,
    CASE WHEN days <= 30 AND v > 0 AND greatest(0, v * 30 - cur) >= 5
         THEN CASE WHEN days <= 7 THEN 'high' ELSE 'medium' END END AS restock_urgency,
    CASE WHEN days <= 30 AND v > 0 AND greatest(0, v * 30 - cur) >= 5
         THEN 'Current stock will last ' || CAST(round(days, 1) AS DECIMAL(10,1)) || ' days at current velocity'
         END AS restock_reason,
    {ts_text("last_sale")} AS last_sale_date, {ts_text("last_restock")} AS last_restock_date,
    CAST(u AS BIGINT) AS total_sales_7d
"""


def flat_insights(insights: DataFrame, *keys: str) -> DataFrame:
    advice = "restock_recommendation"
    return insights.select(
        "product_id", *keys, "current_stock", "stock_status", "velocity_units_per_day",
        "days_until_stockout", "is_dead_stock",
        F.coalesce(F.col(f"{advice}.recommended_quantity"), F.lit(-1)).alias("restock_quantity"),
        F.col(f"{advice}.urgency").alias("restock_urgency"),
        F.col(f"{advice}.reason").alias("restock_reason"),
        "last_sale_date", "last_restock_date", "total_sales_7d",
    )


@query(
    "inventory_insights",
    _STOCK_LOG + f""",
    upto AS (SELECT * FROM prev WHERE event_ts <= TIMESTAMP '{STOCK_AS_OF}'),
    one AS (
        SELECT product_id, arg_max(after_stock, (us, kind, coalesce(order_id, -1), coalesce(line_number, -1),
                                                 coalesce(quantity, -1))) AS cur,
               coalesce(sum(qty) FILTER (event_ts > TIMESTAMP '{STOCK_AS_OF}' - INTERVAL 7 DAYS), 0) AS u,
               max(event_ts) FILTER (kind = 1) AS last_sale,
               max(event_ts) FILTER (kind = 0 AND stock > before_stock) AS last_restock,
               TIMESTAMP '{STOCK_AS_OF}' AS now_ts
        FROM upto GROUP BY 1),
    two AS (SELECT *, CAST(u AS DOUBLE) / 7 AS v FROM one),
    three AS (SELECT *, CASE WHEN u > 0 THEN CAST(cur * 7 AS DOUBLE) / CAST(u AS DOUBLE) ELSE 999 END AS days FROM two)
    SELECT product_id, p.name AS product_name, CAST(p.price AS DOUBLE) AS price, {_INSIGHT_OUT}
    FROM three JOIN prod p ON p.id = product_id
    """,
    ("prod", "item"),
)
def _inventory_insights(spark, sf):
    found = inventory.inventory_insights(*_stock(spark, sf), as_of=STOCK_AS_OF)
    return flat_insights(found, "product_name", "price")


HISTORY_SQL = _STOCK_LOG + f""",
    one AS (
        SELECT product_id, CASE kind WHEN 0 THEN 'product' ELSE 'sale' END AS event_kind, event_ts AS now_ts,
               after_stock AS cur,

               max(CASE WHEN kind = 1 THEN event_ts END) OVER o AS last_sale,
               max(CASE WHEN kind = 0 AND stock > before_stock THEN event_ts END) OVER o AS last_restock,
               coalesce(sum(qty) OVER r, 0) - coalesce(sum(qty) OVER later, 0) AS u
        FROM prev
        WINDOW o AS (PARTITION BY product_id ORDER BY us, kind, order_id, line_number, quantity
                     ROWS UNBOUNDED PRECEDING),
               r AS (PARTITION BY product_id ORDER BY us
                     RANGE BETWEEN 604799999999 PRECEDING AND CURRENT ROW),
               later AS (PARTITION BY product_id, us ORDER BY kind, order_id, line_number, quantity
                         ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
    two AS (SELECT *, CAST(u AS DOUBLE) / 7 AS v FROM one),
    three AS (SELECT *, CASE WHEN u > 0 THEN CAST(cur * 7 AS DOUBLE) / CAST(u AS DOUBLE) ELSE 999 END AS days FROM two)
    SELECT product_id, event_kind, {ts_text("now_ts")} AS event_ts, {_INSIGHT_OUT} FROM three
"""


@query("inventory_history", HISTORY_SQL, ("prod", "item"))
def _inventory_history(spark, sf):
    return flat_insights(inventory.inventory_history(*_stock(spark, sf)), "event_kind", "event_ts")


@query(
    "trending_products",
    f"""
    + t AS (
        SELECT product_id,
               sum(CASE WHEN event_ts > TIMESTAMP '{STOCK_AS_OF}' - INTERVAL 7 DAYS THEN quantity ELSE 0 END) AS a,
               sum(CASE WHEN event_ts > TIMESTAMP '{STOCK_AS_OF}' - INTERVAL 7 DAYS THEN 0 ELSE quantity END) AS b
        FROM item
        WHERE event_ts <= TIMESTAMP '{STOCK_AS_OF}' AND event_ts > TIMESTAMP '{STOCK_AS_OF}' - INTERVAL 14 DAYS
        GROUP BY 1)
    SELECT product_id, CAST(a AS DOUBLE) / 7 AS velocity, CAST(b AS DOUBLE) / 7 AS previous_velocity,
           CAST(a - b AS BIGINT) AS unit_change,
           CASE WHEN b <> 0 THEN CAST(a AS DOUBLE) / b END AS ratio
    FROM t
    """,
    ("item",),
)
def _trending(spark, sf):
    return inventory.trending_products(fixtures.order_items(spark, sf), STOCK_AS_OF)


@query(
    "segments_of_keyed_events",
    _rfm_events_sql("CASE WHEN id % 7 = 0 THEN NULL ELSE customer_id END"),
    ("ev",),
)
def _segments_of_keyed_events(spark, sf):
    """Events without a customer belong to nobody."""
    return rfm.rfm_segments(_some_without_key(spark, sf), RFM_AS_OF).select(
        "customer_id", "frequency", "monetary_value", "segment"
    )


def _some_without_key(spark, sf):
    events = sale_events(spark, sf)
    return events.withColumn("customer_id", F.when(F.col("id") % 7 != 0, F.col("customer_id")))


@query(
    "rapid_orders_of_keyed_events",
    """
    + k AS (SELECT * FROM ev WHERE operation <> 'd' AND id % 7 <> 0),
    n AS (SELECT id, customer_id, count(*) OVER (PARTITION BY customer_id ORDER BY event_us
                 RANGE BETWEEN 299999999 PRECEDING AND CURRENT ROW) AS c FROM k)
    SELECT customer_id || '_' || id || '_rapid_orders' AS alert_id, c AS order_count FROM n WHERE c >= 2
    """,
    ("ev",),
)
def _rapid_orders_of_keyed_events(spark, sf):
    found = anomalies.anomalies(_some_without_key(spark, sf), anomalies.Limits(), [anomalies.RAPID])
    return found.select("alert_id", F.col("details.order_count").cast("long").alias("order_count"))


@query(
    "stock_without_returns",
    """
    + sold AS (SELECT product_id, sum(quantity) AS q FROM item WHERE (order_id + line_number) % 5 <> 0 GROUP BY 1)
    SELECT coalesce(p.id, s.product_id) AS product_id,
           greatest(0, coalesce(p.stock_quantity, 0) - coalesce(CAST(s.q AS BIGINT), 0)) AS current_stock
    FROM prod p FULL JOIN sold s ON s.product_id = p.id
    """,
    ("prod", "item"),
)
def _stock_without_returns(spark, sf):
    """Items with a negative quantity are left out of the clamped stock."""
    q = F.col("quantity")
    items = fixtures.order_items(spark, sf).withColumn(
        "quantity", F.when((F.col("order_id") + F.col("line_number")) % 5 == 0, -q).otherwise(q)
    )
    return inventory.optimizer_stock(fixtures.products(spark, sf), items)


@query(
    "changes_of_one_transaction",
    """
    SELECT customer_id, max(id) AS last_id FROM ev GROUP BY customer_id HAVING max(id) % 3 <> 0
    """,
    ("ev",),
)
def _changes_of_one_transaction(spark, sf):
    """All changes at one time, told apart by their offset; the last of a key may delete it."""
    log = fixtures.order_events(spark, sf).select(
        F.col("customer_id").alias("key"), F.col("id").alias("last_id"), F.col("id").alias("offset"),
        F.lit("2025-01-15").cast("timestamp").alias("event_ts"), F.when(F.col("id") % 3 == 0, "d").otherwise("u").alias("operation"),
    )
    return state.latest_state(log, "key", envelope.event_order(log)).select(F.col("key").alias("customer_id"), "last_id")


@query(
    "sessions_of_keyed_events",
    """
    + g AS (
        SELECT *, CASE WHEN event_us - lag(event_us) OVER (PARTITION BY customer_id ORDER BY event_us)
                            <= 7200000000 THEN 0 ELSE 1 END AS opens
        FROM ev WHERE operation <> 'd' AND id % 7 <> 0),
    h AS (SELECT *, sum(opens) OVER (PARTITION BY customer_id ORDER BY event_us) AS n FROM g)
    SELECT customer_id, min(event_us) AS first_us, count(*) AS order_count FROM h GROUP BY customer_id, n
    """,
    ("ev",),
)
def _sessions_of_keyed_events(spark, sf):
    """Orders without a customer are no session."""
    found = windows.customer_sessions(_some_without_key(spark, sf), "2 hours")
    return found.select("customer_id", F.unix_micros("session_start").alias("first_us"), "order_count")


@query(
    "bursts_of_keyed_events",
    """
    + g AS (
        SELECT *, row_number() OVER w AS pos,
               CASE WHEN event_us - lag(event_us) OVER w <= 3600000000 THEN 0 ELSE 1 END AS opens
        FROM ev WHERE operation <> 'd' AND id % 7 <> 0
        WINDOW w AS (PARTITION BY customer_id ORDER BY event_us, id)),
    h AS (SELECT *, max(CASE WHEN opens = 1 THEN pos END)
                    OVER (PARTITION BY customer_id ORDER BY event_us, id) AS first FROM g)
    SELECT customer_id, id, pos - first + 1 AS burst_length FROM h WHERE pos - first + 1 >= 2
    """,
    ("ev",),
)
def _bursts_of_keyed_events(spark, sf):
    """Orders without a customer are no burst."""
    return anomalies.order_bursts(_some_without_key(spark, sf), k=2, gap="1 hour").select("customer_id", "id", "burst_length")


@query(
    "inventory_of_one_transaction",
    """
    + step AS (
        SELECT id, 100 AS stock, 1 AS n FROM prod UNION ALL SELECT id, 7 + id % 5, 2 FROM prod),
    last AS (SELECT id, max_by(stock, n) AS stock FROM step GROUP BY 1),
    sold AS (SELECT product_id, CAST(sum(quantity) AS BIGINT) AS q FROM item WHERE event_ts >= TIMESTAMP '1998-11-01' GROUP BY 1)
    SELECT l.id AS product_id, CAST(greatest(0, l.stock - coalesce(s.q, 0)) AS BIGINT) AS current_stock
    FROM last l LEFT JOIN sold s ON l.id = s.product_id
    """,
    ("prod", "item"),
)
def _inventory_of_one_transaction(spark, sf):
    """Two recounts of a product at one time: the log's offset says which is the later, whatever order they are read in."""
    products = fixtures.products(spark, sf).withColumn("event_ts", F.lit("1998-11-01").cast("timestamp"))
    second = products.withColumns({"stock_quantity": (7 + F.col("id") % 5).cast("int"), "offset": F.lit(2)})
    first = products.withColumns({"stock_quantity": F.lit(100), "offset": F.lit(1)})
    items = fixtures.order_items(spark, sf).filter("event_ts >= '1998-11-01'")
    found = inventory.inventory_insights(second.unionByName(first), items, "2030-01-01")
    return found.select("product_id", "current_stock")


# ---- patterns of events

def _chain_sql(first: str, last: str, gap_us: int, extra: str = "") -> str:
    """Events of one kind, each with the latest earlier event of another kind, if that is near enough."""
    return f"""
    + k AS (
        SELECT *, max(CASE WHEN status = '{first}' THEN event_us END) OVER w AS began{extra} FROM ev
        WINDOW w AS (PARTITION BY customer_id ORDER BY event_us, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT customer_id, id, began AS started_us FROM k WHERE status = '{last}' AND began IS NOT NULL AND event_us - began <= {gap_us}
    """


@query("pattern_sequence", _chain_sql("view", "purchase", 43_200_000_000), ("ev",))
def _pattern_sequence(spark, sf):
    """A purchase within twelve hours of a view."""
    steps = [patterns.Step(F.col("status") == "view"), patterns.Step(F.col("status") == "purchase", within="12 hours")]
    return patterns.match(fixtures.order_events(spark, sf), steps).drop("event_us")


@query(
    "pattern_without",
    _chain_sql("view", "purchase", 86_400_000_000, ", max(CASE WHEN status = 'error' THEN event_us END) OVER w AS barred")
    + " AND (barred IS NULL OR barred < began)",
    ("ev",),
)
def _pattern_without(spark, sf):
    """A purchase within a day of a view, without an error between them."""
    kind = F.col("status")
    steps = [patterns.Step(kind == "view"), patterns.Step(kind == "purchase", within="24 hours", unless=kind == "error")]
    return patterns.match(fixtures.order_events(spark, sf), steps).drop("event_us")


@query(
    "pattern_repeated",
    """
    + c AS (
        SELECT *, row_number() OVER w AS pos, lag(event_us, 2) OVER w AS began,
               event_us - lag(event_us) OVER w <= 172800000000 AND lag(event_us) OVER w - lag(event_us, 2) OVER w <= 172800000000 AS near
        FROM ev WHERE status = 'click' WINDOW w AS (PARTITION BY customer_id ORDER BY event_us, id)),
    k AS (
        SELECT e.customer_id, e.id, e.event_us, max_by(c.event_us, (c.event_us, c.id)) AS stood, max_by(c.began, (c.event_us, c.id)) AS began
        FROM ev e JOIN c ON c.customer_id = e.customer_id AND c.near AND (c.event_us, c.id) < (e.event_us, e.id)
        WHERE e.status = 'purchase' GROUP BY 1, 2, 3)
    SELECT customer_id, id, began AS started_us FROM k WHERE event_us - stood <= 172800000000
    """,
    ("ev",),
)
def _pattern_repeated(spark, sf):
    """Three clicks, each within two days of the one before, and a purchase within two days of the third."""
    steps = [
        patterns.Step(F.col("status") == "click", within="2 days", times=3), patterns.Step(F.col("status") == "purchase", within="2 days"),
    ]
    return patterns.match(fixtures.order_events(spark, sf), steps).drop("event_us")
