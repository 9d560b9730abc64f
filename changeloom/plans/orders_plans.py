"""Queries over orders, items and products: logs, state, reports and joins."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.decimals import decode_decimal, encode_decimal, overflows
from ..functions.registry import register
from ..functions.times import created_date, iso, parse_time
from ..operators import envelope, orders as order_ops, reports, state
from ..schemas import OPS_REPORT, ORDERS, PRODUCTS
from ..session import scratch_path
from ..sinks.logs import archive
from ..sinks.reports import write_report
from ..sinks.upsert import KeyedTable, to_item_json
from ..sources import changes, fixtures
from ..streaming import pipelines
from .catalog import query, ts_text


def order_log(spark: SparkSession, sf: str, layout: str = "wrapped") -> DataFrame:
    """Orders as a snapshot log, one JSON text per order."""
    orders = fixtures.spread(fixtures.orders(spark, sf))
    return changes.snapshot_as_changes(orders, ORDERS, F.col("event_ts"), layout)


def order_rows(spark: SparkSession, sf: str, layout: str = "wrapped", ops=OPS_REPORT) -> DataFrame:
    """The same orders after a trip through the log."""
    return envelope.with_ops(envelope.parse_rows(order_log(spark, sf, layout), ORDERS), ops)


@query(
    "daily_sales",
    """
    SELECT strftime(event_ts, '%Y-%m-%d') AS date, CAST(sum(total_amount) AS DOUBLE) AS total_amount,
           count(*) AS order_count
    FROM ord GROUP BY 1
    """,
    ("ord",),
)
def _daily_sales(spark, sf):
    return reports.daily_sales(order_rows(spark, sf))


@query(
    "product_sales",
    """
    SELECT product_id, CAST(sum(quantity) AS BIGINT) AS quantity_sold,
           CAST(sum(quantity * price_cents) AS BIGINT) AS revenue_cents
    FROM item GROUP BY 1
    """,
    ("item",),
)
def _product_sales(spark, sf):
    sold = reports.product_sales(fixtures.order_items(spark, sf))
    return sold.select(
        "product_id", "quantity_sold", (F.col("total_revenue") * 100).cast("bigint").alias("revenue_cents")
    )


@query(
    "top_products",
    """
    SELECT product_id, CAST(sum(quantity) AS BIGINT) AS quantity_sold,
           CAST(sum(quantity * price_cents) AS BIGINT) AS revenue_cents
    FROM item GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 100
    """,
    ("item",),
)
def _top_products(spark, sf):
    top = reports.top_products(fixtures.order_items(spark, sf))
    return top.select(
        "product_id", "quantity_sold", (F.col("total_revenue") * 100).cast("bigint").alias("revenue_cents")
    )


@query(
    "customer_metrics",
    """
    SELECT customer_id, count(*) AS order_count, CAST(sum(total_amount) AS DOUBLE) AS total_spent
    FROM ord GROUP BY 1
    """,
    ("ord",),
)
def _customer_metrics(spark, sf):
    return reports.customer_metrics(order_rows(spark, sf, "bare"))


@query(
    "top_customers",
    """
    SELECT customer_id, count(*) AS order_count, CAST(sum(total_amount) AS DOUBLE) AS total_spent
    FROM ord GROUP BY 1 ORDER BY sum(total_amount) DESC, 1 LIMIT 100
    """,
    ("ord",),
)
def _top_customers(spark, sf):
    return reports.top_customers(fixtures.orders(spark, sf))


# ---- status changes: each order starts pending and moves on, day by day, to its final status

_STATUS_SQL = """
    + log AS (
        SELECT id, 0 AS seq, 'c' AS operation, 'pending' AS status FROM ord
        UNION ALL SELECT id, 1, 'u', CASE status WHEN 'pending' THEN 'pending' ELSE 'processing' END FROM ord
        UNION ALL SELECT id, 2, 'u', 'completed' FROM ord WHERE status = 'completed'),
    moves AS (
        SELECT operation, status,
               lag(status) OVER (PARTITION BY id ORDER BY seq) AS old
        FROM log),
    deltas AS (
        SELECT old AS status, -1 AS d FROM moves WHERE operation = 'u' AND old <> status
        UNION ALL SELECT status, 1 FROM moves WHERE operation = 'u' AND old <> status)
"""


def status_log(spark: SparkSession, sf: str, layout: str) -> DataFrame:
    orders = fixtures.spread(fixtures.orders(spark, sf))

    def step(seq: int, op: str, status, old):
        return F.struct(
            F.lit(seq).alias("seq"), F.lit(op).alias("op"), status.alias("status"), old.alias("old")
        )

    pending, none = F.lit("pending"), F.lit(None).cast("string")
    second = F.when(F.col("status") == "pending", pending).otherwise(F.lit("processing"))
    steps = F.array(
        step(0, "c", pending, none),
        step(1, "u", second, pending),
        F.when(F.col("status") == "completed", step(2, "u", F.lit("completed"), second)),
    )
    rows = orders.withColumn("_s", F.explode(F.filter(steps, lambda s: s.isNotNull()))).withColumns({
        "status": F.col("_s.status"), "_op": F.col("_s.op"), "_old": F.col("_s.old"),
        "_at": F.col("event_ts") + F.make_dt_interval(days=F.col("_s.seq")),
    })
    before = None
    if layout == "standard":
        image = [
            (F.col("_old") if c == "status" else F.col(c)).alias(c) for c in ORDERS.columns
        ]
        rows = rows.withColumn("_before", F.when(F.col("_old").isNotNull(), F.struct(*image)))
        before = F.col("_before")
    return changes.to_change_log(rows, ORDERS, F.col("_op"), F.col("_at"), layout, before)


def status_events(spark: SparkSession, sf: str, layout: str) -> DataFrame:
    return envelope.parse_rows(status_log(spark, sf, layout), ORDERS, old=["status"])


@query(
    "status_deltas",
    _STATUS_SQL + "SELECT status, CAST(sum(d) AS BIGINT) AS delta FROM deltas GROUP BY 1",
    ("ord",),
)
def _status_deltas(spark, sf):
    """Flattened updates carry no old image: the old status comes from the order's history."""
    return state.status_deltas(status_events(spark, sf, "wrapped"))


STATUS_COUNTS_SQL = _STATUS_SQL + """
    SELECT status, CAST(sum(d) AS BIGINT) AS order_count FROM (
        SELECT status, d FROM deltas
        UNION ALL SELECT status, 1 FROM log WHERE operation = 'c') GROUP BY 1
"""


@query("order_status_distribution", STATUS_COUNTS_SQL, ("ord",))
def _status_distribution(spark, sf):
    return state.order_status_distribution(status_events(spark, sf, "standard"), full_images=True)


@query(
    "sales_summary",
    """
    SELECT (SELECT count(*) FROM ord) AS total_orders,
           (SELECT CAST(sum(total_amount) AS DOUBLE) FROM ord) AS total_revenue,
           (SELECT count(DISTINCT customer_id) FROM ord) AS unique_customers,
           (SELECT count(DISTINCT product_id) FROM item) AS unique_products_sold
    """,
    ("ord", "item"),
)
def _summary(spark, sf):
    return reports.summary(fixtures.orders(spark, sf), fixtures.order_items(spark, sf))


@query(
    "sales_summary_with_status",
    """
    SELECT 'total_orders' AS metric, CAST(count(*) AS DOUBLE) AS value FROM ord
    UNION ALL SELECT 'total_revenue', CAST(sum(total_amount) AS DOUBLE) FROM ord
    UNION ALL SELECT 'unique_customers', CAST(count(DISTINCT customer_id) AS DOUBLE) FROM ord
    UNION ALL SELECT 'unique_products_sold', CAST(count(DISTINCT product_id) AS DOUBLE) FROM item
    UNION ALL SELECT 'status:' || status, CAST(count(*) AS DOUBLE) FROM ord GROUP BY status
    """,
    ("ord", "item"),
)
def _summary_with_status(spark, sf):
    orders = fixtures.orders(spark, sf)
    return reports.summary_with_status(
        orders, fixtures.order_items(spark, sf), status_events(spark, sf, "wrapped")
    )


# ---- envelope and codec


@query("decimal_roundtrip", "SELECT id, CAST(total_amount AS DOUBLE) AS total_amount FROM ord", ("ord",))
def _decimal_roundtrip(spark, sf):
    return order_rows(spark, sf).select("id", "total_amount")


_PARSED_SQL = f"""
    SELECT id, customer_id, CAST(total_amount AS DOUBLE) AS total_amount, status, 'r' AS operation,
           'orders' AS "table", {ts_text("event_ts")} AS event_ts, {ts_text("event_ts")} AS created_at
    FROM ord
"""


def _parsed(spark, sf, layout):
    parsed = envelope.parse_changes(order_log(spark, sf, layout), ORDERS)
    return parsed.select(
        "after.id", "after.customer_id", "after.total_amount", "after.status", "operation", "table",
        "event_ts", "after.created_at",
    )


for _layout in ("wrapped", "bare", "standard"):
    query(f"parse_{_layout}", _PARSED_SQL, ("ord",))(
        lambda spark, sf, layout=_layout: _parsed(spark, sf, layout)
    )


@query(
    "delete_images",
    """
    SELECT operation, count(*) AS events, count(*) FILTER (operation = 'd') AS with_before,
           count(*) FILTER (operation <> 'd') AS with_after, CAST(sum(total_amount) AS DOUBLE) AS amount
    FROM ev GROUP BY 1
    """,
    ("ev",),
)
def _delete_images(spark, sf):
    events = fixtures.spread(fixtures.order_events(spark, sf))
    log = changes.to_change_log(events, ORDERS, F.col("operation"), F.col("event_ts"))
    parsed = envelope.parse_changes(log, ORDERS)
    amount = F.coalesce("after.total_amount", "before.total_amount")
    return parsed.groupBy("operation").agg(
        F.count(F.lit(1)).alias("events"),
        F.count("before").alias("with_before"),
        F.count("after").alias("with_after"),
        F.sum(amount).alias("amount"),
    )


@query(
    "route_tables",
    """
    SELECT 'orders' AS "table", count(*) AS events, CAST(sum(total_amount) AS DOUBLE) AS amount FROM ord
    UNION ALL SELECT 'products', count(*), CAST(sum(price) AS DOUBLE) FROM prod
    """,
    ("ord", "prod"),
)
def _route_tables(spark, sf):
    mixed = order_log(spark, sf).unionByName(
        changes.snapshot_as_changes(fixtures.products(spark, sf), PRODUCTS, F.col("event_ts"), "bare")
    )
    routed = envelope.route(mixed, ("orders", "products"))

    def total(name: str, column: str) -> DataFrame:
        return routed[name].groupBy("table").agg(
            F.count(F.lit(1)).alias("events"), F.sum(f"after.{column}").alias("amount")
        )

    return total("orders", "total_amount").unionByName(total("products", "price"))


@query(
    "created_dates",
    """
    SELECT CASE id % 5 WHEN 4 THEN '2024-06-01' ELSE strftime(event_ts, '%Y-%m-%d') END AS date,
           count(*) AS order_count
    FROM ord GROUP BY 1
    """,
    ("ord",),
)
def _created_dates(spark, sf):
    orders = fixtures.orders(spark, sf)
    form, ts = F.col("id") % 5, F.col("event_ts")
    text = (
        F.when(form == 0, F.unix_micros(ts).cast("string"))
        .when(form == 1, F.unix_millis(ts).cast("string"))
        .when(form == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(form == 3, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    )
    return reports.daily_sales(orders, created_date(text, "2024-06-01")).select("date", "order_count")


@query(
    "sql_functions",
    """
    SELECT id, CAST(total_amount * 100 AS BIGINT) AS cents, CAST(total_amount AS DOUBLE) AS amount
    FROM ord
    """,
    ("ord",),
)
def _sql_functions(spark, sf):
    register(spark)
    return order_log(spark, sf, "bare").selectExpr(
        "CAST(get_json_object(value, '$.id') AS BIGINT) AS id",
        "decode_cents(get_json_object(value, '$.total_amount')) AS cents",
        "decode_money(get_json_object(value, '$.total_amount')) AS amount",
    )


# ---- state

_LAST_EVENT = """
    SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY event_us DESC, id DESC) = 1
"""


def event_rows(spark, sf):
    return fixtures.order_events(spark, sf).select(
        "customer_id", "id", "operation", "total_amount", "status", "event_us"
    )


@query(
    "latest_state",
    f"""
    SELECT customer_id, id, operation, CAST(total_amount AS DOUBLE) AS total_amount, status, event_us
    FROM ({_LAST_EVENT}) WHERE operation <> 'd'
    """,
    ("ev",),
)
def _latest_state(spark, sf):
    return state.latest_state(event_rows(spark, sf), "customer_id", ["event_us", "id"])


@query(
    "compact_log",
    f"""
    SELECT customer_id, id, operation, CAST(total_amount AS DOUBLE) AS total_amount, status, event_us
    FROM ({_LAST_EVENT})
    """,
    ("ev",),
)
def _compact_log(spark, sf):
    return state.compact(event_rows(spark, sf), "customer_id", ["event_us", "id"])


@query(
    "rebuild_table",
    """
    + log AS (
        SELECT c_custkey AS customer_id, 'r' AS operation, CAST(-1 AS BIGINT) AS id, CAST(0 AS BIGINT) AS event_us
        FROM customer
        UNION ALL SELECT customer_id, operation, id, event_us FROM ev)
    SELECT customer_id, operation, id FROM (
        SELECT * FROM log
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY event_us DESC, id DESC) = 1)
    WHERE operation <> 'd'
    """,
    ("ev",),
)
def _rebuild_table(spark, sf):
    snapshot = fixtures.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.lit("r").alias("operation"),
        F.lit(-1).cast("bigint").alias("id"),
        F.lit(0).cast("bigint").alias("event_us"),
    )
    log = event_rows(spark, sf).select("customer_id", "operation", "id", "event_us")
    rebuilt = state.rebuild(snapshot, log, "customer_id", ["event_us", "id"])
    return rebuilt.select("customer_id", "operation", "id")


@query(
    "keyed_table_upserts",
    f"""
    SELECT customer_id, id, operation, CAST(total_amount AS DOUBLE) AS total_amount, status, event_us
    FROM ({_LAST_EVENT}) WHERE operation <> 'd'
    """,
    ("ev",),
)
def _keyed_table(spark, sf):
    """Three batches, one of them replayed, with a compaction in between."""
    rows = event_rows(spark, sf)
    table = KeyedTable(scratch_path(spark, "keyed"), "customer_id", ["event_us", "id"])
    gone = F.col("operation") == "d"
    for batch in (0, 1, 1):
        table.write(rows.filter(F.col("id") % 3 == batch), batch, gone)
    table.compact(spark)
    table.write(rows.filter(F.col("id") % 3 == 2), 2, gone)
    return table.read(spark)


@query(
    "dedupe_changes",
    "SELECT operation, count(*) AS events, CAST(sum(total_amount) AS DOUBLE) AS amount FROM ev GROUP BY 1",
    ("ev",),
)
def _dedupe_changes(spark, sf):
    rows = event_rows(spark, sf).withColumn("table", F.lit("orders"))
    twice = rows.unionByName(rows.filter("status <> 'view'"))
    once = state.dedupe_changes(twice, ["table", "id", "operation", "event_us"])
    return once.groupBy("operation").agg(
        F.count(F.lit(1)).alias("events"), F.sum("total_amount").alias("amount")
    )


@query(
    "retained_changes",
    """
    SELECT operation, count(*) AS events FROM ev
    WHERE event_ts >= TIMESTAMP '2024-01-24 00:00:00' GROUP BY 1
    """,
    ("ev",),
)
def _retained(spark, sf):
    kept = state.retain(fixtures.order_events(spark, sf), 7, "2024-01-31 00:00:00")
    return kept.groupBy("operation").agg(F.count(F.lit(1)).alias("events"))


@query(
    "op_counts",
    'SELECT \'orders\' AS "table", operation, count(*) AS events FROM ev GROUP BY 2',
    ("ev",),
)
def _op_counts(spark, sf):
    log = changes.to_change_log(
        fixtures.spread(fixtures.order_events(spark, sf)), ORDERS, F.col("operation"), F.col("event_ts")
    )
    return reports.op_counts(envelope.read_metadata(log))


@query(
    "include_list",
    'SELECT \'orders\' AS "table", count(*) AS events FROM ord',
    ("ord",),
)
def _include_list(spark, sf):
    log = order_log(spark, sf).unionByName(
        changes.snapshot_as_changes(fixtures.products(spark, sf), PRODUCTS, F.col("event_ts"))
    )
    kept = changes.filter_tables(envelope.read_metadata(log), ["orders", "order_items"])
    return kept.groupBy("table").agg(F.count(F.lit(1)).alias("events"))


@query(
    "replayed_files",
    f"""
    SELECT id, customer_id, CAST(total_amount AS DOUBLE) AS total_amount, {ts_text("event_ts")} AS event_ts
    FROM ord
    """,
    ("ord",),
)
def _replayed_files(spark, sf):
    """The log written as text and read back."""
    path = scratch_path(spark, "log")
    order_log(spark, sf).write.text(path)
    parsed = envelope.parse_changes(changes.read_change_files(spark, path), ORDERS)
    return parsed.select("after.id", "after.customer_id", "after.total_amount", "event_ts")


@query(
    "replayed_paths",
    """
    SELECT 'orders' AS "table", count(*) AS events, CAST(sum(id) AS BIGINT) AS ids FROM ord
    UNION ALL SELECT 'products', count(*), CAST(sum(id) AS BIGINT) FROM prod
    """,
    ("ord", "prod"),
)
def _replayed_paths(spark, sf):
    """Several logs replayed as one stream; each table's events are routed from the mixed log."""
    paths = [scratch_path(spark, f"log-{n}") for n in ("orders", "products")]
    order_log(spark, sf).select("value").write.text(paths[0])
    changes.snapshot_as_changes(fixtures.products(spark, sf), PRODUCTS, F.col("event_ts"), "bare").select("value").write.text(paths[1])
    mixed = pipelines.run(
        changes.read_change_files(spark, paths, streaming=True), scratch_path(spark, "paths-state"), scratch_path(spark, "mixed-log")
    )
    routed = envelope.route(mixed, ("orders", "products"))
    counts = [r.groupBy("table").agg(F.count(F.lit(1)).alias("events"), F.sum("after.id").alias("ids")) for r in routed.values()]
    return counts[0].unionByName(counts[1])


@query(
    "wire_amounts",
    """
    SELECT id, CASE WHEN id % 9 IN (1, 2, 3) THEN 0 WHEN id % 9 = 8 THEN NULL ELSE CAST(total_amount AS DOUBLE) END AS amount,
           id % 9 = 8 AS too_large
    FROM ord
    """,
    ("ord",),
)
def _wire_amounts(spark, sf):
    """Money as base64 of several lengths and as plain text; null, empty and bad text give 0, what does not fit is flagged."""
    form, amount = F.col("id") % 9, F.col("total_amount")
    units = F.unhex(F.lpad(F.hex((amount * 100).cast("bigint")), F.lit(24), F.lit("0")))
    text = (
        F.when(form == 1, F.lit(None).cast("string")).when(form == 2, F.lit("")).when(form == 3, F.lit("!!bad"))
        .when(form == 4, amount.cast("string")).when(form == 5, F.base64(units)).when(form == 8, F.lit("99999999999.99"))
        .otherwise(encode_decimal(amount))
    )
    return fixtures.orders(spark, sf).select("id", decode_decimal(text).alias("amount"), overflows(text).alias("too_large"))


@query(
    "wire_times",
    """
    SELECT id, CASE WHEN id % 7 = 5 THEN NULL ELSE strftime(event_ts + to_milliseconds(CASE WHEN id % 7 IN (1, 3) THEN 250 ELSE 0 END),
                                                            '%Y-%m-%dT%H:%M:%S') END AS iso,
           CASE WHEN id % 7 = 5 THEN NULL ELSE epoch_us(event_ts) + CASE WHEN id % 7 IN (1, 3) THEN 250000 ELSE 0 END END AS micros
    FROM ord
    """,
    ("ord",),
)
def _wire_times(spark, sf):
    """Times as ISO text with and without ``Z``, with fractions and offsets, as milliseconds and microseconds, and as bad text."""
    form, ts = F.col("id") % 7, F.col("event_ts")
    later = ts + F.expr("INTERVAL 250 MILLISECONDS")
    text = (
        F.when(form == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(form == 1, F.date_format(later, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .when(form == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(form == 3, F.unix_millis(later).cast("string"))
        .when(form == 4, F.unix_micros(ts).cast("string"))
        .when(form == 5, F.lit("yesterday"))
        .otherwise(F.concat(F.date_format(ts + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
    )
    found = fixtures.orders(spark, sf).select("id", parse_time(text).alias("ts"))
    return found.select("id", iso(F.col("ts")).alias("iso"), F.unix_micros("ts").alias("micros"))


@query(
    "archived_changes",
    """
    SELECT 'orders' AS "table", strftime(event_ts, '%Y-%m-%d') AS event_date, operation, 'event' AS status, count(*) AS events
    FROM ev GROUP BY 2, 3
    UNION ALL SELECT 'unknown', NULL, 'unknown', 'tombstone', count(*) FROM ev WHERE operation = 'd'
    UNION ALL SELECT 'unknown', NULL, 'unknown', 'malformed', count(*) FROM ev WHERE id % 100 = 0
    """,
    ("ev",),
)
def _archived(spark, sf):
    root = scratch_path(spark, "archive")
    log = changes.to_change_log(
        fixtures.spread(fixtures.order_events(spark, sf)), ORDERS, F.col("operation"), F.col("event_ts")
    )
    # Each delete is followed by a tombstone, and some messages are cut short.
    events = fixtures.order_events(spark, sf)
    tombstones = events.filter("operation = 'd'").select(F.lit(None).cast("string").alias("value"))
    broken = events.filter("id % 100 = 0").select(F.lit('{"id": 1,').alias("value"))
    archive(log.select("value").unionByName(tombstones).unionByName(broken), root)
    rows = spark.read.parquet(root)
    return rows.groupBy("table", "event_date", "operation", "status").agg(F.count(F.lit(1)).alias("events"))


@query(
    "table_counts",
    """
    SELECT 'Products' AS table_name, count(*) AS record_count FROM part
    UNION ALL SELECT 'Orders', count(*) FROM orders
    UNION ALL SELECT 'Order Items', count(*) FROM lineitem
    """,
)
def _table_counts(spark, sf):
    return reports.table_counts({
        "Products": fixtures.products(spark, sf),
        "Orders": fixtures.orders(spark, sf),
        "Order Items": fixtures.order_items(spark, sf),
    })


@query(
    "recent_changes",
    """
    SELECT 'Products' AS table_name, count(*) AS total_records,
           count(*) FILTER (event_ts > TIMESTAMP '1999-12-31 23:59:00') AS recent_changes FROM prod
    UNION ALL SELECT 'Orders', count(*),
           count(*) FILTER (event_ts > TIMESTAMP '1999-12-31 23:59:00') FROM ord
    UNION ALL SELECT 'Order Items', count(*),
           count(*) FILTER (event_ts > TIMESTAMP '1999-12-31 23:59:00') FROM item
    """,
    ("prod", "ord", "item"),
)
def _recent_changes(spark, sf):
    return reports.recent_changes(
        {
            "Products": (fixtures.products(spark, sf), "updated_at"),
            "Orders": (fixtures.orders(spark, sf), "updated_at"),
            "Order Items": (fixtures.order_items(spark, sf), "created_at"),
        },
        "2000-01-01 00:04:00",
    )


# ---- report files and store items


@query(
    "report_files",
    """
    SELECT strftime(event_ts, '%Y-%m-%d') AS date, CAST(sum(total_amount) AS DOUBLE) AS total_amount,
           count(*) AS order_count
    FROM ord GROUP BY 1
    """,
    ("ord",),
)
def _report_files(spark, sf):
    """The daily report as written, read back from its rows."""
    at = datetime(2025, 1, 15, 10, 30)
    daily = reports.daily_sales(fixtures.orders(spark, sf))
    path = write_report(daily, "date", "daily_sales", scratch_path(spark, "reports"), at)
    value = "struct<total_amount:decimal(22,2),order_count:bigint>"
    rows = spark.read.schema(f"report_type string, key string, value {value}").json(path)
    return rows.select(F.col("key").alias("date"), "value.*")


@query(
    "customer_report_file",
    """
    SELECT CAST(customer_id AS VARCHAR) AS customer_id, count(*) AS order_count,
           CAST(sum(total_amount) AS DOUBLE) AS total_spent
    FROM ord GROUP BY customer_id
    """,
    ("ord",),
)
def _customer_report_file(spark, sf):
    """A report of every customer: the same layout at any length."""
    at = datetime(2025, 1, 15, 10, 30)
    rows = reports.customer_metrics(fixtures.orders(spark, sf))
    path = write_report(rows, "customer_id", "customers", scratch_path(spark, "reports"), at)
    value = "struct<order_count:bigint,total_spent:decimal(22,2)>"
    back = spark.read.schema(f"key string, value {value}").json(path)
    return back.select(F.col("key").alias("customer_id"), "value.order_count", "value.total_spent")


@query(
    "short_report_object",
    """
    SELECT status, count(*) AS order_count FROM ord GROUP BY status
    """,
    ("ord",),
)
def _short_report_object(spark, sf):
    """A report that is short by definition, as one JSON object."""
    rows = fixtures.orders(spark, sf).groupBy("status").agg(F.count("*").alias("order_count"))
    path = write_report(rows, "status", "order_status", scratch_path(spark, "reports"), datetime(2025, 1, 15), as_object=True)
    back = spark.read.schema("data map<string,bigint>").json(path)
    return back.select(F.explode("data").alias("status", "order_count"))


@query(
    "item_json",
    """
    SELECT id, CAST(price AS DOUBLE) AS price, name, id % 3 <> 0 AS has_description,
           CAST(stock_quantity AS BIGINT) AS stock_quantity
    FROM prod
    """,
    ("prod",),
)
def _item_json(spark, sf):
    products = fixtures.products(spark, sf).select(
        "id", "name", F.when(F.col("id") % 3 != 0, F.col("description")).alias("description"),
        F.col("price").cast("double").alias("price"), "stock_quantity",
    )
    item = F.col("item")
    return to_item_json(products).select(
        F.get_json_object(item, "$.id").cast("bigint").alias("id"),
        F.get_json_object(item, "$.price").cast("double").alias("price"),
        F.get_json_object(item, "$.name").alias("name"),
        F.contains(item, F.lit('"description"')).alias("has_description"),
        F.get_json_object(item, "$.stock_quantity").cast("bigint").alias("stock_quantity"),
    )


# ---- joins


@query(
    "enrich_items",
    """
    SELECT i.order_id, i.line_number, i.product_id, i.quantity, i.price_cents,
           p.name AS product_name, CAST(p.price AS DOUBLE) AS list_price
    FROM item i JOIN prod p ON p.id = i.product_id
    """,
    ("item", "prod"),
)
def _enrich_items(spark, sf):
    joined = order_ops.enrich_items(fixtures.order_items(spark, sf), fixtures.products(spark, sf))
    return joined.select(
        "order_id", "line_number", "product_id", "quantity",
        (F.col("price") * 100).cast("bigint").alias("price_cents"), "product_name", "list_price",
    )


_LINES_SQL = """
    SELECT o.id AS order_id, o.customer_id, o.status, i.line_number, i.product_id, i.quantity,
           i.price_cents, p.name AS product_name
    FROM ord o {join} item i ON i.order_id = o.id {join} prod p ON p.id = i.product_id
"""


def _lines(spark, sf, how):
    lines = order_ops.order_lines(
        fixtures.orders(spark, sf), fixtures.order_items(spark, sf), fixtures.products(spark, sf), how
    )
    return lines.select(
        "order_id", "customer_id", "status", "line_number", "product_id", "quantity",
        (F.col("price") * 100).cast("bigint").alias("price_cents"), "product_name",
    )


@query("order_lines", _LINES_SQL.format(join="JOIN"), ("ord", "item", "prod"))
def _order_lines(spark, sf):
    return _lines(spark, sf, "inner")


@query(
    "order_lines_left",
    "SELECT customer_id, count(*) AS lines, count(product_id) AS with_item FROM ("
    + _LINES_SQL.format(join="LEFT JOIN") + ") GROUP BY 1",
    ("ord", "item", "prod"),
)
def _order_lines_left(spark, sf):
    return _lines(spark, sf, "left").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("lines"), F.count("product_id").alias("with_item")
    )


_TOTALS_SQL = """
    + tot AS (SELECT order_id, sum(quantity * price_cents) AS c FROM item GROUP BY 1),
    totals AS (
        SELECT o.id, o.customer_id, CAST(o.total_amount * 100 AS BIGINT) AS header_cents,
               CAST(coalesce(t.c, 0) AS BIGINT) AS item_cents
        FROM ord o LEFT JOIN tot t ON t.order_id = o.id)
"""


@query(
    "recompute_order_totals",
    _TOTALS_SQL + "SELECT id, customer_id, item_cents AS total_cents FROM totals",
    ("ord", "item"),
)
def _recompute(spark, sf):
    totals = order_ops.recompute_order_totals(fixtures.orders(spark, sf), fixtures.order_items(spark, sf))
    return totals.select(
        "id", "customer_id", (F.col("total_amount") * 100).cast("bigint").alias("total_cents")
    )


@query(
    "reconcile_totals",
    _TOTALS_SQL + "SELECT id, header_cents, item_cents FROM totals WHERE header_cents <> item_cents AND id % 3 <> 0",
    ("ord", "item"),
)
def _reconcile(spark, sf):
    """Every third header is right: it is taken from the items."""
    orders, items = fixtures.orders(spark, sf), fixtures.order_items(spark, sf)
    right = order_ops.recompute_order_totals(orders.filter("id % 3 = 0"), items)
    headers = orders.filter("id % 3 <> 0").select("id", "total_amount").unionByName(right.select("id", "total_amount"))
    differ = order_ops.reconcile_totals(headers, items)
    return differ.select(
        "id",
        (F.col("total_amount") * 100).cast("bigint").alias("header_cents"),
        (F.col("item_total") * 100).cast("bigint").alias("item_cents"),
    )


@query(
    "orphan_items",
    """
    SELECT order_id, line_number, product_id, quantity, price_cents FROM item i
    WHERE NOT EXISTS (SELECT 1 FROM ord o WHERE o.id = i.order_id AND o.status <> 'pending')
    """,
    ("ord", "item"),
)
def _orphans(spark, sf):
    """Every item has an order here, so the parents are the orders that left ``pending``."""
    parents = fixtures.orders(spark, sf).filter("status <> 'pending'")
    return order_ops.orphans(fixtures.order_items(spark, sf), parents, "order_id").select(
        "order_id", "line_number", "product_id", "quantity",
        (F.col("price") * 100).cast("bigint").alias("price_cents"),
    )


@query(
    "latest_order",
    f"""
    SELECT customer_id, id, {ts_text("event_ts")} AS created_at, CAST(total_amount AS DOUBLE) AS total_amount,
           status
    FROM ord QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY event_ts DESC, id DESC) = 1
    """,
    ("ord",),
)
def _latest_order(spark, sf):
    return order_ops.latest_order(fixtures.orders(spark, sf))
