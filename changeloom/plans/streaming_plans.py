"""Streaming pipelines over the test tables, run to the end of their input.

Each reads its table as a file stream, sends the rows through the change log and back, and is
held to the same SQL as its batch twin.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import anomalies, envelope, postings, reports, search
from ..schemas import OPS_REPORT, OPS_SALES, ORDERS
from ..session import configure, scratch_path
from ..sources import changes, fixtures
from ..streaming import alerts, joins, pipelines
from .analytics_plans import (
    ANOMALY_SQL, HISTORY_SQL, LIMITS, RFM_AS_OF, RFM_SQL, _window_sql, flat_alerts, flat_insights,
    sale_events,
)
from .catalog import query, ts_text
from .orders_plans import STATUS_COUNTS_SQL, _LAST_EVENT, status_events
from .search_plans import (
    _AFTER_SQL, _DOC_SQL, _INDEX_SQL, _docs, alert_states_sql, parsed_products, posting_sums, product_batches, product_changes,
)


class _Streaming:
    """Reads the test tables as streams through the adapters of the batch queries."""

    def __init__(self, spark: SparkSession):
        self.spark = configure(spark)
        self.conf = spark.conf

    @property
    def read(self):
        return self

    def parquet(self, path: str) -> DataFrame:
        schema = self.spark.read.parquet(path).schema
        # A file stream takes a folder or a pattern, so a table kept as one file goes in as a pattern.
        return self.spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]")


def order_stream(spark: SparkSession, sf: str, ops=OPS_SALES) -> DataFrame:
    events = fixtures.order_events(_Streaming(spark), sf)
    log = changes.to_change_log(events, ORDERS, F.col("operation"), F.col("event_ts"))
    rows = envelope.with_ops(envelope.parse_rows(log, ORDERS), ops)
    # The log's event time has milliseconds; ``created_at`` keeps the microseconds of the data.
    return rows.withColumn("event_ts", F.col("created_at"))


def _run(df: DataFrame, label: str, mode: str = "append") -> DataFrame:
    spark = df.sparkSession
    return pipelines.run(df, scratch_path(spark, f"{label}-state"), scratch_path(spark, label), mode)


@query(
    "stream_sales_windows",
    _window_sql(3600, 300, "sliding_1h_5m")
    + " HAVING s + 3600 <= (SELECT epoch(max(event_ts)) - 600 FROM ev WHERE operation <> 'd')",
    ("ev",),
)
def _stream_windows(spark, sf):
    """Windows the watermark has passed at the end of the input."""
    return _run(pipelines.sales_window_stream(order_stream(spark, sf), "1 hour", "5 minutes"), "windows")


@query("stream_sales_windows_flushed", _window_sql(3600, 300, "sliding_1h_5m"), ("ev",))
def _stream_windows_flushed(spark, sf):
    """All windows of a bounded input: those of the stream, and its final flush."""
    rows = sale_events(spark, sf)
    return _stream_windows(spark, sf).unionByName(pipelines.flush_windows(rows, "1 hour", "5 minutes"))


@query(
    "stream_sessions",
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
    HAVING max(event_us) + 7200000000 <= (SELECT max(event_us) - 600000000 FROM ev WHERE operation <> 'd')
    """,
    ("ev",),
)
def _stream_sessions(spark, sf):
    return _run(pipelines.session_stream(order_stream(spark, sf), "2 hours"), "sessions")


@query(
    "stream_sessions_flushed",
    """
    + g AS (
        SELECT *, CASE WHEN event_us - lag(event_us) OVER (PARTITION BY customer_id ORDER BY event_us)
                            <= 7200000000 THEN 0 ELSE 1 END AS opens
        FROM ev WHERE operation <> 'd'),
    h AS (SELECT *, sum(opens) OVER (PARTITION BY customer_id ORDER BY event_us) AS n FROM g)
    SELECT customer_id, min(event_us) AS first_us, count(*) AS order_count, CAST(sum(total_amount) AS DOUBLE) AS total_amount
    FROM h GROUP BY customer_id, n
    """,
    ("ev",),
)
def _stream_sessions_flushed(spark, sf):
    """All sessions of a bounded input: those of the stream, and its final flush."""
    columns = ["customer_id", F.unix_micros("session_start").alias("first_us"), "order_count", "total_amount"]
    ended = _run(pipelines.session_stream(order_stream(spark, sf), "2 hours"), "sessions")
    return ended.select(*columns).unionByName(pipelines.flush_sessions(sale_events(spark, sf), "2 hours").select(*columns))


@query("stream_anomalies", ANOMALY_SQL, ("ev",))
def _stream_anomalies(spark, sf):
    return flat_alerts(_run(pipelines.anomaly_stream(order_stream(spark, sf), LIMITS), "alerts"))


#: Events in five files by time; every tenth arrives one file late.
_ARRIVAL = "least(4, bucket + CASE WHEN id % 10 = 3 THEN 1 ELSE 0 END)"


@query(
    "stream_late_orders",
    f"""
    + r AS (SELECT min(event_us) AS lo, max(event_us) AS hi FROM ev WHERE operation <> 'd'),
    k AS (SELECT *, {_ARRIVAL} AS file FROM (
              SELECT ev.*, least(4, (event_us - lo) * 5 // (hi - lo)) AS bucket FROM ev, r WHERE operation <> 'd')),
    m AS (SELECT customer_id, file, max(event_us) AS last FROM k GROUP BY 1, 2),
    c AS (
        SELECT e.customer_id, e.id, count(*) AS n FROM k e JOIN k f ON e.customer_id = f.customer_id
          AND f.event_us > e.event_us - 7200000000
          AND (f.file < e.file OR f.file = e.file AND (f.event_us, f.id) <= (e.event_us, e.id))
        WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.customer_id = e.customer_id AND m.file >= f.file AND m.file < e.file
                          AND m.last - 864000000000 >= f.event_us)
        GROUP BY 1, 2)
    SELECT customer_id, id AS order_id, n AS order_count FROM c WHERE n >= 2
    """,
    ("ev",),
)
def _stream_late_orders(spark, sf):
    """Alerts where some orders come late: five parts, one micro-batch each, counted as they arrive; the query stops and goes on
    from its checkpoint after each."""
    root = scratch_path(spark, "late-files")
    events = envelope.with_ops(fixtures.order_events(spark, sf), OPS_SALES)
    low, high = events.agg(F.min("event_us"), F.max("event_us")).first()
    bucket = F.expr(f"least(4, (event_us - {low}) * 5 div ({high} - {low}))")
    rows = events.withColumn("bucket", bucket).withColumn("file", F.expr(_ARRIVAL)).drop("bucket")
    limits = replace(LIMITS, rapid_window="2 hours", kept="10 days")
    state, out = scratch_path(spark, "late-state"), scratch_path(spark, "late-alerts")
    for n in range(5):
        rows.filter(F.col("file") == n).drop("file").write.mode("append").parquet(root)
        stream = spark.readStream.schema(events.schema).parquet(root)
        found = pipelines.run(pipelines.anomaly_stream(stream, limits), state, out)
    return found.filter(F.col("anomaly_type") == anomalies.RAPID).select(
        "customer_id", "order_id", F.col("details.order_count").cast("long").alias("order_count")
    )


@query("stream_sustained", alert_states_sql("(SELECT (max(event_us) // 1000 - 3600000) * 1000 FROM ev)"), ("ev",))
def _stream_sustained(spark, sf):
    """Alert transitions up to the watermark, firing in silence too; the events come in three parts, a third of them a part late."""
    events = fixtures.order_events(spark, sf).select("id", "customer_id", "total_amount", "event_ts", "event_us")
    root, state, out = (scratch_path(spark, f"sustained-{n}") for n in ("input", "state", "output"))
    low, high = events.agg(F.min("event_us"), F.max("event_us")).first()
    # Rows less than half the watermark's delay before a border may come after it.
    shift = F.when(F.col("id") % 3 == 0, 1_800_000_000).otherwise(0)
    part = F.expr(f"least(2, (event_us + shift - {low}) * 3 div ({high} - {low} + 1))")
    rows = events.withColumn("shift", shift).withColumn("part", part).drop("shift", "event_us")
    for n in range(3):
        rows.filter(F.col("part") == n).drop("part").write.mode("append").parquet(root)
        stream = spark.readStream.schema(rows.drop("part").schema).parquet(root)
        found = alerts.alert_stream(stream, F.col("total_amount") > 20, "6 hours", "customer_id", delay="1 hour", order="id")
        moved = pipelines.run(found, state, out)
    return moved.select("customer_id", "state", F.unix_micros("at").alias("at_us"))


@query("stream_inventory", HISTORY_SQL, ("prod", "item"))
def _stream_inventory(spark, sf, twin=pipelines.inventory_stream):
    streaming = _Streaming(spark)
    products = fixtures.products(streaming, sf)

    # The same recounts as in the batch query, one event each.
    def event(every: int, at, stock):
        return F.when(
            F.col("id") % every == 0,
            F.struct(at.cast("timestamp").alias("at"), stock.cast("int").alias("stock")),
        )

    events = F.array(
        event(1, F.col("event_ts"), F.col("stock_quantity")),
        event(3, F.lit("1998-03-01"), F.lit(300)),
        event(5, F.lit("2000-06-15"), F.lit(40)),
    )
    products = products.withColumn("_e", F.explode(F.filter(events, lambda e: e.isNotNull())))
    products = products.withColumns({"event_ts": F.col("_e.at"), "stock_quantity": F.col("_e.stock")})
    found = twin(products, fixtures.order_items(streaming, sf))
    return flat_insights(_run(found, "insights"), "event_kind", "event_ts")


@query("stream_low_stock", HISTORY_SQL.rstrip() + " WHERE cur < 10", ("prod", "item"))
def _stream_low_stock(spark, sf):
    return _stream_inventory(spark, sf, pipelines.low_stock_stream)


@query("stream_status", STATUS_COUNTS_SQL, ("ord",))
def _stream_status(spark, sf):
    root = scratch_path(spark, "status-report")
    pipelines.status_stream(
        status_events(_Streaming(spark), sf, "standard"), root, scratch_path(spark, "status-state"),
        trigger={"availableNow": True}, now=lambda: datetime(2025, 1, 15, 10, 30),
    ).awaitTermination()
    rows = spark.read.schema("key string, value bigint").json(f"{root}/order_status/20250115_103000")
    return rows.select(F.col("key").alias("status"), F.col("value").alias("order_count"))


@query("stream_search_index", _INDEX_SQL + _DOC_SQL, ("prod",))
def _stream_search_index(spark, sf):
    root = scratch_path(spark, "search-table")
    pipelines.search_index_stream(
        product_changes(_Streaming(spark), sf), root, scratch_path(spark, "search-state")
    ).awaitTermination()
    return _docs(search.search_documents(pipelines.search_table(root).read(spark)))


@query("stream_index_after_changes", _AFTER_SQL, ("prod",))
def _stream_postings(spark, sf):
    """Stored postings kept up by a stream; each part of the log is a micro-batch."""
    index = postings.PostingIndex(scratch_path(spark, "stream-postings"), buckets=16, block=64)
    log, state = scratch_path(spark, "product-log"), scratch_path(spark, "postings-state")
    for part in product_batches(spark, sf):
        part.write.mode("append").parquet(log)
        rows = parsed_products(spark.readStream.schema(part.schema).parquet(log))
        pipelines.posting_stream(rows, index, state).awaitTermination()
    return posting_sums(index.postings(spark))


@query("stream_rfm", RFM_SQL, ("ord",))
def _stream_rfm(spark, sf):
    root = scratch_path(spark, "segments")
    pipelines.rfm_stream(
        fixtures.orders(_Streaming(spark), sf), root, scratch_path(spark, "segments-state"),
        as_of=lambda: datetime.fromisoformat(RFM_AS_OF),
    ).awaitTermination()
    return pipelines.rfm_table(root).read(spark)


@query(
    "stream_latest",
    f"SELECT customer_id, id, operation, CAST(total_amount AS DOUBLE) AS total_amount FROM ({_LAST_EVENT})",
    ("ev",),
)
def _stream_latest(spark, sf):
    """The last row per key, kept in a keyed table by an update-mode stream."""
    events = fixtures.order_events(_Streaming(spark), sf)
    rows = events.select("customer_id", "id", "operation", "total_amount", "event_us")
    latest = pipelines.latest_stream(rows, "customer_id", ["event_us", "id"])
    table = pipelines.KeyedTable(scratch_path(spark, "latest"), "customer_id", ["event_us", "id"])
    pipelines.start(
        latest, scratch_path(spark, "latest-state"), mode="update", each_batch=table.sink()
    ).awaitTermination()
    return table.read(spark).drop("event_us")


@query(
    "stream_dedupe",
    "SELECT operation, count(*) AS events, CAST(sum(total_amount) AS DOUBLE) AS amount FROM ev GROUP BY 1",
    ("ev",),
)
def _stream_dedupe(spark, sf):
    events = fixtures.order_events(_Streaming(spark), sf)
    twice = events.select(
        "id", "operation", "total_amount", "event_ts", F.explode(F.array(F.lit(1), F.lit(2))).alias("_copy")
    ).drop("_copy")
    once = pipelines.dedupe_stream(pipelines.with_event_time(twice), ["id", "operation", "event_ts"])
    return _run(once, "deduped").groupBy("operation").agg(
        F.count(F.lit(1)).alias("events"), F.sum("total_amount").alias("amount")
    )


@query(
    "stream_daily_report",
    """
    SELECT strftime(event_ts, '%Y-%m-%d') AS date, CAST(sum(total_amount) AS DOUBLE) AS total_amount,
           count(*) AS order_count
    FROM ev WHERE operation IN ('c', 'r') GROUP BY 1
    """,
    ("ev",),
)
def _stream_report(spark, sf):
    root = scratch_path(spark, "stream-reports")
    daily = reports.daily_sales(order_stream(spark, sf, OPS_REPORT))
    pipelines.report_stream(
        daily, "date", "order_count", "daily_sales", root, scratch_path(spark, "report-state"),
        trigger={"availableNow": True}, now=lambda: datetime(2025, 1, 15, 10, 30),
    ).awaitTermination()
    value = "struct<total_amount:decimal(22,2),order_count:bigint>"
    rows = spark.read.schema(f"key string, value {value}").json(f"{root}/daily_sales/20250115_103000")
    return rows.select(F.col("key").alias("date"), "value.*")


@query(
    "stream_summary",
    """
    SELECT count(*) AS total_orders, CAST(sum(total_amount) AS DOUBLE) AS total_revenue, count(DISTINCT customer_id) AS unique_customers,
           (SELECT count(DISTINCT product_id) FROM item) AS unique_products_sold
    FROM ord
    """,
    ("ord", "item"),
)
def _stream_summary(spark, sf):
    root, streaming = scratch_path(spark, "stream-summary"), _Streaming(spark)
    pipelines.summary_stream(
        fixtures.orders(streaming, sf), fixtures.order_items(streaming, sf), root, scratch_path(spark, "summary-state"),
        trigger={"availableNow": True}, now=lambda: datetime(2025, 1, 15, 10, 30),
    ).awaitTermination()
    metrics = "struct<total_orders:bigint,total_revenue:decimal(22,2),unique_customers:bigint,unique_products_sold:bigint>"
    return spark.read.schema(f"metrics {metrics}").json(f"{root}/summary/20250115_103000").select("metrics.*")


# ---- orders and items as two streams: three parts by time; of both sides, every 29th row comes in the last part

_PARTS = "CASE WHEN {} % 29 = 3 THEN 3 WHEN event_ts < TIMESTAMP '1995-06-01' THEN 1 WHEN event_ts < TIMESTAMP '1997-03-01' THEN 2 ELSE 3 END"
_JOIN_SQL = f"""
    + o AS (SELECT id, event_ts, {_PARTS.format("id")} AS part FROM ord),
    i AS (
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER)) AS id, l_orderkey AS order_id,
               event_ts, {_PARTS.format("l_partkey")} AS part FROM (SELECT *, l_shipdate AS event_ts FROM lineitem)),
    mark AS (
        SELECT p.part, (SELECT max(event_ts) FROM o WHERE part < p.part) AS a, (SELECT max(event_ts) FROM i WHERE part < p.part) AS b
        FROM (VALUES (1), (2), (3), (4)) AS p(part)),
    w AS (SELECT part, least(a, b) - INTERVAL 36 HOURS AS upto FROM mark),
    oo AS (SELECT o.*, coalesce(o.event_ts <= w.upto, false) AS late FROM o JOIN w USING (part)),
    ii AS (SELECT i.*, coalesce(i.event_ts <= w.upto, false) AS late FROM i JOIN w USING (part)),
    pair AS (
        SELECT oo.id AS o, ii.id AS i FROM oo JOIN ii ON oo.id = ii.order_id AND NOT oo.late AND NOT ii.late
         AND ii.event_ts BETWEEN oo.event_ts AND oo.event_ts + INTERVAL 60 DAYS),
    edge AS (SELECT upto FROM w WHERE part = 4),
    outcome AS (
        SELECT 'order' AS side, CAST(id AS VARCHAR) AS id, CASE WHEN id IN (SELECT o FROM pair) THEN 'matched' WHEN event_ts + INTERVAL 60 DAYS >= (SELECT upto FROM edge)
                    THEN 'open' WHEN late THEN 'late' ELSE 'unmatched' END AS outcome FROM oo
        UNION ALL
        SELECT 'item', id, CASE WHEN id IN (SELECT i FROM pair) THEN 'matched' WHEN event_ts >= (SELECT upto FROM edge)
                    THEN 'open' WHEN late THEN 'late' ELSE 'unmatched' END FROM ii)
"""


def _shipped(spark: SparkSession, sf: str) -> DataFrame:
    """Items with an id made of their columns, as no line number is unique here."""
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int")]
    return fixtures.table(spark, sf, "lineitem").select(
        F.concat_ws("-", *columns).alias("id"), F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_shipdate").cast("timestamp").alias("event_ts"),
    )


@query("stream_order_items", _JOIN_SQL + "SELECT side, outcome, count(*) AS rows, min(id) AS first_id, max(id) AS last_id FROM outcome GROUP BY 1, 2", ("ord",))
def _stream_order_items(spark, sf):
    """Two streams joined; matched, unmatched, open and late rows together are the input."""
    sides = {"o": fixtures.orders(spark, sf).select("id", "event_ts"), "i": _shipped(spark, sf)}
    by = {"o": "id", "i": "product_id"}
    root, state, out = (scratch_path(spark, f"order-items-{n}") for n in ("input", "state", "output"))
    partitions = 4 * spark.sparkContext.defaultParallelism
    for part in (1, 2, 3):
        for name, rows in sides.items():
            rows.withColumn("part", F.expr(_PARTS.format(by[name]))).filter(F.col("part") == part).drop("part").write.mode("append").parquet(f"{root}/{name}")
        streams = [spark.readStream.schema(rows.schema).parquet(f"{root}/{name}") for name, rows in sides.items()]
        joined = joins.order_item_stream(*streams, "60 days", "36 hours")
        running = joins.start_joined(joined, state, out, partitions=partitions, one_store=True)
        running.awaitTermination()
    kinds = "order_id bigint, order_ts timestamp, item_id string, item_ts timestamp"
    stored = [spark.read.schema(rows.schema).parquet(f"{root}/{name}") for name, rows in sides.items()]  # ids are made once
    found = joins.account(*stored, spark.read.schema(kinds).parquet(out), "60 days", joins.watermark_of(running))
    return found.groupBy("side", "outcome").agg(F.count(F.lit(1)).alias("rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))
