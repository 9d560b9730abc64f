"""Streaming twins of the operators, and how to run them.

Every pipeline takes parsed rows (``parse_rows`` after the operation filter) as a streaming
DataFrame and returns one; ``start`` and ``run`` attach a sink with checkpoint and trigger.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone
from decimal import Decimal
from math import gcd

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import rules
from ..functions.times import duration_micros, micros
from ..operators import inventory
from ..operators.anomalies import Limits, alerts_from_features
from ..operators.envelope import event_order, require_key
from ..operators.postings import PostingIndex
from ..operators.rfm import finish_totals, rfm_totals
from ..operators.rollups import HLL_LG, customer_bits
from ..operators.state import order_status_distribution as status_counts
from ..operators.windows import _label, customer_sessions, sales_windows, window_metrics
from ..schemas import DELETE
from ..sinks.reports import write_report, write_summary
from ..sinks.upsert import KeyedTable
from .processors import FEATURES, NONE, STOCK_ROWS, AnomalyProcessor, InventoryProcessor

WATERMARK = "10 minutes"
FLUSH = "300 seconds"  # fixed value: report interval
#: Groups that a stream's customers or products are dealt to: a group costs some milliseconds a micro-batch, whatever it holds.
SHARDS = 4096


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def with_event_time(df: DataFrame, delay: str = WATERMARK, ts: str = "event_ts") -> DataFrame:
    """Event time with a watermark; later rows are dropped by windowed operators."""
    return df.withWatermark(ts, delay)


def dedupe_stream(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One copy of each event redelivered within the watermark."""
    return df.dropDuplicatesWithinWatermark(list(key))


def sales_window_stream(
    orders: DataFrame, size: str = "1 hour", slide: str | None = None, delay: str = WATERMARK,
    ts: str = "event_ts", approx: bool = False,
) -> DataFrame:
    """Windowed sales, each window emitted once the watermark passes it.

    Orders fold into panes first, which tile every window; only finished panes go on to the windows over them.  A pane keeps its
    customers as bitmaps, one for each range of 32,768 ids, so the distinct count stays exact and no state entry belongs to a
    single customer and window.  ``approx`` keeps one sketch per pane instead.
    """
    slide = slide or size
    pane = f"{gcd(duration_micros(size), duration_micros(slide))} microseconds"
    rows = with_event_time(orders, delay, ts)
    sums = [F.sum("total_amount").alias("total_revenue"), F.count(F.lit(1)).alias("order_count")]
    added = [F.sum(c).alias(c) for c in ("total_revenue", "order_count")]
    customer = F.col("customer_id").cast("bigint")
    if approx:
        panes = rows.groupBy(F.window(ts, pane).alias("pane")).agg(*sums, F.hll_sketch_agg(customer, HLL_LG).alias("customers"))
        folded = panes.groupBy(F.window(F.window_time("pane"), size, slide).alias("window")).agg(
            *added, F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("unique_customers")
        )
    else:
        bucket, customers = customer_bits(customer)
        panes = rows.groupBy(F.window(ts, pane).alias("pane"), bucket).agg(*sums, customers)
        ranges = panes.groupBy(F.window(F.window_time("pane"), size, slide).alias("window"), "bucket").agg(
            *added, F.bitmap_or_agg("customers").alias("customers")
        )
        folded = ranges.groupBy("window").agg(*added, F.sum(F.bitmap_count("customers")).alias("unique_customers"))
    start_us = micros(F.col("window.start"))
    return window_metrics(folded, start_us, duration_micros(size), _label(size, slide))


def session_stream(
    orders: DataFrame, gap: str = "30 minutes", delay: str = WATERMARK, ts: str = "event_ts"
) -> DataFrame:
    """Customer sessions, emitted once the watermark passes their end."""
    return (
        with_event_time(require_key(orders, "customer_id"), delay, ts)
        .groupBy("customer_id", F.session_window(ts, gap).alias("_w"))
        .agg(F.count(F.lit(1)).alias("order_count"), F.sum("total_amount").alias("total_amount"))
        .select(
            "customer_id",
            F.col("_w.start").alias("session_start"),
            F.col("_w.end").alias("session_end"),
            "order_count",
            "total_amount",
        )
    )


def _timed(rows: DataFrame, delay: str | None, key: str, processor, out: str) -> DataFrame:
    """Rows through a processor; with ``delay`` event time runs its timers."""
    return rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=out, outputMode="Append", timeMode="None" if delay is None else "EventTime",
    )


def _filled(column: Column) -> Column:
    """A number without nulls, for a processor."""
    return F.coalesce(column.cast("bigint"), F.lit(NONE))


def _given(name: str) -> Column:
    """A processor's number, null where it is none."""
    return F.when(F.col(name) != NONE, F.col(name))


def _money(cents: Column, kind: str = "decimal(12,2)") -> Column:
    return (cents.cast("decimal(19,0)") * F.lit(Decimal("0.01"))).cast(kind)


def anomaly_stream(orders: DataFrame, limits: Limits = Limits(), delay: str | None = None) -> DataFrame:
    """Alerts as orders arrive (append mode).

    With ``delay`` the order times of idle customers leave the state, too, once the watermark has passed them by ``limits.kept``;
    Spark then drops orders that are later than ``delay``.  Without, nothing is dropped and old times leave with
    the customer's next order.
    """
    timed = orders if delay is None else with_event_time(orders, delay)
    rows = timed.filter(F.col("customer_id").isNotNull()).select(
        "customer_id",
        _filled(F.col("id")).alias("id"),
        (F.coalesce("total_amount", F.lit(0)) * 100).cast("bigint").alias("cents"),
        micros(F.col("event_ts")).alias("event_us"),
        *(["event_ts"] if delay is not None else []),
    )
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("customer_id"), F.lit(SHARDS)))
    found = _timed(rows, delay, "shard", AnomalyProcessor(limits, delay is not None), FEATURES)
    features = found.select(
        "customer_id", _given("id").alias("id"), _money(F.col("cents")).alias("total_amount"), "event_us", "total_customer_orders",
        _money(F.col("total_cents"), "decimal(22,2)").alias("total_customer_amount"), "spike_count", "rapid_count", "mean_amount",
        F.nanvl("stddev_amount", F.lit(None).cast("double")).alias("stddev_amount"), F.nanvl("z_score", F.lit(None).cast("double")).alias("z_score"),
    )
    return alerts_from_features(features, limits)


def inventory_stream(
    products: DataFrame, items: DataFrame, ties: Sequence[str] = inventory.TIES, delay: str | None = None,
) -> DataFrame:
    """Insight row per product or sale event as it arrives (append mode); ``delay`` as in ``anomaly_stream``."""
    none = F.lit(NONE).cast("bigint")

    def offset(df: DataFrame) -> Column:
        return (_filled(F.col("offset")) if "offset" in df.columns else none).alias("offset")

    if delay is not None:
        products, items = with_event_time(products, delay), with_event_time(items, delay)
    zero, time = F.lit(0).cast("bigint"), ["event_ts"] if delay is not None else []
    p = products.select(
        F.col("id").alias("product_id"),
        F.lit(0).alias("kind"),
        F.coalesce("name", F.lit("Unknown")).alias("name"),
        _filled(F.col("price") * 100).alias("price_cents"),
        F.coalesce("stock_quantity", F.lit(0)).cast("bigint").alias("set"),
        zero.alias("qty"),
        micros(F.col("event_ts")).alias("event_us"),
        offset(products), *[none.alias(t) for t in ties], *time,
    )
    good = inventory.valid_items(items)[0]
    i = good.select(
        "product_id",
        F.lit(1).alias("kind"),
        F.lit(None).cast("string").alias("name"),
        none.alias("price_cents"),
        zero.alias("set"),
        F.coalesce("quantity", F.lit(0)).cast("bigint").alias("qty"),
        micros(F.col("event_ts")).alias("event_us"),
        offset(good), *[_filled(F.col(t)).alias(t) for t in ties], *time,
    )
    rows = p.unionByName(i).filter(F.col("product_id").isNotNull())
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("product_id"), F.lit(SHARDS)))
    window = duration_micros(f"{rules.VELOCITY_DAYS} days")
    stock = _timed(rows, delay, "shard", InventoryProcessor(("offset", *ties), window, delay is not None), STOCK_ROWS)
    flat = stock.select(
        "product_id",
        "event_kind",
        F.timestamp_micros("event_us").alias("event_ts"),
        F.struct(F.col("name").alias("_name"), _money(_given("price_cents")).alias("_price")).alias("_shown"),
        "current_stock",
        F.col("units").alias("_units"),
        _given("sale_us").alias("_sale_us"),
        _given("restock_us").alias("_restock_at"),
    )
    return inventory._insight(flat, F.col("event_ts"), "event_kind", "event_ts")


def rfm_stream(
    orders: DataFrame, root: str, checkpoint: str, as_of: Callable[[], datetime] = utc_now,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep customer segments in a keyed table under ``root``.

    State holds only the mergeable totals; recency and segment are added per batch.
    """
    table = rfm_table(root)
    return start(
        rfm_totals(orders), checkpoint, mode="update", trigger=trigger,
        each_batch=table.sink(prepare=lambda batch: finish_totals(batch, as_of())),
    )


def rfm_table(root: str) -> KeyedTable:
    return KeyedTable(root, "customer_id", ["total_orders"])


def flush_windows(
    orders: DataFrame, size: str = "1 hour", slide: str | None = None, delay: str = WATERMARK, ts: str = "event_ts",
) -> DataFrame:
    """The final flush of a bounded ``sales_window_stream``: windows still open when its input ended.

    ``orders`` is the same input as a batch; only rows that an open window can hold are read.
    """
    edge = orders.agg(F.max(ts)).first()[0]
    mark = F.lit(edge) - F.expr(f"INTERVAL {delay}")
    tail = orders.filter(F.col(ts) >= mark - F.expr(f"INTERVAL {size}"))
    return sales_windows(tail, size, slide).filter(F.col("window_end") > mark)


def flush_sessions(orders: DataFrame, gap: str = "30 minutes", delay: str = WATERMARK, ts: str = "event_ts") -> DataFrame:
    """The final flush of a bounded ``session_stream``: sessions still open when its input ended.

    ``orders`` is the same input as a batch.  A session is open if its end lies behind the watermark; only customers with such a
    session are read.
    """
    edge = orders.agg(F.max(ts)).first()[0]
    mark = F.lit(edge) - F.expr(f"INTERVAL {delay}")
    late = orders.filter(F.col(ts) + F.expr(f"INTERVAL {gap}") > mark).select("customer_id").distinct()
    sessions = customer_sessions(orders.join(late, "customer_id", "left_semi"), gap, ts)
    return sessions.filter(F.col("session_end") > mark)


def status_stream(events: DataFrame, root: str, checkpoint: str, **flush) -> StreamingQuery:
    """The status report over a log whose updates carry their old images."""
    counts = status_counts(events, full_images=True, version="changes")
    return report_stream(
        counts, "status", "changes", "order_status", root, checkpoint, top=lambda df: df.drop("changes"), **flush
    )


def search_table(root: str, ordering: Sequence[str] = ("event_ts",)) -> KeyedTable:
    """Current products; ``search_documents`` makes their documents."""
    return KeyedTable(root, "id", list(ordering))


def search_index_stream(
    changes: DataFrame, root: str, checkpoint: str, trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the products behind the search index, deletes applied, as rows of ``parse_rows`` arrive."""
    table = search_table(root, event_order(changes))
    return start(
        changes, checkpoint, trigger=trigger, each_batch=table.sink(deleted=F.col("operation") == DELETE)
    )


def posting_stream(
    changes: DataFrame, index: PostingIndex, checkpoint: str, trigger: dict | None = None,
) -> StreamingQuery:
    """Keep stored postings up with changes that carry old images; each micro-batch adds what it changes, and no more."""
    return start(changes, checkpoint, trigger=trigger, each_batch=index.sink())


def low_stock_stream(products: DataFrame, items: DataFrame, limit: int = rules.LOW_STOCK) -> DataFrame:
    """An insight row for each event that leaves less than ``limit`` in stock."""
    return inventory_stream(products, items).filter(F.col("current_stock") < limit)


def latest_stream(changes: DataFrame, key: str, ordering: Sequence[str]) -> DataFrame:
    """Last row per key, emitted when it changes (update mode)."""
    rest = [c for c in changes.columns if c != key]
    last = F.max_by(F.struct(*rest), F.struct(*ordering)).alias("_last")
    return changes.groupBy(key).agg(last).select(key, "_last.*")


def report_stream(
    report: DataFrame, key: str, version: str, name: str, root: str, checkpoint: str,
    top: Callable[[DataFrame], DataFrame] = lambda df: df, trigger: dict | None = None,
    now: Callable[[], datetime] = utc_now,
) -> StreamingQuery:
    """A cumulative report over a stream, flushed at every trigger.

    ``report`` is a streaming aggregate per ``key`` whose ``version`` column only grows, such as
    ``daily_sales`` with ``order_count``.  Only changed keys leave the aggregate; they go to a
    keyed table, and the report (or its ``top`` rows) is written from there.
    """
    table = KeyedTable(f"{root.rstrip('/')}/_tables/{name}", key, [version])

    on_batch = table.sink()

    def flush(batch: DataFrame, batch_id: int) -> None:
        on_batch(batch, batch_id)
        write_report(top(table.read(batch.sparkSession)), key, name, root, now())

    return start(
        report, checkpoint, mode="update", each_batch=flush,
        trigger=trigger or {"processingTime": FLUSH},
    )


def summary_stream(
    orders: DataFrame, items: DataFrame, root: str, checkpoint: str, trigger: dict | None = None, now: Callable[[], datetime] = utc_now,
) -> StreamingQuery:
    """The summary report over both streams, flushed at every trigger: orders, revenue, distinct customers and products.

    Customers and products are kept as bitmaps of 32,768 ids, so the numbers are exact, and a flush writes the bitmaps that
    changed; rows without an id count as orders, but not as customers.
    """
    def side(df: DataFrame, name: str, member: str, revenue: Column) -> DataFrame:
        return df.select(F.lit(name).alias("side"), F.col(member).cast("bigint").alias("member"), revenue.cast("decimal(22,2)").alias("revenue"))

    rows = side(orders, "order", "customer_id", F.col("total_amount")).unionByName(side(items, "item", "product_id", F.lit(0)))
    bucket, members = customer_bits(F.col("member"))
    folded = rows.groupBy("side", bucket).agg(F.count(F.lit(1)).alias("rows"), F.sum("revenue").alias("revenue"), members.alias("members"))
    table = KeyedTable(f"{root.rstrip('/')}/_tables/summary", ["side", "bucket"], ["rows"])
    on_batch = table.sink()

    def flush(batch: DataFrame, batch_id: int) -> None:
        on_batch(batch, batch_id)
        of_orders, count = F.col("side") == "order", F.bitmap_count("members")
        write_summary(table.read(batch.sparkSession).agg(
            F.coalesce(F.sum(F.when(of_orders, F.col("rows"))), F.lit(0)).alias("total_orders"),
            F.coalesce(F.sum(F.when(of_orders, F.col("revenue"))), F.lit(0)).alias("total_revenue"),
            F.coalesce(F.sum(F.when(of_orders, count)), F.lit(0)).alias("unique_customers"),
            F.coalesce(F.sum(F.when(~of_orders, count)), F.lit(0)).alias("unique_products_sold"),
        ), root, now())

    return start(folded, checkpoint, mode="update", each_batch=flush, trigger=trigger or {"processingTime": FLUSH})


def start(
    df: DataFrame, checkpoint: str, mode: str = "append", path: str | None = None,
    each_batch: Callable[[DataFrame, int], None] | None = None, trigger: dict | None = None,
) -> StreamingQuery:
    """Start a query into parquet files at ``path``, or into ``each_batch``."""
    writer = (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    if each_batch is not None:
        return writer.foreachBatch(each_batch).start()
    return writer.format("parquet").start(path)


def run(df: DataFrame, checkpoint: str, path: str, mode: str = "append") -> DataFrame:
    """Process all input there is, and read back what was written."""
    query = start(df, checkpoint, mode, path)
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)
