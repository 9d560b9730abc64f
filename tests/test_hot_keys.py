"""Keys split over tasks must give what plain windows give, and both what a loop gives."""

from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from changeloom.operators import anomalies, inventory, ordered, quality, rfm, state
from seeds import rows


@pytest.fixture(scope="module")
def log(spark):
    """3,000 events; one key holds more than a third, times tie often, one key is null."""
    n = F.col("id")
    key = F.when(n % 5 < 2, 0).when(n % 17 == 3, None).otherwise(n % 23)
    mixed = F.pmod(F.xxhash64("id"), F.lit(2500))
    df = spark.range(3000).select(
        "id",
        key.cast("bigint").alias("customer_id"),
        (F.pmod(F.xxhash64("id", F.lit(7)), F.lit(90_000)) / 100).cast("decimal(12,2)").alias("total_amount"),
        F.timestamp_millis(F.lit(1_736_935_200_000) + mixed * 60_000).alias("event_ts"),
        F.element_at(F.array(F.lit("c"), F.lit("u"), F.lit("u")), (n % 3 + 1).cast("int")).alias("operation"),
        F.element_at(F.array(F.lit("new"), F.lit("paid"), F.lit("sent"), F.lit(None).cast("string")), (n % 4 + 1).cast("int")).alias("status"),
    ).withColumn("event_us", F.unix_micros("event_ts"))
    path = ordered.written(df, "test-log")
    return path


def test_scan_against_a_loop(spark, log):
    def body(d, scan):
        d = scan.running(
            d, {"n": F.lit(1), "total": F.col("total_amount")},
            {"before": F.when(F.col("total_amount") > 400, F.col("total_amount"))},
            {"first": F.when(F.col("total_amount") > 500, F.col("id"))},
        )
        d = scan.rolling(d, "event_us", {"hour": (F.lit(1), 3_600_000_000), "half": (F.col("total_amount"), 1_800_000_000)})
        return scan.trailing(d, 10, {"ten": F.col("total_amount"), "k": F.lit(1)})

    wanted, groups = {}, defaultdict(list)
    for r in log.collect():
        groups[r.customer_id].append(r)
    for group in groups.values():
        group.sort(key=lambda r: (r.event_us, r.id))
        before = first = None
        for i, r in enumerate(group):
            if first is None and r.total_amount > 500:
                first = r.id
            seen = group[: i + 1]
            wanted[r.id] = (
                i + 1, sum(x.total_amount for x in seen), before, first,
                sum(x.event_us > r.event_us - 3_600_000_000 for x in seen),
                sum((x.total_amount for x in seen if x.event_us > r.event_us - 1_800_000_000), Decimal(0)),
                sum(x.total_amount for x in seen[-10:]), min(10, i + 1),
            )
            if r.total_amount > 400:
                before = r.total_amount
    for limit in (None, 250):
        out = ordered.per_key(log, "customer_id", ["event_us", "id"], body, limit).collect()
        got = {r.id: (r.n, r.total, r.before, r.first, r.hour, r.half, r.ten, r.k) for r in out}
        assert got == wanted


def test_no_task_holds_a_hot_key(spark, log):
    sizes = []

    class Spy(ordered.SplitScan):
        def running(self, df, *args, **kw):
            sizes.append(self.chunks)
            return super().running(df, *args, **kw)

    plain, ordered.SplitScan = ordered.SplitScan, Spy
    try:
        ordered.per_key(log, "customer_id", ["event_us", "id"], lambda d, s: s.running(d, {"n": F.lit(1)}), 250).count()
    finally:
        ordered.SplitScan = plain
    hot = log.filter("customer_id = 0")
    ranged = hot.repartitionByRange(sizes[0], "customer_id", "event_us", "id")
    biggest = ranged.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert biggest < 2 * 250


def same(make, *args):
    plain, split = make(None), make(200)
    assert plain.schema.simpleString() == split.schema.simpleString()
    assert rows(plain) == rows(split)
    assert plain.count() > 0


def test_customer_operators(spark, log):
    limits = anomalies.Limits(spike_orders=3, large_amount=800.0)
    same(lambda m: rfm.rfm_history(log, max_rows=m))
    same(lambda m: anomalies.anomalies(log, limits, max_rows=m))
    same(lambda m: anomalies.recent_history(log, max_rows=m))
    same(lambda m: anomalies.order_bursts(log, 2, "10 minutes", max_rows=m))


def test_status_operators(spark, log):
    events = log.withColumn("key", F.coalesce("customer_id", F.lit(99)))
    same(lambda m: state.status_deltas(events, "key", ["event_us", "id"], m))
    same(lambda m: state.order_status_distribution(events, "key", ["event_us", "id"], m))


def test_metric_operators(spark, log):
    keyed = log.filter("customer_id IS NOT NULL")
    same(lambda m: quality.sustained(keyed, F.col("total_amount") > 100, "30 minutes", "customer_id", "event_ts", ["id"], m))
    same(lambda m: quality.rate(keyed, "total_amount", "1 hour", "customer_id", "event_ts", ["id"], m))
    slopes = lambda m: quality.slope(keyed, "total_amount", "1 hour", "customer_id", "event_ts", ["id"], m)
    same(lambda m: slopes(m).withColumn("slope_per_second", F.round("slope_per_second", 9)))


def test_inventory_operators(spark, log):
    items = log.filter("id % 10 > 0").select(
        F.coalesce("customer_id", F.lit(99)).alias("product_id"), "event_ts",
        F.col("id").alias("order_id"), F.lit(1).alias("line_number"), (F.col("id") % 4).alias("quantity"))
    products = log.filter("id % 10 = 0").groupBy(F.coalesce("customer_id", F.lit(99)).alias("id"), "event_ts").agg(
        F.max((F.col("id") % 90).cast("int")).alias("stock_quantity"), F.lit("p").alias("name"),
        F.lit(1).cast("decimal(12,2)").alias("price"))
    products, items = ordered.written(products, "p"), ordered.written(items, "i")
    as_of = "2025-01-16 12:00:00"
    same(lambda m: inventory.restock_events(products, items, max_rows=m))
    same(lambda m: inventory.inventory_insights(products, items, as_of, max_rows=m))
    same(lambda m: inventory.inventory_history(products, items, max_rows=m))

    # The clamped stock against a sequential fold.
    stock = defaultdict(int)
    events = [(r.event_ts, 0, 0, r.id, r.stock_quantity) for r in products.collect()]
    events += [(r.event_ts, 1, r.order_id, r.product_id, r.quantity) for r in items.collect()]
    for _, kind, _, product, n in sorted(events):
        stock[product] = n if kind == 0 else max(0, stock[product] - n)
    got = inventory.inventory_insights(products, items, "2030-01-01").collect()
    assert {r.product_id: r.current_stock for r in got} == dict(stock)
    assert {r.product_id: r.current_stock for r in inventory.optimizer_stock(products, items).collect()} == dict(stock)


def test_state_ignores_row_order(spark, log):
    keyed = log.withColumn("customer_id", F.coalesce("customer_id", F.lit(99)))
    one = state.compact(keyed, "customer_id", ["event_us", "id"])
    two = state.compact(keyed.repartition(7, "id"), "customer_id", ["event_us", "id"])
    assert rows(one) == rows(two)
    key = ["id", "operation"]
    once = state.dedupe_changes(keyed.unionByName(keyed), key)
    assert rows(once) == rows(state.dedupe_changes(once, key)) == rows(keyed)
