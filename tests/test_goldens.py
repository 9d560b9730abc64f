"""Hand-computed results over the seed rows, and rule edges."""

from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from changeloom.operators import anomalies, inventory, orders as order_ops, reports, rfm, search, state, windows
from seeds import DAY, items, order_times, orders, products, rows


def test_reports(spark):
    o, i = orders(spark), items(spark)
    assert rows(reports.daily_sales(o)) == [(DAY.date(), D("1819.96"), 3)]
    assert rows(reports.product_sales(i)) == [
        (1, 1, D("1299.99")), (2, 2, D("59.98")), (3, 1, D("89.99")), (4, 1, D("399.99"))]
    assert [r.product_id for r in reports.top_products(i).collect()] == [1, 4, 3, 2]
    assert [r.customer_id for r in reports.top_customers(o, 2).collect()] == [1001, 1003]
    assert rows(reports.customer_metrics(o)) == [(1001, 1, D("1299.99")), (1002, 1, D("119.98")), (1003, 1, D("399.99"))]
    assert reports.summary(o, i).first().asDict() == {
        "total_orders": 3, "total_revenue": D("1819.96"), "unique_customers": 3, "unique_products_sold": 4}
    assert reports.summary(o.limit(0), i.limit(0)).first().total_orders == 0


def test_order_joins(spark):
    o, i = orders(spark), items(spark)
    assert rows(order_ops.reconcile_totals(o, i)) == [(2, D("119.98"), D("149.97"))]
    none = order_ops.recompute_order_totals(o, i.filter("order_id <> 3")).filter("id = 3").first()
    assert none.total_amount == 0
    assert order_ops.orphans(i, products(spark).filter("id > 1"), "product_id").count() == 1


def test_inventory(spark):
    p, i = products(spark), items(spark)
    stock = {r.product_id: r.stock_quantity for r in inventory.current_inventory(p, i).collect()}
    assert stock == {1: 49, 2: 198, 3: 149, 4: 74, 5: 120}
    got = {r.product_id: r for r in inventory.inventory_insights(p, i, DAY + timedelta(minutes=1)).collect()}
    assert [got[k].velocity_units_per_day for k in range(1, 6)] == [0.14, 0.29, 0.14, 0.14, 0.0]
    assert [got[k].days_until_stockout for k in range(1, 6)] == [343.0, 693.0, None, 518.0, None]
    assert {r.stock_status for r in got.values()} == {"healthy"}
    assert [k for k in got if got[k].is_dead_stock] == [5]
    assert not any(r.restock_recommendation for r in got.values())


def test_unknown_products_and_clamping(spark):
    p, i = products(spark).filter("id = 1"), items(spark)
    unclamped = {r.product_id: r.stock_quantity for r in inventory.current_inventory(p, i).collect()}
    assert unclamped == {1: 49, 2: -2, 3: -1, 4: -1}
    clamped = {r.product_id: r.current_stock for r in inventory.optimizer_stock(p, i).collect()}
    assert clamped == {1: 49, 2: 0, 3: 0, 4: 0}
    good, bad = inventory.valid_items(i.withColumn("quantity", F.when(F.col("id") == 1, -1).otherwise(1)))
    assert (good.count(), bad.count()) == (3, 1)


def test_segments_and_alerts(spark):
    o = orders(spark)
    assert {r.segment for r in rfm.rfm_segments(o, DAY).collect()} == {"New"}
    got = anomalies.anomalies(o).collect()
    assert [(r.alert_id, r.severity) for r in got] == [("1001_1_large_order", "low")]


def test_search_documents(spark):
    docs = {r.product_id: r for r in search.search_documents(products(spark)).collect()}
    assert docs[4].search_tokens == ["27", "4k", "inch", "monitor"]
    assert [docs[k].price for k in range(1, 6)] == [129999, 2999, 8999, 39999, 24999]
    assert docs[1].price_display == "$1299.99"
    index = search.search_documents(products(spark))
    assert search.by_token(index, "Wireless").first().product_id == 2
    assert search.search(index, "").count() == 0


def test_status_moves_once(spark):
    events = [(1, "c", "pending", 0), (1, "u", "completed", 1), (1, "u", "completed", 2), (2, "u", "x", 3)]
    df = spark.createDataFrame(events, "id bigint, operation string, status string, event_ts bigint")
    assert rows(state.status_deltas(df)) == [("completed", 1), ("pending", -1)]
    assert rows(state.order_status_distribution(df)) == [("completed", 1), ("pending", 0)]


def kinds(df, **limits):
    return sorted((r.order_id, r.anomaly_type) for r in anomalies.anomalies(df, **limits).collect())


@pytest.mark.parametrize("n, last_ms, spikes", [(5, 3_540_000, 0), (6, 3_540_000, 1), (6, 3_600_000, 0), (6, 3_599_999, 1)])
def test_spike_edges(spark, n, last_ms, spikes):
    df = order_times(spark, [(k, 1, 10, last_ms * k // (n - 1)) for k in range(n)])
    found = [k for k in kinds(df) if k[1] == "order_spike"]
    assert found == [(n - 1, "order_spike")] * spikes


@pytest.mark.parametrize("gap, hit", [(299_999, True), (300_000, False)])
def test_rapid_edges(spark, gap, hit):
    assert kinds(order_times(spark, [(1, 1, 10, 0), (2, 1, 10, gap)])) == ([(2, "rapid_orders")] if hit else [])


def test_equal_times_count_in_id_order(spark):
    assert kinds(order_times(spark, [(1, 1, 10, 0), (2, 1, 10, 0)])) == [(2, "rapid_orders")]


@pytest.mark.parametrize("n, hit", [(9, False), (10, True)])
def test_outlier_edges(spark, n, hit):
    day = 86_400_000
    df = order_times(spark, [(k, 1, 10, k * day) for k in range(n)] + [(n, 1, 100, n * day)])
    assert kinds(df) == ([(n, "statistical_outlier")] if hit else [])
    score = anomalies.order_features(df).filter(f"id = {n}").first().z_score
    assert abs(score - n / (n + 1) ** 0.5) < 1e-9


def test_equal_amounts_have_no_score(spark):
    df = order_times(spark, [(k, 1, 10.1, k * 86_400_000) for k in range(20)])
    assert anomalies.order_features(df).filter("z_score IS NOT NULL").count() == 0


def test_large_edge(spark):
    df = order_times(spark, [(1, 1, "1000.00", 0), (2, 2, "1000.01", 0)])
    assert kinds(df) == [(2, "large_order")]


def test_customer_zero_is_a_customer(spark):
    df = order_times(spark, [(1, 0, 10, 0), (2, 0, 10, 1), (3, None, 5, 2)])
    assert kinds(df.filter("customer_id IS NOT NULL")) == [(2, "rapid_orders")]
    w = windows.sales_windows(df, "1 hour").first()
    assert (w.order_count, w.unique_customers, w.total_revenue) == (3, 1, D("25.00"))
    assert windows.sales_windows(df, "1 hour", "5 minutes").count() == 12


@pytest.mark.parametrize("size, slide", [("1 hour", "5 minutes"), ("1 hour", "25 minutes"), ("10 minutes", "10 minutes"), ("7 minutes", "3 minutes")])
def test_windows_match_the_built_in(spark, size, slide):
    df = order_times(spark, [(k, k * k % 7 or None, 10 + k, k * k * 1777 % 9_000_000) for k in range(300)])
    got = windows.sales_windows(df, size, slide).select("window_start", "window_end", "total_revenue", "order_count", "unique_customers")
    wanted = df.groupBy(F.window("event_ts", size, slide).alias("w")).agg(
        F.sum("total_amount"), F.count("*"), F.countDistinct("customer_id")
    ).select("w.start", "w.end", *[F.col(f"`{c}`") for c in ("sum(total_amount)", "count(1)", "count(DISTINCT customer_id)")])
    assert rows(got) == rows(wanted)


@pytest.mark.parametrize("gap", ["5 minutes", "1 minute"])
def test_sessions_match_the_built_in(spark, gap):
    times = [(k, k % 5, 10, (k * k * 7919) % 7_000_001) for k in range(400)]
    edges = [(400, 9, 1, 0), (401, 9, 1, 300_000), (402, 9, 1, 600_001), (403, 9, 1, 900_000)]
    df = order_times(spark, times + edges)
    got = windows.customer_sessions(df, gap).select("customer_id", "session_start", "session_end", "order_count")
    wanted = df.groupBy("customer_id", F.session_window("event_ts", gap).alias("w")).count().select(
        "customer_id", "w.start", "w.end", "count")
    assert rows(got) == rows(wanted)


def test_bursts_and_trends(spark):
    df = order_times(spark, [(1, 1, 1, 0), (2, 1, 1, 3_600_000), (3, 1, 1, 7_200_000), (4, 1, 1, 10_800_001)])
    assert [(r.id, r.burst_length) for r in anomalies.order_bursts(df).collect()] == [(3, 3)]
    sold = spark.createDataFrame(
        [(1, 7, datetime(2025, 1, 14)), (1, 14, datetime(2025, 1, 5)), (2, 7, datetime(2025, 1, 14))],
        "product_id bigint, quantity int, event_ts timestamp")
    top = inventory.trending_products(sold, "2025-01-15").orderBy(F.desc("unit_change"), "product_id").collect()
    assert [(r.product_id, r.velocity, r.previous_velocity, r.ratio) for r in top] == [(2, 1.0, 0.0, None), (1, 1.0, 2.0, 0.5)]
