"""Streams over several files, one per micro-batch, against their batch twins.

Equality holds when files arrive in event order, as they do here; ``test_restart`` stops half way.
"""

from datetime import datetime

import pytest
from pyspark.sql import Window, functions as F

from changeloom.operators import anomalies, envelope, inventory, reports, rfm
from changeloom.schemas import OPS_SALES, ORDERS
from changeloom.sources import changes, fixtures
from changeloom.streaming import pipelines
from changeloom.plans.analytics_plans import LIMITS, flat_alerts, flat_insights
from seeds import rows

SF = "/root/testdata/sf0.001"
PARTS = 3


def in_files(df, path, order):
    """Write a frame as files in event order, named so that they arrive in that order."""
    df = df.withColumn("_part", F.ntile(PARTS).over(Window.orderBy(*order)))
    for part in range(1, PARTS + 1):
        df.filter(F.col("_part") == part).drop("_part").coalesce(1).write.mode("append").parquet(f"{path}/p={part}")
    return df.drop("_part")


def stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/p=*")


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("events"))
    df = envelope.with_ops(fixtures.order_events(spark, SF), OPS_SALES)
    # A few busy minutes, so that rapid orders cross the borders of files.
    df = df.withColumn("customer_id", F.col("customer_id") % 20)
    return in_files(df, path, ["event_us", "id"]), path


def test_anomalies(spark, events, tmp_path):
    df, path = events
    found = pipelines.anomaly_stream(stream(spark, path, df.schema), LIMITS)
    got = pipelines.run(found, f"{tmp_path}/cp", f"{tmp_path}/out")
    wanted = anomalies.anomalies(df, LIMITS)
    assert wanted.filter("anomaly_type = 'rapid_orders'").count() > 0
    assert rows(flat_alerts(got)) == rows(flat_alerts(wanted))


def test_inventory(spark, tmp_path):
    items = fixtures.order_items(spark, SF)
    products = fixtures.products(spark, SF)
    items = in_files(items, f"{tmp_path}/items", ["event_ts", "order_id", "line_number", "quantity"])
    products.coalesce(1).write.parquet(f"{tmp_path}/products/p=1")
    # Whole days: ties across files would count in arrival order.
    border = spark.read.parquet(f"{tmp_path}/items/p=1").agg(F.max("event_ts")).first()[0]
    assert border is not None
    found = pipelines.inventory_stream(
        stream(spark, f"{tmp_path}/products", products.schema), stream(spark, f"{tmp_path}/items", items.schema))
    got = pipelines.run(found, f"{tmp_path}/cp", f"{tmp_path}/out")
    wanted = inventory.inventory_history(products, items)
    keys = ("event_kind", "event_ts", "product_name", "price")
    assert rows(flat_insights(got, *keys)) == rows(flat_insights(wanted, *keys))


def test_rfm_and_restart(spark, events, tmp_path):
    """One file is there at first; the query stops, and goes on from its checkpoint."""
    df, path = events
    now = datetime(2024, 2, 10)
    table = pipelines.rfm_table(f"{tmp_path}/table")
    import os
    import shutil
    os.makedirs(f"{tmp_path}/in")
    for part in range(1, PARTS + 1):
        shutil.copytree(f"{path}/p={part}", f"{tmp_path}/in/p={part}")
        query = pipelines.rfm_stream(stream(spark, f"{tmp_path}/in", df.schema), f"{tmp_path}/table", f"{tmp_path}/cp", lambda: now)
        query.awaitTermination()
    wanted = rfm.rfm_segments(df, now)
    assert rows(table.read(spark).select(*wanted.columns)) == rows(wanted)


def test_late_rows_are_dropped(spark, tmp_path):
    from seeds import order_times

    hour = 3_600_000
    first = order_times(spark, [(1, 1, 10, 0), (2, 2, 10, 5 * hour)])
    first.coalesce(1).write.parquet(f"{tmp_path}/in/p=1")
    # A batch meets the watermark of the one before, which the batch before that has set.
    order_times(spark, [(4, 2, 5, 5 * hour)]).coalesce(1).write.parquet(f"{tmp_path}/in/p=2")
    order_times(spark, [(3, 3, 10, 60_000)]).coalesce(1).write.parquet(f"{tmp_path}/in/p=3")
    order_times(spark, [(5, 9, 1, 99 * hour)]).coalesce(1).write.parquet(f"{tmp_path}/in/p=4")
    for approx in (False, True):
        found = pipelines.sales_window_stream(stream(spark, f"{tmp_path}/in", first.schema), "1 hour", approx=approx)
        got = pipelines.run(found, f"{tmp_path}/cp{approx}", f"{tmp_path}/out{approx}").orderBy("window_start")
        assert [(float(r.total_revenue), r.order_count, r.unique_customers) for r in got.collect()] == [(10, 1, 1), (15, 2, 1)]


def test_cumulative_report(spark, events, tmp_path):
    df, path = events
    times = iter(datetime(2025, 1, 15, 10, n) for n in range(30))
    written = []

    def now():
        written.append(next(times))
        return written[-1]

    pipelines.report_stream(
        reports.product_sales(stream(spark, path, df.schema).select(
            (F.col("customer_id") % 5).alias("product_id"), F.lit(2).alias("quantity"), F.col("total_amount").alias("price"))),
        "product_id", "quantity_sold", "product_sales", f"{tmp_path}/out", f"{tmp_path}/cp", now=now,
        top=lambda t: t.orderBy(F.desc("total_revenue"), "product_id").limit(3), trigger={"availableNow": True},
    ).awaitTermination()
    assert len(written) >= PARTS
    last = spark.read.json(f"{tmp_path}/out/product_sales/{written[-1]:%Y%m%d_%H%M%S}").collect()
    wanted = df.groupBy((F.col("customer_id") % 5).cast("string").alias("k")).agg(
        F.sum(F.col("total_amount") * 2).alias("t"), F.count("*").alias("n")).orderBy(F.desc("t"), "k").limit(3).collect()
    assert {k: (round(v.total_revenue, 2), v.quantity_sold) for k, v in ((x.key, x.value) for x in last)} == {
        r.k: (float(r.t), 2 * r.n) for r in wanted}


def test_replay_of_text_log(spark, events, tmp_path):
    df, _ = events
    log = changes.to_change_log(df, ORDERS, F.col("operation"), F.col("event_ts"), "bare")
    log.repartition(3).write.text(f"{tmp_path}/log")
    text = changes.read_change_files(spark, f"{tmp_path}/log", streaming=True, files_per_trigger=1)
    got = pipelines.run(envelope.parse_rows(text, ORDERS), f"{tmp_path}/cp", f"{tmp_path}/out")
    assert got.count() == df.count()
    assert rows(got.select("id", "total_amount", "status")) == rows(df.select("id", "total_amount", "status"))


def test_late_events_count_what_came_before():
    import numpy as np

    from changeloom.streaming.processors import _within

    rng = np.random.default_rng(3)
    for _ in range(200):
        old = rng.integers(0, 50, rng.integers(0, 8))
        amounts = rng.integers(0, 5, len(old))
        now = np.sort(rng.integers(0, 50, rng.integers(1, 6)))
        added = rng.integers(0, 5, len(now))
        want = [amounts[old > t - 10].sum() + sum(a for u, a in zip(now[:k + 1], added) if u > t - 10) for k, t in enumerate(now)]
        assert _within(old, amounts, now, added, 10).tolist() == want
    minute = 60
    # 05:00, 04:30, 05:01 in three batches: the third has two orders within five minutes.
    assert _within(np.array([300, 270]) * minute, np.ones(2, int), np.array([301]) * minute, np.ones(1, int), 5 * minute).tolist() == [2]
