"""Inventory by shards: products of one group keep apart, whatever the batches are."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from changeloom.streaming import pipelines
from changeloom.streaming.processors import NONE, InventoryProcessor
from test_keyed_state import Handle, Map

DAY = 86_400_000_000
WINDOW = 7 * DAY


def one_by_one(batches):
    """The same by a loop over events."""
    state, out = {}, []
    for n, batch in enumerate(batches):
        for p, us, kind, tie, qty, to in sorted(batch, key=lambda r: r[:4]):
            s = state.setdefault(p, {"stock": 0, "name": None, "sold": [], "sale": NONE, "restock": NONE})
            if kind == 0:
                if to > s["stock"]:
                    s["restock"] = us
                s["stock"], s["name"] = to, f"n{tie}"
            else:
                s["stock"], s["sale"] = max(0, s["stock"] - qty), us
                s["sold"].append((us, qty, n))
            units = sum(q for t, q, b in s["sold"] if t > us - WINDOW and (b == n or t > s.get("horizon", NONE)))
            out.append((p, us, kind, s["name"], s["stock"], units, s["sale"], s["restock"]))
        for p in {r[0] for r in batch}:
            state[p]["horizon"] = max(state[p].get("horizon", NONE), max(r[1] for r in batch if r[0] == p) - WINDOW)
    return out


def test_shards_against_a_loop(monkeypatch):
    monkeypatch.setattr(Map, "exists", lambda self: bool(self.data), raising=False)
    rng = np.random.default_rng(7)
    for _ in range(60):
        p = InventoryProcessor(("order_id",), WINDOW, timers=True)
        p.init(Handle())
        batches, got, tie = [], [], 0
        for _ in range(int(rng.integers(1, 6))):
            batch = []
            for _ in range(int(rng.integers(1, 40))):
                tie += 1
                kind = int(rng.random() < 0.8)
                us = int(rng.integers(0, 40)) * DAY // 2
                batch.append((int(rng.integers(0, 5)), us, kind, tie, int(rng.integers(0, 9)) * kind, int(rng.integers(0, 50)) * (1 - kind)))
            batches.append(batch)
            frame = pd.DataFrame([
                {"product_id": a, "event_us": us, "kind": k, "order_id": t, "qty": q, "set": to, "name": None if k else f"n{t}", "price_cents": NONE if k else 1}
                for a, us, k, t, q, to in batch
            ])
            for o in p.handleInputRows((3,), iter([frame[:7], frame[7:]]) if len(frame) > 7 else iter([frame]), None):
                got += list(zip(o.product_id, o.event_us, np.where(o.event_kind == "product", 0, 1), o.name, o.current_stock, o.units, o.sale_us, o.restock_us))
        assert [tuple(r) for r in got] == one_by_one(batches)


def test_a_group_holds_many_products(spark, tmp_path):
    """Every group costs a fixed time, so their number must not grow with the products."""
    products = spark.range(9000).select(
        "id", F.lit("a").alias("name"), F.lit(1).cast("decimal(12,2)").alias("price"), F.lit(5).alias("stock_quantity"),
        F.lit("2024-01-01").cast("timestamp").alias("event_ts"),
    )
    items = spark.range(9000).select(
        F.col("id").alias("order_id"), F.lit(1).cast("bigint").alias("line_number"), F.col("id").alias("product_id"), F.lit(2).alias("quantity"),
        F.lit("2024-01-02").cast("timestamp").alias("event_ts"),
    )
    for name, rows in (("p", products), ("i", items)):
        rows.write.parquet(f"{tmp_path}/{name}")
    streams = [spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/{name}") for name, rows in (("p", products), ("i", items))]
    found = pipelines.inventory_stream(*streams)
    assert "shard" in found._jdf.queryExecution().logical().toString()
    got = pipelines.run(found, f"{tmp_path}/cp", f"{tmp_path}/out").groupBy("current_stock", "total_sales_7d").count()
    assert sorted(map(tuple, got.collect())) == [(3, 2, 9000), (5, 0, 9000)]


def test_days_leave_by_timers(spark, tmp_path):
    for day in (1, 2, 20, 40, 60):
        spark.sql(f"SELECT {day}L AS order_id, 1L AS line_number, {day}L AS product_id, 2 AS quantity, timestamp'2024-01-01' + INTERVAL {day} DAYS AS event_ts") \
            .coalesce(1).write.parquet(f"{tmp_path}/i/p={day}")
    schema = "order_id long, line_number long, product_id long, quantity int, event_ts timestamp"
    items = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/i/p=*")
    spark.sql("SELECT 1L AS id, 'a' AS name, 1BD AS price, 5 AS stock_quantity, timestamp'2024-03-01' AS event_ts").write.parquet(f"{tmp_path}/p")
    products = spark.readStream.schema("id long, name string, price decimal(12,2), stock_quantity int, event_ts timestamp").parquet(f"{tmp_path}/p")
    query = pipelines.start(pipelines.inventory_stream(products, items, delay="1 hour"), f"{tmp_path}/cp", path=f"{tmp_path}/out")
    query.awaitTermination()
    assert sum(p["stateOperators"][0]["customMetrics"]["numDeletedTimers"] for p in query.recentProgress if p["stateOperators"]) >= 3
    assert spark.read.parquet(f"{tmp_path}/out").filter("event_kind = 'sale'").count() == 5
