"""Bucketed state: what a micro-batch reads and writes, exact sums and ids, and timers that empty idle keys."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from changeloom.operators import anomalies, inventory
from changeloom.operators.anomalies import Limits
from changeloom.streaming import pipelines
from changeloom.streaming.processors import NONE, AnomalyProcessor, Buckets
from seeds import rows

HOUR = 3_600_000_000


class Map:
    """A map state that counts its calls."""

    def __init__(self):
        self.data, self.writes = {}, 0

    def getValue(self, key):
        return self.data.get(key)

    def updateValue(self, key, value):
        self.data[key], self.writes = value, self.writes + 1

    def removeKey(self, key):
        self.data.pop(key, None)

    def keys(self):
        return iter(list(self.data))

    def iterator(self):
        return iter(list(self.data.items()))

    def get(self):
        return self.data.get(0)

    def update(self, value):
        self.data[0] = value


class Handle:
    def __init__(self):
        self.maps, self.timers = {}, []

    def getMapState(self, name, *schema):
        return self.maps.setdefault(name, Map())

    getValueState = getMapState

    def registerTimer(self, ms):
        self.timers.append(ms)


def frame(ids, cents, times):
    return pd.DataFrame({"customer_id": 1, "id": ids, "cents": cents, "event_us": times})


def test_a_batch_writes_what_it_holds():
    handle, p = Handle(), AnomalyProcessor(Limits(kept="24 hours"), timers=True)
    p.init(handle)
    recent, amounts = handle.maps["recent"], handle.maps["amounts"]
    for batch in range(200):  # ten orders each, an hour apart
        times = batch * HOUR + np.arange(10)
        recent.writes = amounts.writes = 0
        out = list(p.handleInputRows((1,), iter([frame(np.arange(10), np.full(10, 7), times)]), None))[0]
        assert recent.writes == 1 and amounts.writes <= 2
        # The window is open at its start: of the batch before, those later in their hour count.
        assert out["spike_count"].tolist() == ([10] * 10 if batch else list(range(1, 11)))
        assert out["total_customer_orders"].tolist() == list(range(batch * 10 + 1, batch * 10 + 11))
    assert len(recent.data) <= 26 and len(amounts.data) <= 2
    assert len(handle.timers) == 200 and {p.buckets.timed_out(t) for t in handle.timers} == set(range(200))


@pytest.mark.parametrize("size", [1, 7, 100])
def test_last_amounts_and_wide_numbers(size):
    rng = np.random.default_rng(1)
    for top in (1000, 10**12 - 1):  # the second needs more than 64 bits for its squares
        handle, p = Handle(), AnomalyProcessor(Limits(z_rows=size))
        p.init(handle)
        cents, got, at = rng.integers(0, top, 300), [], 0
        while at < 300:
            n = int(rng.integers(1, 40))
            part = cents[at:at + n]
            ids = (1 << 60) + at + np.arange(len(part))
            got += list(p.handleInputRows((1,), iter([frame(ids, part, at * HOUR + np.arange(len(part)))]), None))
            at += n
        got = pd.concat(got)
        assert got["id"].tolist() == [(1 << 60) + k for k in range(300)]
        for k in range(300):
            last = [int(c) for c in cents[max(0, k + 1 - size):k + 1]]
            assert got["mean_amount"].iloc[k] == pytest.approx(sum(last) / len(last) / 100)
            if len(last) > 1:
                exact = len(last) * sum(c * c for c in last) - sum(last) ** 2
                assert got["stddev_amount"].iloc[k] == pytest.approx((exact / (len(last) * (len(last) - 1))) ** 0.5 / 100, rel=1e-12, abs=1e-9)


def test_buckets_far_apart():
    b = Buckets(Map(), 10, 1000)
    assert b.read(0, 99, 0, -1, NONE)[0].tolist() == []
    assert b.add(np.array([5, 6, 700]), np.array([1, 2, 3]), NONE) == [0, 70]
    times, amounts = b.read(0, 10_000, 0, 70, NONE)
    assert sorted(zip(times.tolist(), amounts.tolist())) == [(5, 1), (6, 2), (700, 3)]
    assert b.read(0, 10_000, 0, 70, 5)[0].tolist() == [6, 700]
    assert b.drop(0, 699) == 70 and list(b.state.data) == [(70,)]


def test_idle_customers_leave(spark, tmp_path):
    start = datetime(2024, 1, 1)
    parts = [[(1, 7, 10.0, start), (2, 7, 20.0, start + timedelta(minutes=1)), (3, 8, 30.0, start + timedelta(minutes=2))]]
    parts += [[(10 + n, 9, 5.0, start + timedelta(days=2 * n))] for n in range(1, 5)]
    schema = "id long, customer_id long, total_amount decimal(12,2), event_ts timestamp"
    for n, part in enumerate(parts):
        df = spark.createDataFrame(part, "id long, customer_id long, total_amount double, event_ts timestamp")
        df.withColumn("total_amount", F.col("total_amount").cast("decimal(12,2)")).coalesce(1).write.parquet(f"{tmp_path}/in/p={n}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/p=*")
    query = pipelines.start(pipelines.anomaly_stream(stream, Limits(rapid_orders=2), delay="1 hour"), f"{tmp_path}/cp", path=f"{tmp_path}/out")
    query.awaitTermination()
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    timers = [p["stateOperators"][0]["customMetrics"]["numDeletedTimers"] for p in query.recentProgress]
    # Two times two of idle customers and those of all but the last day are gone; totals and amounts stay.
    assert sum(timers) >= 2 and states[-1] <= 3 * 2 + 2
    whole = spark.createDataFrame([r for p in parts for r in p], "id long, customer_id long, total_amount double, event_ts timestamp")
    wanted = anomalies.anomalies(whole.withColumn("total_amount", F.col("total_amount").cast("decimal(12,2)")), Limits(rapid_orders=2))
    got = spark.read.parquet(f"{tmp_path}/out").select("alert_id", "description")
    assert rows(got) == rows(wanted.select("alert_id", "description")) and got.count() == 1


def test_product_events_of_one_transaction(spark, tmp_path):
    """The log's offset orders them, whatever order they are read in."""
    at = datetime(2024, 1, 1)
    products = [(1, "a", 5.0, 100, at, 10), (1, "a", 5.0, 7, at, 11), (2, "b", 5.0, 9, at, 3), (2, "b", 5.0, 50, at, 2)]
    schema = "id long, name string, price double, stock_quantity int, event_ts timestamp, offset long"
    items = spark.createDataFrame([], "order_id long, line_number long, product_id long, quantity int, event_ts timestamp")
    for order in (products, products[::-1]):
        df = spark.createDataFrame(order, schema).withColumn("price", F.col("price").cast("decimal(12,2)")).coalesce(1)
        got = {r["product_id"]: r["current_stock"] for r in inventory.inventory_insights(df, items, "2024-02-01").collect()}
        assert got == {1: 7, 2: 9} == {r["product_id"]: r["stock_quantity"] for r in inventory.current_inventory(df, items).collect()}
    df.write.parquet(f"{tmp_path}/p")
    items.write.parquet(f"{tmp_path}/i")
    found = pipelines.inventory_stream(*(spark.readStream.schema(x.schema).parquet(f"{tmp_path}/{n}") for x, n in ((df, "p"), (items, "i"))))
    out = pipelines.run(found, f"{tmp_path}/cp", f"{tmp_path}/out")
    assert sorted((r["product_id"], r["current_stock"]) for r in out.collect()) == [(1, 7), (1, 100), (2, 9), (2, 50)]
