"""Order alerts by shards: customers of one group keep apart, whatever the batches are."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from changeloom.operators.anomalies import Limits
from changeloom.streaming import pipelines
from changeloom.streaming.processors import NONE, AnomalyProcessor
from test_keyed_state import HOUR, Handle


def one_by_one(batches, size, spike, rapid, kept):
    """The same by a loop over orders."""
    state, out = {}, []
    for n, batch in enumerate(batches):
        for c, us, tie, cents in sorted(batch, key=lambda r: r[:3]):
            s = state.setdefault(c, {"cents": [], "times": [], "horizon": NONE})
            s["cents"].append(cents)
            s["times"].append((us, n))
            seen = [t for t, b in s["times"] if b == n or t > s["horizon"]]
            last = s["cents"][-size:]
            squares = len(last) * sum(x * x for x in last) - sum(last) ** 2
            deviation = math.sqrt(squares / (len(last) * (len(last) - 1))) / 100 if len(last) > 1 else None
            out.append((
                c, tie, cents, us, len(s["cents"]), sum(s["cents"]), sum(t > us - spike for t in seen), sum(t > us - rapid for t in seen),
                sum(last) / len(last) / 100, deviation,
            ))
        for c in {r[0] for r in batch}:
            state[c]["horizon"] = max(state[c]["horizon"], max(r[1] for r in batch if r[0] == c) - kept)
    return out


@pytest.mark.parametrize("timers, few", [(True, 64), (False, 64), (False, 5), (False, 0)])
@pytest.mark.parametrize("top", [10**4, 10**12])  # the second needs more than 64 bits for its squares
def test_shards_against_a_loop(top, timers, few, monkeypatch):
    monkeypatch.setattr(AnomalyProcessor, "FEW", few)
    rng = np.random.default_rng(11)
    for _ in range(60):
        size, days = int(rng.integers(1, 8)), int(rng.integers(1, 4))
        p = AnomalyProcessor(Limits(z_rows=size, kept=f"{days} days", rapid_window="2 hours"), timers=timers)
        p.init(Handle())
        batches, got, tie = [], [], 0
        for _ in range(int(rng.integers(1, 7))):
            batch = []
            for _ in range(int(rng.integers(1, 50))):
                tie += 1
                batch.append((int(rng.integers(0, 6)), int(rng.integers(0, 240)) * HOUR // 2, tie, int(rng.integers(0, top))))
            batches.append(batch)
            frame = pd.DataFrame(batch, columns=["customer_id", "event_us", "id", "cents"])
            for o in p.handleInputRows((3,), iter([frame[:9], frame[9:]]) if len(frame) > 9 else iter([frame]), None):
                got.append(o)
        wanted = one_by_one(batches, size, HOUR, 2 * HOUR, days * 24 * HOUR)
        got = pd.concat(got)
        exact = ["customer_id", "id", "cents", "event_us", "total_customer_orders", "total_cents", "spike_count", "rapid_count"]
        assert [tuple(r) for r in got[exact].itertuples(index=False)] == [w[:8] for w in wanted]
        assert got["mean_amount"].tolist() == pytest.approx([w[8] for w in wanted])
        for deviation, w in zip(got["stddev_amount"], wanted):
            assert math.isnan(deviation) if w[9] is None else deviation == pytest.approx(w[9], rel=1e-9, abs=1e-9)


def test_a_sparse_customer_is_one_row():
    """Calls to the state cost more than all else: one to read and one to write a customer."""
    handle, p = Handle(), AnomalyProcessor(Limits(kept="10 days"))
    p.init(handle)
    for batch in range(3):
        frame = pd.DataFrame([(c, batch * 20 * HOUR + h * HOUR, h, 5) for c in range(50) for h in range(20)], columns=["customer_id", "event_us", "id", "cents"])
        list(p.handleInputRows((3,), iter([frame]), None))
    assert sum(m.writes for m in handle.maps.values()) == 3 * 50
    # A busy customer has buckets: only those with new orders are written.
    for batch in range(3):
        handle.maps["recent"].writes = 0
        frame = pd.DataFrame([(7, (60 + batch) * HOUR + h, h, 5) for h in range(100)], columns=["customer_id", "event_us", "id", "cents"])
        counts = list(p.handleInputRows((3,), iter([frame]), None))[0]["spike_count"].tolist()
        assert counts[-1] == 100 and (not batch or handle.maps["recent"].writes == 1)


def test_a_group_holds_many_customers(spark, tmp_path):
    """Every group costs a fixed time, so their number must not grow with the customers."""
    for n in range(2):  # two micro-batches
        spark.range(9000).select(
            (F.col("id") + n * 10_000).alias("id"), F.col("id").alias("customer_id"), F.lit(5).cast("decimal(12,2)").alias("total_amount"),
            (F.lit("2024-01-01").cast("timestamp") + F.make_interval(mins=F.lit(n))).alias("event_ts"),
        ).coalesce(1).write.parquet(f"{tmp_path}/in/p={n}")
    schema = "id long, customer_id long, total_amount decimal(12,2), event_ts timestamp"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/p=*")
    found = pipelines.anomaly_stream(stream)
    assert "shard" in found._jdf.queryExecution().logical().toString()
    got = pipelines.run(found, f"{tmp_path}/cp", f"{tmp_path}/out")
    counts = got.groupBy("anomaly_type", "total_customer_orders", "details.order_count").agg(F.count("*"), F.countDistinct("customer_id"))
    assert [tuple(r) for r in counts.collect()] == [("rapid_orders", 2, 2, 9000, 9000)]
