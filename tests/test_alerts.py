"""Alert states against a loop, hot series and ties included, and a stream that fires in silence."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from changeloom.operators import quality
from changeloom.streaming import alerts, pipelines

START = datetime(2024, 1, 1)
SCHEMA = "series long, id long, value long, ts timestamp"


def machine(samples, wait, edge):
    """Transitions of one series; samples are (minute, id, on)."""
    state, since, out = "inactive", None, []
    for at, _, on in [*sorted(samples), (edge, None, None)]:
        if state == "pending" and (since + wait < at or on is not False and since + wait == at):
            state = "firing"
            out.append(("firing", since + wait))
        if on is None:
            break
        if on and state in ("inactive", "resolved"):
            state, since = "pending", at
            out.append(("pending", at))
            if wait == 0:
                state = "firing"
                out.append(("firing", at))
        elif not on and state in ("pending", "firing"):
            state = "resolved" if state == "firing" else "inactive"
            out.append((state, at))
    return out


def rows_of(rng, n):
    rows = [(1 if rng.random() < 0.5 else rng.randrange(2, 7), k, rng.choice([0, 1, 1, 1]), START + timedelta(minutes=rng.randrange(200))) for k in range(n)]
    return rows + [(8, 5000, 1, START + timedelta(minutes=3)), (None, 5001, 1, START), (8, 5002, 1, None)]


@pytest.mark.parametrize("wait", [0, 4, 15])
@pytest.mark.parametrize("max_rows", [None, 30])
def test_states(spark, wait, max_rows):
    rows = rows_of(random.Random(wait), 300)
    df = spark.createDataFrame(rows, SCHEMA)
    got = quality.alert_states(df, F.col("value") == 1, f"{wait} minutes", "series", "ts", order=["id"], max_rows=max_rows)
    minute = lambda ts: int((ts - START).total_seconds()) // 60
    edge = max(minute(r[3]) for r in rows if r[3] is not None and r[0] is not None)
    want = []
    for s in range(1, 9):
        mine = [(minute(r[3]), r[1], r[2] == 1) for r in rows if r[0] == s and r[3] is not None]
        want += [(s, state, at) for state, at in machine(mine, wait, edge)]
    assert sorted((r["series"], r["state"], minute(r["at"])) for r in got.collect()) == sorted(want)
    assert quality.alert_states(df.limit(0), F.col("value") == 1, "1 minute", "series", "ts").collect() == []


def test_fires_in_silence_and_takes_late_samples(spark, tmp_path):
    at = lambda m: START + timedelta(minutes=m)
    batches = [
        [(1, 1, 1, at(0)), (2, 2, 1, at(0)), (9, 3, 0, at(1))],
        [(2, 4, 0, at(5)), (9, 5, 0, at(8))],  # series 1 is silent from here on
        [(9, 6, 0, at(60)), (3, 7, 1, at(52))],
        [(3, 8, 0, at(51)), (3, 9, 1, at(53)), (9, 10, 0, at(200))],  # late, but within the watermark
    ]
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
        found = alerts.alert_stream(stream, F.col("value") == 1, "15 minutes", "series", "ts", delay="10 minutes", order="id")
        out = pipelines.run(found, f"{tmp_path}/cp", f"{tmp_path}/out")
    got = sorted((r["series"], r["state"], r["at"]) for r in out.collect())
    assert got == sorted([
        (1, "pending", at(0)), (1, "firing", at(15)), (2, "pending", at(0)), (2, "inactive", at(5)), (3, "pending", at(52)), (3, "firing", at(67)),
    ])


def test_a_group_holds_many_series(spark, tmp_path):
    """Every group costs a fixed time, so their number must not grow with the series."""
    at = lambda n: F.lit(START) + F.make_dt_interval(mins=F.lit(n))
    for n, on in ((0, 1), (8, 0), (200, 0)):  # every third series is off at 8 minutes, one at 200
        rows = spark.range(9000 if n < 200 else 1).filter("id % 3 = 0" if n else "true")
        rows = rows.select(F.concat(F.lit("s"), "id").alias("series"), "id", F.lit(on).alias("value"), at(n).alias("ts"))
        rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
        found = alerts.alert_stream(stream, F.col("value") == 1, "15 minutes", "series", "ts", delay="10 minutes", order="id")
        query = pipelines.start(found, f"{tmp_path}/cp", path=f"{tmp_path}/out")
        query.awaitTermination()
        states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        assert max(states) <= 4 * pipelines.SHARDS  # two values and their timers a shard
    got = spark.read.parquet(f"{tmp_path}/out").groupBy("state", "at").agg(F.count_distinct("series"), F.count("series"))
    after = lambda n: START + timedelta(minutes=n)
    assert sorted(map(tuple, got.collect())) == [
        ("firing", after(15), 6000, 6000), ("inactive", after(8), 3000, 3000), ("pending", after(0), 9000, 9000),
    ]
