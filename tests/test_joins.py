"""Two joined streams: every row is matched, unmatched, open or late, and late ones become dead letters."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from changeloom.sinks.logs import dlq_sink
from changeloom.streaming import joins, pipelines

START = datetime(2024, 1, 1)


def at(hours):
    return START + timedelta(hours=hours)


def test_every_row_is_accounted_for(spark, tmp_path):
    parts = [
        ([(1, at(0)), (2, at(1)), (3, at(2))], [(10, 1, at(1)), (11, 1, at(2)), (12, 9, at(2)), (13, None, at(2))]),
        ([(4, at(50)), (None, at(50))], [(14, 4, at(51)), (15, 3, at(50))]),
        ([(5, at(3)), (6, at(52))], [(16, 2, at(4)), (17, 6, at(53)), (18, 5, at(53))]),  # 5 and 16 are late
    ]
    schemas = ("id long, event_ts timestamp", "id long, order_id long, event_ts timestamp")
    for part in parts:
        for name, rows, schema in zip("oi", part, schemas):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
        streams = [spark.readStream.schema(s).parquet(f"{tmp_path}/{n}") for n, s in zip("oi", schemas)]
        query = pipelines.start(joins.order_item_stream(*streams, "10 hours", "1 hour"), f"{tmp_path}/cp", path=f"{tmp_path}/out")
        query.awaitTermination()
    batch = [spark.read.parquet(f"{tmp_path}/{n}") for n in "oi"]
    joined = spark.read.parquet(f"{tmp_path}/out")
    mark = joins.watermark_of(query)
    assert mark == at(51)  # the older side's newest row, less the delay
    found = joins.account(batch[0].filter("id IS NOT NULL"), batch[1], joined, "10 hours", mark)
    got = {(r["side"], int(r["id"])): r["outcome"] for r in found.collect()}
    assert got == {
        ("order", 1): "matched", ("order", 2): "unmatched", ("order", 3): "unmatched", ("order", 4): "matched", ("order", 5): "late",
        ("order", 6): "matched", ("item", 10): "matched", ("item", 11): "matched", ("item", 12): "unmatched", ("item", 13): "unmatched",
        ("item", 14): "matched", ("item", 15): "unmatched", ("item", 16): "late", ("item", 17): "matched", ("item", 18): "open",
    }
    letters = joins.late_letters(found, "join")
    for _ in range(2):  # a retry writes the same letters anew
        dlq_sink(f"{tmp_path}/dlq")(letters, 3)
    assert spark.read.json(f"{tmp_path}/dlq").select("topic", "key").orderBy("key").collect() == [("item", "16"), ("order", "5")]
    assert joined.filter(F.col("order_id").isNull() & F.col("item_id").isNull()).count() <= 1


def test_a_joined_stream_does_not_read_before_it_writes(spark, tmp_path):
    """Counting the state's rows costs a read for each write; the join's state has a row per input row."""
    spark.range(3000).select("id", F.lit(START).alias("event_ts")).coalesce(1).write.parquet(f"{tmp_path}/o")
    spark.range(3000).select("id", F.col("id").alias("order_id"), F.lit(START).alias("event_ts")).coalesce(1).write.parquet(f"{tmp_path}/i")
    sides = [spark.readStream.schema(spark.read.parquet(f"{tmp_path}/{n}").schema).parquet(f"{tmp_path}/{n}") for n in "oi"]
    joined, gets, counted = joins.order_item_stream(*sides, "10 hours", "1 hour"), [], spark.conf.get(joins.COUNTED, None)
    for n, run in enumerate((lambda *a: pipelines.start(a[0], a[1], path=a[2]), joins.start_joined)):
        query = run(joined, f"{tmp_path}/cp{n}", f"{tmp_path}/out{n}")
        query.awaitTermination()
        gets.append(query.recentProgress[0]["stateOperators"][0]["customMetrics"]["rocksdbGetCount"])
        assert spark.read.parquet(f"{tmp_path}/out{n}").filter("order_id = item_id").count() == 3000
    assert gets[1] <= gets[0] - 6000 and spark.conf.get(joins.COUNTED, None) == counted
