"""The state of joined streams: one store a partition, and no more partitions than asked for."""

from datetime import datetime

from pyspark.sql import functions as F

from changeloom.streaming import joins, pipelines


def test_a_partition_of_a_joined_stream_has_one_store(spark, tmp_path):
    at = F.lit(datetime(2024, 1, 1)).alias("event_ts")
    spark.range(90).select("id", at).coalesce(1).write.parquet(f"{tmp_path}/o")
    spark.range(60).select("id", F.col("id").alias("order_id"), at).coalesce(1).write.parquet(f"{tmp_path}/i")
    settings = {name: spark.conf.get(name, None) for name in (joins.COUNTED, joins.LAYOUT, joins.PARTITIONS)}
    assert settings[joins.PARTITIONS] == "4"
    for n, (asked, wanted) in enumerate(((None, 4), (3, 3), (50, 4))):
        sides = [spark.readStream.schema(spark.read.parquet(f"{tmp_path}/{x}").schema).parquet(f"{tmp_path}/{x}") for x in "oi"]
        joined = joins.order_item_stream(*sides, "10 hours", "1 hour")
        limit = {} if asked is None else {"partitions": asked}
        query = joins.start_joined(joined, f"{tmp_path}/cp{n}", f"{tmp_path}/out{n}", one_store=True, **limit)
        query.awaitTermination()
        state = query.recentProgress[0]["stateOperators"][0]
        assert (state["numShufflePartitions"], state["numStateStoreInstances"]) == (wanted, wanted)
        assert spark.read.parquet(f"{tmp_path}/out{n}").filter("order_id = item_id").count() == 60
        if n == 0:
            gets = state["customMetrics"]["rocksdbGetCount"]
        assert {name: spark.conf.get(name, None) for name in settings} == settings
    spark.conf.set(joins.LAYOUT, "3")
    try:
        query = pipelines.start(joined, f"{tmp_path}/cp-counted", path=f"{tmp_path}/out-counted")
    finally:
        spark.conf.unset(joins.LAYOUT)
    query.awaitTermination()
    # A counted row is read before it is written, here, too.
    assert gets <= query.recentProgress[0]["stateOperators"][0]["customMetrics"]["rocksdbGetCount"] - 2 * 150
