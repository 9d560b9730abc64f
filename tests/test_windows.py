"""Estimated customers of windows."""

from pyspark.sql import functions as F

from changeloom.operators import windows


def test_every_estimate_is_near(spark):
    """4,000 windows of 500 customers: a sketch of 5 % leaves some of them more than 15 % off."""
    orders = spark.range(2_000_000).select(
        F.xxhash64("id").alias("customer_id"), F.lit(1).cast("decimal(12,2)").alias("total_amount"),
        F.timestamp_micros((F.col("id") % 4_000) * 3_600_000_000).alias("event_ts"),
    )
    found = windows.sales_windows(orders, "1 hour", approx=True)
    worst = found.agg(F.count(F.lit(1)), F.max(F.abs(F.col("unique_customers") - 500))).first()
    assert worst[0] == 4_000 and worst[1] <= 75
