"""The shop tables, mapped from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.times import micros
from ..session import configure

OPENING = "1995-01-01"
#: Setting of benches and tests on tables with fewer splits than cores.
SPREAD = "changeloom.spread"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a table to as many tasks as ``changeloom.spread`` says; unset, leave them as they are.

    A test table is a single row group and so a single task.
    """
    parts = df.sparkSession.conf.get(SPREAD, None)
    return df if parts is None or df.isStreaming else df.repartition(int(parts))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    opened = F.lit(OPENING).cast("timestamp")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.concat("p_type", F.lit(" "), "p_brand").alias("description"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
        (F.lit(50) + (F.col("p_partkey") * 37) % 200).cast("int").alias("stock_quantity"),
        opened.alias("created_at"),
        opened.alias("updated_at"),
        opened.alias("event_ts"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("timestamp")
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
        F.when(status == "F", "completed")
        .when(status == "O", "pending")
        .when(status == "P", "processing")
        .otherwise("unknown")
        .alias("status"),
        day.alias("created_at"),
        day.alias("updated_at"),
        day.alias("event_ts"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items.  (order, line) repeats here, so events are ordered by line and quantity too.

    The unit price is the line price over the quantity, rounded half up in whole cents.
    """
    day = F.col("l_shipdate").cast("timestamp")
    unit_cents = F.expr(
        "(2 * cast(round(l_extendedprice * 100) AS BIGINT) + cast(l_quantity AS BIGINT))"
        " div (2 * cast(l_quantity AS BIGINT))"
    )
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("bigint").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (unit_cents.cast("decimal(12,0)") / 100).cast("decimal(12,2)").alias("price"),
        day.alias("created_at"),
        day.alias("event_ts"),
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fine-grained order events; the operation follows from the event type."""
    kind = F.col("event_type")
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("customer_id"),
        F.col("value").cast("decimal(12,2)").alias("total_amount"),
        kind.alias("status"),
        F.when(kind == "signup", "r")
        .when(kind.isin("purchase", "view"), "c")
        .when(kind == "click", "u")
        .when(kind == "error", "d")
        .otherwise("unknown")
        .alias("operation"),
        ts.alias("created_at"),
        ts.alias("updated_at"),
        ts.alias("event_ts"),
        micros(ts).alias("event_us"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as products with long descriptions."""
    return spread(table(spark, sf_dir, "documents")).select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("name"),
        F.col("text").alias("description"),
        F.lit(0).cast("decimal(12,2)").alias("price"),
        F.lit(0).alias("stock_quantity"),
        F.lit(OPENING).cast("timestamp").alias("updated_at"),
    )
