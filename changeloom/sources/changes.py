"""Change logs as DataFrames: brokers, files, and snapshots of tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.decimals import encode_decimal
from ..functions.times import as_timestamp, millis
from ..schemas import READ, TABLES, Table

#: Default names of topics and of the connector's keep-alive topics.
TOPIC_PREFIX = "dbserver1.public."
HEARTBEAT_PREFIX = "__debezium-heartbeat"


def topics_of(tables: str | Iterable[str], prefix: str = TOPIC_PREFIX) -> str:
    """Comma list of topics for a comma list (or sequence) of tables."""
    names = tables.split(",") if isinstance(tables, str) else tables
    return ",".join(prefix + n.strip() for n in names)


def read_changes(
    spark: SparkSession,
    servers: str,
    topics: str | Iterable[str],
    streaming: bool = True,
    starting: str = "earliest",
    **options: str,
) -> DataFrame:
    """Broker topics, values as text.  Needs the Spark Kafka connector on the class path."""
    reader = spark.readStream if streaming else spark.read
    source = (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics if isinstance(topics, str) else ",".join(topics))
        .option("startingOffsets", starting)
        .options(**options)
        .load()
    )
    return source.select(
        F.col("topic"),
        F.col("partition"),
        F.col("offset"),
        F.col("timestamp").alias("log_ts"),
        F.col("value").cast("string").alias("value"),
    )


_LINE = T.StructType([T.StructField("value", T.StringType())])


def read_change_files(
    spark: SparkSession,
    path: str | Iterable[str],
    streaming: bool = False,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Replay of a log kept as text files, one event per line; several paths are united."""
    paths = [path] if isinstance(path, str) else list(path)
    if not streaming:
        return spark.read.text(paths)

    def one(p: str) -> DataFrame:
        reader = spark.readStream
        if files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)
        return reader.text(p)

    log = one(paths[0])
    for p in paths[1:]:
        log = log.unionByName(one(p))
    return log


def filter_tables(df: DataFrame, names: Iterable[str], column: str = "table") -> DataFrame:
    """Include list of tables; with ``column='topic'`` it takes topic names."""
    return df.filter(F.col(column).isin(*names))


def drop_heartbeats(df: DataFrame, column: str = "topic") -> DataFrame:
    return df.filter(~F.col(column).startswith(HEARTBEAT_PREFIX))


def _wire_value(name: str, kind: T.DataType, table: Table, image: Column | None = None) -> Column:
    c = F.col(name) if image is None else image[name]
    if isinstance(kind, T.DecimalType):
        form = table.wire.get(name, "base64")
        if form == "base64":
            return encode_decimal(c, kind.scale).alias(name)
        return (c.cast("string") if form == "string" else c).alias(name)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).alias(name)
    return c.alias(name)


def _wire_row(table: Table, image: Column | None = None) -> list[Column]:
    return [_wire_value(n, k, table, image) for n, k in table.columns.items()]


def to_change_log(
    df: DataFrame,
    table: Table | str,
    op: Column | str,
    ts: Column,
    layout: str = "wrapped",
    before: Column | None = None,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Write typed rows as change events, one JSON text per row in ``value``.

    Layouts: ``wrapped`` and ``bare`` are flattened, ``standard`` carries both images (the old
    one from the struct column ``before``).
    """
    table = TABLES[table] if isinstance(table, str) else table
    op = F.lit(op) if isinstance(op, str) else op
    name = F.lit(table.name)
    if layout in ("wrapped", "bare"):
        deleted = F.when(op == "d", "true").otherwise("false")
        payload = F.struct(
            *_wire_row(table),
            op.alias("__op"),
            millis(ts).alias("__source_ts_ms"),
            name.alias("__source_table"),
            deleted.alias("__deleted"),
        )
        event = F.struct(payload.alias("payload")) if layout == "wrapped" else payload
    elif layout == "standard":
        row = F.struct(*_wire_row(table))
        old = F.lit(None).cast("string") if before is None else F.when(
            before.isNotNull(), F.struct(*_wire_row(table, before))
        )
        event = F.struct(
            F.struct(
                F.when(op == "d", row).otherwise(old).alias("before") if before is not None
                else F.when(op == "d", row).alias("before"),
                F.when(op != "d", row).alias("after"),
                op.alias("op"),
                millis(ts).alias("ts_ms"),
                F.struct(name.alias("table")).alias("source"),
            ).alias("payload")
        )
    else:
        raise ValueError(f"unknown layout: {layout}")
    return df.select(*keep, F.to_json(event).alias("value"))


def snapshot_as_changes(
    df: DataFrame, table: Table | str, ts: Column | str, layout: str = "wrapped"
) -> DataFrame:
    """Initial snapshot: every row of a table as a read event."""
    at = ts if isinstance(ts, Column) else as_timestamp(ts)
    return to_change_log(df, table, READ, at, layout)
