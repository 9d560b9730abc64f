"""Orders and items joined as they arrive, with an account of every row.

Both sides carry a watermark and an item belongs to an order placed at most ``reach`` before it, so the state holds what can still
match and no more.  Rows without a partner leave when the watermark has passed everything they could meet.  Rows that come
behind the watermark never enter the join; ``account`` finds them and ``late_letters`` makes dead letters of them.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.times import as_timestamp
from .pipelines import WATERMARK, start, with_event_time

#: Whether a state store counts its rows, which costs a read before every write.
COUNTED = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
#: The layout of a join's state; 3 keeps a partition's four tables in one store, where 2 has a store each to load and commit.
LAYOUT = "spark.sql.streaming.join.stateFormatVersion"
#: A new checkpoint has as many partitions of state as this session setting says.
PARTITIONS = "spark.sql.shuffle.partitions"
MATCHED, UNMATCHED, OPEN, LATE = "matched", "unmatched", "open", "late"


def order_item_stream(orders: DataFrame, items: DataFrame, reach: str, delay: str = WATERMARK) -> DataFrame:
    """``order_id, order_ts, item_id, item_ts``: items with their order, and each side's rows without a partner (append mode).

    ``orders`` has ``id, event_ts``, ``items`` has ``id, order_id, event_ts``; ids tell rows apart.
    """
    o = with_event_time(orders.select(F.col("id").alias("order_id"), F.col("event_ts").alias("order_ts")), delay, "order_ts")
    i = with_event_time(
        items.select(F.col("id").alias("item_id"), F.col("order_id").alias("of_order"), F.col("event_ts").alias("item_ts")), delay, "item_ts"
    )
    near = (F.col("item_ts") >= F.col("order_ts")) & (F.col("item_ts") <= F.col("order_ts") + F.expr(f"INTERVAL {reach}"))
    return o.join(i, (F.col("order_id") == F.col("of_order")) & near, "full").select("order_id", "order_ts", "item_id", "item_ts")


def start_joined(
    joined: DataFrame, checkpoint: str, path: str, trigger: dict | None = None, partitions: int | None = None, one_store: bool = False,
) -> StreamingQuery:
    """Start a joined stream into parquet files.

    Every row of both sides is a state row here, so the state's rows are not counted: ``numRowsTotal`` of the query's progress is 0.
    Loading and committing a store costs tenths of a second a micro-batch, whatever it holds: a new checkpoint has ``partitions`` of state
    at most, with ``one_store`` instead of four each, which needs RocksDB.  The session's own settings stay as they are.
    """
    conf = joined.sparkSession.conf
    wanted = {COUNTED: "false"} | ({LAYOUT: "3"} if one_store else {})
    if partitions is not None:
        wanted[PARTITIONS] = str(min(partitions, int(conf.get(PARTITIONS))))
    before = {name: conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            conf.set(name, value)
        return start(joined, checkpoint, path=path, trigger=trigger)  # a query keeps the settings it is started with
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)


def watermark_of(query: StreamingQuery) -> datetime | None:
    """The watermark of a query's last micro-batch: the older of both sides."""
    last = query.lastProgress
    at = last and last["eventTime"].get("watermark")
    return datetime.fromisoformat(at.replace("Z", "+00:00")).replace(tzinfo=None) if at else None


def account(orders: DataFrame, items: DataFrame, joined: DataFrame, reach: str, watermark: datetime | str | Column) -> DataFrame:
    """``side, id`` (as text), ``event_ts, outcome`` of every input row: matched, unmatched, open or late.

    ``orders`` and ``items`` are the input as a batch, ``joined`` what the stream has written.  A row that is missing there is open
    while the watermark has not passed all it could meet; once it has, the row can only have come too late.
    """
    mark, wait = as_timestamp(watermark), F.expr(f"INTERVAL {reach}")

    def side(rows: DataFrame, name: str, key: str, other: str, passed: Column) -> DataFrame:
        found = joined.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.count(other).alias("_partners"))
        missing = F.when(passed < mark, F.lit(LATE)).otherwise(F.lit(OPEN))
        outcome = F.when(F.col("_partners") > 0, F.lit(MATCHED)).when(F.col("_partners") == 0, F.lit(UNMATCHED)).otherwise(missing)
        return rows.select("id", "event_ts").join(found, "id", "left").select(
            F.lit(name).alias("side"), F.col("id").cast("string").alias("id"), "event_ts", outcome.alias("outcome")
        )

    at = F.col("event_ts")
    return side(orders, "order", "order_id", "item_id", at + wait).unionByName(side(items, "item", "item_id", "order_id", at))


def late_letters(accounted: DataFrame, service: str) -> DataFrame:
    """Dead letters of the late rows, for ``sinks.logs.write_dlq``."""
    return accounted.filter(F.col("outcome") == LATE).select(
        F.lit(service).alias("service"), F.col("side").alias("topic"), F.col("id").alias("key"), F.lit("late").alias("error"), "event_ts"
    )
