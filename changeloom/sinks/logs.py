"""Dead letters and the archive of raw changes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.envelope import UNKNOWN, read_metadata


def write_dlq(letters: DataFrame, root: str, batch: int | None = None) -> None:
    """Dead letters as JSON, by service and topic.

    Letters of a numbered batch stand in a folder of their own, which a retry writes anew; others are appended.
    """
    if batch is None:
        letters.write.mode("append").partitionBy("service", "topic").json(root)
    else:
        letters.write.mode("overwrite").partitionBy("service", "topic").json(f"{root.rstrip('/')}/batch={int(batch)}")


def dlq_sink(root: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: each micro-batch's letters once, however often it is tried."""
    return lambda letters, batch: write_dlq(letters, root, batch)


def archive_rows(df: DataFrame, value: str = "value") -> DataFrame:
    """Every raw message with table, operation, event time and day, ready for partitioned storage.

    ``status`` is ``event``, ``tombstone`` (no value) or ``malformed``; the last two stand under table ``unknown``.
    """
    status = F.when(F.col(value).isNull(), "tombstone").when(F.col("corrupt"), "malformed").otherwise("event")
    known = status == "event"
    return read_metadata(df, value).select(
        F.when(known, F.col("table")).otherwise(F.lit(UNKNOWN)).alias("table"),
        F.when(known, F.col("operation")).otherwise(F.lit(UNKNOWN)).alias("operation"),
        "event_ts", F.to_date("event_ts").alias("event_date"), status.alias("status"), value,
    )


def archive(
    df: DataFrame, root: str, checkpoint: str | None = None, value: str = "value"
) -> StreamingQuery | None:
    """Append changes to parquet under ``table=…/event_date=…``.

    A batch frame is written at once; a stream needs a checkpoint and returns its query.
    """
    rows = archive_rows(df, value)
    if not df.isStreaming:
        # Rows of a folder meet in few tasks, and adaptive execution splits folders that are large.
        rows.hint("rebalance", F.col("table"), F.col("event_date")).write.mode("append").partitionBy(
            "table", "event_date"
        ).parquet(root)
        return None
    return (
        rows.writeStream.format("parquet")
        .partitionBy("table", "event_date")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(root)
    )
