"""Applying changes: current rows, compaction, rebuilds, status counts, retention."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.times import as_timestamp
from ..schemas import DELETE, OPS_REPORT, UPDATE
from .envelope import event_order
from .ordered import per_key


def compact(df: DataFrame, key: str | Sequence[str], ordering: Sequence[str]) -> DataFrame:
    """Last row per key.  ``max_by`` combines map-side, so a hot key costs no large group."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*ordering)).alias("_last")
    return df.groupBy(*keys).agg(last).select(
        *[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in df.columns]
    )


def latest_state(
    df: DataFrame,
    key: str | Sequence[str],
    ordering: Sequence[str],
    operation: str = "operation",
) -> DataFrame:
    """Current table: last row per key, without keys whose last event is a delete."""
    return compact(df, key, ordering).filter(F.col(operation) != DELETE)


def rebuild(
    snapshot: DataFrame, changes: DataFrame, key: str, ordering: Sequence[str],
    operation: str = "operation",
) -> DataFrame:
    """Table from a snapshot and the changes after it; both carry the ordering columns."""
    log = snapshot.unionByName(changes, allowMissingColumns=True)
    return latest_state(log, key, ordering, operation)


def dedupe_changes(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One copy of each redelivered event; ``key`` is usually (table, key, op, time)."""
    return df.dropDuplicates(list(key))


def retain(df: DataFrame, days: int, as_of: datetime | str | Column, ts: str = "event_ts") -> DataFrame:
    """Drop log entries older than ``days``."""
    start = as_timestamp(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    return df.filter(F.col(ts) >= start)


def _status_steps(
    events: DataFrame, key: str, ordering: Sequence[str] | None, max_rows: int | None, inserts: bool, full_images: bool
) -> DataFrame:
    """Count changes ``status, delta`` of all events, in one pass over the log.

    An update takes one from the old status and adds one to the new; the old status is that of
    the old image if the log has one, else the key's last known status.
    """
    has_old = "old_status" in events.columns

    def body(d: DataFrame, scan) -> DataFrame:
        known = F.when(F.col(key).isNotNull(), F.col("status"))
        d = scan.running(d, lasts={"_known": known})
        old = F.coalesce(F.col("old_status"), F.col("_known")) if has_old else F.col("_known")
        return d.select("operation", old.alias("old"), F.col("status").alias("new"))

    if full_images:
        if not has_old:
            raise ValueError("full images bring a column old_status")
        moves = events.select("operation", F.col("old_status").alias("old"), F.col("status").alias("new"))
    else:
        moves = per_key(events, key, ordering or event_order(events), body, max_rows)
    moved = (F.col("operation") == UPDATE) & (F.col("old") != F.col("new"))

    def step(hit: Column, status: Column, delta: int) -> Column:
        return F.when(hit, F.struct(status.alias("status"), F.lit(delta).alias("delta")))

    steps = [step(moved, F.col("old"), -1), step(moved, F.col("new"), 1)]
    if inserts:
        inserted = F.col("operation").isin(*OPS_REPORT)
        steps.append(step(inserted, F.coalesce("new", F.lit("unknown")), 1))
    return moves.select(F.explode(F.array_compact(F.array(*steps))).alias("s")).select("s.*")


def status_deltas(
    events: DataFrame, key: str = "id", ordering: Sequence[str] | None = None,
    max_rows: int | None = None, full_images: bool = False,
) -> DataFrame:
    """Net change per status from updates: −1 for the old one, +1 for the new one.

    ``events`` has ``operation, status``, the key and ordering columns, and ``old_status`` where
    the log carries old images.  ``full_images`` says that every update carries its old image
    (``quality.full_image_check`` verifies it): rows are then only counted, and no key's history is put in order.
    """
    steps = _status_steps(events, key, ordering, max_rows, False, full_images)
    return steps.groupBy("status").agg(F.sum("delta").alias("delta"))


def order_status_distribution(
    events: DataFrame, key: str = "id", ordering: Sequence[str] | None = None,
    max_rows: int | None = None, full_images: bool = False, version: str | None = None,
) -> DataFrame:
    """Orders per status: +1 at insert, moved by updates.

    With ``full_images`` it runs on streams, too; ``version`` then names a column that only grows.
    """
    steps = _status_steps(events, key, ordering, max_rows, True, full_images)
    counts = [F.sum("delta").alias("order_count")]
    if version:
        counts.append(F.count(F.lit(1)).alias(version))
    return steps.groupBy("status").agg(*counts)
