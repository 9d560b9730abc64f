"""Keyed tables: upserts, deletes, replays and compaction; item writers for key-value stores."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.times import as_timestamp
from ..operators.state import compact

ITEMS_PER_WRITE = 25  # fixed value: items in one store request

#: Batches between two compactions of a streaming sink.
COMPACT_EVERY = 20

_DELETED = "_deleted"
_BATCH = "batch_id"


def stamp(df: DataFrame, at: datetime | str | Column) -> DataFrame:
    """Audit column ``updated_at``."""
    return df.withColumn("updated_at", as_timestamp(at))


class KeyedTable:
    """Last row per key, kept as parquet: one folder per batch, merged when read.

    A batch costs what it holds, not what the table holds.  Writing the same batch id again
    replaces that folder, so replays after a failure change nothing.  ``compact`` folds all
    batches up to one into a base folder; ``sink`` does so every ``COMPACT_EVERY`` batches.  A list of
    finished folders is kept beside them: what a failed writer left half done is not in it and never read.
    """

    def __init__(self, root: str, key: str | Sequence[str], ordering: Sequence[str]):
        self.root = root.rstrip("/")
        self.key = [key] if isinstance(key, str) else list(key)
        self.ordering = list(ordering)

    def write(self, batch: DataFrame, batch_id: int, deleted: Column | None = None) -> None:
        """Store one batch; rows where ``deleted`` holds remove their key."""
        gone = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
        last = compact(batch.withColumn(_DELETED, gone), self.key, self.ordering)
        last.write.mode("overwrite").parquet(f"{self.root}/batches/{_BATCH}={int(batch_id)}")
        self._finished(batch.sparkSession, "batch", int(batch_id))

    def sink(
        self, deleted: Column | None = None, prepare: Callable[[DataFrame], DataFrame] | None = None,
        every: int = COMPACT_EVERY,
    ) -> Callable[[DataFrame, int], None]:
        """Function for ``foreachBatch``; folds the batches after each ``every`` of them."""

        def on_batch(batch: DataFrame, batch_id: int) -> None:
            self.write(prepare(batch) if prepare else batch, batch_id, deleted)
            if batch_id % every == every - 1:
                self.compact(batch.sparkSession)

        return on_batch

    def read(self, spark: SparkSession) -> DataFrame:
        """Current rows."""
        return self._merged(spark, *self._parts(spark)).filter(~F.col(_DELETED)).drop(_DELETED, _BATCH)

    def compact(self, spark: SparkSession) -> int:
        """Fold the batches finished by now into a new base; returns the last batch id in it.

        Old folders stay: readers that started before keep working.  Deletes remain as markers, so late
        batches still meet them.
        """
        base, batches = self._parts(spark)
        upto = max(batches, default=base)
        if upto is None:
            raise ValueError("the table holds no finished batch")
        if batches:
            self._merged(spark, base, batches).write.mode("overwrite").parquet(f"{self.root}/base/upto={upto}")
            self._finished(spark, "base", upto)
        return upto

    def _finished(self, spark: SparkSession, kind: str, number: int) -> None:
        row = spark.createDataFrame([(kind, number)], "kind string, number long")
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/finished")

    def _parts(self, spark: SparkSession) -> tuple[int | None, list[int]]:
        """Newest finished base, and the finished batches after it."""
        done = [tuple(r) for r in spark.read.parquet(f"{self.root}/finished").distinct().collect()]
        base = max((n for kind, n in done if kind == "base"), default=None)
        return base, sorted(n for kind, n in done if kind == "batch" and (base is None or n > base))

    def _merged(self, spark: SparkSession, base: int | None, batches: list[int]) -> DataFrame:
        parts = []
        if base is not None:
            parts.append(spark.read.parquet(f"{self.root}/base/upto={base}"))
        if batches:
            folders = [f"{self.root}/batches/{_BATCH}={n}" for n in batches]
            parts.append(spark.read.option("basePath", f"{self.root}/batches").parquet(*folders))
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return compact(rows, self.key, [*self.ordering, _BATCH])


def _item(c: Column, kind: T.DataType) -> Column:
    """Store form of a value: floats become decimals, nulls vanish from lists."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return c.cast("decimal(38,10)")
    if isinstance(kind, T.StructType):
        fields = [_item(c[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(F.filter(c, lambda v: v.isNotNull()), lambda v: _item(v, kind.elementType))
    if isinstance(kind, T.MapType):
        present = F.map_filter(c, lambda _, v: v.isNotNull())
        return F.transform_values(present, lambda _, v: _item(v, kind.valueType))
    return c


def normalised(df: DataFrame) -> DataFrame:
    """All columns in store form."""
    return df.select(*[_item(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def to_item_json(df: DataFrame, column: str = "item") -> DataFrame:
    """Each row as one JSON item without nulls."""
    rows = normalised(df)
    return rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "true"}).alias(column))


def write_items(
    df: DataFrame,
    open_store: Callable[[], Callable[[list[dict[str, Any]]], None]],
    batch_size: int = ITEMS_PER_WRITE,
) -> None:
    """Write rows to an external key-value store, in requests of at most 25 items.

    ``open_store`` runs once per partition and returns a function that stores a list of items.
    An error fails the task, which Spark retries; puts by key make the retry harmless.
    """
    size = min(batch_size, ITEMS_PER_WRITE)

    def send(rows: Iterable[Any]) -> None:
        import json

        put, buffer = open_store(), []
        for row in rows:
            buffer.append(json.loads(row.item))
            if len(buffer) >= size:
                put(buffer)
                buffer = []
        if buffer:
            put(buffer)

    to_item_json(df).foreachPartition(send)
