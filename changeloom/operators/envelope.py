"""Change events: three JSON layouts in, one canonical event out.

Layouts: ``{"payload": {row…, "__op", "__source_table", "__source_ts_ms", "__deleted"}}``, the
same payload bare, and ``{"payload": {"before", "after", "op", "source", "ts_ms"}}`` (wrapped or
bare).  One ``from_json`` with a fixed schema reads them all; nothing is inferred from data.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.decimals import parse_amount
from ..functions.times import parse_time
from ..schemas import DELETE, TABLES, UNKNOWN, Table

CORRUPT = "_corrupt_record"

_META = [
    T.StructField("__op", T.StringType()),
    T.StructField("__source_table", T.StringType()),
    T.StructField("__source_ts_ms", T.LongType()),
    T.StructField("__deleted", T.StringType()),
    T.StructField("op", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
    T.StructField("source", T.StructType([T.StructField("table", T.StringType())])),
]


def _event_schema(row: T.StructType | None) -> T.StructType:
    fields = list(_META)
    if row is not None:
        fields += [T.StructField("before", row), T.StructField("after", row), *row.fields]
    return T.StructType(
        [T.StructField("payload", T.StructType(fields)), *fields, T.StructField(CORRUPT, T.StringType())]
    )


def _either(*paths: str) -> str:
    """SQL for the first field found, in the payload or at the top level of a bare event."""
    return f"coalesce({', '.join(f'_event.payload.{p}, _event.{p}' for p in paths)})"


# Expressions over ``_event`` are SQL text: a select list of them is one call into the JVM.
_OPERATION = f"coalesce({_either('__op', 'op')}, '{UNKNOWN}')"
_TABLE = f"coalesce({_either('__source_table', 'source.table')}, '{UNKNOWN}')"
_SOURCE_MS = _either("__source_ts_ms", "ts_ms")
_CORRUPT = f"_event.{CORRUPT} IS NOT NULL"


def event_order(df: DataFrame) -> list[str]:
    """Order of a log's events: time, and the offset where the log has one, as changes of one transaction share their time."""
    return [c for c in ("event_ts", "offset") if c in df.columns]


def _decoded(text: Column, name: str, table: Table) -> Column:
    """A column of the table from its wire text."""
    kind = table.columns[name]
    if isinstance(kind, T.DecimalType):
        text = parse_amount(text, table.wire.get(name, "base64"), kind.scale, kind.precision)
    elif isinstance(kind, T.TimestampType):
        text = parse_time(text)
    return text.alias(name)


def _parsed_once(df: DataFrame, keep: list[str], value: str, row: T.StructType | None) -> DataFrame:
    """``_event`` parsed from the text.  The one-element explode keeps the optimizer from
    copying the parser into every filter and column that reads it."""
    event = F.from_json(F.col(value), _event_schema(row))
    return df.select(*keep, F.explode(F.array(event)).alias("_event"))


def _with_metadata(df: DataFrame, value: str, prefix: str) -> DataFrame:
    """Metadata of each message under ``prefix`` names, next to the other columns."""
    found = {
        "operation": _OPERATION,
        "table": _TABLE,
        "ts_ms": _SOURCE_MS,
        "event_ts": f"timestamp_millis({_SOURCE_MS})",
        "corrupt": f"`{value}` IS NOT NULL AND {_CORRUPT}",
    }
    names = {prefix + n for n in found}
    keep = [c for c in df.columns if c not in names]
    return _parsed_once(df, keep, value, None).selectExpr(
        *[f"`{c}`" for c in keep], *[f"{sql} AS `{prefix}{n}`" for n, sql in found.items()]
    )


def read_metadata(df: DataFrame, value: str = "value") -> DataFrame:
    """Operation, table and event time only, without decoding row images."""
    return _with_metadata(df, value, "")


def _images(
    df: DataFrame, table: Table, value: str, fallback: Column | None
) -> tuple[DataFrame, list[str]]:
    """Event fields, and both row images as wire text in ``_before_*`` and ``_after_*``.

    Other columns of the log stay, unless an event field has their name.

    A row marked deleted travels in ``before``, any other flattened row in ``after``.
    """
    fields = {value, "operation", "table", "ts_ms", "event_ts", *table.columns}
    keep = [c for c in df.columns if c not in fields]
    parsed = _parsed_once(df, keep, value, table.wire_schema).filter(
        f"_event IS NOT NULL AND NOT ({_CORRUPT})"
    )
    standard = f"{_either('op')} IS NOT NULL AND {_either('__op')} IS NULL"
    gone = f"({_OPERATION} = '{DELETE}' OR coalesce({_either('__deleted')}, 'false') = 'true')"
    rows = parsed.selectExpr(
        *[f"`{c}`" for c in keep],
        f"{_OPERATION} AS operation",
        f"{_TABLE} AS `table`",
        f"{_SOURCE_MS} AS ts_ms",
        f"timestamp_millis({_SOURCE_MS}) AS event_ts",
        f"CASE WHEN {standard} THEN {_either('before')} IS NOT NULL ELSE {gone} END AS _has_old",
        f"CASE WHEN {standard} THEN {_either('after')} IS NOT NULL ELSE NOT {gone} END AS _has_new",
        # Only one of image and flat row exists in an event: the first non-null one is the value.
        *[
            f"{_either(f'{image}.{n}', n)} AS _{image}_{n}"
            for image in ("before", "after") for n in table.columns
        ],
    )
    if fallback is not None:
        rows = rows.withColumn("event_ts", F.coalesce("event_ts", fallback.cast("timestamp")))
    return rows, [*keep, "operation", "table", "ts_ms", "event_ts"]


def parse_changes(
    df: DataFrame, table: Table | str, value: str = "value", fallback: Column | None = None
) -> DataFrame:
    """Canonical events: ``operation, table, ts_ms, event_ts, before, after`` plus other columns.

    Tombstones and malformed text give no event; ``split_valid`` tells them apart.
    """
    table = TABLES[table] if isinstance(table, str) else table
    rows, kept = _images(df, table, value, fallback)

    def image(name: str) -> Column:
        return F.struct(*[_decoded(F.col(f"_{name}_{c}"), c, table) for c in table.columns])

    return rows.select(
        *kept,
        F.when(F.col("_has_old"), image("before")).alias("before"),
        F.when(F.col("_has_new"), image("after")).alias("after"),
    )


def parse_rows(
    df: DataFrame, table: Table | str, value: str = "value", fallback: Column | None = None,
    old: Iterable[str] = (),
) -> DataFrame:
    """Events as flat rows: the new image, or the old one of a delete, under the table's columns.

    Equal to flattening ``parse_changes``, but each column stands alone, so unused ones are
    neither decoded nor carried.  ``old`` adds ``old_<column>`` from the old image.
    """
    table = TABLES[table] if isinstance(table, str) else table
    rows, kept = _images(df, table, value, fallback)
    picked = rows.selectExpr(
        *[f"`{c}`" for c in kept],
        *[
            f"CASE WHEN _has_new THEN _after_{c} WHEN _has_old THEN _before_{c} END AS {c}"
            for c in table.columns
        ],
        *[f"CASE WHEN _has_old THEN _before_{c} END AS old_{c}" for c in old],
    )
    return picked.select(
        *kept,
        *[_decoded(F.col(c), c, table) for c in table.columns],
        *[_decoded(F.col(f"old_{c}"), c, table).alias(f"old_{c}") for c in old],
    )


def with_ops(df: DataFrame, ops: Iterable[str], column: str = "operation") -> DataFrame:
    return df.filter(F.col(column).isin(*ops))


def require_key(df: DataFrame, column: str) -> DataFrame:
    """Drop rows without a key; 0 is a key."""
    return df.filter(F.col(column).isNotNull())


def split_valid(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good, bad): readable JSON objects, and the rest with an ``error`` text.

    Tombstones (null values) are in neither; count them with ``message_counts``.
    """
    marked = _with_metadata(df, value, "_m_").filter(F.col(value).isNotNull())
    bad = marked.filter("_m_corrupt").select(*df.columns, F.lit("JSON decode error").alias("error"))
    return marked.filter("not _m_corrupt").select(*df.columns), bad


def route(
    df: DataFrame, tables: Iterable[str] = TABLES, unknown: str = "skip", value: str = "value"
) -> dict[str, DataFrame]:
    """Canonical events per table from one mixed log.

    ``unknown='dlq'`` adds an entry ``unknown`` with the raw events of other tables.
    """
    names = list(tables)

    def may_be(name: str) -> Column:
        # A message of the table holds its name in quotes, if no character is written as an escape.
        return F.col(value).contains(f'"{name}"') | F.col(value).contains("\\u")

    # A cheap look at the text first: a message is parsed for its own table and seldom for another.
    routed = {t: parse_changes(df.filter(may_be(t)), t, value).filter(F.col("table") == t) for t in names}
    if unknown == "dlq":
        marked = _with_metadata(df, value, "_m_")
        other = ~F.col("_m_corrupt") & ~F.col("_m_table").isin(*names) & F.col(value).isNotNull()
        routed["unknown"] = marked.filter(other).select(
            *df.columns, F.lit("Processing failed").alias("error")
        )
    return routed
