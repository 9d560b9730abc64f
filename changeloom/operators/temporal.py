"""History of a table: when each version of a row was valid, and what a row looked like at the time of another event.

Both walk a key's versions in event order by ``per_key``: one exchange and one sort for ordinary keys, range-cut chunks for keys that
one task can't hold.  No version is compared with every event of its key, as a join on time ranges would do.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.times import as_timestamp, micros
from ..schemas import DELETE
from .envelope import event_order
from .ordered import per_key
from .state import latest_state


def validity(
    changes: DataFrame, key: str = "id", ordering: Sequence[str] | None = None, ts: str = "event_ts",
    operation: str = "operation", max_rows: int | None = None,
) -> DataFrame:
    """Versions of each row with ``valid_from`` and ``valid_to``; the newest has no end.

    A delete ends the version before it and gives none itself.  Of several events at one time only the last in the
    order is a version.  Events without a key or a time are left out.
    """
    order = list(ordering or event_order(changes))
    if order[0] != ts:
        raise ValueError("the event order starts with the event time")
    known = changes.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    # The next event is the last one before, once the order is turned around.
    turned = {f"_back_{i}": -(micros(F.col(c)) if c == ts else F.col(c).cast("bigint")) for i, c in enumerate(order)}

    def body(rows: DataFrame, scan) -> DataFrame:
        return scan.running(rows, lasts={"valid_to": F.col(ts)})

    found = per_key(known.withColumns(turned), key, list(turned), body, max_rows)
    current = F.col("valid_to").isNull() | (F.col("valid_to") > F.col(ts))
    return (
        found.filter(current & (F.col(operation) != DELETE)).withColumn("valid_from", F.col(ts)).drop(*turned)
        .select(*changes.columns, "valid_from", "valid_to")
    )


def as_of(versions: DataFrame, at: datetime | str | Column) -> DataFrame:
    """The rows of ``validity`` that held at a time."""
    moment = as_timestamp(at)
    return versions.filter(
        (F.col("valid_from") <= moment) & (F.col("valid_to").isNull() | (F.col("valid_to") > moment))
    )


def table_as_of(
    changes: DataFrame, key: str, at: datetime | str | Column, ordering: Sequence[str] | None = None, ts: str = "event_ts",
) -> DataFrame:
    """The table as it stood at a time, from the log alone: later changes are dropped at the scan, the rest folded map-side."""
    return latest_state(changes.filter(F.col(ts) <= as_timestamp(at)), key, ordering or event_order(changes))


def join_as_of(
    facts: DataFrame, changes: DataFrame, fact_key: str, columns: Sequence[str], key: str = "id", fact_ts: str = "event_ts",
    ts: str = "event_ts", ordering: Sequence[str] | None = None, operation: str = "operation", how: str = "left",
    prefix: str = "", max_rows: int | None = None,
) -> DataFrame:
    """``facts`` with ``columns`` of the version of their key that held at their time.

    A change at the very time of a fact counts.  Facts before the first version, after a delete, or without a key or a time get
    nulls, or go with ``how='inner'``.  Facts and versions are sorted together and each fact takes the last
    version before it, so a key with a third of all facts is split like any other.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unknown kind of join: {how}")
    order = list(ordering or event_order(changes))
    if order[0] != ts:
        raise ValueError("the event order starts with the event time")
    ties = order[1:]
    fact = F.struct("*").alias("_fact")
    version = F.struct(*[F.col(c) for c in columns], (F.col(operation) == DELETE).alias("_gone")).alias("_version")
    rows = facts.select(
        F.col(fact_key).alias("_key"), micros(F.col(fact_ts)).alias("_us"), F.lit(1).alias("_kind"), fact,
        F.xxhash64("*").alias("_tie_0"),  # tells facts of one time apart, where a hot key is cut
    )
    log = changes.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(key).alias("_key"), micros(F.col(ts)).alias("_us"), F.lit(0).alias("_kind"),
        *[F.col(c).cast("bigint").alias(f"_tie_{i}") for i, c in enumerate(ties)], version,
    )
    placed = rows.filter("_key IS NOT NULL AND _us IS NOT NULL")
    both = placed.unionByName(log, allowMissingColumns=True)
    tied = ["_tie_0", *[f"_tie_{i}" for i in range(1, len(ties))]]

    def body(d: DataFrame, scan) -> DataFrame:
        d = scan.running(d, lasts={"_held": F.col("_version")})
        return d.filter("_kind = 1").select("_fact", "_held")

    found = per_key(both, "_key", ["_us", "_kind", *tied], body, max_rows)
    held = F.when(~F.col("_held._gone"), F.col("_held"))
    out = found.select("_fact", held.alias("_held"))
    if how == "inner":
        out = out.filter("_held IS NOT NULL")
    else:
        loose = rows.filter("_key IS NULL OR _us IS NULL").select("_fact", F.lit(None).cast(out.schema["_held"].dataType).alias("_held"))
        out = out.unionByName(loose)
    return out.select("_fact.*", *[F.col(f"_held.{c}").alias(f"{prefix}{c}") for c in columns])


def prices_at_sale(items: DataFrame, products: DataFrame, **options) -> DataFrame:
    """Items with the name and price their product had when they were sold, as ``product_name`` and ``sale_price``.

    ``products`` are changes (rows of ``parse_rows``), not the current table.
    """
    joined = join_as_of(items, products, "product_id", ["name", "price"], prefix="_then_", **options)
    return joined.withColumnsRenamed({"_then_name": "product_name", "_then_price": "sale_price"})
