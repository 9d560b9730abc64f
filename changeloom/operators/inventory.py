"""Stock, velocity, stock-out forecast and restock advice per product.

Products (``id, name, price, stock_quantity, event_ts``) and items (``product_id, quantity,
event_ts`` and tie-break columns) form one log per product.  A product event sets the stock, an
item lowers it; at equal times the product event comes first.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import rules
from ..functions.times import as_timestamp, duration_micros, micros
from .envelope import event_order, require_key
from .ordered import per_key

TIES = ("order_id", "line_number", "quantity")
_WEEK = duration_micros(f"{rules.VELOCITY_DAYS} days")


def _last_products(products: DataFrame) -> DataFrame:
    position = F.struct(*event_order(products))
    last = F.max_by(F.struct("stock_quantity", "name", "price", "event_ts"), position)
    return require_key(products, "id").groupBy(F.col("id").alias("product_id")).agg(last.alias("p")).select(
        "product_id",
        F.col("p.stock_quantity").alias("_stock"),
        F.col("p.name").alias("product_name"),
        F.col("p.price").alias("price"),
        F.col("p.event_ts").alias("_set_at"),
    )


def _sold_since(products: DataFrame, items: DataFrame) -> DataFrame:
    """Per product: last set stock, and units sold at or after that moment.

    Items are folded per product and event time first, map-side, so a hot product is small before the join.
    """
    sold = require_key(items, "product_id").groupBy("product_id", "event_ts").agg(
        F.sum(F.col("quantity").cast("bigint")).alias("quantity")
    )
    # The left join keeps items of unknown products, which start at stock 0.
    known = _last_products(products)
    after = F.col("_set_at").isNull() | (F.col("event_ts") >= F.col("_set_at"))
    by_item = (
        sold.join(known.select("product_id", "_set_at"), "product_id", "left")
        .filter(after)
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("_sold"))
    )
    return known.join(by_item, "product_id", "full").withColumns({
        "_stock": F.coalesce("_stock", F.lit(0)).cast("bigint"),
        "_sold": F.coalesce("_sold", F.lit(0)),
    })


def current_inventory(products: DataFrame, items: DataFrame) -> DataFrame:
    """Stock per product; may fall below 0, and unknown products start at 0."""
    return _sold_since(products, items).select(
        "product_id",
        "product_name",
        "price",
        (F.col("_stock") - F.col("_sold")).alias("stock_quantity"),
    )


def optimizer_stock(products: DataFrame, items: DataFrame) -> DataFrame:
    """Stock per product, never below 0.

    Sales are not negative (``valid_items``; others are left out), so clamping after every sale equals clamping
    their sum once.
    """
    return _sold_since(products, valid_items(items)[0]).select(
        "product_id",
        F.greatest(F.lit(0), F.col("_stock") - F.col("_sold")).alias("current_stock"),
    )


def low_stock(inventory: DataFrame, limit: int = rules.LOW_STOCK) -> DataFrame:
    return inventory.filter(F.col("stock_quantity") < limit)


def valid_items(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad): items the clamped stock algebra holds for, and items with a negative quantity.

    The clamped operators keep the good ones; send the bad ones to the dead letters.
    """
    ok = F.coalesce(F.col("quantity"), F.lit(0)) >= 0
    bad = items.filter(~ok).withColumn("error", F.lit("Processing failed"))
    return items.filter(ok), bad


def apply_deltas(
    snapshot: DataFrame, deltas: DataFrame, key: str, column: str, delta: str = "delta"
) -> DataFrame:
    """Add the sum of all deltas to a counter; a missing key starts at 0."""
    change = deltas.groupBy(key).agg(F.sum(F.col(delta).cast("bigint")).alias("_change"))
    value = F.coalesce(F.col(column).cast("bigint"), F.lit(0)) + F.coalesce("_change", F.lit(0))
    return snapshot.join(change, key, "full").withColumn(column, value).drop("_change")


def _log(products: DataFrame, items: DataFrame, ties: Sequence[str]) -> DataFrame:
    """One tagged log; ``_kind`` puts product events before items of the same time, ``_offset`` those of one transaction in order."""

    def offset(df: DataFrame) -> Column:
        return (F.col("offset") if "offset" in df.columns else F.lit(None)).cast("bigint").alias("_offset")

    p = require_key(products, "id").select(
        F.col("id").alias("product_id"),
        F.lit(0).alias("_kind"),
        F.coalesce("name", F.lit("Unknown")).alias("_name"),
        F.col("price").alias("_price"),
        F.coalesce("stock_quantity", F.lit(0)).cast("bigint").alias("_set"),
        micros(F.col("event_ts")).alias("event_us"),
        offset(products),
    )
    i = require_key(valid_items(items)[0], "product_id").select(
        "product_id",
        F.lit(1).alias("_kind"),
        F.coalesce("quantity", F.lit(0)).cast("bigint").alias("_qty"),
        micros(F.col("event_ts")).alias("event_us"),
        offset(items),
        *[F.col(t) for t in ties],
    )
    return p.unionByName(i, allowMissingColumns=True)


def _stock_log(d: DataFrame, scan) -> DataFrame:
    """Stock before and after each event, last product row, last restock and sale times.

    With S the running total of units sold, a product event of stock s at total S0 makes the
    stock max(0, s + S0 − S) until the next one.
    """
    is_set = F.col("_kind") == 0
    d = scan.running(d, {"_sold": F.coalesce("_qty", F.lit(0))})
    ceiling = F.when(is_set, F.col("_set") + F.col("_sold"))
    row = F.when(is_set, F.struct("_name", "_price"))
    d = d.withColumn("_ceiling", ceiling).withColumn("_row", row)
    d = scan.running(
        d, lasts={
            "_ceiling_before": F.col("_ceiling"),
            "_row_before": F.col("_row"),
        },
    )
    sold_before = F.col("_sold") - F.coalesce("_qty", F.lit(0))
    before = F.greatest(F.lit(0), F.coalesce("_ceiling_before", F.lit(0)) - sold_before)
    after = F.greatest(
        F.lit(0), F.coalesce("_ceiling", "_ceiling_before", F.lit(0)) - F.col("_sold")
    )
    # An unknown product has no ceiling: its stock is 0 and stays there.
    d = d.withColumn("_known", F.coalesce("_ceiling", "_ceiling_before").isNotNull())
    d = d.withColumns({
        "stock_before": F.when(F.col("_ceiling_before").isNull(), F.lit(0)).otherwise(before),
        "stock_after": F.when(F.col("_known"), after).otherwise(F.lit(0)),
        "_shown": F.coalesce("_row", "_row_before"),
    })
    return d.withColumn(
        "_restock_us", F.when(is_set & (F.col("_set") > F.col("stock_before")), F.col("event_us"))
    )


def _order(ties: Sequence[str]) -> list[str]:
    return ["event_us", "_kind", "_offset", *ties]


def restock_events(
    products: DataFrame, items: DataFrame, ties: Sequence[str] = TIES, max_rows: int | None = None
) -> DataFrame:
    """Product events that raise the stock above its running value."""
    log = _log(products, items, ties)
    found = per_key(log, "product_id", _order(ties), _stock_log, max_rows)
    return found.filter(F.col("_restock_us").isNotNull()).select(
        "product_id",
        F.timestamp_micros("event_us").alias("restocked_at"),
        "stock_before",
        F.col("_set").alias("stock_after"),
    )


def _insight(df: DataFrame, now: Column, *extra: str) -> DataFrame:
    """The twelve output fields from ``_stock, _units, _shown, _sale_us, _restock_us``."""
    stock = F.col("current_stock")
    sale, restock = F.timestamp_micros("_sale_us"), F.timestamp_micros("_restock_at")
    df = df.withColumn("_speed", rules.velocity(F.col("_units")))
    df = df.withColumn("_days", rules.days_left(stock, F.col("_units")))
    speed, days = F.col("_speed"), F.col("_days")
    return df.select(
        "product_id",
        *extra,
        F.col("_shown._name").alias("product_name"),
        stock,
        F.coalesce(F.col("_shown._price"), F.lit(0)).cast("decimal(12,2)").alias("price"),
        rules.stock_status(stock, days).alias("stock_status"),
        F.round(speed, 2).alias("velocity_units_per_day"),
        rules.days_left_output(days).alias("days_until_stockout"),
        rules.is_dead_stock(sale, now).alias("is_dead_stock"),
        rules.restock_advice(stock, speed, days).alias("restock_recommendation"),
        sale.alias("last_sale_date"),
        restock.alias("last_restock_date"),
        F.coalesce("_units", F.lit(0)).alias("total_sales_7d"),
    )


def inventory_insights(
    products: DataFrame, items: DataFrame, as_of: datetime | str, ties: Sequence[str] = TIES,
    max_rows: int | None = None,
) -> DataFrame:
    """One row per product as of a point in time; events after it are ignored."""
    now = as_timestamp(as_of)
    past = F.col("event_ts") <= now  # before the union, where it reaches the scans
    log = _log(products.filter(past), items.filter(past), ties)
    found = per_key(log, "product_id", _order(ties), _stock_log, max_rows)
    is_sale = F.col("_kind") == 1
    recent = is_sale & (F.col("event_us") > micros(now) - _WEEK)
    position = F.struct(*_order(ties))
    last = found.groupBy("product_id").agg(
        F.max_by(F.struct("stock_after", "_shown"), position).alias("_last"),
        F.sum(F.when(recent, F.col("_qty"))).alias("_units"),
        F.max(F.when(is_sale, F.col("event_us"))).alias("_sale_us"),
        F.max("_restock_us").alias("_restock_at"),
    )
    flat = last.withColumns({
        "current_stock": F.col("_last.stock_after"), "_shown": F.col("_last._shown"),
    })
    return _insight(flat, now)


def inventory_history(
    products: DataFrame, items: DataFrame, ties: Sequence[str] = TIES, max_rows: int | None = None
) -> DataFrame:
    """One insight row per event, seen at the event's time."""
    log = _log(products, items, ties)

    def body(d: DataFrame, scan) -> DataFrame:
        d = scan.rolling(d, "event_us", {"_units": (F.coalesce("_qty", F.lit(0)), _WEEK)}, signed=False)
        d = _stock_log(d, scan)
        d = scan.running(
            d,
            lasts={
                "_sale_before": F.when(F.col("_kind") == 1, F.col("event_us")),
                "_restock_before": F.col("_restock_us"),
            },
        )
        return d

    found = per_key(log, "product_id", _order(ties), body, max_rows)
    is_sale = F.col("_kind") == 1
    flat = found.withColumns({
        "current_stock": F.col("stock_after"),
        "_sale_us": F.when(is_sale, F.col("event_us")).otherwise(F.col("_sale_before")),
        "_restock_at": F.coalesce("_restock_us", "_restock_before"),
        "event_kind": F.when(is_sale, "sale").otherwise("product"),
        "event_ts": F.timestamp_micros("event_us"),
    })
    return _insight(flat, F.col("event_ts"), "event_kind", "event_ts", *ties)


def trending_products(items: DataFrame, as_of: datetime | str) -> DataFrame:
    """Velocity of the last 7 days against the 7 days before; the caller orders the rows."""
    now, at = as_timestamp(as_of), F.col("event_ts")
    week = F.expr(f"INTERVAL {rules.VELOCITY_DAYS} DAYS")
    recent = items.filter((at <= now) & (at > now - week - week))
    units = recent.groupBy("product_id").agg(
        F.sum(F.when(at > now - week, F.col("quantity")).otherwise(0)).alias("_new"),
        F.sum(F.when(at > now - week, F.lit(0)).otherwise(F.col("quantity"))).alias("_old"),
    )
    return units.select(
        "product_id",
        rules.velocity(F.col("_new")).alias("velocity"),
        rules.velocity(F.col("_old")).alias("previous_velocity"),
        (F.col("_new") - F.col("_old")).alias("unit_change"),
        F.try_divide(F.col("_new").cast("double"), F.col("_old").cast("double")).alias("ratio"),
    )
