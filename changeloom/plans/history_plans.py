"""Queries over the history of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import envelope, temporal
from ..schemas import PRODUCTS
from ..sources import changes, fixtures
from .catalog import query, ts_text

# ---- prices over time: every product's first price, two later ones for some, a delete, and a return

_STEPS = [
    # (operation, every, time, price in hundredths of the first one)
    ("c", 1, "1995-01-01", 100),
    ("u", 2, "1996-03-01", 110),
    ("u", 3, "1996-03-01", 125),  # after the one before in the same transaction
    ("d", 7, "1997-06-01", 125),
    ("c", 14, "1998-02-01", 90),
]

def _steps_sql() -> str:
    parts = [
        f"""SELECT id, name, CAST(CAST(price * 100 AS BIGINT) * {share} // 100 AS BIGINT) AS cents, '{op}' AS operation,
                   TIMESTAMP '{at}' AS since, {n} AS n FROM prod WHERE id % {every} = 0"""
        for n, (op, every, at, share) in enumerate(_STEPS)
    ]
    return f"""
    + change AS ({' UNION ALL '.join(parts)}),
    version AS (
        SELECT *, lead(since) OVER (PARTITION BY id ORDER BY since, n) AS valid_to FROM change
        QUALIFY valid_to IS NULL OR valid_to > since)
    """


def product_history(spark: SparkSession, sf: str) -> DataFrame:
    """Price changes as a parsed log; ``offset`` orders what shares its time."""
    products = fixtures.spread(fixtures.products(spark, sf))
    log = None
    for n, (op, every, at, share) in enumerate(_STEPS):
        cents = F.expr(f"cast(price * 100 AS BIGINT) * {share} div 100")
        rows = products.filter(F.col("id") % every == 0).withColumn("price", (cents / F.lit(100).cast("decimal(3,0)")).cast("decimal(12,2)"))
        part = changes.to_change_log(rows, PRODUCTS, op, F.lit(at).cast("timestamp"), "standard").withColumn("offset", F.lit(n).cast("bigint"))
        log = part if log is None else log.unionByName(part)
    return envelope.parse_rows(log, PRODUCTS)


@query(
    "validity_intervals",
    _steps_sql() + f"""
    SELECT id, name, cents AS price_cents, operation, {ts_text('since')} AS valid_from, {ts_text('valid_to')} AS valid_to
    FROM version WHERE operation <> 'd'
    """,
    ("prod",),
)
def _validity(spark, sf):
    return temporal.validity(product_history(spark, sf)).select(
        "id", "name", (F.col("price") * 100).cast("bigint").alias("price_cents"), "operation", "valid_from", "valid_to"
    )


@query(
    "table_as_of",
    _steps_sql() + """
    SELECT id, name, cents AS price_cents FROM version
    WHERE operation <> 'd' AND since <= TIMESTAMP '1997-09-01' AND (valid_to IS NULL OR valid_to > TIMESTAMP '1997-09-01')
    """,
    ("prod",),
)
def _table_as_of(spark, sf):
    """Rebuilt from the log up to a day; both ways must agree."""
    history = product_history(spark, sf)
    return temporal.table_as_of(history, "id", "1997-09-01").select("id", "name", (F.col("price") * 100).cast("bigint").alias("price_cents"))


@query(
    "item_prices_as_of",
    _steps_sql() + """
    SELECT i.order_id, i.line_number, i.product_id, i.quantity, i.price_cents AS charged_cents, v.name AS product_name, v.cents AS list_cents
    FROM item i LEFT JOIN version v ON v.id = i.product_id AND v.operation <> 'd' AND v.since <= i.event_ts
     AND (v.valid_to IS NULL OR v.valid_to > i.event_ts)
    """,
    ("prod", "item"),
)
def _prices_as_of(spark, sf):
    """Each sold item beside the list price of its day, not today's."""
    items = fixtures.spread(fixtures.order_items(spark, sf))
    priced = temporal.prices_at_sale(items, product_history(spark, sf))
    return priced.select(
        "order_id", "line_number", "product_id", F.col("quantity").cast("bigint").alias("quantity"),
        (F.col("price") * 100).cast("bigint").alias("charged_cents"), "product_name",
        (F.col("sale_price") * 100).cast("bigint").alias("list_cents"),
    )
