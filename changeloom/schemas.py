"""The three source tables and how their columns travel in the change log."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)


@dataclass(frozen=True)
class Table:
    """A source table: column types, primary key, and per-column wire forms.

    ``wire`` says how a money column is written in the log: ``base64`` (big-endian two's
    complement), ``string`` or ``number``.  The form is a setting and never guessed, since
    ``"1234"`` is a number and valid base64 at once.
    """

    name: str
    key: str
    columns: dict[str, T.DataType]
    wire: dict[str, str] = field(default_factory=dict)

    def with_wire(self, **forms: str) -> "Table":
        return Table(self.name, self.key, self.columns, {**self.wire, **forms})

    @property
    def wire_schema(self) -> T.StructType:
        """Row image as found in JSON: money and times are text until decoded."""
        as_text = (T.DecimalType, T.TimestampType)
        return T.StructType([
            T.StructField(c, T.StringType() if isinstance(t, as_text) else t)
            for c, t in self.columns.items()
        ])


PRODUCTS = Table(
    "products",
    "id",
    {
        "id": T.LongType(),
        "name": T.StringType(),
        "description": T.StringType(),
        "price": MONEY,
        "stock_quantity": T.IntegerType(),
        "created_at": T.TimestampType(),
        "updated_at": T.TimestampType(),
    },
    {"price": "base64"},
)

ORDERS = Table(
    "orders",
    "id",
    {
        "id": T.LongType(),
        "customer_id": T.LongType(),
        "total_amount": MONEY,
        "status": T.StringType(),
        "created_at": T.TimestampType(),
        "updated_at": T.TimestampType(),
    },
    {"total_amount": "base64"},
)

ORDER_ITEMS = Table(
    "order_items",
    "id",
    {
        "id": T.LongType(),
        "order_id": T.LongType(),
        "product_id": T.LongType(),
        "quantity": T.IntegerType(),
        "price": MONEY,
        "created_at": T.TimestampType(),
    },
    {"price": "base64"},
)

TABLES = {t.name: t for t in (PRODUCTS, ORDERS, ORDER_ITEMS)}

# Operation codes of the change log.
CREATE, READ, UPDATE, DELETE, UNKNOWN = "c", "r", "u", "d", "unknown"

# The operations each program accepts.
OPS_SALES = (CREATE, UPDATE, READ)
OPS_RFM = (CREATE, UPDATE, READ)
OPS_ANOMALY = (CREATE, UPDATE, READ)
OPS_ITEM_SALE = (CREATE, READ)
OPS_REPORT = (CREATE, READ)
OPS_UPSERT = (CREATE, READ, UPDATE)
