"""Registry of runnable queries: a Spark plan each, with the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    plan: Plan
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, tables: tuple[str, ...] = ()) -> Callable[[Plan], Plan]:
    """Register a plan; ``tables`` names the shared table expressions its SQL builds on."""

    def add(plan: Plan) -> Plan:
        text = None
        if sql is not None:
            body = dedent(sql).strip()
            text = f"WITH {', '.join(BASE[t] for t in tables)}{', ' if body.startswith('+') else ' '}" if tables else ""
            text += body.lstrip("+ ")
        QUERIES[name] = Query(name, lambda spark, sf: plain(plan(spark, sf)), text)
        return plan

    return add


def plain(df: DataFrame) -> DataFrame:
    """Output types that every engine shares: BIGINT, DOUBLE, BOOLEAN and text."""

    def one(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.FloatType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(F.transform(c, lambda v: v.cast("string")), " ")
        return c.alias(f.name)

    return df.select(*[one(f) for f in df.schema.fields])


def ts_text(expr: str) -> str:
    """SQL for a timestamp in the output form of ``plain``."""
    return f"strftime({expr}, '%Y-%m-%dT%H:%M:%S.%f')"


#: Table expressions of the oracle SQL, equal to ``sources.fixtures``.
BASE = {
    "prod": """prod AS (
        SELECT p_partkey AS id, p_name AS name, p_type || ' ' || p_brand AS description,
               CAST(p_retailprice AS DECIMAL(12,2)) AS price,
               50 + (p_partkey * 37) % 200 AS stock_quantity,
               TIMESTAMP '1995-01-01' AS event_ts
        FROM part)""",
    "ord": """ord AS (
        SELECT o_orderkey AS id, o_custkey AS customer_id,
               CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending'
                    WHEN 'P' THEN 'processing' ELSE 'unknown' END AS status,
               o_orderdate AS event_ts
        FROM orders)""",
    "item": """item AS (
        SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line_number,
               l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
               (2 * CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(l_quantity AS BIGINT))
                     // (2 * CAST(l_quantity AS BIGINT)) AS price_cents,
               l_shipdate AS event_ts
        FROM lineitem)""",
    "ev": """ev AS (
        SELECT event_id AS id, user_id AS customer_id, CAST(value AS DECIMAL(12,2)) AS total_amount,
               CAST(round(value * 100) AS BIGINT) AS cents,
               event_type AS status,
               CASE event_type WHEN 'signup' THEN 'r' WHEN 'purchase' THEN 'c' WHEN 'view' THEN 'c'
                    WHEN 'click' THEN 'u' WHEN 'error' THEN 'd' ELSE 'unknown' END AS operation,
               ts AS event_ts, epoch_us(ts) AS event_us
        FROM events)""",
}
