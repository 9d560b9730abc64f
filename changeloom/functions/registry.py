"""The same expressions for SQL users, as temporary SQL functions that Catalyst inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .text import WORD

# Bodies are SQL expressions over the parameters; none of them leaves the JVM.
_SQL_FUNCTIONS = {
    "money_hex(t STRING) RETURNS STRING": """
        regexp_replace(hex(try_to_binary(t, 'base64')), '^((?:00)+(?=[0-7])|(?:FF)+(?=[89A-F]))', '')""",
    "money_size(t STRING) RETURNS INT": "length(try_to_binary(t, 'base64'))",
    # Up to eight bytes are read as they are and the sign is spread by shifts; longer ones by halves.
    "money_short(t STRING) RETURNS BIGINT": """
        shiftright(shiftleft(CAST(conv(hex(try_to_binary(t, 'base64')), 16, -10) AS BIGINT), 64 - 8 * money_size(t)), 64 - 8 * money_size(t))""",
    "money_long(t STRING) RETURNS DECIMAL(38,0)": """
        CASE WHEN length(money_hex(t)) <= 32 THEN try_add(
          try_multiply(CAST(conv(substr(lpad(money_hex(t), 32, CASE WHEN money_hex(t) >= '8' THEN 'F' ELSE '0' END), 1, 16), 16, -10)
                            AS DECIMAL(20,0)), 18446744073709551616),
          CAST(conv(substr(lpad(money_hex(t), 32, CASE WHEN money_hex(t) >= '8' THEN 'F' ELSE '0' END), 17, 16), 16, 10)
               AS DECIMAL(20,0))) END""",
    "money_units(t STRING) RETURNS DECIMAL(38,0)": """
        CASE WHEN money_size(t) BETWEEN 1 AND 8 THEN CAST(money_short(t) AS DECIMAL(38,0))
             WHEN money_size(t) > 8 THEN money_long(t) END""",
    "decode_cents(t STRING) RETURNS BIGINT": """
        CASE WHEN money_size(t) BETWEEN 1 AND 8 THEN money_short(t)
             WHEN money_size(t) > 8 THEN try_cast(money_long(t) AS BIGINT) ELSE 0 END""",
    "decode_money(t STRING) RETURNS DECIMAL(12,2)": """
        CASE WHEN money_size(t) BETWEEN 1 AND 8
             THEN coalesce(try_cast(CAST(money_short(t) AS DECIMAL(19,0)) * 0.01 AS DECIMAL(12,2)), try_cast(t AS DECIMAL(12,2)))
             WHEN money_size(t) > 8
             THEN coalesce(try_cast(try_multiply(money_long(t), 0.01) AS DECIMAL(12,2)), try_cast(t AS DECIMAL(12,2)))
             WHEN try_cast(t AS DECIMAL(12,2)) IS NOT NULL THEN try_cast(t AS DECIMAL(12,2))
             WHEN try_cast(t AS DOUBLE) IS NOT NULL THEN NULL
             ELSE CAST(0 AS DECIMAL(12,2)) END""",
    "tokenize(t STRING) RETURNS ARRAY<STRING>": f"""
        sort_array(array_distinct(regexp_extract_all(lower(coalesce(t, '')), r'{WORD}', 0)))""",
    "rfm_segment(recency BIGINT, frequency BIGINT, monetary DOUBLE) RETURNS STRING": """
        CASE WHEN recency > 90 THEN 'Churned'
             WHEN frequency >= 5 AND monetary >= 500 THEN 'VIP'
             WHEN recency > 30 AND frequency >= 3 THEN 'At-Risk'
             WHEN frequency <= 2 THEN 'New'
             ELSE 'Regular' END""",
}


def register(spark: SparkSession) -> None:
    """Make ``money_hex``, ``money_size``, ``money_short``, ``money_long``, ``money_units``, ``decode_cents``, ``decode_money``, ``tokenize`` and ``rfm_segment`` callable in SQL."""
    for signature, body in _SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
