from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from changeloom.functions import registry, rules, text, times
from changeloom.functions.decimals import decode_decimal, encode_decimal, parse_amount

DECIMALS = {
    "BQk=": "12.89", "BRM=": "12.99", "AfvP": "1299.99", "AA==": "0.00", "/w==": "-0.01",
    "+vc=": "-12.89", "AIA=": "1.28", "gA==": "-1.28", "/38=": "-1.29", "AlQL4/8=": "99999999.99",
    "C7c=": "29.99", "Iyc=": "89.99", "AJw/": "399.99", "Yac=": "249.99", "Lt4=": "119.98",
}


def test_decode_and_encode(spark):
    df = spark.createDataFrame(list(DECIMALS.items()), "wire string, value string")
    got = df.select("value", "wire", decode_decimal(F.col("wire")).alias("d"),
                    encode_decimal(F.col("value").cast("decimal(12,2)")).alias("e")).collect()
    assert all(r.d == Decimal(r.value) and r.e == r.wire for r in got)


def test_decode_of_bad_and_plain_values(spark):
    df = spark.createDataFrame(
        [(None,), ("!!bad",), ("29.99",), ("-5",), ("",), ("AAAAAAAAAAAAAAAAAA==",)], "t string"
    )
    got = [r.d for r in df.select(decode_decimal(F.col("t")).alias("d")).collect()]
    assert got == [Decimal(x) for x in ("0", "0", "29.99", "-5", "0", "0")]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.integers(-10**12 + 1, 10**12 - 1), min_size=300, max_size=400))
def test_codec_round_trip(spark, cents):
    edges = [s * (1 << (8 * n - 1)) + d for n in range(1, 5) for s in (1, -1) for d in (-1, 0, 1)]
    df = spark.createDataFrame([(c,) for c in cents + edges], "c bigint")
    amount = (F.col("c").cast("decimal(12,0)") / 100).cast("decimal(12,2)")
    back = (decode_decimal(encode_decimal(amount)) * 100).cast("bigint")
    assert df.filter(back != F.col("c")).count() == 0


def test_wire_form_is_a_setting(spark):
    df = spark.createDataFrame([("1234",)], "t string")
    as_number, as_bytes = df.select(
        parse_amount(F.col("t"), "number"), parse_amount(F.col("t"), "base64")
    ).first()
    assert as_number == Decimal("1234.00") and as_bytes != as_number
    with pytest.raises(ValueError):
        parse_amount(F.col("t"), "guess")


def test_times(spark):
    ms = 1_736_935_200_000
    df = spark.createDataFrame(
        [(str(ms),), (str(ms * 1000),), ("2025-01-15T10:00:00Z",), ("2025-01-15T10:00:00",), (None,), ("soon",)],
        "t string",
    )
    got = df.select(times.parse_time(F.col("t")).alias("t"), times.created_date(F.col("t"), "2024-02-03").alias("d")).collect()
    assert [r.t for r in got] == [datetime(2025, 1, 15, 10)] * 4 + [None, None]
    assert [r.d for r in got] == [date(2025, 1, 15)] * 4 + [date(2024, 2, 3)] * 2
    assert df.limit(1).select(times.iso(times.parse_time(F.col("t")))).first()[0] == "2025-01-15T10:00:00"


def test_text(spark):
    df = spark.createDataFrame([("27-inch 4K monitor", Decimal("19.99")), (None, Decimal("1234.5"))], "t string, p decimal(12,2)")
    got = df.select(text.tokenize(F.col("t")), text.cents(F.col("p")), text.price_display(F.col("p"))).collect()
    assert got[0][0] == ["27", "4k", "inch", "monitor"] and got[0][1] == 1999
    assert got[1][0] == [] and got[1][2] == "$1234.50"
    accents = spark.createDataFrame([("Étude_1, étude_1! 東京",)], "t string")
    assert accents.select(text.tokenize(F.col("t"))).first()[0] == ["étude_1", "東京"]


@pytest.mark.parametrize("recency, orders, spend, wanted", [
    (90, 5, 600, "VIP"), (91, 5, 600, "Churned"), (31, 3, 100, "At-Risk"), (30, 3, 100, "Regular"),
    (31, 5, 600, "VIP"), (0, 2, 900, "New"), (31, 2, 10, "New"), (0, 5, 499, "Regular"), (999, 0, 0, "Churned"),
])
def test_segments(spark, recency, orders, spend, wanted):
    registry.register(spark)
    df = spark.range(1).select(rules.segment(F.lit(recency), F.lit(orders), F.lit(spend)).alias("a"),
                               F.expr(f"rfm_segment({recency}L, {orders}L, {spend}D)").alias("b"))
    assert tuple(df.first()) == (wanted, wanted)


@pytest.mark.parametrize("stock, units, status, days, quantity, urgency", [
    (6, 14, "critical", 3.0, 54, "high"),
    (9, 7, "low", 9.0, 21, "medium"),
    (0, 14, "out_of_stock", 0.0, 60, "high"),
    (49, 1, "healthy", 343.0, None, None),
    (149, 1, "healthy", None, None, None),
    (120, 0, "healthy", None, None, None),
    (29, 7, "low", 29.0, None, None),
    (30, 7, "healthy", 30.0, None, None),
    (7, 7, "critical", 7.0, 23, "high"),
])
def test_stock_rules(spark, stock, units, status, days, quantity, urgency):
    s, u = F.lit(stock), F.lit(units)
    left, speed = rules.days_left(s, u), rules.velocity(u)
    advice = rules.restock_advice(s, speed, left)
    got = spark.range(1).select(rules.stock_status(s, left), rules.days_left_output(left),
                                advice["recommended_quantity"], advice["urgency"]).first()
    assert tuple(got) == (status, days, quantity, urgency)


def test_dead_stock_and_recency_edges(spark):
    df = spark.createDataFrame(
        [(datetime(2025, 1, 1),), (datetime(2024, 12, 31, 23, 59),), (datetime(2024, 12, 31),), (None,)], "t timestamp"
    )
    now = F.lit("2025-01-31").cast("timestamp")
    got = df.select(rules.is_dead_stock(F.col("t"), now), rules.recency_days(F.col("t"), now)).collect()
    assert [tuple(r) for r in got] == [(False, 30), (False, 30), (True, 31), (True, 999)]


def test_sql_functions(spark):
    registry.register(spark)
    for wire, value in DECIMALS.items():
        assert spark.sql(f"SELECT decode_money('{wire}')").first()[0] == Decimal(value)
    assert spark.sql("SELECT decode_money(NULL), decode_money('!!bad')").first()[:] == (Decimal("0.00"),) * 2
    assert spark.sql("SELECT tokenize('Ring of RINGS, ring')").first()[0] == ["of", "ring", "rings"]


def test_money_of_any_length(spark):
    from base64 import b64encode

    from changeloom.functions.decimals import decode_base64, decode_decimal, overflows
    from changeloom.functions.registry import register

    register(spark)
    cents = [1299, -1299, 0, 127, 128, -128, -129, 10**12 - 1, -(10**12) + 1]
    texts = [(b64encode(c.to_bytes(n, "big", signed=True)).decode(), c) for c in cents for n in (6, 8, 9, 12, 16, 20)]
    big = [b64encode(c.to_bytes(n, "big", signed=True)).decode() for c, n in ((10**12, 8), (-(10**14), 9), (2**100, 16), (2**140, 20))]
    df = spark.createDataFrame([*texts, *[(t, None) for t in big], ("%", 0), (None, 0), ("12.5", 1250)], "t string, c long")
    rows = df.select("c", decode_decimal(F.col("t")).alias("v"), overflows(F.col("t")).alias("o"), F.expr("decode_money(t)").alias("m")).collect()
    for r in rows:
        assert r.v == r.m
        if r.c is None:
            assert r.v is None and r.o
        else:
            assert r.v * 100 == r.c and not r.o
    wide = df.select(decode_base64(F.col("t"), 2, 38).alias("v")).filter("v > 1000000000000").count()
    assert wide >= 1
