"""Validity intervals and as-of joins against a loop, with plain windows and with hot keys cut into chunks."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from changeloom.operators import temporal

START = datetime(2024, 1, 1)
LOG = "id long, operation string, price long, event_ts timestamp, offset long"


def history(rng, n):
    """One product holds most changes; many share their time."""
    rows = []
    for k in range(n):
        key = 1 if rng.random() < 0.6 else rng.randrange(2, 8)
        rows.append((key, rng.choice("ccuud"), k, START + timedelta(minutes=rng.randrange(n // 3)), k))
    return rows + [(None, "c", 5, START, 900), (3, "c", 6, None, 901)]


def held(rows, key, at):
    """Price at a time, or None: the last change up to it."""
    known = [(r[3], r[4], r) for r in rows if r[0] == key and key is not None and r[3] is not None and at is not None and r[3] <= at]
    last = max(known)[2] if known else None
    return None if last is None or last[1] == "d" else last[2]


@pytest.mark.parametrize("max_rows", [None, 20])
def test_validity(spark, max_rows):
    rows = history(random.Random(1), 300)
    versions = temporal.validity(spark.createDataFrame(rows, LOG), max_rows=max_rows)
    got = {(r["id"], r["valid_from"], r["valid_to"], r["price"]) for r in versions.collect()}
    want = set()
    for key in range(1, 8):
        times = sorted({r[3] for r in rows if r[0] == key and r[3] is not None})
        for at, after in zip(times, [*times[1:], None]):
            if (price := held(rows, key, at)) is not None:
                want.add((key, at, after, price))
    assert got == want
    for minute in (-1, 0, 17, 55, 500):
        at = START + timedelta(minutes=minute)
        expected = {(k, held(rows, k, at)) for k in range(1, 8) if held(rows, k, at) is not None}
        assert {(r["id"], r["price"]) for r in temporal.as_of(versions, at).collect()} == expected
        table = temporal.table_as_of(spark.createDataFrame(rows, LOG).filter("id IS NOT NULL"), "id", at)
        assert {(r["id"], r["price"]) for r in table.collect()} == expected


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("max_rows", [None, 25])
def test_join_as_of(spark, max_rows, how):
    rng = random.Random(2)
    rows = history(rng, 200)
    sales = [(k, 1 if rng.random() < 0.5 else rng.randrange(0, 9), START + timedelta(minutes=rng.randrange(-3, 80))) for k in range(300)]
    sales += [(300, None, START), (301, 1, None), (302, 1, START), (302, 1, START)]
    facts = spark.createDataFrame(sales, "sale long, id long, event_ts timestamp")
    found = temporal.join_as_of(
        facts.withColumn("price", F.lit(0)), spark.createDataFrame(rows, LOG), "id", ["price"], prefix="then_", how=how, max_rows=max_rows,
    )
    assert found.columns == ["sale", "id", "event_ts", "price", "then_price"]
    want = [(s[0], held(rows, s[1], s[2])) for s in sales]
    assert sorted(((r["sale"], r["then_price"]) for r in found.collect()), key=repr) == sorted(
        (w for w in want if how == "left" or w[1] is not None), key=repr
    )


def test_log_without_offset_and_empty_sides(spark):
    log = spark.createDataFrame([(1, "c", 7, START, 0)], LOG).drop("offset")
    facts = spark.createDataFrame([(1, 1, START)], "sale long, product_id long, event_ts timestamp")
    assert temporal.join_as_of(facts, log, "product_id", ["price"]).first()["price"] == 7
    assert temporal.join_as_of(facts, log.limit(0), "product_id", ["price"]).first()["price"] is None
    assert temporal.join_as_of(facts.limit(0), log, "product_id", ["price"]).collect() == []
    with pytest.raises(ValueError):
        temporal.join_as_of(facts, log, "product_id", ["price"], how="outer")
