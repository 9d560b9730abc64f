import json
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from changeloom import schemas
from changeloom.operators import envelope, quality, state
from changeloom.sources import changes
from seeds import DAY, orders, products, rows

MS = 1_736_935_200_000


def log(spark, *events):
    values = [(e if isinstance(e, str) or e is None else json.dumps(e),) for e in events]
    return spark.createDataFrame(values, "value string")


def row(i=1, op="c", **more):
    return {"id": i, "customer_id": 7, "total_amount": "BQk=", "status": "new", "__op": op,
            "__source_ts_ms": MS, "__source_table": "orders", "__deleted": "false", **more}


def test_layouts_agree(spark):
    image = {"id": 1, "customer_id": 7, "total_amount": "BQk=", "status": "new"}
    standard = {"before": None, "after": image, "op": "c", "ts_ms": MS, "source": {"table": "orders"}}
    df = log(spark, {"schema": {"type": "struct"}, "payload": row()}, row(), {"payload": standard}, standard)
    got = envelope.parse_changes(df, "orders").collect()
    assert len({(r.operation, r.table, r.ts_ms, r.after) for r in got}) == 1
    r = got[0]
    assert (r.operation, r.table, r.before, r.event_ts) == ("c", "orders", None, datetime(2025, 1, 15, 10))
    assert (r.after.id, r.after.total_amount, r.after.created_at) == (1, Decimal("12.89"), None)


def test_deletes_travel_in_before(spark):
    flagged = row(2, "u", __deleted="true")
    image = {"id": 3, "status": "old"}
    standard = {"payload": {"before": image, "after": None, "op": "d", "source": {"table": "orders"}}}
    got = envelope.parse_changes(log(spark, row(1, "d"), flagged, standard), "orders").collect()
    assert [(r.before.id, r.after) for r in got] == [(1, None), (2, None), (3, None)]
    flat = envelope.parse_rows(log(spark, row(1, "d"), flagged, standard), "orders", old=["status"])
    assert [(r.id, r.old_status) for r in flat.collect()] == [(1, "new"), (2, "new"), (3, "old")]


def test_update_carries_both_images(spark):
    event = {"payload": {"before": {"id": 1, "status": "a"}, "after": {"id": 1, "status": "b"}, "op": "u",
                         "source": {"table": "orders"}, "ts_ms": MS}}
    r = envelope.parse_rows(log(spark, event), "orders", old=["status"]).first()
    assert (r.status, r.old_status) == ("b", "a")


def test_defaults(spark):
    r = envelope.parse_changes(log(spark, {"id": 0, "customer_id": 0}), "orders",
                               fallback=F.lit("2020-01-01")).first()
    assert (r.operation, r.table, r.ts_ms) == ("unknown", "unknown", None)
    assert r.event_ts == datetime(2020, 1, 1) and r.after.id == 0
    assert r.after.total_amount == Decimal("0.00")
    keyed = envelope.require_key(envelope.parse_rows(log(spark, row(customer_id=0), row(customer_id=None)), "orders"), "customer_id")
    assert [r.customer_id for r in keyed.collect()] == [0]


def test_malformed_and_tombstones(spark):
    df = log(spark, row(), "{broken", "null", "[]", None, '"text"')
    good, bad = envelope.split_valid(df)
    assert good.count() == 1 and envelope.parse_changes(df, "orders").count() == 1
    assert sorted(r.value for r in bad.collect()) == ['"text"', "[]", "null", "{broken"]
    counts = quality.message_counts(df.withColumn("topic", F.lit("t")), "s").collect()
    assert {r.outcome: r.messages for r in counts} == {
        "Processing failed": 1, "JSON decode error": 4, "tombstone": 1}


def test_amount_forms(spark):
    numbers = schemas.ORDERS.with_wire(total_amount="number")
    texts = schemas.ORDERS.with_wire(total_amount="string")
    assert envelope.parse_rows(log(spark, row(total_amount=12.5)), numbers).first().total_amount == Decimal("12.50")
    assert envelope.parse_rows(log(spark, row(total_amount="1234")), texts).first().total_amount == Decimal("1234.00")
    assert envelope.parse_rows(log(spark, row(total_amount="x")), texts).first().total_amount == Decimal("0.00")


def test_routing(spark):
    mixed = log(spark, row(), row(__source_table="products"), row(__source_table="audit"), "{")
    routed = envelope.route(mixed, unknown="dlq")
    assert {n: df.count() for n, df in routed.items()} == {"products": 1, "orders": 1, "order_items": 0, "unknown": 1}
    assert "unknown" not in envelope.route(mixed)


def test_round_trip_of_tables(spark):
    for df, table in ((orders(spark), schemas.ORDERS), (products(spark), schemas.PRODUCTS)):
        for layout in ("wrapped", "bare", "standard"):
            for form in ("base64", "string", "number"):
                shaped = table.with_wire(**{c: form for c in table.wire})
                back = envelope.parse_rows(changes.snapshot_as_changes(df, shaped, DAY, layout), shaped)
                now = state.latest_state(back, "id", ["event_ts"])
                assert rows(now.select(*table.columns)) == rows(df.select(*table.columns)), (layout, form)


def test_topics_and_filters(spark):
    assert changes.topics_of("orders, products") == "dbserver1.public.orders,dbserver1.public.products"
    df = spark.createDataFrame([("__debezium-heartbeat.x",), ("a",)], "topic string")
    assert [r.topic for r in changes.drop_heartbeats(df).collect()] == ["a"]
    assert changes.filter_tables(df, ["b"], "topic").count() == 0


def test_dead_letters(spark):
    df = log(spark, "{", row(__source_table="audit"), row(__source_table="products")).withColumn("topic", F.lit("t"))
    got = quality.dead_letters(df, "svc", datetime(2025, 1, 15, 10, 30)).collect()
    assert sorted((r.error, r.topic, r.service, r.timestamp) for r in got) == [
        (e, "t", "svc", "2025-01-15T10:30:00.000000") for e in ("JSON decode error", "Processing failed")]
