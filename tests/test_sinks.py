import json
import os
from datetime import datetime
from glob import glob

from pyspark.sql import functions as F

from changeloom.operators import reports
from changeloom.sinks import reports as report_sink
from changeloom.sinks.logs import archive, write_dlq
from changeloom.sinks.upsert import ITEMS_PER_WRITE, KeyedTable, normalised, stamp, to_item_json, write_items
from changeloom.sources import changes
from seeds import DAY, items, orders, rows

AT = datetime(2025, 1, 15, 10, 30)


def batch(spark, *values):
    return spark.createDataFrame(list(values), "k bigint, v string, n bigint, gone boolean")


def test_keyed_table(spark, tmp_path):
    table = KeyedTable(str(tmp_path), "k", ["n"])
    gone = F.col("gone")
    table.write(batch(spark, (1, "a", 1, False), (1, "b", 2, False), (2, "c", 1, False)), 0, gone)
    table.write(batch(spark, (2, "c", 2, True), (3, "d", 2, False)), 1, gone)
    wanted = [(1, "b", 2, False), (3, "d", 2, False)]
    assert rows(table.read(spark)) == wanted
    table.write(batch(spark, (2, "c", 2, True), (3, "d", 2, False)), 1, gone)  # replay
    assert rows(table.read(spark)) == wanted
    assert table.compact(spark) == 1 and rows(table.read(spark)) == wanted
    table.write(batch(spark, (1, "old", 1, False), (2, "e", 3, False)), 2, gone)  # late, and back again
    assert rows(table.read(spark)) == [(1, "b", 2, False), (2, "e", 3, False), (3, "d", 2, False)]
    # A folder that its writer did not finish does not count.
    batch(spark, (9, "half", 9, False)).withColumn("_deleted", F.lit(False)).write.parquet(f"{tmp_path}/batches/batch_id=7")
    batch(spark).write.parquet(f"{tmp_path}/base/upto=9")
    assert len(rows(table.read(spark))) == 3


def test_batch_written_during_compaction(spark, tmp_path, monkeypatch):
    table = KeyedTable(str(tmp_path), "k", ["n"])
    table.write(batch(spark, (1, "a", 1, False)), 0)
    merged = table._merged

    def slow(*args):
        found = merged(*args)
        monkeypatch.setattr(table, "_merged", merged)
        table.write(batch(spark, (2, "b", 1, False)), 1)
        return found

    monkeypatch.setattr(table, "_merged", slow)
    assert table.compact(spark) == 0
    assert len(rows(table.read(spark))) == 2


def test_sink_compacts(spark, tmp_path):
    table = KeyedTable(str(tmp_path), "k", ["n"])
    on_batch = table.sink(every=2)
    for n in range(5):
        on_batch(batch(spark, (n % 2, str(n), n, False)), n)
    assert table._parts(spark) == (3, [4])
    assert rows(table.read(spark)) == [(0, "4", 4, False), (1, "3", 3, False)]


def test_item_form(spark):
    df = spark.createDataFrame(
        [(1, 0.1, None, {"a": None, "b": 1.5}, ["x", None], (None, 2.5))],
        "k bigint, f double, none string, m map<string,double>, l array<string>, s struct<p:string,q:double>")
    assert dict(normalised(df).dtypes)["f"] == "decimal(38,10)"
    item = json.loads(to_item_json(df).first().item)
    assert item == {"k": 1, "f": 0.1, "m": {"b": 1.5}, "l": ["x"], "s": {"q": 2.5}}
    assert stamp(df, AT).first().updated_at == AT


def test_items_go_out_in_small_requests(spark, tmp_path):
    out = str(tmp_path)

    def open_store():
        import os
        import uuid

        def put(part):
            with open(os.path.join(out, uuid.uuid4().hex), "w") as f:
                json.dump(part, f)

        return put

    write_items(spark.range(230).coalesce(3), open_store)
    parts = [json.load(open(f)) for f in glob(f"{out}/*")]
    assert max(len(p) for p in parts) == ITEMS_PER_WRITE
    assert sorted(i["id"] for p in parts for i in p) == list(range(230))


def read_json(path):
    return [json.loads(line) for f in glob(f"{path}/part-*") for line in open(f)]


def test_reports(spark, tmp_path):
    o, i = orders(spark), items(spark)
    status = o.groupBy("status").agg(F.count("*").alias("order_count"))
    paths = report_sink.write_reports(
        {
            "daily_sales": (reports.daily_sales(o), "date"),
            "product_sales": (reports.top_products(i), "product_id"),
            "customer_metrics": (reports.top_customers(o), "customer_id"),
            "order_status": (status, "status"),
        },
        str(tmp_path), AT, as_object=("product_sales", "customer_metrics", "order_status"),
    )
    assert paths["daily_sales"] == f"{tmp_path}/daily_sales/20250115_103000"
    [daily] = read_json(paths["daily_sales"])
    assert daily == {
        "report_type": "daily_sales", "generated_at": "2025-01-15T10:30:00",
        "key": "2025-01-15", "value": {"total_amount": 1819.96, "order_count": 3}}
    [top] = read_json(paths["product_sales"])
    assert top["data"]["1"] == {"quantity_sold": 1, "total_revenue": 1299.99}
    [by_status] = read_json(paths["order_status"])
    assert by_status["data"] == {"completed": 1, "pending": 1, "processing": 1}
    [summary] = read_json(report_sink.write_summary(reports.summary(o, i), str(tmp_path), AT, status))
    assert summary["metrics"] == {
        "total_orders": 3, "total_revenue": 1819.96, "unique_customers": 3, "unique_products_sold": 4,
        "order_status_breakdown": {"completed": 1, "pending": 1, "processing": 1}}


def test_one_layout_at_every_length(spark, tmp_path):
    long = spark.range(10_001).select(F.col("id").alias("customer_id"), F.lit(1).alias("order_count"))
    for n in (3, 10_000, 10_001):
        path = report_sink.write_report(long.limit(n), "customer_id", f"c{n}", str(tmp_path), AT)
        back = spark.read.schema("report_type string, key string, value int").json(path)
        assert back.filter("value = 1 and key is not null").count() == n


def test_dlq_and_archive(spark, tmp_path):
    letters = spark.createDataFrame(
        [("t", "{", "e", "now", "s")], "topic string, message string, error string, timestamp string, service string")
    write_dlq(letters, f"{tmp_path}/dlq")
    assert os.path.isdir(f"{tmp_path}/dlq/service=s/topic=t")
    log = changes.snapshot_as_changes(orders(spark), "orders", DAY)
    log.coalesce(1).write.text(f"{tmp_path}/log")
    archive(log, f"{tmp_path}/batch")
    stream = archive(changes.read_change_files(spark, f"{tmp_path}/log", streaming=True), f"{tmp_path}/stream", f"{tmp_path}/cp")
    stream.awaitTermination()
    both = [spark.read.parquet(f"{tmp_path}/{k}").drop("event_ts") for k in ("batch", "stream")]
    assert rows(both[0]) == rows(both[1]) and both[0].count() == 3
    assert os.path.isdir(f"{tmp_path}/batch/table=orders/event_date=2025-01-15")
    odd = spark.createDataFrame([(None,), ("{",)], "value string")
    archive(odd, f"{tmp_path}/odd")
    assert sorted(r.status for r in spark.read.parquet(f"{tmp_path}/odd").collect()) == ["malformed", "tombstone"]


def test_apply_deltas(spark):
    from changeloom.operators.inventory import apply_deltas

    snapshot = spark.createDataFrame([(1, 10), (2, 5)], "k bigint, stock int")
    deltas = spark.createDataFrame([(1, -3), (1, -4), (3, -2)], "k bigint, delta int")
    assert rows(apply_deltas(snapshot, deltas, "k", "stock")) == [(1, 3), (2, 5), (3, -2)]
