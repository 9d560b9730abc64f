"""Stored postings against a loop over the texts: ranking, block skipping, pruned folders, upkeep in batches and streams."""

import random
import re
from collections import Counter
from datetime import datetime, timedelta

import pytest

from changeloom.operators import postings
from changeloom.session import scratch_path
from changeloom.streaming import pipelines

SCHEMA = "id long, operation string, name string, description string, old_name string, old_description string, event_ts timestamp"
START = datetime(2024, 1, 1)


def texts(rng, n):
    words = ["ring", "red", "small", "Gold", "wide", "über", "x_1"] + [f"w{k}" for k in range(30)]
    return {k: (" ".join(rng.choices(words, range(len(words), 0, -1), k=rng.randrange(0, 9))), rng.choice([None, "red ring", "Ring-ring"])) for k in range(n)}


def counts(products):
    return {k: Counter(re.findall(r"\w+", " ".join(t for t in v if t is not None).lower())) for k, v in products.items()}


def ranked(products, query, k, require_all):
    held = counts(products)
    tokens = set(re.findall(r"\w+", query.lower()))
    weights = {t: postings.weight(len(products), sum(t in c for c in held.values())) for t in tokens if any(t in c for c in held.values())}
    if require_all and len(weights) < len(tokens):
        return []
    found = []
    for product, c in held.items():
        mine = [t for t in weights if c[t]]
        if mine and (not require_all or len(mine) == len(tokens)):
            found.append((-sum(weights[t] * (1000 * c[t] // (c[t] + 1)) for t in mine), product, len(mine)))
    return [(product, n, -score) for score, product, n in sorted(found)[:k]]


def changes_between(rng, before, after, at):
    rows = []
    for k in before.keys() | after.keys():
        old, new = before.get(k), after.get(k)
        if old == new:
            continue
        if old and new and rng.random() < 0.5:  # by way of a third text
            rows += [(k, "u", "w1 w2", "x", *old, at), (k, "u", *new, "w1 w2", "x", at + timedelta(seconds=1))]
        elif old and not new:
            rows.append((k, "d", *old, *old, at))
        else:
            rows.append((k, "u" if old else "c", *new, *(old or (None, None)), at))
    return rows


def versions(rng):
    now = texts(rng, 120)
    out = [now]
    for _ in range(3):
        other = texts(rng, 140)
        now = {k: (other[k] if rng.random() < 0.3 else v) for k, v in now.items() if rng.random() > 0.1}
        now.update({k: other[k] for k in rng.sample(sorted(other), 15)})
        out.append(now)
    return out


@pytest.fixture(scope="module")
def index(spark):
    rng = random.Random(1)
    index, before = postings.PostingIndex(scratch_path(spark, "test-postings"), buckets=8, block=16), {}
    steps = versions(rng)
    for n, after in enumerate(steps):
        log = spark.createDataFrame(changes_between(rng, before, after, START + timedelta(days=n)), SCHEMA)
        index.add(log, n)
        index.add(log, n)  # written again
        before = after
    return index, before


def stored(spark, index):
    return {(r["token"], r["product_id"]): r["tf"] for r in index.postings(spark).collect()}


def wanted(products):
    return {(t, k): n for k, c in counts(products).items() for t, n in c.items()}


def test_upkeep_equals_a_rebuild(spark, index):
    index, products = index
    assert stored(spark, index) == wanted(products)
    whole = index.compact(spark, scratch_path(spark, "test-compacted"))
    assert stored(spark, whole) == wanted(products)
    for one in (index, whole):
        sums = {r["token"]: r["n"] for r in one.rows(spark).groupBy("token").agg({"products": "sum"}).withColumnRenamed("sum(products)", "n").collect()}
        assert sums.pop(postings.ALL) == len(products)
        assert {t: n for t, n in sums.items() if n} == Counter(t for t, _ in wanted(products))


@pytest.mark.parametrize("query", ["ring", "red RING small", "gold über w29 w7", "unknown ring", "unknown", " -- ", "w1 w2 w3 w4 w5"])
@pytest.mark.parametrize("require_all", [False, True])
def test_search(spark, index, query, require_all):
    index, products = index
    got = [tuple(r) for r in index.search(spark, query, k=7, require_all=require_all).collect()]
    assert got == ranked(products, query, 7, require_all)


def test_reads_little(spark, index, monkeypatch):
    index, products = index
    plan = index.rows(spark, ["ring", "red"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    monkeypatch.setattr(postings, "FIRST_BLOCKS", 1)
    opened = []
    scores = postings.PostingIndex._scores
    monkeypatch.setattr(postings.PostingIndex, "_scores", lambda self, rows, w, least, k: opened.append(
        rows.select("block").distinct().count()) or scores(self, rows, w, least, k))
    assert [tuple(r) for r in index.search(spark, "w29 w28", k=1).collect()] == ranked(products, "w29 w28", 1, False)
    assert opened[0] == 1 and opened[1] < index.rows(spark, ["w29", "w28"]).select("block").distinct().count()


def test_stream(spark):
    rng = random.Random(2)
    root, log = scratch_path(spark, "test-stream-postings"), scratch_path(spark, "test-log")
    index, before, state = postings.PostingIndex(root, buckets=4, block=16), {}, scratch_path(spark, "test-state")
    for n, after in enumerate(versions(rng)):
        spark.createDataFrame(changes_between(rng, before, after, START + timedelta(days=n)), SCHEMA).write.mode("append").parquet(log)
        pipelines.posting_stream(spark.readStream.schema(SCHEMA).parquet(log), index, state).awaitTermination()
        before = after
    assert stored(spark, index) == wanted(before)


def test_rows_without_text_or_key(spark):
    index = postings.PostingIndex(scratch_path(spark, "test-postings"))
    index.add(spark.createDataFrame([(None, "c", "ring", None, None, None, START), (1, "c", None, None, None, None, START)], SCHEMA), 0)
    assert stored(spark, index) == {}
    assert index.search(spark, "ring").collect() == []
    index.add(spark.createDataFrame([], SCHEMA), 1)
    assert index.rows(spark, [postings.ALL]).count() == 1
