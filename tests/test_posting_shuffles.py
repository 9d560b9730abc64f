"""Stored postings are dealt to tasks once."""

from changeloom.operators import postings


def test_words_are_shuffled_once(spark):
    net = spark.createDataFrame([(1, None, "a b a"), (9, "b", "b c"), (70, "d", None)], "id long, old string, new string")
    found = postings.posting_blocks(postings.posting_deltas(net, 8), postings.product_change(net))
    got = sorted((r["token"], r["block"], r["ids"], r["tfs"], r["max_tf"], r["products"]) for r in found.collect())
    assert got == [("a", 0, [1], [2], 2, 1), ("b", 0, [1], [1], 1, 1), ("c", 1, [9], [1], 1, 1), ("d", 8, [70], [0], 0, -1)]
    plan = postings.posting_deltas(net, 8).groupBy("token", "block").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1
    both = spark.createDataFrame([(1, None, "a")], "id long, old string, new string")
    assert [r["products"] for r in postings.posting_blocks(postings.posting_deltas(both), postings.product_change(both)).filter("token = ''").collect()] == [1]
