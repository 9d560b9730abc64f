"""Ranked search over stored postings, kept up from the change log.

A posting says how often a token stands in a product's text.  Postings are stored in blocks of product ids, sorted by token, in
folders by hash of the token, so a search opens only the folders of its own tokens.  A block's row carries its highest
frequency; with it a search bounds every block's scores before it reads a single id, and opens only blocks
that can hold one of the best.

A batch of changes becomes a folder of its own: new frequencies of the tokens that changed, 0 where a token is gone, and the net number
of products per token.  A batch written again replaces itself.  Reading takes the newest batch of each posting;
``compact`` folds all into a new index.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import tokenize, words
from ..schemas import DELETE, OPS_REPORT
from .envelope import event_order

#: Folders of an index; a search reads one for each of its tokens at most.
BUCKETS = 64
#: Product ids of a block.
BLOCK = 4096
#: Blocks read first, to learn how good the best are.
FIRST_BLOCKS = 8
#: Texts of a product that are searched.
FIELDS = ("name", "description")
#: No word is empty: this token's rows count products.
ALL = ""

_STORED = "token string, block bigint, ids array<bigint>, tfs array<bigint>, max_tf bigint, products bigint, batch bigint, bucket bigint"


def net_changes(
    changes: DataFrame, key: str = "id", ordering: Sequence[str] | None = None, fields: Sequence[str] = FIELDS, operation: str = "operation",
) -> DataFrame:
    """``id, old, new``: each changed product's text before and after; null where it did not exist.

    ``changes`` carry old images (``parse_rows(old=fields)``).  The first and the last change of a product decide, both
    found map-side, whatever lies between.
    """
    order = F.struct(*(ordering or event_order(changes)))
    was = F.when(~F.col(operation).isin(*OPS_REPORT), F.concat_ws(" ", *[F.col(f"old_{f}") for f in fields]))
    now = F.when(F.col(operation) != DELETE, F.concat_ws(" ", *fields))
    return (
        changes.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("id"))
        .agg(F.min_by(F.struct(was.alias("t")), order).alias("old"), F.max_by(F.struct(now.alias("t")), order).alias("new"))
        .select("id", F.col("old.t").alias("old"), F.col("new.t").alias("new"))
    )


def posting_deltas(net: DataFrame, block: int = BLOCK) -> DataFrame:
    """``token, block, id, tf, change``: postings that are not as before; ``change`` is +1, 0 or -1 product for the token.

    Words are dealt once, by token and block, and counted and gathered where they lie.
    """
    sides = F.array(
        F.struct(words(F.col("old")).alias("words"), F.lit(1).alias("was"), F.lit(0).alias("now")),
        F.struct(words(F.col("new")).alias("words"), F.lit(0).alias("was"), F.lit(1).alias("now")),
    )
    spoken = net.select(F.col("id").cast("bigint").alias("id"), F.explode(sides).alias("s")).select(
        F.explode("s.words").alias("token"), _block(block), "id", "s.was", "s.now"
    )
    counted = spoken.repartition("token", "block").groupBy("token", "block", "id").agg(F.sum("was").alias("was"), F.sum("now").alias("tf"))
    change = (F.col("tf") > 0).cast("bigint") - (F.col("was") > 0).cast("bigint")
    return counted.filter("was <> tf").select("token", "block", "id", "tf", change.alias("change"))


def _block(block: int) -> Column:
    return F.expr(f"coalesce(id div {int(block)}, 0)").alias("block")


def product_change(net: DataFrame) -> DataFrame:
    """``change``: products that came, less those that went."""
    return net.agg(F.sum(F.col("new").isNotNull().cast("bigint") - F.col("old").isNotNull().cast("bigint")).alias("change"))


def posting_blocks(deltas: DataFrame, products: DataFrame) -> DataFrame:
    """Deltas in blocks of ids; no row holds more than a block, however common its token.  ``products`` becomes the row of ``ALL``."""
    grouped = deltas.groupBy("token", "block").agg(
        F.sort_array(F.collect_list(F.struct("id", "tf"))).alias("pairs"), F.max("tf").alias("max_tf"), F.sum("change").alias("products")
    )
    none, zero = F.array().cast("array<bigint>"), F.lit(0).cast("bigint")
    count = products.filter("change <> 0").select(
        F.lit(ALL).alias("token"), zero.alias("block"), none.alias("ids"), none.alias("tfs"), zero.alias("max_tf"), F.col("change").alias("products")
    )
    return grouped.select("token", "block", F.col("pairs.id").alias("ids"), F.col("pairs.tf").alias("tfs"), "max_tf", "products").unionByName(count)


def weight(products: int, holding: int) -> int:
    """Weight of a token that ``holding`` of all products hold."""
    return math.floor(1000 * math.log((2 * products + 2) / (2 * holding + 1)))


def gain(tf: str) -> Column:
    """Thousandths of a token's weight that the occurrences in a column bring: rising, and below 1000."""
    return F.expr(f"1000 * {tf} div ({tf} + 1)")


class PostingIndex:
    """Postings under ``root``: ``batch=N/bucket=K`` folders."""

    def __init__(self, root: str, buckets: int = BUCKETS, block: int = BLOCK):
        self.root, self.buckets, self.block = root.rstrip("/"), buckets, block

    def _bucket(self, token: Column) -> Column:
        return F.pmod(F.xxhash64(token), F.lit(self.buckets)).cast("bigint")

    def _write(self, deltas: DataFrame, products: DataFrame, batch: int) -> None:
        rows = posting_blocks(deltas, products).withColumn("bucket", self._bucket(F.col("token")))
        # A large bucket is split, small ones share a task; each stays sorted, so readers skip row groups by token.
        rows = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "token", "block")
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/batch={int(batch)}")

    def add(self, changes: DataFrame, batch: int, **options) -> None:
        """Take in a batch of changes with old images; batches are numbered in their order."""
        self._add(net_changes(changes, **options), batch)

    def _add(self, net: DataFrame, batch: int) -> None:
        self._write(posting_deltas(net, self.block), product_change(net), batch)

    def add_documents(self, documents: DataFrame, key: str = "id", fields: Sequence[str] = FIELDS, batch: int = 0) -> None:
        """Take in rows of a table that are not yet there."""
        text = F.concat_ws(" ", *fields)
        self._add(documents.select(F.col(key).alias("id"), F.lit(None).cast("string").alias("old"), text.alias("new")), batch)

    def sink(self, after: int = 1, **options) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``: micro-batch n becomes batch ``after + n``; a retried one replaces itself."""
        return lambda changes, n: self.add(changes, after + n, **options)

    def rows(self, spark: SparkSession, tokens: Sequence[str] | None = None) -> DataFrame:
        """Stored blocks; with ``tokens`` only their folders are read."""
        stored = spark.read.schema(_STORED).option("basePath", self.root).parquet(self.root)
        if tokens is None:
            return stored
        folders = spark.range(1).select(*[self._bucket(F.lit(t)).alias(f"b{i}") for i, t in enumerate(tokens)]).first()
        return stored.filter(F.col("bucket").isin(*sorted(set(folders))) & F.col("token").isin(*tokens))

    @staticmethod
    def newest(blocks: DataFrame) -> DataFrame:
        """``token, product_id, tf`` as the newest batch has them, without those that are gone."""
        each = blocks.select("token", "batch", F.explode(F.arrays_zip("ids", "tfs")).alias("p"))
        last = each.groupBy("token", F.col("p.ids").alias("product_id")).agg(F.max_by("p.tfs", "batch").alias("tf"))
        return last.filter("tf > 0")

    def postings(self, spark: SparkSession, tokens: Sequence[str] | None = None) -> DataFrame:
        return self.newest(self.rows(spark, tokens))

    def compact(self, spark: SparkSession, root: str) -> "PostingIndex":
        """The same postings as one batch of a new index."""
        whole = PostingIndex(root, self.buckets, self.block)
        kept = self.postings(spark).select("token", F.col("product_id").alias("id"), "tf", F.lit(1).cast("bigint").alias("change"))
        count = self.rows(spark, [ALL]).agg(F.sum("products").alias("change"))
        whole._write(kept.withColumn("block", _block(self.block)), count, 0)
        return whole

    def search(self, spark: SparkSession, query: str, k: int = 10, require_all: bool = False) -> DataFrame:
        """The k products with the highest scores, ties by id: ``product_id, matched_tokens, score``.

        The score sums weight times ``gain`` over the query's tokens.  The blocks with the highest bounds are read first; their
        k-th score closes every block whose bound is below it.
        """
        tokens = spark.createDataFrame([(query,)], "q string").select(tokenize(F.col("q"))).first()[0]
        out = "product_id bigint, matched_tokens bigint, score bigint"
        if not tokens:
            return spark.createDataFrame([], out)
        held = self.rows(spark, [ALL, *tokens]).groupBy("token").agg(F.sum("products").alias("products")).collect()
        held = {r["token"]: r["products"] for r in held}
        weights = {t: weight(held.get(ALL, 0), held[t]) for t in tokens if held.get(t, 0) > 0}
        if not weights or (require_all and len(weights) < len(tokens)):
            return spark.createDataFrame([], out)
        w = F.create_map(*[F.lit(x) for t, v in weights.items() for x in (t, v)])[F.col("token")]
        rows = self.rows(spark, list(weights))
        bounds = self._bounds(rows, w, len(weights) if require_all else 1)
        first = [r["block"] for r in bounds.orderBy(F.desc("bound"), "block").limit(FIRST_BLOCKS).collect()]
        least = len(weights) if require_all else 1
        best = self._scores(rows.filter(F.col("block").isin(*first)), w, least, k).collect()
        bar = best[-1]["score"] if len(best) == k else 0
        opened = bounds.filter(F.col("bound") >= bar).select("block")
        return self._scores(rows.join(opened, "block", "left_semi"), w, least, k)

    @staticmethod
    def _bounds(rows: DataFrame, w: Column, least: int) -> DataFrame:
        """``block, bound``: no product of the block scores more.  Of the stored blocks only the heads are read."""
        heads = rows.groupBy("block", "token").agg(F.max("max_tf").alias("max_tf"))
        bound = heads.groupBy("block").agg(F.sum(w * gain("max_tf")).alias("bound"), F.count(F.lit(1)).alias("tokens"))
        return bound.filter(F.col("tokens") >= least).select("block", "bound")

    def _scores(self, rows: DataFrame, w: Column, least: int, k: int) -> DataFrame:
        scored = self.newest(rows).groupBy("product_id").agg(
            F.count(F.lit(1)).alias("matched_tokens"), F.sum(w * gain("tf")).cast("bigint").alias("score")
        )
        return scored.filter(F.col("matched_tokens") >= least).orderBy(F.desc("score"), F.asc("product_id")).limit(k)
