"""Product search documents and lookups over them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import cents, price_display, tokenize
from ..functions.times import as_timestamp
from .envelope import event_order
from .state import latest_state

#: Product ids per posting list row; bounds the size of every collected list.
POSTING_BLOCK = 65_536


def search_documents(
    products: DataFrame, indexed_at: datetime | str | Column | None = None
) -> DataFrame:
    """One search document per product row."""
    name = F.coalesce("name", F.lit(""))
    description = F.coalesce("description", F.lit(""))
    changed = [c for c in ("updated_at", "created_at") if c in products.columns]
    docs = products.select(
        F.col("id").alias("product_id"),
        name.alias("name"),
        F.lower(name).alias("name_lower"),
        description.alias("description"),
        cents(F.coalesce("price", F.lit(0))).alias("price"),
        price_display(F.coalesce("price", F.lit(0))).alias("price_display"),
        F.coalesce("stock_quantity", F.lit(0)).cast("bigint").alias("stock_quantity"),
        # No word spans the blank, so this is the union of both token lists in one pass.
        tokenize(F.concat_ws(" ", name, description)).alias("search_tokens"),
        F.coalesce(*[F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") for c in changed], F.lit("")).alias("cdc_timestamp"),
    )
    if indexed_at is not None:
        docs = docs.withColumn("indexed_at", as_timestamp(indexed_at))
    return docs


def search_index(
    changes: DataFrame, ordering: Sequence[str] | None = None,
    indexed_at: datetime | str | Column | None = None,
) -> DataFrame:
    """Documents of the current products: rows of ``parse_rows`` with deletes applied.

    Text is tokenised after the fold, so each product is tokenised once.
    """
    return search_documents(latest_state(changes, "id", ordering or event_order(changes)), indexed_at)


def by_id(index: DataFrame, product_id: int) -> DataFrame:
    return index.filter(F.col("product_id") == product_id)


def by_name(index: DataFrame, name: str) -> DataFrame:
    """Exact name, any case."""
    return index.filter(F.col("name_lower") == F.lower(F.lit(name)))


def by_price(index: DataFrame, price_cents: int) -> DataFrame:
    return index.filter(F.col("price") == price_cents)


def by_price_range(index: DataFrame, low_cents: int, high_cents: int) -> DataFrame:
    return index.filter(F.col("price").between(low_cents, high_cents))


def by_token(index: DataFrame, token: str) -> DataFrame:
    return index.filter(F.array_contains("search_tokens", token.lower()))


def inverted_index(index: DataFrame, block: int = POSTING_BLOCK) -> DataFrame:
    """Token to sorted product ids, in blocks of ids: ``token, block, product_ids, doc_count``.

    A common word may occur in a third of all products, so no row holds a whole posting list:
    block b holds the ids in [b·block, (b+1)·block).
    """
    # The outer form keeps the optimizer from tokenising once more for an emptiness test.
    postings = index.select(F.explode_outer("search_tokens").alias("token"), "product_id").filter(
        F.col("token").isNotNull()
    )
    return postings.groupBy("token", F.expr(f"product_id div {int(block)}").alias("block")).agg(
        F.sort_array(F.collect_list("product_id")).alias("product_ids"),
        F.count(F.lit(1)).alias("doc_count"),
    )


def token_counts(postings: DataFrame) -> DataFrame:
    """Documents per token: the blocks of the inverted index added up."""
    return postings.groupBy("token").agg(F.sum("doc_count").alias("doc_count"))


def search(index: DataFrame, query: str, require_all: bool = True) -> DataFrame:
    """Products matching a query, best first; all its words, or any of them."""
    wanted = tokenize(F.lit(query))
    found = F.size(F.array_intersect("search_tokens", wanted))
    least = F.size(wanted) if require_all else F.lit(1)
    return (
        index.withColumn("matched_tokens", found)
        .filter((F.col("matched_tokens") >= least) & (F.size(wanted) > 0))
        .orderBy(F.desc("matched_tokens"), F.asc("product_id"))
    )


def price_facets(index: DataFrame, bands: Sequence[int]) -> DataFrame:
    """Products per price band; ``bands`` are rising lower bounds in cents."""
    lower = F.lit(None).cast("bigint")
    for bound in bands:
        lower = F.when(F.col("price") >= bound, F.lit(bound).cast("bigint")).otherwise(lower)
    return (
        index.groupBy(lower.alias("band_from"))
        .agg(F.count(F.lit(1)).alias("products"))
    )
