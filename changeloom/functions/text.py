"""Search text and display strings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Letters, digits and underscore of any script.
WORD = r"[\p{L}\p{N}_]+"


def words(text: Column) -> Column:
    """Lower-case words in order, with repeats."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def tokenize(text: Column) -> Column:
    """Distinct lower-case words, sorted."""
    return F.sort_array(F.array_distinct(words(text)))


def cents(price: Column) -> Column:
    """Exact cents of a decimal price."""
    return (price * 100).cast("bigint")


def money_text(price: Column) -> Column:
    """Two-decimal text."""
    return price.cast("decimal(12,2)").cast("string")


def price_display(price: Column) -> Column:
    return F.concat(F.lit("$"), money_text(price))
