"""Documents to token ids: quality rules, line dedup, SimHash near-dedup, mixing, byte-level BPE.

``STAGES`` lists (name, function); each takes (spark, docs, sf_dir) and returns a DataFrame.  All but the last return
the columns of ``documents``.  ``run`` writes each stage's rows to the shared folder and gives them to the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from changeloom.llm import bpe, line_windows, mixing, quality, simhash
from changeloom.llm.queries import VOCABULARY
from changeloom.plans.catalog import Query
from changeloom.session import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of windows that stood earlier go from the texts; every document stays, and ``n_chars`` follows its text."""
    rows = line_windows.dedup_lines(docs).select("row.*")
    return rows.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else rows


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: a document taken twice is two rows."""
    return mixing.mix(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row left, and the digest of the text they decode to."""
    return bpe.encode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, decoded=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("byte_bpe", byte_bpe),
]

#: The method-bound stages (estimation, balanced sampling, merges) have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERY = Query("pipeline", run, ORACLE_SQL)
