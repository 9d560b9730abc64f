"""Gives every row what was found about its text elsewhere, and rewrites the text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from changeloom.llm.arrays import PIECE_BYTES, pieces


def digest(text: Column) -> Column:
    """Tells texts of one id apart."""
    return F.xxhash64(text)


def rewrite(
    docs: DataFrame, found: DataFrame, step: Callable[[pa.RecordBatch], tuple[pa.Array, pa.StructArray]], info: str,
    doc_id: str = "doc_id", text: str = "text", limit: int = PIECE_BYTES,
) -> DataFrame:
    """``row, info``: rows (all columns, their names don't matter) with the text that ``step`` makes of ``text`` and ``found``.

    ``found`` holds ``id, digest, found``, one row for each text it says anything about; other rows get null.
    """
    said = found.select(F.col("id").alias("found_id"), F.col("digest").alias("found_digest"), "found")
    row = F.col("row")
    joined = docs.select(F.struct("*").alias("row")).join(
        said,
        row.getField(doc_id).eqNullSafe(F.col("found_id")) & digest(row.getField(text)).eqNullSafe(F.col("found_digest")), "left",
    ).select("row", "found")
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fields = batch.column("row").flatten()
            flat = pa.RecordBatch.from_arrays([fields[place], batch.column("found"), batch.column("row")], names=["text", "found", "row"])
            for piece in pieces(flat, "text", limit):
                texts, info = step(piece)
                fields, kind = piece.column("row").flatten(), piece.column("row").type
                fields[place] = texts.cast(fields[place].type)
                rows = pa.StructArray.from_arrays(fields, fields=[kind.field(k) for k in range(kind.num_fields)])
                yield pa.RecordBatch.from_arrays([rows, info], names=["row", "info"])

    out = T.StructType([T.StructField("row", docs.schema), T.StructField("info", T.StructType.fromDDL(info))])
    return joined.mapInArrow(run, out)


SPANS = "array<struct<from_byte: bigint, to_byte: bigint>>"
SPAN = pa.list_(pa.struct([("from_byte", pa.int64()), ("to_byte", pa.int64())]))


def spans(starts, ends) -> list[dict[str, int]]:
    return [{"from_byte": int(a), "to_byte": int(b)} for a, b in zip(starts, ends)]
