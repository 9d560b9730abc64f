r"""Line dedup over overlapping windows of three lines.

A line is a ``\n``-split part with a word (a character outside space and tab to carriage return); lines without one
are no part of windows and always stay.  Every window of three consecutive lines is hashed (128 bits, from 128 bits a line); of equal
windows anywhere in the corpus the first by (id, nulls last; text digest; line) stays, and all lines that a later
one covers go, so overlapping windows merge to longer removed runs.

Windows are counted with map-side combining; only windows found twice or more are joined back to their places, and a
frequent window's places are split by the adaptive skew join.  Texts are shuffled once, to meet their removed lines.

Defined results: null and empty texts and texts of fewer than three lines hold no window and stay as they are; rows
equal in id and text are one document, all of them get the same result; an empty table gives an empty table; all
columns of the input are kept apart from the operator's own, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from changeloom.llm.arrays import Texts, digests, mix, pieces
from changeloom.llm.rewrite import SPAN, SPANS, digest, rewrite, spans

WINDOW = 3
INFO = f"n_lines bigint, n_removed bigint, spans {SPANS}"


def full_lines(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines with a word: starts, ends, documents, and the line's number in its document."""
    starts, ends, doc = t.lines()
    number = np.arange(len(doc)) - np.searchsorted(doc, doc)
    words, _, _ = t.words()
    full = np.searchsorted(words, ends) > np.searchsorted(words, starts)
    return starts[full], ends[full], doc[full], number[full]


def windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, digest, lines, h1, h2``: the numbers of each window's lines and its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                t = Texts.of(piece.column("text"))
                starts, ends, doc, number = full_lines(t)
                n = max(len(doc) - WINDOW + 1, 0)
                inside = np.flatnonzero(doc[:n] == doc[WINDOW - 1:])
                each = digests(t.strings(starts, ends))
                one, two = np.zeros(len(inside), np.uint64), np.full(len(inside), 7, np.uint64)
                for k in range(WINDOW):
                    one, two = mix(one + each[inside + k, 0]), mix(two ^ each[inside + k, 1])
                numbers = np.stack([number[inside + k] for k in range(WINDOW)], axis=1).astype(np.int32).ravel()
                at = pa.array(doc[inside])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id").take(at), piece.column("digest").take(at),
                     pa.ListArray.from_arrays(np.arange(0, len(numbers) + 1, WINDOW, dtype=np.int32), pa.array(numbers)),
                     pa.array(one.view(np.int64)), pa.array(two.view(np.int64))],
                    names=["id", "digest", "lines", "h1", "h2"],
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    few = docs.select(F.col(doc_id).alias("id"), digest(F.col(text)).alias("digest"), F.col(text).alias("text")).filter(
        F.col("text").isNotNull()
    )
    return few.mapInArrow(run, f"id {kind}, digest long, lines array<int>, h1 long, h2 long")


def removals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, digest, lines``: the line numbers that go, for each document that loses any."""
    found = windows(docs, doc_id, text)
    rank = F.struct(F.col("id").isNull(), F.col("id"), F.col("digest"), F.col("lines")[0])
    # Rows equal in id and text give a window at the same place: they count once.
    first = found.groupBy("h1", "h2").agg(F.min(rank).alias("first"), F.max(rank).alias("last")).filter(
        ~F.col("first").eqNullSafe(F.col("last"))
    )
    again = found.join(first, ["h1", "h2"]).filter(~rank.eqNullSafe(F.col("first")))
    return again.groupBy("id", "digest").agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("lines"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``row, info``: the row with its new text, and what went: lines, removed lines and removed runs in the old text
    (byte offsets in UTF-8, of the lines without their line ends)."""
    gone = removals(docs, doc_id, text).withColumnRenamed("lines", "found")
    return rewrite(docs, gone, _without, INFO, doc_id, text)


def _without(piece: pa.RecordBatch) -> tuple[pa.Array, pa.StructArray]:
    """Texts without their removed lines."""
    t = Texts.of(piece.column("text"))
    starts, ends, doc = t.lines()
    first = np.searchsorted(doc, np.arange(t.n + 1))
    _, _, full_doc, _ = full_lines(t)
    gone, texts = piece.column("found"), piece.column("text")
    affected = np.flatnonzero(gone.is_valid())
    new = texts.to_pylist() if len(affected) else None
    counts, runs = np.zeros(t.n, np.int64), [[] for _ in range(t.n)]
    for i in affected.tolist():
        goes = np.zeros(first[i + 1] - first[i], bool)
        goes[gone[i].values.to_numpy()] = True
        s, e = starts[first[i]:first[i + 1]], ends[first[i]:first[i + 1]]
        new[i] = b"\n".join(t.data[a:b].tobytes() for a, b in zip(s[~goes], e[~goes])).decode()
        edges = np.flatnonzero(np.diff(goes.astype(np.int8), prepend=0, append=0))
        runs[i] = spans(s[edges[::2]] - t.at[i], e[edges[1::2] - 1] - t.at[i])
        counts[i] = goes.sum()
    info = pa.StructArray.from_arrays(
        [pa.array(t.per_doc(full_doc)), pa.array(counts), pa.array(runs, SPAN)], ["n_lines", "n_removed", "spans"]
    )
    return (texts if new is None else pa.array(new, pa.string())), info
