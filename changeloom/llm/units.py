r"""Substring dedup by hashed units: lines, cut further at sentence ends.

A unit ends at ``\n`` and at white space after ``.``, ``!`` or ``?``, so a passage pasted into a paragraph is
found by its whole sentences.  Units are normalised (A-Z lower-cased; white space and ASCII punctuation left out) and hashed
to 128 bits.  Of equal units anywhere in the corpus the first by (id, nulls last; text digest; unit number) stays.
Later ones go where neighbouring later ones together have ``MIN_WORDS`` words, so phrases and short headings that clean
documents share by chance stay.  What goes is given by its byte offsets in the original text.

Counting combines map-side; only units found twice or more are ranked and joined, and a frequent unit is split by
the adaptive skew join.  Texts are shuffled once, to meet the numbers of their removed units.

Defined results: null and empty texts and units without letters, digits or other characters are never removed; rows equal in
id and text are one document and get the same result; an empty table gives an empty table; all columns of the input
are kept apart from the operator's own, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from changeloom.llm.arrays import IS_SPACE, NEWLINE, Texts, digests, pieces
from changeloom.llm.rewrite import SPAN, SPANS, digest, rewrite, spans
from changeloom.session import written

#: Words that a run of repeated units has at least to be removed.
MIN_WORDS = 25
INFO = f"n_units bigint, n_removed bigint, n_removed_words bigint, spans {SPANS}"

_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PLAIN = ~IS_SPACE.copy()
_PLAIN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = False


def cut(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Units with any plain character: starts, ends (without the white space that ends them), documents, numbers."""
    d = t.data
    stop = IS_SPACE[d]
    stop[1:] &= _ENDS[d[:-1]] | (d[1:] == NEWLINE)
    firsts = t.at[:-1][t.at[:-1] < len(d)]
    stop[firsts] = d[firsts] == NEWLINE
    starts, ends, doc = t.runs(~stop)
    plain = np.concatenate(([0], np.cumsum(_PLAIN[d])))
    full = plain[ends] > plain[starts]
    starts, ends, doc = starts[full], ends[full], doc[full]
    return starts, ends, doc, np.arange(len(doc)) - np.searchsorted(doc, doc)


def hashes(t: Texts, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of each normalised unit's digest."""
    keep = _PLAIN[t.data]
    place = np.concatenate(([0], np.cumsum(keep)))
    plain = Texts(_LOWER[t.data[keep]], place[t.at])
    both = digests(plain.strings(place[starts], place[ends]))
    return np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])


def found_units(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, digest, nr, h1, h2``: each unit of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                t = Texts.of(piece.column("text"))
                starts, ends, doc, number = cut(t)
                one, two = hashes(t, starts, ends)
                at = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id").take(at), piece.column("digest").take(at), pa.array(number.astype(np.int32)),
                     pa.array(one.view(np.int64)), pa.array(two.view(np.int64))], names=["id", "digest", "nr", "h1", "h2"],
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    few = docs.select(F.col(doc_id).alias("id"), digest(F.col(text)).alias("digest"), F.col(text).alias("text"))
    return few.filter("text IS NOT NULL").mapInArrow(run, f"id {kind}, digest long, nr int, h1 long, h2 long")


def later_units(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, digest, found``: numbers of the units that stand earlier too, for each document that has any."""
    units = found_units(docs, doc_id, text)
    often = units.groupBy("h1", "h2").count().filter("count > 1").select("h1", "h2")
    copies = written(units.join(often, ["h1", "h2"]), "repeated-units")
    rank = F.struct(F.col("id").isNull(), F.col("id"), F.col("digest"), F.col("nr"))
    first = copies.groupBy("h1", "h2").agg(F.min(rank).alias("first"))
    later = copies.join(first, ["h1", "h2"]).filter(~rank.eqNullSafe(F.col("first")))
    return later.groupBy("id", "digest").agg(F.collect_set("nr").alias("found"))


def dedup_units(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``row, info``: the row with its new text; units, removed units and words, removed runs in the old text."""

    def step(piece: pa.RecordBatch) -> tuple[pa.Array, pa.StructArray]:
        t = Texts.of(piece.column("text"))
        starts, ends, doc, number = cut(t)
        words, _, _ = t.words()
        size = np.searchsorted(words, ends) - np.searchsorted(words, starts)
        first = np.searchsorted(doc, np.arange(t.n + 1))
        found, texts = piece.column("found"), piece.column("text")
        new, runs = None, [[] for _ in range(t.n)]
        removed, removed_words = np.zeros(t.n, np.int64), np.zeros(t.n, np.int64)
        for i in np.flatnonzero(found.is_valid()).tolist():
            a, b = first[i], first[i + 1]
            later = np.zeros(b - a, bool)
            later[found[i].values.to_numpy()] = True
            edges = np.flatnonzero(np.diff(later.astype(np.int8), prepend=0, append=0))
            sums = np.concatenate(([0], np.cumsum(size[a:b])))
            cuts = [(x, y) for x, y in zip(edges[::2], edges[1::2]) if sums[y] - sums[x] >= min_words]
            if not cuts:
                continue
            new = texts.to_pylist() if new is None else new
            s, e, end = starts[a:b], ends[a:b], t.at[i + 1]
            gone = np.zeros(end - t.at[i], bool)
            for x, y in cuts:
                for u in range(x, y):
                    gone[s[u] - t.at[i]:min(e[u] + 1, end) - t.at[i]] = True
                removed[i] += y - x
                removed_words[i] += sums[y] - sums[x]
            new[i] = t.data[t.at[i]:end][~gone].tobytes().decode()
            edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
            runs[i] = spans(edges[::2], edges[1::2])
        info = pa.StructArray.from_arrays(
            [pa.array(t.per_doc(doc)), pa.array(removed), pa.array(removed_words), pa.array(runs, SPAN)],
            ["n_units", "n_removed", "n_removed_words", "spans"],
        )
        return (texts if new is None else pa.array(new, pa.string())), info

    return rewrite(docs, later_units(docs, doc_id, text), step, INFO, doc_id, text)
