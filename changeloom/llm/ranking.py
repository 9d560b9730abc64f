r"""Ranked lexical search over a length-stratified index.

Terms are maximal runs ``[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+`` with A-Z lower-cased.  N documents hold a term, L is the
number of all their terms, n that of one document; its normaliser is m = 100 - b + (b n N) div L.  A term found tf times has
impact (1000000000 tf) div (1000 tf + 8 m), which m and tf alone decide.  So the index groups documents by equal m: a
stratum holds, per term, its documents by falling tf, and an impact is computed once per term and tf of a stratum.

``build`` makes one row per stratum.  A stratum of many documents is dealt into parts of about ``STRATUM`` by row number, so equal
copies with a third of all rows are many rows.  ``search`` reads the rows of its partition, some strata at a time, and
bounds every query's score in a stratum by its terms' highest tf there.  Strata are visited by falling bound; a query skips
those whose bound is below its tenth score so far, which loses nothing, as scores equal to it are still visited.
The partitions' heaps merge to the result.

Queries are taken in blocks of about ``BLOCK`` items, each read by the driver (their terms and weights, never documents); every block
meets every stratum.  Statistics cover all documents.

Defined results: null, empty and termless texts are no documents and never found; repeated rows are documents of their own
and stand side by side in the ranking; rows that repeat an item's id are one item with the terms of all; null ids of documents come
first among equal scores; items without a term that any document holds give no row; empty tables give an empty table; terms of any length
and texts of any length count whole; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from changeloom.llm.arrays import Texts, pieces
from changeloom.session import scratch_path, written

B = 90
TOP = 10
#: Documents of an index row, about.
STRATUM = 512
#: Tables of large strata up to this many rows are broadcast, larger ones are joined.
BROADCAST_ROWS = 200_000
#: Documents whose strata are ordered by bound together.
VISIT = 4096
#: Items of a block of queries, about.
BLOCK = 1000
#: Postings, or cells of a table of scores (items by documents), worked on at once.
CELLS = 500_000

_IN_TERM = np.zeros(256, bool)
_IN_TERM[128:] = _IN_TERM[48:58] = _IN_TERM[65:91] = _IN_TERM[97:123] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def terms_of(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Document and term of every term in a column of texts, in order."""
    t = Texts.of(column)
    inside = _IN_TERM[t.data]
    starts, ends, doc = t.runs(inside)
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=at[1:])
    data = _LOWER[t.data[inside]]
    return doc, pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(data))


def _counted(doc: np.ndarray, terms: pa.Array, n: int) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Per document: its distinct terms, how often each stands, and the number of all."""
    known = terms.dictionary_encode()
    size = max(len(known.dictionary), 1)
    pair, tf = np.unique(doc * size + known.indices.to_numpy(), return_counts=True)
    at = np.searchsorted(pair, np.arange(n + 1) * size).astype(np.int32)
    names = known.dictionary.take(pa.array(pair % size)).cast(pa.string())
    return (
        # Joined by blanks, which no term holds: a string moves lighter than a list of them.
        pc.binary_join(pa.ListArray.from_arrays(pa.array(at), names), " "), pa.ListArray.from_arrays(pa.array(at), pa.array(tf.astype(np.int32))),
        np.bincount(doc, minlength=n).astype(np.int64),
    )


def forward(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n, terms, tfs`` of the documents with a term; terms are joined by blanks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                terms, tfs, n = _counted(*terms_of(piece.column("text")), piece.num_rows)
                out = pa.RecordBatch.from_arrays([piece.column("id"), pa.array(n), terms, tfs], names=["id", "n", "terms", "tfs"])
                yield out.filter(pa.array(n > 0))

    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(
        run, "id bigint, n bigint, terms string, tfs array<int>"
    )


INDEX = (
    "m bigint, ids array<bigint>, terms array<string>, dfs array<int>, run_ends array<int>, run_tfs array<int>, "
    "doc_ends array<int>, docs array<int>"
)


def _stratum(table: pa.Table) -> pa.Table:
    """One index row: term k has the runs up to ``run_ends[k]``; a run has one tf and the documents up to ``doc_ends`` of it."""
    table = table.combine_chunks()
    terms, tfs = pc.split_pattern(table["terms"].combine_chunks(), " "), table["tfs"].combine_chunks()
    sizes = pc.list_value_length(terms).to_numpy()
    known = terms.flatten().dictionary_encode()
    code, tf = known.indices.to_numpy(), tfs.flatten().to_numpy()
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    order = np.lexsort((doc, -tf, code))
    code, tf, doc = code[order], tf[order], doc[order]
    new = np.flatnonzero((np.diff(code, prepend=-1) != 0) | (np.diff(tf, prepend=-1) != 0))
    doc_ends = np.append(new[1:], len(code)).astype(np.int32)
    of = np.arange(len(known.dictionary))
    run_ends = np.searchsorted(code[new], of, "right").astype(np.int32)

    def one(values) -> pa.Array:
        values = values if isinstance(values, (pa.Array, pa.ChunkedArray)) else pa.array(values)
        values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    return pa.table({
        "m": table["m"].slice(0, 1), "ids": one(table["id"]), "terms": one(known.dictionary.cast(pa.string())),
        "dfs": one(np.bincount(code, minlength=len(of)).astype(np.int32)), "run_ends": one(run_ends),
        "run_tfs": one(tf[new].astype(np.int32)), "doc_ends": one(doc_ends), "docs": one(doc),
    })


class Index:
    """Strata and corpus totals, both written tables."""

    def __init__(self, strata: DataFrame, totals: DataFrame):
        self.strata, self.totals = strata, totals


def build(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", b: int = B, stratum: int = STRATUM) -> Index:
    """The index of all documents."""
    # Row numbers deal copies, even of one id, over the parts of a stratum.
    each = _stored(forward(docs, doc_id, text).withColumn("row", F.monotonically_increasing_id()), "forward")
    totals = written(each.agg(F.count("*").alias("n_docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_terms")), "totals")
    n_docs, n_terms = totals.first()
    # The product is taken in decimals, which no corpus overflows.
    m = F.expr(f"{100 - b} + cast(n AS decimal(12,0)) * cast({b * n_docs} AS decimal(16,0)) div cast({max(n_terms, 1)} AS decimal(19,0))")
    placed = each.withColumn("m", m.cast("bigint"))
    sizes = placed.groupBy("m").agg(F.ceil(F.count("*") / stratum).cast("int").alias("parts")).filter("parts > 1")
    sizes = written(sizes, "large-strata")  # at most one row for each STRATUM documents
    sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_ROWS else sizes
    dealt = placed.join(sizes, "m", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("row"), F.col("parts")), F.lit(0)))
    dealt = dealt.repartition("m", "part")  # a join by m alone would leave a large stratum's parts together
    # A row holds a whole part; small row groups bound what a reader decodes at once.
    strata = dealt.groupBy("m", "part").applyInArrow(_stratum, INDEX)
    # A row holds a whole part; small row groups bound what a reader decodes at once.
    return Index(_stored(strata, "strata", **{"parquet.block.size": 8 << 20, "parquet.page.size.row.check.min": 1}), totals)


def _stored(df: DataFrame, label: str, **options) -> DataFrame:
    """A table in the shared folder, packed tightly, as an index holds about as many bytes as its texts."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(compression="zstd", **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item, term``, each pair once."""
    each = forward(items, item_id, text)
    return each.select(F.col("id").alias("item"), F.explode(F.split("terms", " ")).alias("term")).distinct()


def weights(index: Index, terms: DataFrame) -> DataFrame:
    """``item, term, w`` for the terms that some document holds; w falls with the number of documents that hold it."""
    held = index.strata.select(F.explode(F.arrays_zip("terms", "dfs")).alias("t")).select(F.col("t.terms").alias("term"), F.col("t.dfs").alias("df"))
    df = held.join(terms.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    w = F.floor(F.lit(1000) * F.log((2 * F.col("n_docs") + 2) / (2 * F.col("df") + 1))).cast("bigint")
    totals = index.totals.first()
    return terms.join(df.withColumn("n_docs", F.lit(totals["n_docs"])), "term").select("item", "term", w.alias("w"))


class _Heaps:
    """The best documents of each item so far."""

    def __init__(self, n: int, top: int):
        self.top, self.least = top, np.zeros(n, np.int64)
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.known = np.zeros(0, bool)

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, known: np.ndarray) -> None:
        item, score = np.concatenate((self.item, item)), np.concatenate((self.score, score))
        doc, known = np.concatenate((self.doc, doc)), np.concatenate((self.known, known))
        order = np.lexsort((doc, known, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        order, item, place = order[place < self.top], item[place < self.top], place[place < self.top]
        self.item, self.score, self.doc, self.known = item, score[order], doc[order], known[order]
        full = place == self.top - 1
        self.least[item[full]] = self.score[full]


def _impact(tf: np.ndarray, m: int) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class _Stratum:
    """A stratum's postings of the queries' terms."""

    def __init__(self, row: dict[str, pa.Array], m: int, words: pa.Array):
        self.m, self.ids = m, row["ids"]
        word = pc.index_in(row["terms"], value_set=words)
        here = np.flatnonzero(word.is_valid().to_numpy(zero_copy_only=False))
        run_ends = row["run_ends"].to_numpy()
        self.run_ends, self.run_tfs = run_ends, row["run_tfs"].to_numpy().astype(np.int64)
        self.doc_ends, self.docs = row["doc_ends"].to_numpy(), row["docs"].to_numpy()
        #: The stratum's term of each word of the queries, or -1.
        self.term = np.full(len(words), -1, np.int64)
        self.term[word.take(pa.array(here)).to_numpy()] = here
        starts = np.append(0, run_ends)[:-1]
        #: Highest impact of a word: that of its first run, as runs fall in tf.
        self.highest = np.zeros(len(words), np.int64)
        found = np.flatnonzero(self.term >= 0)
        self.highest[found] = _impact(self.run_tfs[starts[self.term[found]]], m)
        self.starts = starts

    def scores(self, items: np.ndarray, word: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Scores of the stratum's documents (columns); pair i gives ``word[i]`` of weight ``w[i]`` to row ``items[i]``."""
        term = self.term[word]
        items, term, w = items[term >= 0], term[term >= 0], w[term >= 0]
        impact = _impact(self.run_tfs, self.m)  # once per term and tf
        first = np.append(0, self.doc_ends)
        begin, end = first[self.starts[term]], first[self.run_ends[term]]
        run = np.repeat(np.arange(len(self.doc_ends)), np.diff(first))
        n, k = (int(items.max()) + 1 if len(items) else 0), len(self.ids)
        out = np.zeros(n * k, np.int64)
        sizes = end - begin
        stop = np.searchsorted(np.cumsum(sizes), np.arange(0, sizes.sum() + CELLS, CELLS), "right")
        for a, b in zip(stop[:-1], np.append(stop[1:-1], len(sizes))):
            size = sizes[a:b]
            at = np.repeat(begin[a:b] - np.append(0, np.cumsum(size))[:-1], size) + np.arange(size.sum())
            # Sums below 2^53 are exact in doubles.
            part = np.bincount(np.repeat(items[a:b], size) * k + self.docs[at], np.repeat(w[a:b], size) * impact[run[at]], n * k)
            out += part.astype(np.int64)
        return out.reshape(n, k)


def _candidates(scores: np.ndarray, least: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Items and documents that may enter the heaps: no lower than the item's least score and its tenth here."""
    bar = np.maximum(least, 1)
    if scores.shape[1] > top:
        bar = np.maximum(bar, np.partition(scores, -top, axis=1)[:, -top])
    return np.nonzero(scores >= bar[:, None])


def _visits(n_items: int, item: np.ndarray, word: np.ndarray, w: np.ndarray, words: pa.Array, top: int):
    def visit(strata: list[_Stratum], heaps: _Heaps) -> None:
        bounds = np.stack([np.bincount(item, w * s.highest[word], n_items).astype(np.int64) for s in strata])
        for at in np.argsort(-bounds.max(axis=1), kind="stable"):
            s = strata[at]
            for start in range(0, n_items, max(1, CELLS // max(len(s.ids), 1))):
                stop = min(n_items, start + max(1, CELLS // max(len(s.ids), 1)))
                bound = bounds[at, start:stop]
                wanted = np.flatnonzero((bound > 0) & (bound >= heaps.least[start:stop])) + start
                if not len(wanted):
                    continue
                row = np.full(n_items, -1)
                row[wanted] = np.arange(len(wanted))
                mine = row[item] >= 0
                scores = s.scores(row[item[mine]], word[mine], w[mine])
                i, d = _candidates(scores, heaps.least[wanted[:len(scores)]], top)
                ids = s.ids.take(pa.array(d))
                heaps.add(wanted[i], scores[i, d], pc.fill_null(ids, 0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps, strata, held = _Heaps(n_items, top), [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].values for name in batch.schema.names if name != "m"}
                strata.append(_Stratum(row, batch.column("m")[k].as_py(), words))
                held += len(row["ids"])
                if held >= VISIT:
                    visit(strata, heaps)
                    strata, held = [], 0
        if strata:
            visit(strata, heaps)
        yield pa.RecordBatch.from_arrays(
            [pa.array(heaps.item), pa.array(heaps.score), pa.array(heaps.doc, mask=~heaps.known)], names=["place", "score", "doc_id"]
        )

    return run


def search(index: Index, items: DataFrame, item_id: str = "item_id", text: str = "text", top: int = TOP, block: int = BLOCK) -> DataFrame:
    """``item_id, rank, doc_id, score``: the best documents of each item."""
    weighed = written(weights(index, item_terms(items, item_id, text)), "item-terms")
    blocks = math.ceil(weighed.select("item").distinct().count() / block)
    spark, found = items.sparkSession, None
    for b in range(blocks):
        rows = weighed.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).orderBy("item", "term").toArrow()
        ids = rows["item"].combine_chunks().dictionary_encode(null_encoding="encode")
        words = rows["term"].combine_chunks().dictionary_encode()
        run = _visits(
            len(ids.dictionary), ids.indices.to_numpy().astype(np.int64), words.indices.to_numpy().astype(np.int64), rows["w"].to_numpy(),
            words.dictionary, top,
        )
        heaps = index.strata.mapInArrow(run, "place bigint, score bigint, doc_id bigint")
        named = spark.createDataFrame(list(enumerate(ids.dictionary.to_pylist())), "place bigint, item_id bigint")
        heaps = heaps.join(F.broadcast(named), "place").select("item_id", "score", "doc_id")
        found = heaps if found is None else found.unionByName(heaps)
    if found is None:
        found = spark.createDataFrame([], "item_id bigint, score bigint, doc_id bigint")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
