"""Embedding near-dedup: cosine links within a label by int8 tile products with rigorous error bounds.

Equal vectors are folded first (a hash of 128 bits), with their number.  A label's distinct vectors are dealt into blocks,
and each pair of blocks is one task's tile.  A unit vector x is kept as scale s and int8 vector q; the norm e of the
remainder x - s q is measured, so the true cosine of x and y lies within e_x + e_y + e_x e_y of s_x s_y (q_x . q_y).
The product of small integers is exact in the matrix product used.  Pairs below the threshold by that bound are
done, pairs above it are links, and only pairs between are computed again from the vectors in double precision.

A tile gives each vector's number of links and a spanning forest of its links, never the pairs; so a group of copies with a
third of all rows costs no more than other rows.  Work within a label grows with the square of its distinct vectors,
as an exact search by this method does; a large label is many tiles of equal size.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component, and vectors without a label,
have no link; vectors of different lengths don't link; repeated rows are vectors of their own and link with each other; a null
id is never the smallest unless it is alone; an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from changeloom.llm.components import components, forest
from changeloom.session import written

THRESHOLD = 0.93
#: Vectors of a block; a tile holds two blocks.
BLOCK = 2048
#: Rows of a tile multiplied at once.
STRIP = 512
#: Slack for rounding in double precision.
ROUND = 1e-12


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 vectors, scales, and upper bounds for the norms of what they leave out."""
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    return q, scale, np.linalg.norm(unit - scale[:, None] * q, axis=1) + ROUND


def strip_links(vectors: np.ndarray, norms: np.ndarray, q: np.ndarray, scale: np.ndarray, error: np.ndarray,
                rows: slice, columns: slice, threshold: float) -> np.ndarray:
    """Which rows link with which columns."""
    # Products of int8 vectors are whole numbers below 2^24 (2^53): exact in float (double).
    kind = np.float32 if q.shape[1] * 127 * 127 < 1 << 24 else np.float64
    near = (q[rows].astype(kind) @ q[columns].astype(kind).T) * (scale[rows, None] * scale[None, columns])
    bound = error[rows, None] + error[None, columns] + error[rows, None] * error[None, columns]
    links = near - bound >= threshold + ROUND
    i, j = np.nonzero((near + bound >= threshold - ROUND) & ~links)
    for s in range(0, len(i), 100_000):
        a, b = i[s:s + 100_000], j[s:s + 100_000]
        x, y = a + rows.start, b + columns.start
        links[a, b] = np.einsum("ij,ij->i", vectors[x], vectors[y]) / (norms[x] * norms[y]) >= threshold
    return links


def _tile(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        rep, own = np.array(table["rep"].to_pylist(), object), table["own"].to_numpy()
        order = np.argsort(own, kind="stable")
        rep, own, copies = rep[order], own[order], table["copies"].to_numpy()[order]
        flat = table["embedding"].combine_chunks()
        vectors = flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(flat), -1)[order]
        norms = np.linalg.norm(vectors, axis=1)
        q, scale, error = quantised(vectors / norms[:, None])
        n = len(own)
        cut = int(np.searchsorted(own, own[-1])) if own[0] != own[-1] else 0
        links, label = np.zeros(n, np.int64), np.arange(n)
        for start in range(0, cut or n, STRIP):
            rows, columns = slice(start, min(start + STRIP, cut or n)), slice(cut if cut else start, n)
            found = strip_links(vectors, norms, q, scale, error, rows, columns, threshold)
            if not cut:  # a block with itself: each pair once
                found &= np.arange(found.shape[1])[None] > np.arange(found.shape[0])[:, None]
            links[rows] += found @ copies[columns]
            links[columns] += copies[rows] @ found
            i, j = np.nonzero(found)
            if len(i):
                label = forest(n, np.concatenate((np.arange(n), i + rows.start)), np.concatenate((label, j + columns.start)))
        some, linked = links > 0, label != np.arange(n)
        return pa.table({
            "a": pa.array([*rep[some], *rep[linked]], pa.string()),
            "b": pa.array([*[None] * int(some.sum()), *rep[label[linked]]], pa.string()),
            "links": pa.array([*links[some].tolist(), *[0] * int(linked.sum())], pa.int64()),
        })

    return run


def usable(embedding: Column, label: Column) -> Column:
    """Has a label, and a cosine."""
    number = F.transform(embedding, lambda x: x.cast("double"))
    bad = F.exists(number, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(label.isNotNull() & ~bad & F.exists(number, lambda x: x != 0), F.lit(False))


def near_vectors(
    table: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, vec_id: str = "vec_id", embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """Per row: id, ``n_links``, ``component_id`` (smallest id reachable) and ``kept`` (whether it is its own)."""
    e, of = F.col("embedding"), F.col("label")
    rows = table.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"), F.col(label).alias("label"))
    half = [F.lpad(F.hex(F.xxhash64(F.lit(k), of, e)), 16, "0") for k in (1, 2)]
    rows = rows.select("*", F.when(usable(e, of), F.concat(*half)).alias("rep"))
    reps = written(
        rows.filter("rep IS NOT NULL").groupBy("rep").agg(
            F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.count("*").alias("copies"),
            F.min("vec_id").alias("least"),
        ).withColumn("length", F.size("embedding")), "vectors",
    )
    blocks = reps.groupBy("label", "length").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = reps.join(blocks, ["label", "length"]).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = dealt.select(
        "label", "length", "rep", "embedding", "copies", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other")).drop("other")
    found = written(
        dealt.groupBy("label", "length", "low", "high").applyInArrow(_tile(threshold), "a string, b string, links long"), "tiles"
    )
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    roots = components(found.filter("b IS NOT NULL").select("a", "b")).select(F.col("node").alias("rep"), "root")
    each = reps.select("rep", "copies", "least").join(counts, "rep", "left").join(roots, "rep", "left").withColumn(
        "root", F.coalesce("root", "rep")
    )
    least = each.groupBy("root").agg(F.min("least").alias("component_id"))
    each = each.join(least, "root").select(
        "rep", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    out = rows.select("vec_id", "rep").join(each, "rep", "left").withColumn(
        "component_id", F.when(F.col("rep").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    )
    return out.select(
        F.col("vec_id").alias(vec_id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
