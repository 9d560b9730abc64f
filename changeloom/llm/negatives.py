"""Hard negatives by integer inner products: Strassen multiplication on tiles, mergeable heaps of positives and windows.

Each component x becomes the integer floor(scale x).  Rows are dealt into blocks by a row number that is written first, and a
block of anchors with a block of candidates is one task's tile.  A tile's scores come strip by strip from Strassen's recursion on
matrices padded with zeros: seven products of half the size instead of eight.  Integers are held as floats where every sum on the
way is a whole number that the float holds exactly, by a bound from the rows' norms, and as int64 otherwise: additions are then
modulo 2^64, so every score that fits 64 bits is exact (a hundred times a score must fit, too).  Heaps keep, per anchor, the best
candidates of the anchor's label, which alone are multiplied; a score below a heap's last one is passed over by one comparison.
The tiles' heaps merge to the anchor's positives.  Each positive's score gives a window of scores; a second pass over the same blocks keeps, per
anchor and window, the best candidates of other labels, and these heaps merge to the negatives.

Anchors are a stated share of the rows and meet all rows in blocks, so work is anchors times rows; a tile gives at most
``positives`` (``positives`` times ``negatives``) rows an anchor.  A row moves once for each block of the other side: blocks are as large as a
task's memory allows, whatever the number of rows, and vectors move as packed integers.  A block's size does not depend on labels or ids, so a
label or a repeated row with a third of all rows changes nothing.

Defined results: rows without a label, or whose vector is null or holds a null or non-finite component (or one whose
integer leaves 64 bits), take no part; vectors of different lengths aren't compared, empty ones have score 0; repeated rows are rows of
their own, as anchors, positives and negatives; a row without an id is no anchor and comes last among equal scores; anchors
without positives, and positives without negatives, give no row; an empty table gives an empty table; other
columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from changeloom.session import written

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: A negative's score lies between these hundredths of its positive's.
LOW, HIGH = 50, 95
#: Rows of a block of anchors and of candidates, and numbers in their vectors, at most.
ANCHORS, CANDIDATES = 1 << 16, 1 << 18
CELLS = 1 << 24
#: Smaller tables are dealt into so many blocks of candidates, each of so many rows at least.
SHARES, LEAST_ROWS = 32, 4096
MOST_TASKS = 10_000
#: Anchors and candidates of a strip of scores.
STRIP = 512, 1024
#: A strip with a larger share of open scores is searched as a whole.
DENSE = 1 / 64
#: Sides up to which matrices are multiplied directly.
LEAF = 32


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b.T`` of int64 matrices, exact modulo 2^64.

    Sides above ``leaf`` are padded with zeros to a multiple of a power of two, so that each halving is even.
    """
    kind = exact_kind(longest(a), longest(b), _depth(a, b, leaf))
    return multiplied(a.astype(kind), b.astype(kind), leaf).astype(np.int64)


def longest(rows: np.ndarray) -> float:
    """The largest norm of integer vectors."""
    wide = rows.astype(float)
    return math.sqrt(np.einsum("ij,ij->i", wide, wide).max(initial=0))


def exact_kind(a: float, b: float, depth: int) -> type:
    """The smallest type that multiplies vectors of such norms exactly.

    A level of the recursion adds two parts of vectors on either side and four products, so any sum on the way, in any order, is below
    4^(depth + 1) times both norms, by Cauchy and Schwarz.
    """
    top = 4.0 ** (depth + 1) * max(a, 1) * max(b, 1) * 1.001
    return np.float32 if top < 1 << 24 else np.float64 if top < 1 << 53 else np.int64


def _depth(a: np.ndarray, b: np.ndarray, leaf: int) -> int:
    """All three sides are halved together, until the shortest is a leaf."""
    shortest = min(*a.shape, len(b))
    return max(0, math.ceil(math.log2(shortest / leaf))) if shortest else 0


def multiplied(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b.T`` in the type of both matrices, which ``exact_kind`` gives."""
    sides, depth = (a.shape[0], a.shape[1], b.shape[0]), _depth(a, b, leaf)
    step = 1 << depth
    n, k, m = (-(-s // step) * step for s in sides)
    out = np.empty((n, m), a.dtype)
    spare = [np.empty((n >> depth - d, m >> depth - d), a.dtype) for d in range(depth)]
    _product(_padded(a, n, k), _padded(b, m, k), depth, out, spare)
    return out[:sides[0], :sides[2]]


def _padded(rows: np.ndarray, n: int, k: int) -> np.ndarray:
    if rows.shape == (n, k):
        return rows
    out = np.zeros((n, k), rows.dtype)
    out[:rows.shape[0], :rows.shape[1]] = rows
    return out


def _product(a: np.ndarray, b: np.ndarray, depth: int, out: np.ndarray, spare: list[np.ndarray]) -> None:
    """Strassen's seven products, added up in ``out``; ``b`` is held transposed, which keeps both operands' rows together in memory.

    ``spare`` has a matrix for each depth.
    """
    if depth == 0:
        np.matmul(np.ascontiguousarray(a), np.ascontiguousarray(b).T, out=out)
        return
    n, k, m = a.shape[0] // 2, a.shape[1] // 2, b.shape[0] // 2
    a11, a12, a21, a22 = a[:n, :k], a[:n, k:], a[n:, :k], a[n:, k:]
    b11, b21, b12, b22 = b[:m, :k], b[:m, k:], b[m:, :k], b[m:, k:]
    c11, c12, c21, c22 = out[:n, :m], out[:n, m:], out[n:, :m], out[n:, m:]
    d, p = depth - 1, spare[depth - 1]
    _product(a11 + a22, b11 + b22, d, c11, spare)
    _product(a21 + a22, b11, d, c21, spare)
    _product(a11, b12 - b22, d, c12, spare)
    np.subtract(c11, c21, out=c22)
    c22 += c12
    _product(a22, b21 - b11, d, p, spare)
    c11 += p
    c21 += p
    _product(a11 + a12, b22, d, p, spare)
    c11 -= p
    c12 += p
    _product(a21 - a11, b11 + b12, d, p, spare)
    c22 += p
    _product(a12 - a22, b21 + b22, d, p, spare)
    c11 += p


_LEAST = np.iinfo(np.int64).min


def best(scores: np.ndarray, open_: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and place (from 0) of each row's k highest open scores; the leftmost of equal ones first."""
    left, open_ = np.where(open_, scores, _LEAST), open_.copy()
    at = np.arange(len(left))
    rows, columns, places = [], [], []
    for place in range(k if left.shape[1] else 0):
        column = left.argmax(axis=1)
        some = open_[at, column]
        if not some.all():  # the least integer may be a score
            some = open_.any(axis=1)
            column = np.where(open_[at, column], column, open_.argmax(axis=1))
        if not some.any():
            break
        rows.append(at[some])
        columns.append(column[some])
        places.append(np.full(int(some.sum()), place))
        left[at[some], column[some]] = _LEAST
        open_[at[some], column[some]] = False
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate([none, *x]).astype(np.int64) for x in (rows, columns, places))


class _Heaps:
    """The best candidates of each anchor of a strip in each of its windows of scores; candidates come in the order that breaks ties.

    ``low`` and ``high`` are the windows' bounds by anchor and window.
    """

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.high, self.k, self.windows = high, k, low.shape[1]
        #: What a further candidate must reach: the least score of the window, or more than its heap's last.
        self.bar = low.copy()
        self.owner, self.score, self.place = (np.zeros(0, np.int64) for _ in range(3))
        self.new: list[tuple[np.ndarray, ...]] = []

    def add(self, scores: np.ndarray, start: int, open_: Callable) -> None:
        """Take a strip's scores; ``open_`` tells which pairs of an anchor and a column of the strip count."""
        passed = scores >= self.bar.min(axis=1)[:, None]
        some = np.count_nonzero(passed)
        if some > scores.size * DENSE:
            fit = open_(np.arange(scores.shape[0])[:, None], np.arange(scores.shape[1])[None])
            for w in range(self.windows):
                i, j, _ = best(scores, fit & (scores >= self.bar[:, w, None]) & (scores <= self.high[:, w, None]), self.k)
                self._take(i, j, scores, w, start)
        elif some:
            i, j = _places(passed)
            fit = open_(i, j)
            i, j = i[fit], j[fit]
            score = scores[i, j]
            for w in range(self.windows):
                inside = (score >= self.bar[i, w]) & (score <= self.high[i, w])
                self._take(i[inside], j[inside], scores, w, start)
        if sum(len(x[0]) for x in self.new) * 2 > self.bar.size * self.k:
            self.merge()

    def _take(self, i: np.ndarray, j: np.ndarray, scores: np.ndarray, w: int, start: int) -> None:
        if len(i):
            self.new.append((i * self.windows + w, scores[i, j].astype(np.int64), j + start))

    def merge(self) -> None:
        """Merge what was added into the heaps and raise their bars."""
        owner, score, place = (np.concatenate(x) for x in zip((self.owner, self.score, self.place), *self.new))
        order = np.lexsort((place, ~score, owner))
        owner = owner[order]
        rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
        order, owner, rank = order[rank < self.k], owner[rank < self.k], rank[rank < self.k]
        self.owner, self.score, self.place, self.new = owner, score[order], place[order], []
        last = rank == self.k - 1
        self.bar.flat[owner[last]] = np.minimum(self.score[last], -_LEAST - 2) + 1


def _places(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the few true entries: words of eight are looked at first."""
    flat = np.ascontiguousarray(mask).reshape(-1)
    cut = len(flat) // 8 * 8
    words = np.flatnonzero(flat[:cut].view(np.uint64))
    at = (words[:, None] * 8 + np.arange(8)).reshape(-1)
    at = np.concatenate((at[flat[at]], cut + np.flatnonzero(flat[cut:])))
    return at // mask.shape[1], at % mask.shape[1]


class _Tile:
    """Anchors and candidates of a task, candidates in the order that breaks ties."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        role = table["is_anchor"].to_numpy()
        self.ids, self.row, self.label = table["id"].combine_chunks(), table["row"].to_numpy(), table["label"].to_numpy()
        self.windows = table["windows"].combine_chunks()
        vectors = _unpacked(table["vector"].combine_chunks(), table["length"][0].as_py())
        a, c = np.flatnonzero(role), np.flatnonzero(~role)
        unknown = self.ids.is_null().to_numpy(zero_copy_only=False)
        self.a, self.c = a, c[np.lexsort((self.row[c], self.ids.fill_null(0).to_numpy()[c], unknown[c]))]
        self.anchors, self.candidates = vectors[self.a], vectors[self.c]
        depth = max(0, math.ceil(math.log2(max(vectors.shape[1], 1) / LEAF)))
        self.kind = exact_kind(*(max((longest(v[s:s + 4096]) for s in range(0, len(v), 4096)), default=0) for v in (self.anchors, self.candidates)), depth)

    def strips(self, anchors: np.ndarray) -> Iterator[np.ndarray]:
        rows, _ = STRIP
        for s in range(0, len(anchors), rows):
            yield anchors[s:s + rows]

    def search(self, anchors: np.ndarray, candidates: np.ndarray | None, heaps: _Heaps, open_: Callable) -> None:
        """Give the heaps the scores of some anchors with some candidates (all, if None)."""
        left = self.anchors[anchors].astype(self.kind)
        n, s, size = len(self.c) if candidates is None else len(candidates), 0, STRIP[1] // 4
        while s < n:  # short strips first: they set the bars
            at = slice(s, s + size) if candidates is None else candidates[s:s + size]
            right = self.candidates[at].astype(self.kind)
            heaps.add(multiplied(left, right), s, lambda i, j, s=s: open_(i, j + s))
            s, size = s + size, min(2 * size, STRIP[1])
        heaps.merge()

    def rows_of(self, anchors: np.ndarray, candidates: np.ndarray, scores: np.ndarray) -> dict[str, pa.Array]:
        at = self.c[candidates]
        return {
            "anchor": pa.array(self.row[self.a[anchors]]), "row": pa.array(self.row[at]), "id": self.ids.take(pa.array(at)),
            "score": pa.array(scores),
        }


def _joined(parts: list[tuple[np.ndarray, ...]], n: int) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * n


_HEAP = "anchor bigint, row bigint, id bigint, score bigint"


def _positives(k: int):
    def run(table: pa.Table) -> pa.Table:
        t, parts = _Tile(table), []
        own, other = t.label[t.a], t.label[t.c]
        of, by = np.argsort(own, kind="stable"), np.argsort(other, kind="stable")
        own, other = own[of], other[by]
        for label in np.unique(own):
            mine = by[np.searchsorted(other, label):np.searchsorted(other, label, "right")]
            for a in t.strips(of[np.searchsorted(own, label):np.searchsorted(own, label, "right")]):
                least, most = (-np.inf, np.inf) if t.kind is not np.int64 else (_LEAST, -_LEAST - 1)
                heaps = _Heaps(np.full((len(a), 1), least, t.kind), np.full((len(a), 1), most, t.kind), k)
                rows, columns = t.row[t.a[a]], t.row[t.c[mine]]
                t.search(a, mine, heaps, lambda i, j, rows=rows, columns=columns: rows[i] != columns[j])
                parts.append((a[heaps.owner], mine[heaps.place], heaps.score))
        return pa.table(t.rows_of(*_joined(parts, 3)))

    return run


def _negatives(k: int, low: int, high: int, positives: int):
    def run(table: pa.Table) -> pa.Table:
        t, parts = _Tile(table), []
        windows = t.windows.take(pa.array(t.a))
        sizes = windows.value_lengths().fill_null(0).to_numpy()
        owner = np.repeat(np.arange(len(t.a)), sizes)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        flat = windows.flatten()
        least, most = (np.inf, -np.inf) if t.kind is not np.int64 else (-_LEAST - 1, _LEAST)  # no window: nothing fits
        score, row = np.zeros((len(t.a), positives), np.int64), np.full((len(t.a), positives), -1, np.int64)
        lows, highs = np.full(score.shape, least, t.kind), np.full(score.shape, most, t.kind)
        score[owner, place], row[owner, place] = flat.field("score").to_numpy(), flat.field("row").to_numpy()
        lows[owner, place], highs[owner, place] = -(-low * score[owner, place] // 100), high * score[owner, place] // 100
        for a in t.strips(np.arange(len(t.a))):
            heaps = _Heaps(lows[a], highs[a], k)
            own, other = t.label[t.a[a]], t.label[t.c]
            t.search(a, None, heaps, lambda i, j, own=own, other=other: own[i] != other[j])
            of, w = a[heaps.owner // positives], heaps.owner % positives
            parts.append((of, heaps.place, heaps.score, row[of, w], score[of, w]))
        of, candidates, scores, positive, positive_score = _joined(parts, 5)
        return pa.table(t.rows_of(of, candidates, scores) | {"positive": pa.array(positive), "positive_score": pa.array(positive_score)})

    return run


def _packed(scale: int):
    """Vectors as integers of the fewest bytes that hold a batch; rows whose vector takes no part are left out."""
    bound = (1 << 63) / scale - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            sizes = vectors.value_lengths().to_numpy()
            x = vectors.flatten().to_numpy(zero_copy_only=False)  # null components become nan
            with np.errstate(invalid="ignore"):
                fine = np.abs(x) <= bound
            keep = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[~fine], minlength=len(sizes)) == 0
            number = np.floor(x[np.repeat(keep, sizes)] * scale).astype(np.int64)
            kind = next(t for t in _WIDTHS if len(number) == 0 or (np.iinfo(t).min <= number.min() and number.max() <= np.iinfo(t).max))
            sizes = sizes[keep].astype(np.int32)
            ends = np.append(0, np.cumsum(sizes, dtype=np.int64) * kind.itemsize)
            packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(number.astype(kind))])
            rest = batch.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays(
                [rest.column("id"), rest.column("label"), packed.cast(pa.binary()), pa.array(sizes), rest.column("anchor")],
                names=["id", "label", "vector", "length", "anchor"],
            )

    return run


_WIDTHS = [np.dtype(t) for t in ("<i2", "<i4", "<i8")]


def _unpacked(packed: pa.Array, length: int) -> np.ndarray:
    """The rows of ``_packed`` vectors of one length, as integers of the widest kind among them."""
    if length == 0:
        return np.zeros((len(packed), 0), np.int64)
    width = pc.binary_length(packed).to_numpy() // length
    kinds = [t for t in _WIDTHS if (width == t.itemsize).any()]
    out = np.empty((len(packed), length), kinds[-1])
    for kind in kinds:
        at = np.flatnonzero(width == kind.itemsize)
        some = packed.take(pa.array(at)) if len(kinds) > 1 else packed
        ends = np.frombuffer(some.buffers()[1], np.int32)[some.offset:some.offset + len(some) + 1]
        out[at] = np.frombuffer(some.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(kind).reshape(-1, length)
    return out


def _tiles(rows: DataFrame, anchors: DataFrame, carried: str, tasks: int) -> DataFrame:
    """Each block of anchors beside each block of candidates, by length; ``carried`` is a column of anchors that candidates lack."""
    shape = ["id", "label", "row", "vector", "length", "is_anchor", "a_block", "c_block"]
    kind = dict(anchors.dtypes)[carried]
    one = anchors.withColumns({
        "is_anchor": F.lit(True), "c_block": F.explode(F.sequence(F.lit(0), F.col("c_blocks") - 1)),
    }).select(*shape, carried)
    other = rows.filter("a_blocks > 0").withColumns({
        "is_anchor": F.lit(False), "a_block": F.explode(F.sequence(F.lit(0), F.col("a_blocks") - 1)),
    }).select(*shape, F.lit(None).cast(kind).alias(carried))
    # By number, as each tile is a task's work, however few bytes it has.
    return one.unionByName(other).repartition(tasks, "length", "a_block", "c_block").groupBy("length", "a_block", "c_block")


def merged(heaps: DataFrame, key: list[str], k: int) -> DataFrame:
    """The first k of all heaps of a key, with their ``rank``: heaps merge as the top of their union."""
    order = Window.partitionBy(*key).orderBy(F.desc("score"), F.asc_nulls_last("id"), F.asc("row"))
    return heaps.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    table: DataFrame, is_anchor: Column, vec_id: str = "vec_id", embedding: str = "embedding", label: str | Column = "label",
    scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    anchors: int = ANCHORS, candidates: int = CANDIDATES,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows where ``is_anchor`` holds."""
    rows = table.select(
        F.col(vec_id).cast("long").alias("id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
        F.col(embedding).cast("array<double>").alias("vector"), F.coalesce(is_anchor & F.col(vec_id).isNotNull(), F.lit(False)).alias("anchor"),
    ).filter("label IS NOT NULL AND vector IS NOT NULL").mapInArrow(
        _packed(scale), "id bigint, label bigint, vector binary, length int, anchor boolean"
    ).withColumn("row", F.monotonically_increasing_id())
    # Written once: both passes and any repeated task then see the same row numbers.
    rows = written(rows, "integer-vectors")
    n, cells = F.count("*"), F.greatest("length", F.lit(1))
    least = F.least(F.lit(SHARES), F.ceil(n / LEAST_ROWS))
    counts = written(rows.groupBy("length").agg(n.alias("n"), F.count_if("anchor").alias("heads"), least.alias("shares")).select(
        "length",
        F.greatest(F.ceil(F.col("n") / F.least(F.lit(candidates), F.greatest(F.lit(1), F.floor(CELLS / cells)))), "shares").cast("int").alias("c_blocks"),
        F.ceil(F.col("heads") / F.least(F.lit(anchors), F.greatest(F.lit(1), F.floor(CELLS / 4 / cells)))).cast("int").alias("a_blocks"),
    ), "blocks")
    tiles = counts.agg(F.sum(F.col("a_blocks").cast("long") * F.col("c_blocks"))).first()[0] or 0
    tasks = max(1, min(tiles, MOST_TASKS))
    dealt = rows.join(counts, "length").withColumns({
        "c_block": F.pmod(F.xxhash64("row"), F.col("c_blocks")).cast("int"),
        "a_block": F.when(F.col("anchor"), F.pmod(F.xxhash64("row", F.lit(1)), F.col("a_blocks")).cast("int")),
    })
    heads = dealt.filter("anchor").drop("anchor")
    none = F.lit(None).cast("array<struct<row: bigint, score: bigint>>").alias("windows")
    found = _tiles(dealt.drop("anchor"), heads.select("*", none), "windows", tasks).applyInArrow(_positives(positives), _HEAP)
    kept = written(merged(found, ["anchor"], positives).select("anchor", "row", "id", "score"), "positives")
    windows = kept.groupBy("anchor").agg(F.collect_list(F.struct("row", "score")).alias("windows"))
    opened = heads.join(windows.withColumnRenamed("anchor", "row"), "row")
    found = _tiles(dealt.drop("anchor"), opened, "windows", tasks).applyInArrow(
        _negatives(negatives, low, high, positives), f"{_HEAP}, positive bigint, positive_score bigint"
    )
    last = merged(found, ["anchor", "positive"], negatives)
    named = kept.select("anchor", F.col("row").alias("positive"), F.col("id").alias("positive_id"))
    ids = heads.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return last.join(named, ["anchor", "positive"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
