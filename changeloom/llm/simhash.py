r"""SimHash near-dedup with a Gray-ordered hierarchical index.

Texts are lower-cased (A-Z), cut to words ``[^\x20\x09-\x0D]+`` and to shingles of three words; a fingerprint bit is 1
where more than half the shingles' XXH64 (seed 42) have it.  Fingerprints link at three or fewer differing bits.

Search works on distinct fingerprints.  Two linked ones share at least one of four 16-bit blocks, so each is sent
to four groups, rotated to let the block lead.  Within a group, codes are sorted by Gray rank, which puts codes with long
common bit patterns side by side; runs of them form upper nodes that hold the bits all their codes share.  A pair of
nodes whose shared bits differ in more than three places is dropped with everything below; one whose codes can't
differ in more is linked whole; the others open to their children.  A group above ``GROUP`` codes is dealt into chunks
and searched by pairs of chunks, so no task holds a hot group.  Each task gives a spanning forest of its links.

Shingle length and distance are parameters.  Links at d bits share at least ``lead`` of d + ``lead`` blocks, and fingerprints are
sent to a group for each choice of ``lead`` blocks, so the search is exact at any distance.  With ``similarity``, fingerprints only
propose: all pairs within the distance, and all texts of one fingerprint, link where their sets of shingles of ``SIMILAR`` words
have that Jaccard similarity.  Every pair is compared, so this work grows with the square of a group of near copies.

Defined results: null, empty and wordless texts have fingerprint zero and link like any other; repeated rows share a
fingerprint; with ``similarity`` wordless texts are alike and shorter texts are one shingle; null ids never are the smallest unless a group has no other; an empty table gives an empty table; columns
other than id and text are not looked at (``keep_one`` carries them).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from changeloom.llm.arrays import pieces
from changeloom.llm.components import components, forest
from changeloom.session import written

SEED = 42
SHINGLE = 3
DISTANCE = 3
#: Blocks that links are sure to share.
LEAD = 1
#: Words of the shingles that ``similarity`` compares.
SIMILAR = 5
#: Codes of one group held by a task; larger groups are searched by pairs of chunks.
GROUP = 200_000
#: Codes a task sorts at once, about.
TASK = 400_000
FANOUT = 8
FRONTIER = 200_000
#: Shingles whose bits are counted at once.
STEP = 200_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    words = text.translate(_LOWER).split()  # bytes split at the word rule's white space
    n = len(words) - shingle + 1
    if n < 1:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else [], np.uint64)
    runs = zip(*(words[k:] for k in range(shingle)))
    return np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(SEED)), np.uint64, n)


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints of documents with so many hashes each."""
    doc, sums = np.repeat(np.arange(len(counts)), counts), np.zeros((len(counts), 64), np.int64)
    for start in range(0, len(doc), STEP):
        part = doc[start:start + STEP]
        heads = np.flatnonzero(np.diff(part, prepend=-1))
        bits = np.unpackbits(hashes[start:start + STEP].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        sums[part[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int32)
    return np.packbits(2 * sums > counts[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id, digest, fp``: the fingerprint of every row; the digest tells texts of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", 2 << 20):
                each = [shingle_hashes(x, shingle) for x in piece.column("text").cast(pa.binary()).fill_null(b"").to_pylist()]
                codes = majority(np.concatenate(each), np.array([len(x) for x in each]))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), piece.column("digest"), pa.array(codes.view(np.int64))], names=["id", "digest", "fp"]
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    few = docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("digest"), F.col(text).alias("text"))
    return few.mapInArrow(run, f"id {kind}, digest long, fp long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


def close_pairs(
    codes: np.ndarray, group: np.ndarray, distance: int = DISTANCE, every_pair: bool = False
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between codes of one group: places in ``codes``, which stand sorted by group and Gray rank.  Stars stand for codes that
    are all near each other, unless every pair is asked for."""
    # Levels from the codes up: all bits set in every code below, bits set in any, first child of each node.
    levels = [(codes, codes, np.arange(len(codes)), group)]
    firsts: list[np.ndarray] = []
    while len(levels[-1][3]) > len(np.unique(levels[-1][3])):
        every, some, first, of = levels[-1]
        rank = np.arange(len(of)) - np.searchsorted(of, of)
        heads = np.flatnonzero(rank % FANOUT == 0)
        firsts.append(np.append(heads, len(of)))
        levels.append((np.bitwise_and.reduceat(every, heads), np.bitwise_or.reduceat(some, heads), first[heads], of[heads]))
    top = len(levels) - 1
    roots = np.arange(len(levels[top][0]))
    stack = [(top, part, part) for part in np.array_split(roots, max(1, len(roots) // FRONTIER))]
    while stack:
        level, p, q = stack.pop()
        every, some, first, _ = levels[level]
        fixed = ~(every[p] ^ some[p]) & ~(every[q] ^ some[q])
        apart = np.bitwise_count((every[p] ^ every[q]) & fixed)
        near = apart <= distance
        p, q, apart, fixed = p[near], q[near], apart[near], fixed[near]
        if level == 0:
            yield first[p[p != q]], first[q[p != q]]
            continue
        ends = np.append(first[1:], len(codes))
        # Every code below p is near every code below q: one star links them all.
        whole = (apart + np.bitwise_count(~fixed) <= distance) & (not every_pair)
        for node in (p[whole], q[whole]):
            size = ends[node] - first[node]
            offset = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            yield np.repeat(first[p[whole]], size), np.repeat(first[node], size) + offset
        p, q = p[~whole], q[~whole]
        heads = firsts[level - 1]
        for s in range(0, len(p), FRONTIER // 16):
            x, y = p[s:s + FRONTIER // 16], q[s:s + FRONTIER // 16]
            nx, ny = heads[x + 1] - heads[x], heads[y + 1] - heads[y]
            k = np.arange((nx * ny).sum()) - np.repeat(np.cumsum(nx * ny) - nx * ny, nx * ny)
            wide = np.repeat(ny, nx * ny)
            cx = np.repeat(heads[x], nx * ny) + k // wide
            cy = np.repeat(heads[y], nx * ny) + k % wide
            once = cx <= cy
            stack.append((level - 1, cx[once], cy[once]))


def _search(batches: Iterator[pa.RecordBatch], masks: list[int], distance: int, every_pair: bool) -> Iterator[pa.RecordBatch]:
    """Spanning links of a partition's groups, or every link; the whole of a group is here."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    t = pa.Table.from_batches(held)
    fp = t["fp"].to_numpy().view(np.uint64)
    # The bits a group shares are left out: they lead.
    rest = fp & ~np.array(masks, np.uint64)[t["block"].to_numpy()]
    keys = [t[k].to_numpy() for k in ("pair_b", "pair_a", "lead", "block")]
    order = np.lexsort((gray_rank(rest), *keys))
    changed = np.zeros(len(order), bool)
    for k in keys:
        k = k[order]
        changed[1:] |= k[1:] != k[:-1]
    group, codes = np.cumsum(changed), fp[order]
    sizes = np.bincount(group)
    codes, group = codes[sizes[group] > 1], group[sizes[group] > 1]
    if not len(codes):
        return

    def batch(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(codes[x].view(np.int64)), pa.array(codes[y].view(np.int64))], names=["a", "b"])

    pairs = close_pairs(codes, np.unique(group, return_inverse=True)[1], distance, every_pair)
    if every_pair:
        yield from (batch(x, y) for x, y in pairs)
        return
    label, a, b, held_links = np.arange(len(codes)), [], [], 0
    for x, y in pairs:
        a.append(x), b.append(y)
        held_links += len(x)
        if held_links > 2_000_000:
            label = forest(len(codes), np.concatenate((np.arange(len(codes)), *a)), np.concatenate((label, *b)))
            a, b, held_links = [], [], 0
    label = forest(len(codes), np.concatenate((np.arange(len(codes)), *a)), np.concatenate((label, *b)))
    linked = np.flatnonzero(label != np.arange(len(label)))
    yield batch(linked, label[linked])


def block_masks(distance: int, lead: int = LEAD) -> list[int]:
    """Bits of each choice of ``lead`` out of ``distance + lead`` blocks."""
    n = distance + lead
    if not 0 < n <= 64 or lead < 1:
        raise ValueError(f"{n} blocks of 64 bits")
    ends = [64 * k // n for k in range(n + 1)]
    blocks = [(1 << ends[k + 1]) - (1 << ends[k]) for k in range(n)]
    return [sum(chosen) for chosen in combinations(blocks, lead)]


def links(
    distinct: DataFrame, group: int = GROUP, task: int = TASK, distance: int = DISTANCE, lead: int = LEAD, every_pair: bool = False
) -> DataFrame:
    """``a, b``: links that connect what the links of all distinct ``fp`` connect; with ``every_pair`` all of them, some repeatedly."""
    masks = block_masks(distance, lead)
    blocks = F.array(*[
        F.struct(F.lit(k).alias("block"), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("lead"))
        for k, m in enumerate(masks)
    ])
    sent = distinct.select("fp", F.explode(blocks).alias("x")).select("fp", "x.block", "x.lead")
    # Groups above the bound: their number is at most 4 n / bound, and the optimizer broadcasts them only where they are small.
    hot = sent.groupBy("block", "lead").count().filter(F.col("count") > group).select(
        "block", "lead", F.ceil(2 * F.col("count") / group).cast("int").alias("chunks")
    )
    dealt = sent.join(hot, ["block", "lead"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    dealt = dealt.select("fp", "block", "lead", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    dealt = dealt.select("fp", "block", "lead", F.least("own", "other").alias("pair_a"), F.greatest("own", "other").alias("pair_b"))
    spark = distinct.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), len(masks) * distinct.count() // task)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _search(batches, masks, distance, every_pair)

    return dealt.repartition(parts, "block", "lead", "pair_a", "pair_b").mapInArrow(search, "a long, b long")


def shingle_sets(docs: DataFrame, text: str = "text", shingle: int = SIMILAR) -> DataFrame:
    """``digest, shingles``: the distinct shingles of each distinct text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                each = [np.unique(shingle_hashes(x, shingle)).view(np.int64) for x in piece.column("text").cast(pa.binary()).fill_null(b"").to_pylist()]
                yield pa.RecordBatch.from_arrays([piece.column("digest"), pa.array(each, pa.list_(pa.int64()))], names=["digest", "shingles"])

    few = docs.select(F.xxhash64(F.col(text)).alias("digest"), F.col(text).alias("text"))
    return few.mapInArrow(run, "digest long, shingles array<long>").dropDuplicates(["digest"])


def similar(docs: DataFrame, found: DataFrame, near: DataFrame, similarity: float, text: str = "text") -> DataFrame:
    """``a, b``: digests of texts of one fingerprint, or of two linked in ``near``, whose shingles are that similar."""
    texts = found.select("digest", "fp").distinct()
    one, two = texts.toDF("a", "fa"), texts.toDF("b", "fb")
    equal = one.join(two, (F.col("fa") == F.col("fb")) & (F.col("a") < F.col("b"))).select("a", "b")
    apart = near.toDF("fa", "fb").join(one, "fa").join(two, "fb").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = written(equal.union(apart).distinct(), "candidate-texts")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("digest")).distinct()
    sets = written(shingle_sets(docs, text).join(ends, "digest", "left_semi"), "shingle-sets")
    both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    common = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - common
    return both.filter((union == 0) | (common >= F.lit(similarity) * union)).select("a", "b")


def grouped(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE, lead: int = LEAD,
    similarity: float | None = None,
) -> DataFrame:
    """``id, digest, fp, root``: the fingerprint of every row and its component of fingerprints, or of similar texts."""
    found = written(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    distinct = written(found.select("fp").distinct(), "distinct-fingerprints")
    near = links(distinct, distance=distance, lead=lead, every_pair=similarity is not None)
    key = "fp"
    if similarity is not None:
        near, key = similar(docs, found, near.distinct(), similarity, text), "digest"
    roots = components(near).select(F.col("node").alias(key), "root")
    return found.join(roots, key, "left").select("id", "digest", "fp", F.coalesce("root", key).alias("root"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``fingerprint`` and ``component_id``, the smallest id its links reach."""
    rows = grouped(docs, doc_id, text)
    least = rows.groupBy("root").agg(F.min("id").alias("component_id"))
    return rows.join(least, "root").select(
        F.col("id").alias(doc_id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE, lead: int = LEAD,
    similarity: float | None = None,
) -> DataFrame:
    """One document of each component with all its columns: the first by id (nulls last), then text digest."""
    rows = grouped(docs, doc_id, text, shingle, distance, lead, similarity)
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", "digest")
    first = rows.groupBy("root").agg(F.min(rank).alias("first"))
    each = written(
        rows.groupBy("root", "id", "digest").count().join(first, "root").select(
            "id", "digest", "count", rank.eqNullSafe(F.col("first")).alias("stays")
        ), "near-duplicates",
    )
    one_row = docs.select(F.struct("*").alias("row"))

    def same(other: DataFrame):
        row = F.col("row")
        return row.getField(doc_id).eqNullSafe(other["id"]) & F.xxhash64(row.getField(text)).eqNullSafe(other["digest"])

    others = each.filter(~F.col("stays") | (F.col("count") > 1))
    alone = one_row.join(others, same(others), "left_anti").select("row.*")
    copied = each.filter(F.col("stays") & (F.col("count") > 1))
    # Rows equal in id and text: any one of them stays.
    one = one_row.join(copied, same(copied), "left_semi").groupBy(
        F.col("row").getField(doc_id).alias("i"), F.xxhash64(F.col("row").getField(text)).alias("d")
    ).agg(F.first("row").alias("row")).select("row.*")
    return alone.union(one)
