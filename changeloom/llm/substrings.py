r"""Removes every byte covered by a 200-byte string that starts anywhere else, too.

**Candidates.**  Of the ``GRAM``-byte strings inside a window of 200 bytes, the one with the smallest hash (the first
of equals) is the window's anchor.  Equal windows have equal anchors, so only windows whose anchor's hash stands twice or
more in the corpus can repeat, and all windows that can be equal meet under one hash.  A run of window starts with one
anchor is one row, a *strand*: some 70 starts, so about one row per 70 bytes is shuffled, never one per byte.

**Decision.**  Equal strands are folded with their number (counted with map-side combining).  The distinct strands
of an anchor come from different shards of the corpus; their suffixes are merged as Burrows-Wheeler transforms are, by
iterative interleave refinement (Holt and McMillan, 2014): the interleave starts as one shard after another; each round
reads the symbols before every suffix (two at a time) and deals the suffixes stably by them.  After h symbols the interleave
is right for h of them and its blocks are the intervals with a common prefix of h, so 100 rounds give the repeated intervals
without sorting suffixes.  A block of one is final and leaves, and only suffixes that still lead to a window start are carried.
An anchor with a single distinct strand has one block from the start and needs no round.

**Scale.**  Tasks hold ``BUCKET`` bytes of strands.  An anchor with more than ``GROUP`` distinct strands is decided by
counting its windows one by one with a digest each, which no task holds whole.  Texts are shuffled twice (packed): to
cut the strands' bytes, and to meet their removed runs.

Defined results: matches never cross documents and count inside one document too, overlaps included; null and empty texts and
texts below 200 bytes lose nothing; bytes are removed even inside a character, so the rest is binary; rows equal in id and
text are two documents, whose text thus stands twice; an empty table gives an empty table; other columns are not
looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F

from changeloom.llm.arrays import Texts, mix, pieces
from changeloom.llm.rewrite import SPAN, SPANS, digest, spans
from changeloom.session import written

LENGTH = 200
GRAM = 64
#: Distinct strands of one anchor that a task may hold.
GROUP = 20_000
#: Bytes of strands a task decides at once, about.
BUCKET = 8 << 20
PIECE = 1 << 20
#: Places told apart inside one stretch of the anchor search.
STRETCH = 1 << 23

_PLACE = np.uint64((1 << 24) - 1)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def strands(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of window starts with one anchor: first start, number of starts, anchor's place, anchor's hash."""
    width, found = LENGTH - GRAM + 1, []
    for low in range(0, len(t.data) - LENGTH + 1, STRETCH):
        high = min(low + STRETCH, len(t.data) - LENGTH + 1)
        at = np.arange(low, high + width - 1)
        h = t.hashes(at, at + GRAM)
        best = _sliding_min((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), width)
        starts = np.arange(low, high)
        # A window lies inside one document.
        room = np.repeat(t.at[1:], np.diff(t.at))[low:high]
        inside = starts + LENGTH <= room
        starts, anchor = starts[inside], (best[inside] & _PLACE).astype(np.int64)
        if not len(starts):
            continue
        new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)))
        heads = np.flatnonzero(new)
        found.append((starts[heads], np.diff(np.append(heads, len(starts))), anchor[heads] + low, h[anchor[heads]]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def pack(start: np.ndarray, size: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """A strand's place in its text, number of starts, and distance from its first start to its anchor, as one number."""
    return start << 20 | size << 10 | (shift + 1)


def all_strands(docs: DataFrame) -> DataFrame:
    """``h, c, place, id, digest`` of every strand: anchor's hash, hash of the strand's own bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                t = Texts.of(piece.column("text"))
                start, size, anchor, h = strands(t)
                c = mix(t.hashes(start, start + size + LENGTH - 1) + mix((anchor - start).astype(np.uint64) << np.uint64(32) | size.astype(np.uint64)))
                doc = t.doc_of(start) if len(start) else start
                # Empty documents share their offset with the next: the last one of them holds the bytes.
                place = pack(start - t.at[doc], size, anchor - start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), pa.array(place), piece.column("id").take(pa.array(doc)),
                     piece.column("digest").take(pa.array(doc))], names=["h", "c", "place", "id", "digest"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"h long, c long, place long, id {kind}, digest long")


def packed(docs: DataFrame) -> DataFrame:
    """``id, digest, bytes``: texts compressed for the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            small = pa.array([None if x is None else tool.compress(x) for x in texts.to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("digest"), small], names=["id", "digest", "bytes"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, digest long, bytes binary")


def _with_texts(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Texts beside what was found of them: ``id, bytes, found``."""
    other = found.select(F.col("id").alias("found_id"), F.col("digest").alias("found_digest"), "found")
    small = packed(docs)
    return small.join(
        other, small["id"].eqNullSafe(other["found_id"]) & small["digest"].eqNullSafe(other["found_digest"]), how
    ).select("id", "bytes", "found")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strands' bytes."""
    tool = zstandard.ZstdDecompressor()
    for batch in batches:
        for small, found in zip(batch.column("bytes"), batch.column("found")):
            text, rows = tool.decompress(small.as_py()), found.as_py()
            for row in rows:
                start, size = row["place"] >> 20, row["place"] >> 10 & 1023
                row["size"], row["shift"], row["bytes"] = size, (row["place"] & 1023) - 1, text[start:start + size + LENGTH - 1]
            yield pa.RecordBatch.from_pylist([{k: r[k] for k in ("h", "c", "copies", "size", "shift", "bytes")} for r in rows], _STRAND)


_STRAND = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("copies", pa.int64()), ("size", pa.int32()), ("shift", pa.int32()), ("bytes", pa.binary())])


def repeated_starts(text: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Flags the places (ascending) in ``text`` whose ``length`` symbols stand at another of the places, too."""
    # A round reads the two symbols before a suffix as one, so 200 symbols take 100 rounds.
    pairs = (text[:-1].astype(np.uint16) << np.uint16(8)) | text[1:]
    suffix, block = starts + length, np.zeros(len(starts), np.int32)
    for h in range(0, length, 2):
        suffix = suffix - 2
        order = np.argsort(pairs[suffix], kind="stable")
        suffix, block = suffix[order], block[order]
        symbol = pairs[suffix]
        head = np.ones(len(suffix) + 1, bool)
        head[1:-1] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
        block = np.cumsum(head[:-1], dtype=np.int32)
        if h % 4 == 2 or h == length - 2:
            shared = ~(head[:-1] & head[1:])  # a block of one is final
            suffix, block = suffix[shared], block[shared]
    out = np.zeros(len(starts), bool)
    out[np.searchsorted(starts, suffix)] = True
    return out


def _runs(flags: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return spans(edges[::2], edges[1::2])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which starts of each strand repeat: ``h, c, runs``; all strands of an anchor are in one task."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    t = pa.Table.from_batches(held).combine_chunks()
    strand = t["bytes"].combine_chunks()
    at = np.frombuffer(strand.buffers()[1], np.int32, len(strand) + 1, strand.offset * 4).astype(np.int64)
    text = np.frombuffer(strand.buffers()[2], np.uint8)
    size, copies = t["size"].to_numpy().astype(np.int64), t["copies"].to_numpy()
    first = np.cumsum(size) - size
    starts = np.repeat(at[:-1] - first, size) + np.arange(size.sum())
    flags = repeated_starts(text, starts) | np.repeat(copies > 1, size)
    rows = [(k, _runs(flags[a:a + n])) for k, (a, n) in enumerate(zip(first.tolist(), size.tolist())) if flags[a:a + n].any()]
    kept = pa.array([k for k, _ in rows], pa.int64())
    yield pa.RecordBatch.from_arrays(
        [t["h"].combine_chunks().take(kept), t["c"].combine_chunks().take(kept), pa.array([r for _, r in rows], SPAN)], names=["h", "c", "runs"]
    )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each window of the strands: ``h, c, nr, window, copies``."""
    for batch in batches:
        for row in batch.to_pylist():
            n = row["size"]
            digests = [hashlib.blake2b(row["bytes"][k:k + LENGTH], digest_size=16).digest() for k in range(n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["h"]] * n), pa.array([row["c"]] * n), pa.array(range(n), pa.int32()), pa.array(digests, pa.binary()),
                 pa.array([row["copies"]] * n)], names=["h", "c", "nr", "window", "copies"],
            )


def _joined_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        runs = []
        for numbers in batch.column("nrs").to_pylist():
            flags = np.zeros(max(numbers) + 1, bool)
            flags[numbers] = True
            runs.append(_runs(flags))
        yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("c"), pa.array(runs, SPAN)], names=["h", "c", "runs"])


def decided(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """``id, digest, found``: for each text with repeated windows, its strands' places and repeated runs of starts."""
    spark = docs.sparkSession
    each = all_strands(docs)
    often = each.groupBy("h").count().filter("count > 1").select("h")
    met = written(each.join(often, "h"), "strands")
    place = F.struct("id", "digest", "place")
    distinct = met.groupBy("h", "c").agg(F.count("*").alias("copies"), F.min(place).alias("one"))
    distinct = written(distinct, "distinct-strands")
    sizes = distinct.groupBy("h").agg(F.count("*").alias("kinds"))
    several = written(distinct.join(sizes, "h").filter("kinds > 1"), "strands-to-merge")

    wanted = several.groupBy(F.col("one.id").alias("id"), F.col("one.digest").alias("digest")).agg(
        F.collect_list(F.struct("h", "c", "copies", F.col("one.place").alias("place"))).alias("found")
    )
    cut = "h long, c long, copies long, size int, shift int, bytes binary"
    # Rows equal in id and text give their strands more than once.
    fetched = written(_with_texts(docs, wanted, "inner").mapInArrow(_cut, cut).dropDuplicates(["h", "c"]), "strand-bytes")
    total = fetched.agg(F.sum(F.length("bytes"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // BUCKET + 1)
    hot = sizes.filter(F.col("kinds") > group).select("h")
    merged = fetched.join(hot, "h", "left_anti").repartition(parts, "h").mapInArrow(_merge, f"h long, c long, runs {SPANS}")
    windows = fetched.join(hot, "h", "left_semi").mapInArrow(_windows, "h long, c long, nr int, window binary, copies long")
    again = windows.groupBy("h", "window").agg(F.sum("copies").alias("all")).filter(F.col("all") > 1).drop("all")
    counted = windows.join(again, ["h", "window"]).groupBy("h", "c").agg(F.collect_list("nr").alias("nrs"))
    counted = counted.mapInArrow(_joined_runs, f"h long, c long, runs {SPANS}")
    runs = written(merged.union(counted), "repeated-runs")

    alone = distinct.join(sizes.filter("kinds = 1").select("h"), "h", "left_semi").select(
        "h", "c", F.array(F.struct(F.lit(0).cast("long").alias("from_byte"), F.shiftright("one.place", 10).bitwiseAND(F.lit(1023)).cast("long").alias("to_byte"))).alias("runs")
    )
    return met.join(runs.union(alone), ["h", "c"]).groupBy("id", "digest").agg(
        F.collect_list(F.struct("place", "runs")).alias("found")
    )


def _covered(found: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row's repeated runs of starts: row, first byte and the byte behind the last they cover."""
    strand = found.flatten()
    runs = strand.field("runs")
    run, count = runs.flatten(), pc.list_value_length(runs).to_numpy()
    row = np.repeat(np.arange(len(found)), pc.fill_null(pc.list_value_length(found), 0).to_numpy())
    start = np.repeat(strand.field("place").to_numpy() >> 20, count)
    return np.repeat(row, count), start + run.field("from_byte").to_numpy(), start + run.field("to_byte").to_numpy() - 1 + LENGTH


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tool = zstandard.ZstdDecompressor()
    for batch in batches:
        row, start, end = _covered(batch.column("found"))
        first = np.searchsorted(row, np.arange(batch.num_rows + 1))
        rows = []
        for k, small in enumerate(batch.column("bytes").to_pylist()):
            text, a, b = tool.decompress(small) if small is not None else b"", first[k], first[k + 1]
            if a == b:
                rows.append((len(text), 0, [], text))
                continue
            n = len(text) + 1
            gone = np.cumsum(np.bincount(start[a:b], minlength=n) - np.bincount(end[a:b], minlength=n))[:-1] > 0
            rows.append((len(text), int(gone.sum()), _runs(gone), np.frombuffer(text, np.uint8)[~gone].tobytes()))
        n, removed, runs, kept = zip(*rows) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, SPAN), pa.array(kept, pa.binary())],
            names=["id", "n_bytes", "n_removed", "spans", "kept"],
        )


def dedup_substrings(table: DataFrame, doc_id: str = "doc_id", text: str = "text", group: int = GROUP) -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_removed``, ``spans`` (removed runs in the text's bytes) and ``kept``, the other bytes."""
    docs = table.select(F.col(doc_id).alias("id"), digest(F.col(text)).alias("digest"), F.col(text).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    out = _with_texts(docs, decided(docs, group), "left").mapInArrow(_kept, f"id {kind}, n_bytes long, n_removed long, spans {SPANS}, kept binary")
    return out.withColumnRenamed("id", doc_id)
