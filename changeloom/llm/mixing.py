r"""Mixing sources to target weights by balanced sampling (the cube method, in its fast form by Chauvet and Tillé, 2006).

Every document of a source is wanted target / source size times, between 0 and 3.  The whole part is given to all; the
fraction is an inclusion probability.  The flight phase moves the probabilities of a window of documents through
the null-space of the constraints (token total, document total), so both totals stay exact while at least one
of them reaches 0 or 1 in every move.  What stays open, two documents a source, is the landing problem: constraints are
given up one by one.  Documents come in order of falling size and the largest open one is moved first, so landing is
among the smallest.

A source is dealt into chunks of about ``CHUNK`` documents (a hot source into many); what a chunk leaves open, two
documents, goes to the next round, until one chunk a source lands.  A flight streams over sorted rows with ``WINDOW`` of them
in hand.  Random numbers are hashes of the documents, so reruns agree.

Defined results: null and empty texts have size 0 and may be taken without effect; rows equal in id, source and text are one
document of their joint size and share its number of copies; a null source is a source and comes last; an empty table
gives an empty table; other columns are carried by ``mix`` and not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from changeloom.llm.arrays import IS_SPACE, Texts, pieces
from changeloom.session import written

WEIGHTS = (5, 2, 1)
MOST = 3
CHUNK = 4_000
WINDOW = 64


def sized(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``id, source, digest, size, rows``: one row per document; size is the words of one of its rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                t = Texts.of(piece.column("text"))
                _, _, doc = t.runs(~IS_SPACE[t.data])
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(c) for c in ("id", "source", "digest")), pa.array(t.per_doc(doc))],
                    names=["id", "source", "digest", "size"],
                )

    kinds = {k: docs.schema[c].dataType.simpleString() for k, c in (("id", doc_id), ("source", source))}
    few = docs.select(
        F.col(doc_id).alias("id"), F.col(source).alias("source"), F.xxhash64(F.col(text)).alias("digest"), F.col(text).alias("text")
    )
    rows = few.mapInArrow(count, f"id {kinds['id']}, source {kinds['source']}, digest long, size long")
    return rows.groupBy("id", "source", "digest", "size").agg(F.count("*").alias("rows"))


def targets(units: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, target``: sources ranked by code point, null last, get repeating weights' shares of all sizes; a
    target stops at ``most`` times its source's size and the excess is shared again by weight."""
    sums = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    order = F.col("source").asc_nulls_last()
    dealt = written(sums.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "sources")
    # One row a partition: as many as the session's shuffle partitions.
    before = dealt.groupBy("part").count().select(
        "part", F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")
    )
    rank = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1 + F.col("before")
    weight = F.array(*[F.lit(float(w)) for w in weights])[F.pmod(rank, F.lit(len(weights))).cast("int")]
    # No broadcast hint: sources may be many.
    ranked = written(dealt.join(before, "part").select("source", "source_size", weight.alias("weight")), "source-weights")
    limit = most * F.col("source_size")
    whole = ranked.agg(F.sum("source_size").alias("all"), F.sum("weight").alias("weight")).first()
    level, last = (whole["all"] / whole["weight"] if whole["weight"] else 0.0), None
    while level != last:
        full = F.col("weight") * F.lit(level) >= limit
        now = ranked.agg(F.sum(F.when(full, limit)).alias("full"), F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        last = level
        if now["open"]:
            level = max(level, (whole["all"] - (now["full"] or 0)) / now["open"])
    return ranked.select("source", "source_size", F.least(F.col("weight") * F.lit(level), limit.cast("double")).alias("target"))


class Flight:
    """Open documents of one chunk, ``WINDOW`` at most: serial number, probability, token and row totals, random number."""

    def __init__(self):
        self.open = np.zeros((0, 5))
        self.decided: list[tuple[int, int]] = []
        self.waiting: list[tuple] = []

    def _settle(self) -> None:
        p = self.open[:, 1]
        closed = (p <= 1e-9) | (p >= 1 - 1e-9)
        self.decided += [(int(n), round(x)) for n, x in self.open[closed, :2].tolist()]
        self.open = self.open[~closed]

    def _direction(self) -> np.ndarray | None:
        """The first document's own axis, laid into the null-space of sizes and counts, or of sizes alone where the first can't
        move otherwise."""
        size, rows = self.open[:, 2], self.open[:, 3]
        for a in ([size, rows], [size]):
            a = np.stack(a)
            way = -a.T @ (np.linalg.pinv(a @ a.T) @ a[:, 0])
            way[0] += 1
            if way[0] > 1e-6:
                return way
        return None

    def _move(self, way: np.ndarray) -> None:
        """As far as the cube allows, forth or back by chance, so that probabilities hold on average."""
        p, up, down = self.open[:, 1], way > 1e-12, way < -1e-12
        forth = min(np.min((1 - p[up]) / way[up], initial=np.inf), np.min(-p[down] / way[down], initial=np.inf))
        back = min(np.min(p[up] / way[up], initial=np.inf), np.min((p[down] - 1) / way[down], initial=np.inf))
        p += way * (forth if self.open[0, 4] * (forth + back) < back else -back)
        self._settle()

    def _round_first(self) -> None:
        self.open[0, 1] = float(self.open[0, 4] < self.open[0, 1])
        self._settle()

    def _fly(self) -> None:
        way = self._direction()
        if way is None:
            self._round_first()
        else:
            self._move(way)

    def add(self, unit: tuple) -> None:
        """The first open document is the largest: it is moved until it settles, the smaller ones make up for it."""
        self.waiting.append(unit)
        if len(self.waiting) + len(self.open) >= WINDOW:
            self._take()
            while len(self.open) > WINDOW // 2:
                self._fly()

    def _take(self) -> None:
        if self.waiting:
            self.open = np.concatenate((self.open, np.array(self.waiting, float)))
            self.waiting = []

    def finish(self, land: bool) -> list[tuple[int, float]]:
        """Moves on while the null-space isn't empty; then lands, or gives back what stays open."""
        self._take()
        while len(self.open) > 2:
            self._fly()
        while land and len(self.open):
            self._fly() if len(self.open) > 1 else self._round_first()
        left = [(int(n), p) for n, p in self.open[:, :2].tolist()]
        self.open = self.open[:0]
        return left


def _fly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``one`` (0 or 1, null where open) and the probability reached; rows stand by chunk and falling size."""
    # Only rows still open leave their batch late: at most two a chunk.
    flight, chunk, last, held = Flight(), None, False, {}
    serial = 0

    def out(decided) -> pa.RecordBatch:
        rows = [held.pop(n) | {"one": one} for n, one in decided]
        return pa.RecordBatch.from_pylist(rows, schema)

    def end():
        return [held.pop(n) | {"p": p, "one": None} for n, p in flight.finish(land=last)]

    schema = None
    for batch in batches:
        if schema is None:
            fields = [f for f in batch.schema if f.name not in ("chunk", "last")]
            schema = pa.schema([*fields, pa.field("one", pa.int32())])
        late = []
        for row in batch.to_pylist():
            key, final = row.pop("chunk"), row.pop("last")
            if key != chunk:
                late += end()
                chunk, last = key, final
            held[serial] = row
            flight.add((serial, row["p"], row["size"] * row["rows"], row["rows"], row["random"]))
            serial += 1
        yield pa.RecordBatch.from_pylist(late, schema)
        decided, flight.decided = flight.decided, []
        yield out(decided)
    if schema is not None:
        rows = end()
        yield pa.RecordBatch.from_pylist(rows, schema)
        yield out(flight.decided)


def mixed(units: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``id, source, digest, size, rows, source_size, target, copies``: how often each document is taken."""
    spark = units.sparkSession
    of = written(targets(units).withColumnRenamed("source", "of"), "targets")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = units.join(of, units["source"].eqNullSafe(of["of"])).drop("of")
    joined = joined.withColumn("times", times).withColumn("whole", F.floor("times").cast("int"))
    # 31 bits of hash as a number from 0 to 1.
    random = F.shiftrightunsigned(F.xxhash64("id", "digest", F.lit("mix")), 33) / F.lit(float(1 << 31))
    rows = joined.select(*units.columns, "source_size", "target", "whole", (F.col("times") - F.col("whole")).alias("p"), random.alias("random"))
    sure = F.col("p") <= 0
    given = rows.filter(sure).withColumn("one", F.lit(0))
    done, open_ = [given], rows.filter(~sure)
    columns = given.columns
    number = 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    while True:
        sizes = open_.groupBy("source").agg(F.ceil(F.count("*") / chunk).cast("int").alias("chunks"))
        most = sizes.agg(F.max("chunks")).first()[0] or 0
        if not most:
            break
        sizes = sizes.withColumnRenamed("source", "of")
        dealt = open_.join(sizes, open_["source"].eqNullSafe(sizes["of"])).drop("of")
        key = F.xxhash64("source", F.pmod(F.xxhash64("id", "digest", F.lit(number)), F.col("chunks")))
        dealt = dealt.withColumn("chunk", key).withColumn("last", F.col("chunks") == 1).drop("chunks", "one")
        dealt = dealt.repartition(parts, "chunk").sortWithinPartitions("chunk", F.desc("size"), "random", "id", "digest")
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema if f.name not in ("chunk", "last"))
        flown = written(dealt.mapInArrow(_fly, f"{kinds}, one int"), "flight")
        done.append(flown.filter(F.col("one").isNotNull()).select(columns))
        if most == 1:
            break
        open_, number = flown.filter(F.col("one").isNull()), number + 1
    every = done[0]
    for more in done[1:]:
        every = every.union(more)
    return every.select(*units.columns, "source_size", "target", (F.col("whole") + F.col("one")).alias("copies"))


def taken(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Per row: id, ``size``, ``source_size``, ``target`` of its source, ``taken`` words."""
    units = written(sized(docs, doc_id, source, text), "sizes")
    each = mixed(units).select("*", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return each.select(
        F.col("id").alias(doc_id), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mix itself: every row of the input as often as it is taken, with all its columns."""
    units = written(sized(docs, doc_id, source, text), "sizes")
    copies = mixed(units).filter(F.col("copies") > 0).select("id", F.col("source").alias("of"), "digest", "copies")
    rows, row = docs.select(F.struct("*").alias("row")), F.col("row")
    same = (
        row.getField(doc_id).eqNullSafe(F.col("id")) & row.getField(source).eqNullSafe(F.col("of"))
        & F.xxhash64(row.getField(text)).eqNullSafe(F.col("digest"))
    )
    return rows.join(copies, same).select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
