"""Running, rolling and trailing totals per key, in event order, safe for hot keys.

A plain window function puts a whole key into one task.  That is the best plan for ordinary
keys, and a dead end for a key that holds a third of all rows.  ``per_key`` therefore counts
rows per key first (map-side combined, reads only the key).  Keys up to ``max_rows`` rows take
plain windows; larger ones are range-partitioned by (key, order), so that Spark's own sampled
range bounds cut them into even chunks.  Chunk totals are tiny; their prefix sums are joined
back, and every total comes out exact.

All frames run from the start of the key, so each costs one step per row.  A frame of a given
width is the difference of two running totals and never scanned row by row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import shared_dir, written

#: Rows of one key that a single task may sort and scan.
MAX_ROWS_PER_KEY = 4_000_000
#: Tables of chunk totals or hot keys up to this many rows are broadcast, larger ones are joined.
BROADCAST_ROWS = 200_000

_CHUNK = "_chunk"


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def per_key(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    body: Callable[[DataFrame, "Scan"], DataFrame],
    max_rows: int | None = None,
) -> DataFrame:
    """Run ``body(rows, scan)`` over all keys; ``scan`` hides how large keys are split.

    ``order`` names the columns of the event order within a key; together they should tell
    rows apart.
    """
    shared_dir(df.sparkSession)  # a missing setting shows now, not on the day a key grows large
    limit = max_rows or MAX_ROWS_PER_KEY
    counts = df.groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_rows"))
    hot = counts.filter(F.col("_rows") > limit)
    n_hot, n_rows = hot.agg(F.count(F.lit(1)), F.sum("_rows")).first()
    if not n_hot:
        return body(df, Scan(key, order))
    hot = _small(written(hot, "hot-keys"), n_hot)
    match = df[key].eqNullSafe(hot["_hot"])
    cold_rows = df.join(hot, match, "left_anti")
    hot_rows = df.join(hot, match, "left_semi")
    chunks = math.ceil(n_rows / limit) + 1
    return body(cold_rows, Scan(key, order)).unionByName(
        body(hot_rows, SplitScan(key, order, chunks, limit))
    )


class Scan:
    """Totals by plain windows: one exchange and one sort by (key, order) serve all calls."""

    def __init__(self, key: str, order: Sequence[str]):
        self.key = key
        self.order = list(order)

    def _sorted(self):
        return Window.partitionBy(self.key).orderBy(*self.order)

    def running(
        self,
        df: DataFrame,
        sums: Mapping[str, Column] | None = None,
        lasts: Mapping[str, Column] | None = None,
        firsts: Mapping[str, Column] | None = None,
    ) -> DataFrame:
        """Add running sums (current row included), last non-null values before the row, and
        first non-null values up to the row."""
        upto = self._sorted().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = self._sorted().rowsBetween(Window.unboundedPreceding, -1)
        return df.select(
            "*",
            *[F.sum(c).over(upto).alias(n) for n, c in (sums or {}).items()],
            *[F.last(c, ignorenulls=True).over(before).alias(n) for n, c in (lasts or {}).items()],
            *[F.first(c, ignorenulls=True).over(upto).alias(n) for n, c in (firsts or {}).items()],
        )

    def rolling(
        self, df: DataFrame, at: str, frames: Mapping[str, tuple[Column, int]], signed: bool = True
    ) -> DataFrame:
        """Add sums over the rows with ``at`` in (now − width, now], up to the current row.

        ``at`` is an integer column and the leading order column; ``frames`` maps a name to
        (value, width).  Rows that tie on ``at`` count only if they come no later in the order.
        ``signed=False`` promises values of 0 or more, which saves work.
        """
        if self.order[0] != at:
            raise ValueError("rolling frames need their time column first in the order")
        # Frames over the same value share one running total.
        values = {str(v): v for v, _ in frames.values()}
        total = {text: f"_total_{i}" for i, text in enumerate(values)}
        sums = {total[text]: F.coalesce(v, F.lit(0)) for text, v in values.items()}
        df = self.running(df, {**sums, "_pos": F.lit(1)} if signed else sums)
        gone = Window.partitionBy(self.key).orderBy(at)
        left = {}
        for n, (v, width) in frames.items():
            outside = gone.rangeBetween(Window.unboundedPreceding, -width)
            name = total[str(v)]
            # The total at the last row outside: the largest one, if totals only rise.
            last = F.max(F.struct("_pos", name)).over(outside)[name] if signed else F.max(name).over(outside)
            left[n] = last.alias(f"_left_{n}")
        df = df.select("*", *left.values())
        df = df.withColumns({
            n: F.col(total[str(v)]) - F.coalesce(F.col(f"_left_{n}"), F.lit(0))
            for n, (v, _) in frames.items()
        })
        return df.drop("_pos", *sums, *[f"_left_{n}" for n in frames])

    def trailing(self, df: DataFrame, rows: int, sums: Mapping[str, Column]) -> DataFrame:
        """Add sums over the last ``rows`` rows, the current one included."""
        totals = {f"_total_{n}": F.coalesce(v, F.lit(0)) for n, v in sums.items()}
        df = self.running(df, totals)
        df = df.withColumns({
            n: F.col(f"_total_{n}")
            - F.coalesce(F.lag(f"_total_{n}", rows).over(self._sorted()), F.lit(0))
            for n in sums
        })
        return df.drop(*totals)

    def history(
        self, df: DataFrame, sums: Mapping[str, Column], at: str, frames: Mapping[str, tuple[Column, int]], rows: int,
        trailing: Mapping[str, Column],
    ) -> DataFrame:
        """``running`` sums, ``rolling`` frames of values of 0 or more, and ``trailing`` sums, all from one set of running totals."""
        if self.order[0] != at:
            raise ValueError("rolling frames need their time column first in the order")
        total = {str(v): n for n, v in sums.items()}
        added = {}
        for v in [*[v for v, _ in frames.values()], *trailing.values()]:
            if str(v) not in total:
                total[str(v)] = f"_total_{len(added)}"
                added[total[str(v)]] = F.coalesce(v, F.lit(0))
        df = self.running(df, {**sums, **added})
        gone = Window.partitionBy(self.key).orderBy(at)
        inside = {
            n: F.col(total[str(v)])
            - F.coalesce(F.max(total[str(v)]).over(gone.rangeBetween(Window.unboundedPreceding, -width)), F.lit(0))
            for n, (v, width) in frames.items()
        }
        last = {
            n: F.col(total[str(v)]) - F.coalesce(F.lag(total[str(v)], rows).over(self._sorted()), F.lit(0))
            for n, v in trailing.items()
        }
        return df.withColumns({**inside, **last}).drop(*added)


class SplitScan(Scan):
    """The same totals for keys too large for one task."""

    def __init__(self, key: str, order: Sequence[str], chunks: int, max_rows: int):
        super().__init__(key, order)
        self.chunks = chunks
        self.max_rows = max_rows

    def running(self, df, sums=None, lasts=None, firsts=None):
        sums, lasts, firsts = dict(sums or {}), dict(lasts or {}), dict(firsts or {})
        kept = df.columns
        values = {f"_v_{n}": c for n, c in {**sums, **lasts, **firsts}.items()}
        ranged = written(
            df.select("*", *[c.alias(n) for n, c in values.items()])
            .repartitionByRange(self.chunks, self.key, *self.order)
            .withColumn(_CHUNK, F.spark_partition_id()),
            "chunks",
        )

        at = F.struct(*self.order)
        totals = ranged.groupBy(self.key, _CHUNK).agg(
            *[F.sum(f"_v_{n}").alias(f"_c_{n}") for n in sums],
            *[
                F.max_by(F.col(f"_v_{n}"), F.when(F.col(f"_v_{n}").isNotNull(), at)).alias(f"_c_{n}")
                for n in lasts
            ],
            *[
                F.min_by(F.col(f"_v_{n}"), F.when(F.col(f"_v_{n}").isNotNull(), at)).alias(f"_c_{n}")
                for n in firsts
            ],
        )
        earlier = (
            Window.partitionBy(self.key).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        )
        carried = totals.select(
            F.col(self.key).alias("_k"),
            F.col(_CHUNK).alias("_n"),
            *[F.sum(f"_c_{n}").over(earlier).alias(f"_c_{n}") for n in sums],
            *[F.last(f"_c_{n}", ignorenulls=True).over(earlier).alias(f"_c_{n}") for n in lasts],
            *[F.first(f"_c_{n}", ignorenulls=True).over(earlier).alias(f"_c_{n}") for n in firsts],
        )

        here = Window.partitionBy(self.key, _CHUNK).orderBy(*self.order)
        upto = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = here.rowsBetween(Window.unboundedPreceding, -1)
        # Every chunk border adds at most one row to the table of chunk totals.
        rows = ranged.join(
            _small(carried, 2 * self.chunks),
            ranged[self.key].eqNullSafe(carried["_k"]) & (ranged[_CHUNK] == carried["_n"]),
            "left",
        )
        as_plain = {f.name: f.dataType for f in Scan.running(self, df, sums).schema}
        added = {}
        for n in sums:
            local = F.sum(f"_v_{n}").over(upto)
            both = F.when(
                local.isNotNull() | F.col(f"_c_{n}").isNotNull(),
                F.coalesce(local, F.lit(0)) + F.coalesce(F.col(f"_c_{n}"), F.lit(0)),
            )
            added[n] = both.cast(as_plain[n])
        for n in lasts:
            local = F.last(f"_v_{n}", ignorenulls=True).over(before)
            added[n] = F.coalesce(local, F.col(f"_c_{n}"))
        for n in firsts:
            local = F.first(f"_v_{n}", ignorenulls=True).over(upto)
            added[n] = F.coalesce(F.col(f"_c_{n}"), local)
        return rows.select(*kept, *[c.alias(n) for n, c in added.items()])

    def rolling(self, df, at, frames, signed=True):
        """Each row enters at its time and leaves again ``width`` later: a running sum of both.

        Leaving rows come first at equal times, as the frame is open at its start.
        """
        if self.order[0] != at:
            raise ValueError("rolling frames need their time column first in the order")
        kept = df.columns
        values = {f"_v_{n}": F.coalesce(v, F.lit(0)) for n, (v, _) in frames.items()}
        rows = df.select("*", *[v.alias(n) for n, v in values.items()])
        moves = rows.withColumn("_enters", F.lit(1))
        for n, (_, width) in frames.items():
            moves = moves.unionByName(
                rows.select(
                    self.key,
                    (F.col(at) + width).alias(at),
                    *[c for c in self.order if c != at],
                    (-F.col(f"_v_{n}")).cast(rows.schema[f"_v_{n}"].dataType).alias(f"_v_{n}"),
                    F.lit(0).alias("_enters"),
                ),
                allowMissingColumns=True,
            )
        scan = SplitScan(
            self.key, [at, "_enters", *self.order[1:]], self.chunks * (1 + len(frames)), self.max_rows
        )
        moved = scan.running(moves, {f"_r_{n}": F.col(f"_v_{n}") for n in frames})
        whole = Scan(self.key, self.order)
        plain = {f.name: f.dataType for f in whole.rolling(df, at, frames, signed).schema}
        return moved.filter(F.col("_enters") == 1).select(
            *kept, *[F.col(f"_r_{n}").cast(plain[n]).alias(n) for n in frames]
        )

    def history(self, df, sums, at, frames, rows, trailing):
        df = self.rolling(self.running(df, sums), at, frames, signed=False)
        return self.trailing(df, rows, trailing)

    def trailing(self, df, rows, sums):
        """Blocks of row numbers, each with the last ``rows`` rows of the block before it."""
        kept = df.columns
        totals = {f"_total_{n}": F.coalesce(v, F.lit(0)) for n, v in sums.items()}
        counted = self.running(df, {"_pos": F.lit(1), **totals})
        size = max(self.max_rows, 2 * rows)
        block = F.floor((F.col("_pos") - 1) / size)
        edge = (F.col("_pos") - 1) % size >= size - rows
        spread = counted.withColumn(
            "_block",
            F.explode(F.when(edge, F.array(block, block + 1)).otherwise(F.array(block))),
        ).withColumn("_home", F.col("_block") == block)
        here = Window.partitionBy(self.key, "_block").orderBy("_pos")
        spread = spread.withColumns({
            n: F.col(f"_total_{n}") - F.coalesce(F.lag(f"_total_{n}", rows).over(here), F.lit(0))
            for n in sums
        })
        return spread.filter("_home").select(*kept, *sums)
