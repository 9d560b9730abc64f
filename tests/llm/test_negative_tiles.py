"""Tiles of hard negatives: rows move once for each block of the other side, and strips with heaps lose nothing."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeloom.llm import negatives


def test_rows_move_once_for_each_block_of_the_other_side(spark, monkeypatch):
    rows = [(50 * k if k < 700 else 50 * k + 1, [float(k % 13 - 6), float(k % 7 - 3)], k % 3) for k in range(1500)]
    table, moved, tiles = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), [], negatives._tiles

    def counted(*args):
        found = tiles(*args)
        moved.append(found._df.count())
        return found

    monkeypatch.setattr(negatives, "_tiles", counted)
    negatives.mine(table, F.col("vec_id") % 50 == 0)
    assert moved == [2200, 2200]


@pytest.mark.parametrize("top", [3, 200, 1 << 18, 1 << 40])
def test_products_are_exact_in_the_kind_they_are_held_in(top):
    rng = np.random.default_rng(top)
    a, b = rng.integers(-top, top + 1, (70, 70)), rng.integers(-top, top + 1, (130, 70))
    a[0], b[0] = top, -top
    assert (negatives.strassen(a, b, 8) == a @ b.T).all()
    kinds = [negatives.exact_kind(n, n, 1) for n in (3, 1000, 2000, 1 << 22, 1 << 25)]
    assert kinds == [np.float32, np.float32, np.float64, np.float64, np.int64]


@pytest.mark.parametrize("span", [3, 60, 5000])
@pytest.mark.parametrize("kind", [np.float32, np.int64])
def test_heaps_keep_what_a_sort_keeps(span, kind):
    rng = np.random.default_rng(span)
    scores = rng.integers(-span, span, (9, 700)).astype(kind)
    shut = rng.random(scores.shape) < 0.3
    low = rng.integers(-span, 1, (9, 2)).astype(kind)
    high = low + rng.integers(0, span, low.shape).astype(kind)
    heaps = negatives._Heaps(low, high, 4)
    for s in range(0, 700, 90):
        heaps.add(scores[:, s:s + 90], s, lambda i, j, s=s: ~shut[i, j + s])
    heaps.merge()
    got = list(zip(heaps.owner.tolist(), heaps.score.tolist(), heaps.place.tolist()))
    want = []
    for i in range(9):
        for w in range(2):
            fit = [(-int(scores[i, j]), j) for j in range(700) if not shut[i, j] and low[i, w] <= scores[i, j] <= high[i, w]]
            want += [(2 * i + w, -s, j) for s, j in sorted(fit)[:4]]
    assert got == want


def test_vectors_of_any_width_come_back(spark):
    rows = [(k, [float(k), -1.5 * 10 ** (k % 4 * 4)], 1) for k in range(40)] + [(90, [None, 1.0], 1), (91, [2.0, float("inf")], 1)]
    for row in ([(99, [], 1)], rows[:1], rows):
        table = spark.createDataFrame(row, "id long, vector array<double>, label long").select("id", "label", "vector", F.lit(True).alias("anchor"))
        packed = table.coalesce(1).mapInArrow(negatives._packed(256), "id bigint, label bigint, vector binary, length int, anchor boolean").toArrow()
        got = negatives._unpacked(packed["vector"].combine_chunks(), packed["length"][0].as_py()).tolist()
        assert got == [[int(np.floor(256 * x)) for x in v] for i, v, _ in row if i not in (90, 91)]
