"""Hard negatives, ranked search and reply trees against brute force, on ordinary and on edge rows."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeloom.llm import chat, negatives, ranking

CLASHES = ("id", "row", "label2", "vector", "length", "score", "rank", "term", "terms", "tfs", "m", "n", "part", "parts", "ids", "item", "w",
           "place", "anchor", "positive", "windows", "t", "p", "up", "at", "leaf", "total", "turns", "spans")


# 11
@pytest.mark.parametrize("shape", [(0, 5, 3), (1, 1, 1), (17, 16, 33), (64, 64, 64), (65, 70, 129), (100, 33, 250), (130, 128, 140)])
def test_strassen(shape):
    rng = np.random.default_rng(1)
    n, k, m = shape
    for top in (200, 1 << 62):  # the second wraps around in both products alike
        a, b = rng.integers(-top, top, (n, k)), rng.integers(-top, top, (m, k))
        assert (negatives.strassen(a, b) == a @ b.T).all()


def test_best_breaks_ties_to_the_left():
    scores = np.array([[5, 7, 7, 5], [np.iinfo(np.int64).min, 1, 1, 1]])
    open_ = np.array([[True] * 4, [True, False, False, True]])
    rows, columns, places = negatives.best(scores, open_, 3)
    assert sorted(zip(rows.tolist(), places.tolist(), columns.tolist())) == [(0, 0, 1), (0, 1, 2), (0, 2, 0), (1, 0, 3), (1, 1, 0)]


def brute_negatives(rows, positives=5, k=3):
    def fine(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    rows = [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in rows if label is not None and fine(v)]
    out = []
    order = lambda t: (-t[0], t[1] is None, t[1] or 0, t[2])
    for a, (i, v, label) in enumerate(rows):
        if i is None or i % 50:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), j, b, other) for b, (j, w, other) in enumerate(rows) if len(w) == len(v)]
        mine = sorted([s for s in scored if s[2] != a and s[3] == label], key=order)[:positives]
        for ps, j, *_ in mine:
            found = sorted([s for s in scored if s[3] != label and 50 * ps <= 100 * s[0] <= 95 * ps], key=order)[:k]
            out += [(i, j, rank, n, ps, ns) for rank, (ns, n, *_) in enumerate(found, 1)]
    return Counter(out)


@pytest.mark.parametrize("blocks", [{}, {"anchors": 2, "candidates": 7}])
def test_negatives(spark, blocks):
    rng = random.Random(2)
    rows = [(k, [rng.gauss(0, 1) for _ in range(18)], k % 3) for k in range(150)]
    rows += [(k, [float(rng.randrange(3)), 1.0], k % 2) for k in range(200, 260)]  # many ties, another length
    rows += [rows[50]] * 3 + [(None, rows[0][1], 0), (None, rows[1][1], 1)]  # repeated rows, no id
    rows += [(300, None, 1), (350, [1.0, None], 1), (400, [float("nan")], 1), (450, [float("inf")], 1), (500, [1.0], None),
             (550, [], 1), (551, [], 1), (600, [1e30, 0.0], 1), (650, [0.5] * 18, 9)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    rows = [r for r in rows if r[0] != 600]  # its integers leave 64 bits
    plain = negatives.mine(table, F.col("vec_id") % 50 == 0, **blocks)
    assert plain.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(map(tuple, plain.collect())) == brute_negatives(rows)
    if not blocks:
        clashing = table.withColumns({c: F.lit("x") for c in CLASHES})
        assert Counter(map(tuple, negatives.mine(clashing, F.col("vec_id") % 50 == 0).collect())) == brute_negatives(rows)
        assert negatives.mine(table.limit(0), F.col("vec_id") % 50 == 0).collect() == []


# 12
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(docs, items, top=10):
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked, out = defaultdict(set), []
    for i, t in items:
        asked[i] |= set(terms(t))
    for item, words in asked.items():
        scored = []
        for i, c in counted:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in words if c[t]
            )
            if score > 0:
                scored.append((-score, i is not None, i or 0))
        out += [(item, r, i if known else None, -s) for r, (s, known, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("small", [False, True])
def test_search(spark, small, monkeypatch):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(60)] + ["Über", "中文", "x" * 3000]
    text = lambda n: " ".join(rng.choices(words, range(len(words), 0, -1), k=n))
    docs = [(k, text(rng.choice([1, 3, 8, 20, 60]))) for k in range(300)]
    docs += [(k, "W1, w2 w3-w2\tw9") for k in range(900, 960)] + [(7, "w1 w2"), (7, "w1 w2"), (None, "w1 w2 w3"), (None, "w50")]
    docs += [(2000, None), (2001, ""), (2002, " .,; \n"), (2003, "w55 " * 50_000 + "w56")]
    items = [(k, text(12)) for k in range(30)] + [(40, None), (41, "--"), (42, "unknown"), (43, "w1 W1 w2"), (43, "w3"), (None, "w50 w51"), (44, "ÜBER über 中文")]
    if small:  # strata of many parts, visited one by one
        monkeypatch.setattr(ranking, "VISIT", 1)
        monkeypatch.setattr(ranking, "CELLS", 50)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    index = ranking.build(d, stratum=3 if small else ranking.STRATUM)
    got = ranking.search(index, i, block=7 if small else ranking.BLOCK)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_search(docs, items)
    if not small:
        clashing = [x.withColumns({c: F.lit("x") for c in CLASHES}) for x in (d, i)]
        got = ranking.search(ranking.build(clashing[0]), clashing[1])
        assert sorted(map(tuple, got.collect()), key=repr) == brute_search(docs, items)
        assert ranking.search(ranking.build(d.limit(0)), i).collect() == []
        assert ranking.search(index, i.limit(0)).collect() == []


def test_bound_is_never_below_a_score():
    rng = np.random.default_rng(4)
    tf, m = rng.integers(1, 500, 1000), int(rng.integers(10, 2000))
    assert (np.diff(ranking._impact(np.sort(tf), m)) >= 0).all()


# 13
def brute_paths(rows, best):
    tree = defaultdict(dict)
    for t, node, parent, role, text, score in rows:
        at = tree[t].setdefault(node, [[], 0.0, []])
        at[0].append(parent)
        at[1] += score or 0
        at[2].append((role or "", text or "", score is not None, score or 0))
    out = []
    for t, nodes in tree.items():
        up = {n: min((p for p in v[0] if p is not None), default=None) for n, v in nodes.items()}
        up = {n: p if p in nodes else None for n, p in up.items()}
        found = []
        for leaf in set(nodes) - {p for p in up.values() if p is not None}:
            path, at = [], leaf
            while at is not None and len(path) <= len(nodes):
                path.append(at)
                at = up[at]
            if len(path) <= len(nodes):
                found.append((-sum(nodes[n][1] for n in path), leaf, path[::-1]))
        for rank, (total, leaf, path) in enumerate(sorted(found, key=lambda f: f[:2])[:best], 1):
            turns = [x[:2] for n in path for x in sorted(nodes[n][2])]
            out.append((t, leaf, rank, -total, len(turns), turns))
    return sorted(out, key=repr)


def tree_rows():
    rng = random.Random(5)
    rows = [(1, k, k - 1 if k else None, ("user", "assistant")[k % 2], f"turn {k}", 0.5) for k in range(70)]  # a long chain
    rows += [(2, k, rng.randrange(k) if k else None, "user", f"reply {k}", float(rng.randrange(4))) for k in range(60)]
    rows += [(3, k, 0 if k else None, "assistant", "same", 1.0) for k in range(40)]  # a hot node, equal scores
    rows += [(4, 1, 2, "user", "circle", 1.0), (4, 2, 1, "user", "circle", 1.0), (4, 3, 2, "user", "below a circle", 1.0), (4, 9, 9, "user", "own", 1.0)]
    rows += [(5, 1, 77, "user", "orphan", None), (5, 2, 1, None, None, 1.0), (5, 2, 1, None, None, 1.0), (5, 2, 1, "assistant", "b", None)]
    rows += [(None, 1, None, "system", r"\ ### : </turn>" + "\n\\", 1.0), (None, 2, 1, "a: b:\n#", "</turn></turn>\n### user: x", 1.0)]
    return rows + [(6, 1, None, "assistant", "long #" * 100_000, 1.0), (7, 1, None, "", "", None)]


FIELDS = "tree long, node long, parent long, role string, text string, score double"


@pytest.mark.parametrize("best", [1, 3, 1000])
def test_trees(spark, best):
    rows = tree_rows()
    table = spark.createDataFrame(rows, FIELDS)
    done = chat.format_trees(table, best=best).withColumn("turns", chat.read_turns(F.col("text")))
    got = [(r["tree"], r["leaf"], r["rank"], r["total"], r["n_turns"], [tuple(t) for t in r["turns"]]) for r in done.collect()]
    assert sorted(got, key=repr) == brute_paths(rows, best)
    if best == 1:
        clashing = table.withColumns({c: F.lit("x") for c in CLASHES if c not in table.columns})
        assert chat.format_trees(clashing).count() == len(got)
        assert chat.format_trees(table.limit(0)).collect() == []


def test_template_and_mask(spark):
    done = chat.format_trees(spark.createDataFrame(tree_rows(), FIELDS), best=3)
    for r in done.select("*", chat.read_loss(F.col("text"), F.col("spans")).alias("loss"), chat.read_turns(F.col("text")).alias("turns")).collect():
        text = r["text"]
        # The control strings stand only where the template puts them.
        assert text.count("</turn>\n") == text.count("</turn>") == text.count("### ") == r["n_turns"]
        cut = "".join(text[s["from_char"]:s["to_char"]] for s in r["spans"] if s["loss"])
        said = "".join(t["text"] for t in r["turns"] if t["role"] == "assistant")
        assert r["loss"] == re.sub(r"(?s)\\(.)", r"\1", cut) == said
