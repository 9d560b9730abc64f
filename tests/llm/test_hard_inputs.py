"""Inputs built to break hashes, run times and codes."""

import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from changeloom.llm import html_text, language, line_windows, quality, units
from changeloom.llm.arrays import Texts, codes, digests


def thue_morse(n, zero, one):
    """Two strings that every polynomial hash modulo a power of two takes for equal, once they are long enough."""
    a, b = zero, one
    while len(a) < n:
        a, b = a + b, b + a
    return a, b


PAIRS = [thue_morse(n, *words) for n in (1024, 8192, 65536) for words in (("a", "b"), ("one phrase of it. ", "two phrase of it. "))]


@pytest.mark.parametrize("pair", PAIRS)
def test_strings_that_hash_alike_modulo_a_power_of_two(pair):
    x, y = pair
    t = Texts.of(pa.array([x, y, x]))
    strings = t.strings(t.at[:-1], t.at[1:])
    assert codes(strings)[0].tolist() == [0, 1, 0]
    d = digests(strings)
    assert (d[0] == d[2]).all() and (d[0] != d[1]).all()
    one, two = (s.replace(" ", "_") for s in pair)  # one word each
    found = quality.features(pa.array([f"{x}\n{y}", f"{x}\n{x}", f"{one} {two} {one} {two} {two} {one}", f"{one} {two} " * 3]))
    assert found["n_dup_lines"].tolist() == [0, 1, 0, 0] and found["n_repeat_words"].tolist()[2:] == [0, 6]


def test_lines_that_hash_alike_stay(spark):
    x, y = PAIRS[0]
    docs = spark.createDataFrame([(1, f"{x}\n{y}\n{x}"), (2, f"{y}\n{x}\n{y}"), (3, f"{x}\n{y}\n{x}")], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in line_windows.dedup_lines(docs).select("row.doc_id", "info.n_removed").collect()}
    assert got == {1: 0, 2: 0, 3: 3}
    left, right = (p.replace(". ", " ") for p in PAIRS[3])
    docs = spark.createDataFrame([(1, left + "."), (2, right + "."), (3, left + ".")], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in units.dedup_units(docs).select("row.doc_id", "info.n_removed").collect()}
    assert got == {1: 0, 2: 0, 3: 1}


def test_spans_of_strings():
    rng = np.random.default_rng(1)
    for _ in range(50):
        text = "".join(rng.choice(list("ab \n"), 60))
        t = Texts.of(pa.array([text, "", text[::-1]]))
        for starts, ends, doc in (t.words(), t.lines()):
            got = [x.decode() for x in t.strings(starts, ends).to_pylist()]
            assert got == [(text + text[::-1])[a:b] for a, b in zip(starts, ends)]


@pytest.mark.parametrize("n_words", [5, 3000])
def test_repeated_windows_against_a_loop(n_words):
    """Few words make one exact key; many take a number a step."""
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, n_words, 400)) for _ in range(40)]
    if n_words > 1000:
        texts.append(" ".join(f"x{k}" for k in range(400_000)) + " x0 x1 x2")
    got = quality.features(pa.array(texts))["n_repeat_words"].tolist()
    for text, n in zip(texts, got):
        words = text.split()
        seen, covered = {}, set()
        for k in range(len(words) - 2):
            seen.setdefault(tuple(words[k:k + 3]), []).append(k)
        for places in seen.values():
            if len(places) > 1:
                covered.update(j for p in places for j in range(p, p + 3))
        assert n == len(covered)


TREE = html_text.grow(html_text.LABELLED)
PARAGRAPH = " ".join(["A paragraph of the article that runs on for a while with many words in it."] * 4)


@pytest.mark.parametrize("page", [
    "<a " * 350_000, "<b>" * 100_000 + "</i>" * 100_000, "<p><div>" + "<b>" * 100_000 + "<hr>" * 100_000, "<!--" * 250_000,
    "<script>" * 125_000, "<svg " * 200_000, "<a \"" * 250_000, "<a '>" * 200_000 + "\"", "<div>" * 150_000, "<p>a<b>" * 100_000,
], ids=range(10))
def test_broken_pages_take_linear_time(page):
    began = time.perf_counter()
    html_text.main_text(f"<article><p>{PARAGRAPH}</p></article>" + page, TREE)
    assert time.perf_counter() - began < 10  # seconds; a quadratic run takes minutes


@pytest.mark.parametrize("mark", ["class='reader-comments'", "id='comment-thread'", "class='sidebar-left'", "class=left-sidebar", "class='pageFooter'",
                                  "id=cookieBanner"])
def test_marked_blocks_in_an_article(mark):
    page = f"<article><p>{PARAGRAPH}</p><div {mark}><p>{PARAGRAPH.upper()}</p></div></article>"
    assert html_text.main_text(page, TREE) == PARAGRAPH


@pytest.mark.parametrize("end", ["<!-- never closed", "<!-- never <p>closed", "<script>x = 1", "<script>x <b> y", "<style", "<a href="])
def test_unfinished_ends(end):
    got = html_text.main_text(f"<article><p>{PARAGRAPH}</p></article>{end}", TREE)
    assert got == PARAGRAPH


def test_texts_with_very_many_letters():
    letters = [chr(c) for c in range(0x4E00, 0x2FA20) if chr(c).isalpha()]
    assert len(letters) > language.NONE
    texts = ["plain words of a text", "".join(letters[: len(letters) // 2]), letters[-1], "".join(letters[len(letters) // 2:]), "12 34", "".join(letters)]
    profiles = {"en": ["e", "t", "a"], "zh": [letters[-1], letters[0]]}
    alone = [tuple(x[0] for x in language.identify([t], profiles)) for t in texts]
    together = list(zip(*language.identify(texts, profiles)))
    assert together == alone and together[2][0] == 1 and together[4][0] == -1 and together[5][0] != -1


def test_learning_from_very_many_letters(spark):
    letters = [chr(c) for c in range(0x4E00, 0x2FA20) if chr(c).isalpha()]
    rows = [(k, "".join(letters[k::4]), "zh") for k in range(4)] + [(9, "plain words", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    learned = language.learn(docs)
    assert set(learned) <= {"en", "zh"} and learned
    assert docs.filter(~language.held_out(F.col("doc_id"))).count() > 1
