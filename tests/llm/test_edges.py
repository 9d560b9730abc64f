"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from changeloom.llm import bpe, html_text, language, line_windows, mixing, quality, simhash, substrings, units, vectors

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"
#: Names the operators use themselves, and some that Spark gives by default.
CLASHES = ("id", "digest", "row", "info", "found", "kept", "size", "rows", "h", "c", "h1", "nr", "lines", "count", "copies", "fp", "root",
           "n_words", "of", "chunk", "p", "one", "place", "bytes", "held_out", "label", "rep", "n", "spans", "ids", "url", "component_id")
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
LONG = " ".join(f"word{i}." for i in range(60_000))
ROWS = [
    (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \n\t ", None, None, 4), (None, WORDS, "en", "a", 9),
    (None, WORDS, "en", "a", 9), (5, WORDS, None, "b", 9), (5, WORDS, None, "b", 9), (6, LONG, "en", "b", 1),
    (7, "ü", "de", None, 1), (8, "\x00 a b 中文。", "zh", "", 1), (9, f"{WORDS}\n{WORDS}\n{WORDS}\n{WORDS}", "en", "c", 1),
]
PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN

OPERATORS = {
    "quality": lambda d: quality.judge(d), "keep_good": lambda d: quality.keep_good(d),
    "units": lambda d: units.dedup_units(d).select("row.*"), "lines": lambda d: line_windows.dedup_lines(d).select("row.*"),
    "simhash": lambda d: simhash.near_duplicates(d), "keep_one": lambda d: simhash.keep_one(d),
    "taken": lambda d: mixing.taken(d), "mix": lambda d: mixing.mix(d), "encode": lambda d: bpe.encode(d, PATH, PATTERN),
    "digests": lambda d: bpe.digests(d, PATH, PATTERN), "substrings": lambda d: substrings.dedup_substrings(d),
    "language": lambda d: language.predict(d, language.learn(d)),
}
#: Rows of the result on ROWS: all but for the operators that drop or repeat some.
SOME = {"keep_good", "keep_one", "mix"}


def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("name", OPERATORS)
def test_rows(spark, name):
    plain = OPERATORS[name](docs(spark, ROWS)).collect()
    if name not in SOME:
        assert len(plain) == len(ROWS)
    clashing = docs(spark, ROWS).withColumns({c: F.lit("x") for c in CLASHES})
    again = OPERATORS[name](clashing)
    key = lambda rows: sorted(repr([r[c] for c in plain[0].asDict()]) for r in rows)
    if plain:
        assert key(again.collect()) == key(plain)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](docs(spark, [])).collect() == []


def test_carried_columns(spark):
    every = docs(spark, ROWS).withColumns({c: F.lit("x") for c in CLASHES})
    for name in ("keep_good", "units", "lines", "keep_one", "mix"):
        assert OPERATORS[name](every).columns == every.columns


def test_results_of_edge_rows(spark):
    d = docs(spark, ROWS)
    by = {r["doc_id"]: r for r in quality.judge(d).collect()}
    assert not by[1]["kept"] and by[1]["n_words"] == 0 and by[2]["base_failed"]
    by = {r["doc_id"]: r for r in simhash.near_duplicates(d).collect()}
    assert {by[k]["fingerprint"] for k in (1, 2, 3)} == {"0" * 16} and {by[k]["component_id"] for k in (1, 2, 3)} == {1}
    assert by[5]["component_id"] == by[None]["component_id"] == 5
    by = {r["doc_id"]: r for r in language.predict(d, language.learn(d)).collect()}
    assert by[1]["lang_pred"] == by[2]["lang_pred"] == by[3]["lang_pred"] == "und"
    assert language.predict(d, {}).filter("lang_pred != 'und'").count() == 0
    assert [r["n_tokens"] for r in bpe.digests(d, PATH, PATTERN).filter("doc_id < 3").collect()] == [0, 0]
    by = {r["doc_id"]: r for r in line_windows.dedup_lines(d).select("row.doc_id", "row.text", "info.*").collect()}
    assert by[1]["text"] is None and by[9]["n_removed"] == 3 and by[9]["text"] == WORDS
    assert simhash.keep_one(d).filter("text is not null and trim(text) like 'alpha%' and not text like '%\n%'").count() == 1


PAGES = [(1, "u", None), (2, "u", ""), (3, None, "<p>a &amp; b\n c</p><script>x"), (3, None, "<p>a &amp; b\n c</p><script>x"),
         (4, "u", "<div>" * 5000 + "deep " * 50 + "</p></b>"), (5, "u", "no tags at all &lt;here&gt; " * 20), (None, "u", "<!-- never closed <p>x")]


def test_pages(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    plain = html_text.extract(pages).collect()
    by = {r["page_id"]: r for r in plain}
    assert len(plain) == len(PAGES) and by[1]["text"] == by[2]["text"] == by[None]["text"] == ""
    assert by[5]["text"].startswith("no tags at all <here>") and by[5]["n_chars"] == len(by[5]["text"])
    assert by[4]["text"] == " ".join(["deep"] * 50)
    clashing = pages.withColumns({"text": F.lit("x"), "n_chars": F.lit(1)})
    assert sorted(map(repr, html_text.extract(clashing).collect())) == sorted(map(repr, plain))
    assert html_text.extract(pages.limit(0)).collect() == []


VECTORS = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.1], 1), (3, [1.0, 0.1], 1), (4, None, 1), (5, [0.0, 0.0], 1), (6, [1.0, None], 1),
           (7, [float("nan"), 1.0], 1), (8, [1.0, 0.0], None), (9, [], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.0], 2), (None, [5.0, 0.0], 2),
           (12, [float("inf"), 1.0], 1)]


def test_vectors(spark):
    table = spark.createDataFrame(VECTORS, "vec_id long, embedding array<float>, label int")
    plain = vectors.near_vectors(table).collect()
    got = sorted((str(r["vec_id"]), r["n_links"], r["component_id"], r["kept"]) for r in plain)
    alone = [(str(k), 0, k, True) for k in (4, 5, 6, 7, 8, 9, 10, 12)]
    linked = [("1", 3, 1, True), ("2", 3, 1, False), ("3", 3, 1, False), ("3", 3, 1, False), ("11", 1, 11, True), ("None", 1, 11, False)]
    assert got == sorted(alone + linked)
    clashing = table.withColumns({c: F.lit("x") for c in ("rep", "links", "copies", "own", "low", "length", "root", "kept")})
    assert sorted(map(repr, vectors.near_vectors(clashing).collect())) == sorted(map(repr, plain))
    assert vectors.near_vectors(table.limit(0)).collect() == []
