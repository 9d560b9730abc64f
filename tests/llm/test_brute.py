"""Operators against brute force, exact round trips or held-out accuracy."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
import tiktoken
import xxhash

import corpus_pipeline
from changeloom.llm import bpe, html_text, language, line_windows, mixing, quality, simhash, substrings, vectors
from changeloom.llm.components import components, forest
from changeloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


def groups(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 600)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    want = groups(600, links)
    assert all(got.get(k, k) == want[k] for k in range(600))
    assert forest(600, *np.array(links).T).tolist() == want


# 1
def test_html_fixture():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header>Site <a href=/>Home</a></header>
    <nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav><div class="cookie-notice">We use cookies on this site to make it better for you.</div>
    <article><header><h1>The &quot;head&quot; line</h1></header><p>First   paragraph of the text with <a href=x>one link</a> in it &amp; more words.<br>Next line.
    <p>Short.<ul><li>An item of a list in the article</ul><div class=ad>Buy now and save a lot of money on things.</div></article>
    <section id="comments"><p>I like this article very much, said a reader who had time to write it down at length.</p></section>
    <form>Your name <input name=n><button>Send</button></form><footer>&copy; Site</footer></body></html>"""
    assert html_text.main_text(page, html_text.grow(html_text.LABELLED)) == "\n\n".join((
        'The "head" line', "First paragraph of the text with one link in it & more words. Next line.", "Short.", "An item of a list in the article",
    ))


def test_html_without_article():
    text = ["A long paragraph of running text " * 6, "Another one that goes on for a while, too " * 5]
    page = f"<body><ul><li><a>Home</a><li><a>News</a></ul><div>{text[0]}</div><div>{text[1]}</div><p><a>Next page</a></p><p>Imprint</p>"
    got = html_text.main_text(page, html_text.grow(html_text.LABELLED))
    assert got == "\n\n".join(t.strip() for t in text)


PARAGRAPH = " ".join(["A paragraph of the article that runs on for a while with many words in it."] * 4)
FRAME = "<nav><a href=/>Home</a></nav>{}<footer>Imprint and other things</footer>"


@pytest.mark.parametrize("wrapper", ["div class='layout has-sidebar'", 'div id="page-no-header"', "div class=search-enabled", "div class='layout sidebar'",
                                     "form id=aspnetForm", "section class='widget'"])
@pytest.mark.parametrize("element", ["article", "main", "main><article"])
def test_html_wrappers(wrapper, element):
    page = FRAME.format(f"<{wrapper}><{element}><p>{PARAGRAPH}</p></{element.split('>')[0]}></{wrapper.split()[0]}>")
    assert html_text.main_text(page, html_text.grow(html_text.LABELLED)) == PARAGRAPH


@pytest.mark.parametrize("wrapper", ["div class='layout has-sidebar'", 'div id="page-no-header"', "div class=search-enabled"])
def test_html_wrappers_without_article(wrapper):
    page = FRAME.format(f"<{wrapper}><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></{wrapper.split()[0]}>")
    assert html_text.main_text(page, html_text.grow(html_text.LABELLED)) == f"{PARAGRAPH}\n\n{PARAGRAPH}"


@pytest.mark.parametrize("around", ["aside", "nav", "section id=comments", "ol class='comment-list'", "div hidden", "div class='related-posts'"])
def test_html_articles_in_furniture(around):
    other = f"<{around}><article><p>{PARAGRAPH.upper()}</p></article></{around.split()[0]}>"
    for page in (f"<article><p>{PARAGRAPH}</p></article>{other}", f"<main><p>{PARAGRAPH}</p>{other}</main>"):
        assert html_text.main_text(FRAME.format(page), html_text.grow(html_text.LABELLED)) == PARAGRAPH


@pytest.mark.parametrize("mark", ["site-footer", "cookie-notice", "share-buttons", "main-menu", "ad", "ad_slot", "comments-list"])
def test_html_marked_compounds(mark):
    page = f"<body><p>{PARAGRAPH}</p><div class='x {mark}'>{PARAGRAPH.upper()}</div><p>{PARAGRAPH}</p>"
    assert html_text.main_text(page, html_text.grow(html_text.LABELLED)) == f"{PARAGRAPH}\n\n{PARAGRAPH}"


@pytest.mark.parametrize("tag", ["<svg/>", "<svg class='i' viewBox=\"0 0 1 1\" />", "<math/>", "<MATH alttext='a>b'/>", "<svg><path d='M0'/></svg>"])
@pytest.mark.parametrize("later", ["", "<svg><text>unseen</text></svg><math><mi>unseen</mi></math>"])
def test_html_self_closed(tag, later):
    page = f"<article><p>{PARAGRAPH} {tag}</p><p>{PARAGRAPH}</p></article>{later}"
    assert html_text.main_text(page, html_text.grow(html_text.LABELLED)) == f"{PARAGRAPH}\n\n{PARAGRAPH}"


def test_html_articles_of_pages(spark):
    for row in spark.read.parquet(f"{SF}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)(</article>|$)", row["html"], re.S)[1]
        parts = (" ".join(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:h1|p)>", article))
        got = html_text.main_text(row["html"], html_text.grow(html_text.LABELLED))
        assert got.replace("&", "") == "\n\n".join(x for x in parts if x).replace("&amp;", "&").replace("&", "")


# 2
def test_vectors_brute(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 24))
    x = np.concatenate([base + rng.normal(scale=s, size=base.shape) for s in (0.0, 0.1, 0.2, 0.27, 0.28, 0.3)]).astype(np.float32)
    x = np.concatenate((x, x[:30], np.repeat(x[:1], 50, axis=0)))
    label = [int(k) for k in rng.integers(0, 3, len(x))]
    table = spark.createDataFrame([(k, v.tolist(), l) for k, (v, l) in enumerate(zip(x, label))], "vec_id long, embedding array<float>, label int")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    near = (u @ u.T >= 0.93) & (np.array(label)[:, None] == np.array(label)[None]) & ~np.eye(len(x), dtype=bool)
    want = groups(len(x), np.argwhere(near))
    for block in (2048, 16):
        got = {r["vec_id"]: r for r in vectors.near_vectors(table, block=block).collect()}
        assert [got[k]["n_links"] for k in range(len(x))] == near.sum(axis=1).tolist()
        assert [got[k]["component_id"] for k in range(len(x))] == want


def test_quantisation_bound():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 48)) ** 3
    u = x / np.linalg.norm(x, axis=1)[:, None]
    q, scale, error = vectors.quantised(u)
    near = (q.astype(float) @ q.astype(float).T) * scale[:, None] * scale[None]
    bound = error[:, None] + error[None] + error[:, None] * error[None]
    assert (np.abs(near - u @ u.T) <= bound).all() and q.dtype == np.int8


# 3
def test_quality_counts(spark, docs):
    got = {r["doc_id"]: r for r in QUERIES["op3_quality_rules"].plan(spark, SF).collect()}
    for d in docs:
        words = WORD.findall(d["text"] or "")
        three = list(zip(words, words[1:], words[2:]))
        often = Counter(three)
        covered = {i + k for i, x in enumerate(three) if often[x] > 1 for k in range(3)}
        seen, dup = set(), 0
        for line in (d["text"] or "").split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        r = got[d["doc_id"]]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", d["text"] or "")), dup, len(covered))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_quality_labels(spark):
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op3_quality_rules"].plan(spark, SF).collect() if r["doc_id"] in labels and not r["base_failed"]]
    right = [r["kept"] == bool(labels[r["doc_id"]]["quality"]) for r in rows]
    assert len(right) > 30 and np.mean(right) > 0.97


def test_estimation_finds_accuracies():
    rng = np.random.default_rng(5)
    good, says = rng.random(40_000) < 0.7, np.array(list(quality.RULES.values()))
    when_right, when_wrong = np.linspace(0.35, 0.8, len(says)), np.linspace(0.12, 0.02, len(says))
    speaks = rng.random((len(good), len(says))) < np.where((says > 0) == good[:, None], when_right, when_wrong)
    found, counts = np.unique(quality.pattern(speaks), return_counts=True)
    model = quality.fit(found, counts)
    wrong = (quality.posterior(speaks, *model) >= 0.5) != good
    v = quality.unpattern(found)
    accuracy = quality.accuracy(v, counts, quality.posterior(v, *model))
    true = [np.mean((good if s > 0 else ~good)[speaks[:, k]]) for k, s in enumerate(says)]
    assert wrong.mean() < 0.05 and np.abs(accuracy - true).max() < 0.1


# 5
def tiktoken_encoding():
    with open(PATH, "rb") as f:
        return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.parse_ranks(f.read()), special_tokens={})


def test_bpe_queries(spark, docs):
    enc = tiktoken_encoding()
    got = {r["doc_id"]: r for r in QUERIES["op5_byte_bpe"].plan(spark, SF).collect()}
    for d in docs:
        ids = enc.encode_ordinary(d["text"])
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(d["text"].encode()).hexdigest()


def test_bpe_random(monkeypatch):
    enc, rng = tiktoken_encoding(), random.Random(6)
    with open(PATH, "rb") as f:
        codec = bpe.Codec(f.read(), PATTERN)
    monkeypatch.setattr(bpe, "LOOK", 16)
    monkeypatch.setattr(bpe, "KEPT_STEPS", 500)
    monkeypatch.setattr(bpe, "KEPT_WORDS", 50)
    monkeypatch.setattr(bpe, "CHUNK", 3)
    parts = ["a", "b", "the", "ing", " ", "é", "中", "😀", "0", "!!", "\n", "\t", "tion", "'s", "____", "=" * 40, "Zz"]
    for _ in range(600):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 60)))
        ids = codec.encode(text)
        assert ids == enc.encode_ordinary(text) and "".join(codec.decode(ids)) == text
    many = "ab" * 30_000
    assert codec.encode(many) == enc.encode_ordinary(many)


def test_bpe_tables(spark, docs):
    few = spark.createDataFrame([(d["doc_id"], d["text"]) for d in docs[:20]], "doc_id long, text string")
    ids = bpe.encode(few, PATH, PATTERN)
    assert {(r["doc_id"], r["text"]) for r in bpe.decode(ids, PATH, PATTERN).collect()} == {(d["doc_id"], d["text"]) for d in docs[:20]}


# 6
def wanted_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    full, whole = set(), sum(sizes.values())
    while True:
        rest = whole - sum(3 * sizes[s] for s in full)
        share = sum(weight[s] for s in names if s not in full)
        target = {s: 3.0 * sizes[s] if s in full else rest * weight[s] / share for s in names}
        more = {s for s in names if s not in full and target[s] > 3 * sizes[s]}
        if not more:
            return target
        full |= more


@pytest.mark.parametrize("chunk", [4000, 30])
def test_mixing(spark, chunk):
    rng = random.Random(7)
    rows = [(k, rng.choice(["a", "b", "b", "b", "b", "b", "c", "d", None]), "w " * rng.randint(0, 60)) for k in range(1500)]
    table = spark.createDataFrame(rows, "doc_id long, source string, text string")
    units = mixing.sized(table)
    got = mixing.mixed(units, chunk=chunk).collect()
    sizes, taken, many, picked = defaultdict(int), defaultdict(int), Counter(), Counter()
    for _, source, text in rows:
        sizes[source] += len(text.split())
        many[source] += 1
    want = wanted_targets(sizes)
    assert len(got) == len(rows) and {r["id"] for r in got} == set(range(1500))
    for r in got:
        assert 0 <= r["copies"] <= 3 and abs(r["target"] - want[r["source"]]) < 1e-6 and r["source_size"] == sizes[r["source"]]
        taken[r["source"]] += r["copies"] * r["size"]
        picked[r["source"]] += r["copies"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 60 and abs(picked[s] - many[s] * want[s] / sizes[s]) <= 8
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mixed(units, chunk=chunk).collect()))


# 7
def brute_spans(texts):
    seen = Counter(t[k:k + 200] for t in texts for k in range(len(t) - 199))
    for t in texts:
        gone = [False] * len(t)
        for k in range(len(t) - 199):
            if seen[t[k:k + 200]] > 1:
                gone[k:k + 200] = [True] * 200
        yield gone


@pytest.mark.parametrize("group", [20_000, 1])
def test_substrings_brute(spark, group):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(60) for _ in range(4)]
    texts = [prose(80) for _ in range(6)]
    texts += [prose(rng.randint(0, 20)) + rng.choice(shared)[rng.randint(0, 40):] + prose(rng.randint(0, 20)) for _ in range(25)]
    texts += [texts[0], texts[0] + "x", "ab" * 250, "q" * 199, "r" * 201, shared[0] + shared[1] + shared[0]]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in substrings.dedup_substrings(table, group=group).collect()}
    data = [t.encode() for t in texts]
    for k, (t, gone) in enumerate(zip(data, brute_spans(data))):
        edges = [i for i in range(len(gone) + 1) if (gone[i - 1] if i else False) != (gone[i] if i < len(gone) else False)]
        assert [(s["from_byte"], s["to_byte"]) for s in got[k]["spans"]] == list(zip(edges[::2], edges[1::2]))
        assert bytes(got[k]["kept"]) == bytes(b for b, g in zip(t, gone) if not g) and got[k]["n_bytes"] == len(t)


# 8
def test_language_held_out(spark, docs):
    lang = {d["doc_id"]: d["lang"] for d in docs}
    rows = QUERIES["op8_language_id"].plan(spark, SF).collect()
    held = [r for r in rows if r["held_out"]]
    assert held and np.mean([lang[r["doc_id"]] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def brute_grams(text):
    s = re.sub("_+", "_", "_" + "".join(c if c.isalpha() else "_" for c in text.lower()) + "_")
    found = Counter(s[i:i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1))
    return {g: n for g, n in found.items() if g.strip("_") and not (len(g) == 3 and g[1] == "_")}


def test_language_distance(docs, monkeypatch):
    monkeypatch.setattr(language, "CHARS", 700)
    texts = [d["text"] for d in docs[:40]] + ["", "ß", "1 2", "中文 x", "ab_cd"]
    place = lambda found: sorted(found, key=lambda g: (-found[g], len(g) < 3, len(g) < 2, [0 if c == "_" else ord(c) for c in g]))[:300]
    profiles = {name: place(brute_grams(" ".join(d["text"] for d in docs if d["lang"] == name))) for name in ("de", "en", "fr")}
    best, score = language.identify(texts, profiles)
    for k, text in enumerate(texts):
        own = place(brute_grams(text))
        away = [sum(abs(p.index(g) - r) if g in p else 300 for r, g in enumerate(own)) for p in profiles.values()]
        assert best[k] == (np.argmin(away) if own else -1)
        assert score[k] == pytest.approx(1 - min(away) / (300 * len(own)) if own else 0.0)


# 9
def fingerprint(text):
    words = WORD.findall(text.translate({c: c + 32 for c in range(65, 91)}))
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    bits = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(shingles))


def test_simhash_query(spark, docs):
    codes = [fingerprint(d["text"]) for d in docs]
    links = [(i, j) for i in range(len(codes)) for j in range(i) if (codes[i] ^ codes[j]).bit_count() <= 3]
    want = groups(len(codes), links)
    got = {r["doc_id"]: r for r in QUERIES["op9_simhash_near_dedup"].plan(spark, SF).collect()}
    for k, d in enumerate(docs):
        assert got[d["doc_id"]]["fingerprint"] == f"{codes[k]:016x}" and got[d["doc_id"]]["component_id"] == docs[want[k]]["doc_id"]


@pytest.mark.parametrize("group", [200_000, 7])
def test_simhash_links(spark, group):
    rng = random.Random(9)
    codes = {rng.getrandbits(64) for _ in range(200)}
    for c in list(codes)[:60]:
        for _ in range(12):
            codes.add(c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    base = rng.getrandbits(64) & ~0xFFFF
    codes = sorted(codes | {base | k for k in range(300)})
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    found = simhash.links(spark.createDataFrame([(c,) for c in signed], "fp long"), group=group).collect()
    at = {c: k for k, c in enumerate(signed)}
    x = np.array(codes, np.uint64)
    want = groups(len(codes), [(i, j) for i in range(len(x)) for j in np.flatnonzero(np.bitwise_count(x[i] ^ x[:i]) <= 3)])
    assert groups(len(codes), [(at[r["a"]], at[r["b"]]) for r in found]) == want


@pytest.mark.parametrize("distance,lead", [(0, 1), (7, 1), (6, 3)])
def test_simhash_distance(spark, distance, lead):
    rng = random.Random(distance)
    codes = {rng.getrandbits(64) for _ in range(100)}
    for c in list(codes)[:50]:
        codes |= {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, distance + 2))) for _ in range(8)}
    codes = sorted(codes)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    table, x = spark.createDataFrame([(c,) for c in signed], "fp long"), np.array(codes, np.uint64)
    at = {c: k for k, c in enumerate(signed)}
    near = {(j, i) for i in range(len(x)) for j in np.flatnonzero(np.bitwise_count(x[i] ^ x[:i]) <= distance).tolist()}
    found = [(at[r["a"]], at[r["b"]]) for r in simhash.links(table, distance=distance, lead=lead, group=40).collect()]
    assert groups(len(x), found) == groups(len(x), near)
    found = simhash.links(table, distance=distance, lead=lead, every_pair=True).collect()
    assert {tuple(sorted((at[r["a"]], at[r["b"]]))) for r in found} == near


def test_simhash_similarity(spark, docs):
    def shingles(text):
        words = WORD.findall(text.translate({c: c + 32 for c in range(65, 91)}))
        return {tuple(words[k:k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())

    sets, codes = [shingles(d["text"]) for d in docs], [fingerprint(d["text"]) for d in docs]
    like = [(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert sum(sets[i] != sets[j] for i, j in like) == 2
    for distance, lead in ((3, 1), (12, 2)):
        near = [(i, j) for i, j in like if (codes[i] ^ codes[j]).bit_count() <= distance]
        want = {docs[k]["doc_id"] for k in set(groups(len(docs), near))}
        kept = simhash.keep_one(spark.read.parquet(f"{SF}/documents.parquet"), distance=distance, lead=lead, similarity=0.8)
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)
    assert len(near) == len(like)


# pipeline
def test_pipeline(spark, docs):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "simhash_near_dedup", "mix_sources", "byte_bpe"]
    rows, frames = table, []
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, SF)
        got = rows.collect()
        rows = spark.createDataFrame(got, rows.schema)
        frames.append(got)
    good, lined, single, mixed, coded = frames
    kept = {r["doc_id"] for r in QUERIES["op3_quality_rules"].plan(spark, SF).collect() if r["kept"]}
    assert {r["doc_id"] for r in good} == kept and len(good) == len(kept)
    seen, want = set(), {}
    for r in sorted(good, key=lambda r: r["doc_id"]):
        lines = r["text"].split("\n")
        full = [k for k, x in enumerate(lines) if WORD.search(x)]
        gone = set()
        for w in zip(full, full[1:], full[2:]):
            key = tuple(lines[k] for k in w)
            gone |= set(w) if key in seen else set()
            seen.add(key)
        want[r["doc_id"]] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    assert {r["doc_id"]: r["text"] for r in lined} == want and all(r["n_chars"] == len(r["text"]) for r in lined)
    order = sorted(lined, key=lambda r: r["doc_id"])
    codes = [fingerprint(r["text"]) for r in order]
    roots = groups(len(order), [(i, j) for i in range(len(codes)) for j in range(i) if (codes[i] ^ codes[j]).bit_count() <= 3])
    assert sorted(r["doc_id"] for r in single) == sorted(order[k]["doc_id"] for k in set(roots))
    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in single} and max(Counter(r["doc_id"] for r in mixed).values()) <= 3
    enc, text = tiktoken_encoding(), {r["doc_id"]: r["text"] for r in single}
    assert Counter(r["doc_id"] for r in coded) == Counter(r["doc_id"] for r in mixed)
    assert all(list(r["ids"]) == enc.encode_ordinary(text[r["doc_id"]]) for r in coded)


def test_pipeline_decodes(spark):
    rows = [(1, "Some text, ünïcode 中文 and\n\nlines."), (2, ""), (3, None)]
    coded = corpus_pipeline.byte_bpe(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    assert {r["doc_id"]: r["decoded_sha256"] for r in coded} == {k: hashlib.sha256((t or "").encode()).hexdigest() for k, t in rows}
    assert [len(r["ids"]) > 0 for r in sorted(coded)] == [True, False, False]


# 10
def test_line_spans(spark):
    rows = [(1, "a a\nb\nc\nd"), (2, "x\nb\n\nc\nd\ny"), (3, "c\nd\ny\nz")]
    out = line_windows.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).select("row.*", "info.*").collect()
    by = {r["doc_id"]: r for r in out}
    assert by[1]["text"] == "a a\nb\nc\nd" and by[2]["text"] == "x\n\ny" and by[3]["text"] == "z"
    assert [(s["from_byte"], s["to_byte"]) for s in by[2]["spans"]] == [(2, 3), (5, 8)]
    assert by[2]["n_removed"] == 3 and by[2]["n_lines"] == 5
