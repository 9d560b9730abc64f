"""Language identification by rank-order profiles (Cavnar and Trenkle, 1994).

Texts are lower-cased; runs of other characters than letters become one word border.  A text's n-grams of one to three
characters (letters, with borders) are ranked by frequency, ties by code points; its first ``TOP`` are compared
with each language's ranked profile.  The out-of-place distance adds up how far each n-gram is from its place in the
profile, ``TOP`` for one the profile lacks; the nearest language wins, ties by name.  The score is 1 less the distance
as a share of the largest possible.

Profiles are learned from labelled rows: about ``LEARN_DOCS`` documents a language, chosen by a hash of the id (all, where
there are fewer).  They are languages x ``TOP`` n-grams on the driver and in the tasks' closure.  Prediction is one scan
without a shuffle, over whole texts.

Defined results: null texts and texts without a letter are ``und`` with score 0, and so is every text if nothing could be
learned; rows without an id count as learnable; rows without a language are only predicted; repeated rows give
equal rows; an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from changeloom.llm.arrays import pieces

TOP = 300
#: Bound on the sample of labelled documents a language's profile is learned from (by hash of the id, so on average).
LEARN_DOCS = 2000
PIECE = 1 << 20
CHARS = 1 << 20
#: Stands for "no character" in n-grams shorter than three; the code of a word border is 0.
NONE = 0xFFFF
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def _counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys = keys[order]
    heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)
    return keys[heads], np.add.reduceat(counts[order], heads) if len(heads) else counts


class TooManyLetters(Exception):
    """Texts hold more different letters than a code has values; they are to be taken in smaller parts."""


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters met (code points, sorted), n-grams (document << 48 and three codes of 16 bits: place among the letters
    from 1) and how often."""
    texts = [t.lower() for t in texts]
    # A border before, between and after the documents.
    points = np.frombuffer(("\0" + "\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    seen = np.unique(points)
    alpha = np.array([chr(c).isalpha() if not 0xD800 <= c < 0xE000 else False for c in seen.tolist()], bool)
    letters = seen[alpha]
    if len(letters) >= NONE:
        if len(texts) > 1:
            raise TooManyLetters
        letters = letters[: NONE - 1]  # one text with more letters: the last of the code space count as borders
    code = np.searchsorted(letters, points).astype(np.uint64) + np.uint64(1)
    place = np.minimum(code.astype(np.int64) - 1, max(len(letters) - 1, 0))
    code[(letters[place] != points) if len(letters) else slice(None)] = 0
    doc = np.repeat(np.arange(len(texts), dtype=np.uint64), [len(t) + 1 for t in texts])
    doc = np.concatenate((doc[:1], doc))[: len(code)] if len(texts) else np.zeros(len(code), np.uint64)
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != 0) | (code[:-1] != 0)
    code, doc = code[keep], doc[keep] << np.uint64(48)
    none, high, mid = np.uint64(NONE), np.uint64(32), np.uint64(16)
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for s in range(0, len(code), CHARS):
        c, d = code[s:s + CHARS + 2], doc[s:s + CHARS + 2]
        n = min(CHARS, len(c))
        m, k = min(n, len(c) - 1), max(min(n, len(c) - 2), 0)
        one = (d[:n] | none << high | none << mid | c[:n])[c[:n] != 0]
        # A pair or triple belongs to the document of its letter; borders stand between documents.
        two = np.where(c[:m] != 0, d[:m], d[1:m + 1]) | none << high | c[:m] << mid | c[1:m + 1]
        two = two[(c[:m] != 0) | (c[1:m + 1] != 0)]
        three = (d[1:k + 1] | c[:k] << high | c[1:k + 1] << mid | c[2:k + 2])[c[1:k + 1] != 0]
        found = np.sort(np.concatenate((one, two, three)))
        heads = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1]))) if len(found) else np.zeros(0, int)
        more, times = found[heads], np.diff(np.append(heads, len(found)))
        keys, counts = (more, times) if not len(keys) else _counted(np.concatenate((keys, more)), np.concatenate((counts, times)))
    return letters, keys, counts


_LOW = np.uint64((1 << 48) - 1)


def ranked(keys: np.ndarray, counts: np.ndarray, top: int = TOP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, n-grams and ranks of each document's most frequent n-grams."""
    doc = (keys >> np.uint64(48)).astype(np.int64)
    order = np.lexsort((keys, -counts, doc))
    doc, keys = doc[order], keys[order] & _LOW
    rank = np.arange(len(doc)) - np.searchsorted(doc, doc)
    first = rank < top
    return doc[first], keys[first], rank[first]


def spell(keys: np.ndarray, letters: np.ndarray) -> list[str]:
    """N-grams as text: ``_`` is a border."""
    table = np.append(np.array([ord("_")], np.uint32), letters)
    out = []
    for key in keys.tolist():
        codes = [key >> 32 & NONE, key >> 16 & NONE, key & NONE]
        out.append("".join(chr(table[c]) for c in codes if c != NONE))
    return out


def coded(names: list[str], letters: np.ndarray) -> np.ndarray:
    """N-grams as keys over some letters; those with other letters get a key that no text has."""
    place = {chr(c): k + 1 for k, c in enumerate(letters.tolist())} | {"_": 0}
    out = []
    for name in names:
        codes = [NONE] * (3 - len(name)) + [place.get(c) for c in name]
        out.append((1 << 63) + len(out) if None in codes else codes[0] << 32 | codes[1] << 16 | codes[2])
    return np.array(out, np.uint64)


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", bound: int = LEARN_DOCS) -> dict[str, list[str]]:
    """Each language's n-grams by rank."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id")))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row per language
    if not sizes:
        return {}
    # A filter beside the scan: joining the sizes would shuffle all texts by language.
    size = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])
    part = F.pmod(F.xxhash64("id", F.lit("learn")), F.lit(1_000_000))
    few = rows.filter(part * size[F.col("lang")] < F.lit(bound * 1_000_000)).select("lang", "text")

    def counted(texts: list[str], of: list[str]) -> Iterator[pa.RecordBatch]:
        names = sorted(set(of))
        number = np.array([names.index(x) for x in of])
        try:
            letters, keys, counts = grams(texts)
        except TooManyLetters:
            half = len(texts) // 2
            yield from counted(texts[:half], of[:half])
            yield from counted(texts[half:], of[half:])
            return
        keys = number[(keys >> np.uint64(48)).astype(int)].astype(np.uint64) << np.uint64(48) | keys & _LOW
        keys, counts = _counted(keys, counts)
        yield pa.RecordBatch.from_pydict({
            "lang": [names[k] for k in (keys >> np.uint64(48)).tolist()], "gram": spell(keys & _LOW, letters), "n": counts.astype(np.int64),
        })

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                yield from counted(piece.column("text").to_pylist(), piece.column("lang").to_pylist())

    found = few.mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = found.select("lang", "gram", place.alias("place")).filter(F.col("place") <= TOP)
    profiles: dict[str, list[str]] = {}
    for row in sorted(best.collect(), key=lambda r: (r["lang"], r["place"])):  # languages x TOP rows
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


def identify(texts: list[str], profiles: dict[str, list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Language (its number among the profiles, -1 for none) and score of each text."""
    try:
        letters, keys, counts = grams(texts)
    except TooManyLetters:
        half = len(texts) // 2
        return tuple(np.concatenate(x) for x in zip(identify(texts[:half], profiles), identify(texts[half:], profiles)))
    doc, keys, rank = ranked(keys, counts)
    size = np.bincount(doc, minlength=len(texts))
    distance = np.zeros((len(texts), max(len(profiles), 1)))
    for k, names in enumerate(profiles.values()):
        own = coded(names, letters)
        order = np.argsort(own)
        at = np.minimum(np.searchsorted(own[order], keys), len(own) - 1)
        out = np.where(own[order][at] == keys, np.abs(order[at] - rank), TOP)
        distance[:, k] = np.bincount(doc, weights=out, minlength=len(texts))
    best = np.argmin(distance, axis=1)
    score = 1 - distance[np.arange(len(texts)), best] / np.maximum(size * TOP, 1)
    none = (size == 0) | (not profiles)
    return np.where(none, -1, best), np.where(none, 0.0, score)


def predict(docs: DataFrame, profiles: dict[str, list[str]], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, ``held_out``, ``lang_pred`` and ``score``."""
    names = [*profiles, UNKNOWN]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                best, score = identify(piece.column("text").fill_null("").to_pylist(), profiles)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column("held_out"), pa.array([names[k] for k in best.tolist()], pa.string()), pa.array(score)],
                    names=[doc_id, "held_out", "lang_pred", "score"],
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    few = docs.select(F.col(doc_id).alias("id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("text"))
    return few.mapInArrow(run, f"`{doc_id}` {kind}, held_out boolean, lang_pred string, score double")
