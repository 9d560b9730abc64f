r"""Quality rules as weak supervision.

Each rule votes for good or for bad documents where its condition holds, and abstains elsewhere.  Expectation-
maximisation estimates the accuracy of every rule's votes and the share of good documents; the posterior
probability of being good replaces the usual filter that all rules must pass.

The corpus enters the estimation as counts of vote patterns: at most 2^rules rows, whatever the corpus, so the
driver holds a table of proven size and the rest is one map-side aggregate.  Two scans, no shuffle of texts.

Defined results: a null or empty text has no word, fails the base rules and is rejected; repeated rows are judged
alike; ids may be null or repeated; an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from changeloom.llm.arrays import IS_SPACE, Texts, codes, later, pieces, repeated

MIN_WORDS = 50
#: Rejected by the base rules above this percentage of words in repeated three-word windows.
MAX_REPEAT_PERCENT = 50
KEEP_FROM = 0.5
EM_ROUNDS = 60
#: Weight of the starting beliefs against the corpus, as a share of its documents: of a rule's accuracy, and of the share of good.
PRIOR_WEIGHT, SHARE_WEIGHT = 0.02, 0.5
#: A rule is right more often than wrong, never always: without the first, good and bad could change places.
ACCURACIES = (0.6, 0.999)
#: Starting beliefs: share of good documents; how often a rule votes where it is right and where it is wrong.
START_GOOD = 0.8
RIGHT_GOOD, WRONG_GOOD = 0.8, 0.1
RIGHT_BAD, WRONG_BAD = 0.3, 0.02
#: Weight of the starting beliefs against the corpus, as a share of its documents: of a rule's votes, and of the share of good.
PRIOR_WEIGHT, SHARE_WEIGHT = 0.02, 0.5
#: Least and most evidence of a vote (natural log).
EVIDENCE = (0.5, 6.0)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_ascii_letters",
          "n_shouts", "n_stops", "n_marked_words")


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL, _SHOUT, _STOP = _flags(b"#*$%&|<>"), _flags(b"!?"), _flags(b".!?:;,")
_UPPER = _flags(bytes(range(65, 91)))
_LETTER = _flags(bytes([*range(65, 91), *range(97, 123)]))
_CONTINUES = np.array([0x80 <= b < 0xC0 for b in range(256)])


def _again(doc: np.ndarray, words: list[np.ndarray], docs: int, size: int) -> np.ndarray:
    """Flags the windows that stand twice or more in their document."""
    bits = max(int(size).bit_length(), 1)
    if 3 * bits + int(docs).bit_length() <= 63:
        return repeated(((doc << bits | words[0]) << bits | words[1]) << bits | words[2])
    key = doc
    for word in words:  # one exact number for document and words so far
        _, key = np.unique(key * size + word, return_inverse=True)
    return repeated(key)


def features(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of every text of a column."""
    t = Texts.of(column)
    d = t.data
    starts, ends, doc = t.words()
    # Windows of words i, i+1, i+2 by exact numbers of the words; windows that leave a document are not looked at.
    n = max(len(doc) - 2, 0)
    inside = np.flatnonzero(doc[:n] == doc[2:])
    word, size = codes(t.strings(starts, ends))
    again = np.zeros(n, bool)
    again[inside] = _again(doc[inside], [word[inside + k] for k in range(3)], t.n, size)
    covered = np.zeros(len(doc), bool)
    for k in range(3):
        covered[k:k + n] |= again
    ls, le, ldoc = t.lines()
    words_before = np.searchsorted(starts, ls)
    full = np.searchsorted(starts, le) > words_before
    line, size = codes(t.strings(ls[full], le[full]))
    dup = np.zeros(len(ls), bool)
    dup[full] = later(ldoc[full] * max(size, 1) + line)
    last = d[ends - 1]
    return {
        "n_words": t.per_doc(doc), "word_chars": t.count(~IS_SPACE[d] & ~_CONTINUES[d]), "n_symbols": t.count(_SYMBOL[d]),
        "n_dup_lines": t.per_doc(ldoc, dup), "n_repeat_words": t.per_doc(doc, covered), "n_lines": t.per_doc(ldoc, full),
        "n_upper": t.count(_UPPER[d]), "n_ascii_letters": t.count(_LETTER[d]), "n_shouts": t.count(_SHOUT[d]),
        "n_stops": t.per_doc(doc, _STOP[last]), "n_marked_words": t.per_doc(doc, _SYMBOL[last]),
    }


def votes(f: dict[str, np.ndarray]) -> np.ndarray:
    """One row per document, one column per rule of ``RULES``: whether the rule votes; otherwise it abstains."""
    words, lines, letters = (np.maximum(f[k], 1) for k in ("n_words", "n_lines", "n_ascii_letters"))
    some, enough = f["n_words"] >= 20, f["n_words"] >= MIN_WORDS
    symbols, shouts, stops = f["n_symbols"] / words, f["n_shouts"] / words, f["n_stops"] / words
    repeats, upper, size = f["n_repeat_words"] / words, f["n_upper"] / letters, f["word_chars"] / words
    dup = f["n_dup_lines"] / lines
    calm = (symbols <= 0.02) & (shouts <= 0.05) & (upper <= 0.3)
    return np.stack((
        f["n_words"] < MIN_WORDS,
        (size < 2) | (size > 14),
        symbols > 0.1,
        f["n_marked_words"] > 0.1 * words,
        dup > 0.3,
        some & (repeats > 0.35),
        some & (upper > 0.5),
        shouts > 0.2,
        some & (stops < 0.005),
        enough & calm & (stops >= 0.02) & (stops <= 0.5),
        enough & calm & (size >= 3) & (size <= 9),
        enough & (symbols <= 0.05) & (shouts <= 0.05) & (repeats <= 0.1) & (dup <= 0.1),
    ), axis=1)


#: Every rule and what its vote says: 1 for a good document, -1 for a bad one.
RULES = {
    "short": -1, "word_length": -1, "symbols": -1, "marked_words": -1, "repeated_lines": -1, "repeated_windows": -1,
    "capitals": -1, "shouts": -1, "no_sentences": -1, "sentences": 1, "plain_words": 1, "varied": 1,
}
_SAYS = np.array(list(RULES.values()))
PATTERNS = 1 << len(RULES)
_PLACES = 1 << np.arange(len(RULES))


def pattern(v: np.ndarray) -> np.ndarray:
    """The votes as one number below ``PATTERNS``."""
    return v.astype(np.int64) @ _PLACES


def unpattern(p: np.ndarray) -> np.ndarray:
    return p[:, None] // _PLACES % 2


def fit(patterns: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray]:
    """Expectation-maximisation over vote patterns: the share of good documents and each rule's evidence, the log of how
    much more often it votes on good documents than on bad ones.

    A rule that abstains says nothing.  The starting beliefs count as a share of all documents, so the estimate doesn't
    depend on the corpus size and stays proper where a rule never votes.
    """
    v, n = unpattern(patterns).astype(float), counts.astype(float)
    weight = max(PRIOR_WEIGHT * n.sum(), 1e-9)
    right, wrong = np.where(_SAYS > 0, RIGHT_GOOD, RIGHT_BAD), np.where(_SAYS > 0, WRONG_GOOD, WRONG_BAD)
    start_good, start_bad = np.where(_SAYS > 0, right, wrong), np.where(_SAYS > 0, wrong, right)
    prior, evidence = START_GOOD, np.log(start_good / start_bad)
    for _ in range(EM_ROUNDS):
        good = n * posterior(v, prior, evidence)
        bad = n - good
        prior = (good.sum() / n.sum() + SHARE_WEIGHT * START_GOOD) / (1 + SHARE_WEIGHT)
        on_good = (good @ v + weight * start_good) / (good.sum() + weight)
        on_bad = (bad @ v + weight * start_bad) / (bad.sum() + weight)
        # A rule's vote never speaks for the other side; otherwise good and bad could change places.
        evidence = _SAYS * np.clip(_SAYS * np.log(on_good / on_bad), *EVIDENCE)
    return prior, evidence


def accuracy(v: np.ndarray, n: np.ndarray, good: np.ndarray) -> np.ndarray:
    """How often each rule's vote is right, by the posterior of the documents it votes on."""
    return (n @ (v * np.where(_SAYS > 0, good[:, None], 1 - good[:, None]))) / np.maximum(n @ v, 1e-9)


def posterior(v: np.ndarray, prior: float, evidence: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-(np.log(prior / (1 - prior)) + v @ evidence)))


def vote_patterns(docs: DataFrame, text: str = "text") -> DataFrame:
    """``pattern, n``: how many documents got each combination of votes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(PATTERNS, np.int64)
        for batch in batches:
            for piece in pieces(batch, text):
                seen += np.bincount(pattern(votes(features(piece.column(text)))), minlength=len(seen))
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"pattern": some.astype(np.int64), "n": seen[some]})

    each = docs.select(F.col(text)).mapInArrow(count, "pattern long, n long")
    return each.groupBy("pattern").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Posterior of good for each vote pattern, learned from all documents."""
    rows = vote_patterns(docs, text).collect()  # at most PATTERNS rows
    found = sorted((r["pattern"], r["n"]) for r in rows)
    if not found:
        return np.full(PATTERNS, START_GOOD)
    prior, evidence = fit(np.array([p for p, _ in found]), np.array([n for _, n in found]))
    return posterior(unpattern(np.arange(PATTERNS)), prior, evidence)


def base_failed(f: dict[str, np.ndarray]) -> np.ndarray:
    return (f["n_words"] < MIN_WORDS) | (100 * f["n_repeat_words"] > MAX_REPEAT_PERCENT * f["n_words"])


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, counts, ``votes`` (the rules that voted), ``base_failed``, ``p_good`` and ``kept``."""
    table, names = learn(docs, text), np.array(list(RULES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text):
                f = features(piece.column(text))
                v = votes(f)
                p, failed = table[pattern(v)], base_failed(f)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), *[pa.array(f[k]) for k in COUNTS], pa.array([",".join(names[r]) for r in v], pa.string()),
                     pa.array(failed), pa.array(p), pa.array(~failed & (p >= KEEP_FROM))],
                    names=[doc_id, *COUNTS, "votes", "base_failed", "p_good", "kept"],
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    out = f"`{doc_id}` {kind}, {', '.join(f'{c} long' for c in COUNTS)}, votes string, base_failed boolean, p_good double, kept boolean"
    return docs.select(doc_id, text).mapInArrow(run, out)


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents kept, with all their columns."""
    table = learn(docs, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text):
                f = features(piece.column(text))
                yield piece.filter(pa.array(~base_failed(f) & (table[pattern(votes(f))] >= KEEP_FROM)))

    return docs.mapInArrow(run, docs.schema)
