"""What encoding costs: pairs of tokens are told without merging them, plain texts by the quicker matcher; results stay."""

import random

import regex
from public_tokenizers import PATTERN, path

from changeloom.llm import bpe


def _codec():
    with open(path("byte_bpe_50k.tiktoken"), "rb") as f:
        return bpe.Codec(f.read(), PATTERN)


def test_pairs_are_not_merged():
    codec, rng = _codec(), random.Random(3)
    transducer, merged, calls = codec.words.transducer, bpe.Transducer.merged, []
    transducer.merged = lambda piece, *least: calls.append(piece) or merged(transducer, piece, *least)
    parts = ["ge", "ver", "schÖ", "ung", "heit", "tz", "ließ", "ein", "Ber", "über", "x", "keit"]
    words = {"".join(rng.choices(parts, k=rng.randint(1, 6))) for _ in range(4000)}
    got = {w: codec.words[w] for w in words}
    # A token alone, and its halves: no more merging than that, however many pairs were met.
    assert len(set(calls)) * 2 >= len(calls) and set(calls) <= set(transducer.ranks)
    assert len(transducer.pairs) > len(calls)
    for w in rng.sample(sorted(words), 300):
        assert [transducer.tokens[r] for r in got[w]] == merged(transducer, w.encode())
    for left, right in [p for p in transducer.pairs if p[0] is not None]:
        both = [transducer.tokens[left], transducer.tokens[right]]
        assert transducer.pairs[left, right] == (merged(transducer, b"".join(both)) == both)


def test_vocabularies_that_no_merges_made():
    ranks = {b"ab": 0, b"a": 1, b"b": 2, b"ba": 3, b"aba": 4}
    transducer, rng = bpe.Transducer(ranks), random.Random(4)
    assert not transducer.ordered
    for _ in range(300):
        piece = bytes(rng.choices(b"ab", k=rng.randint(1, 12)))
        assert [transducer.tokens[r] for r in transducer.encode(piece)] == transducer.merged(piece)


def test_matchers_agree():
    codec, wide, rng = _codec(), regex.compile(PATTERN).findall, random.Random(5)
    letters = [*map(chr, range(128)), *" \t\n\r'sl1_-" * 8]
    for _ in range(20000):
        text = "".join(rng.choices(letters, k=rng.randint(0, 30)))
        assert codec.find(text) == wide(text)
    assert codec.find("Öl 's x") == wide("Öl 's x")
    assert bpe.matcher(r"\p{Lu}+|\s+") == regex.compile(r"\p{Lu}+|\s+").findall  # a class it does not know
