"""Byte-level BPE: encoding with a lazily determinised transducer, streaming decoding.

**Encoding.**  In a byte-pair encoding every prefix has one encoding, and it is the only chain of tokens in which each
neighbouring pair, encoded alone, gives that pair.  So the nondeterministic transducer guesses token starts; a state of
the deterministic one holds, for every place that may still start a token, the bytes since it and the token before it.
Reading a byte gives the next state and the one token that can end there.  Tokens that the chains to all places of a
state share are certain and are emitted; a token's length bounds how long that can take, so lookahead is bounded.
States, transitions and the pairs' own encodings are made when first met and kept; a whole pre-token read from
the start state is kept as one transition, too.  The tables are bounded and only caches.

**Decoding.**  Token bytes are fed to an incremental UTF-8 state machine, which holds back at most three bytes of a
character cut by a token's end.

Texts never leave their row, so there is no shuffle.  The vocabulary (under 1 MB) is read by the driver and broadcast.

Defined results: null and empty texts have no token; any other column is not looked at; repeated rows give equal
rows; an empty table gives an empty table; long texts are worked on as a whole, a pre-token of any length in linear time.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Pre-tokens (of the last two generations) and transitions kept by a task; the tables start anew beyond.
KEPT_WORDS = 250_000
KEPT_STEPS = 200_000
#: Bytes of a pre-token read before certain tokens are emitted, from time to time.
LOOK = 1024
#: Tokens decoded at once.
CHUNK = 4096
#: Key of a state's live places among its steps, which have bytes as keys.
LIVE = -1


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Lines of base64 token and rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class Transducer:
    """Encodes single pre-tokens by their ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        # The vocabulary's prefix tree: steps by byte, and the rank of the token that ends at a node.
        self.below: list[dict[int, int]] = [{}]
        self.ends: list[int | None] = [None]
        self.depth = [0]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                if byte not in self.below[node]:
                    self.below[node][byte] = len(self.below)
                    self.below.append({})
                    self.ends.append(None)
                    self.depth.append(self.depth[node] + 1)
                node = self.below[node][byte]
            self.ends[node] = rank
        self.pairs: dict[tuple[int, int], bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        # Whether all merges rank behind all single bytes, as in any vocabulary that merges made.
        single = [rank for token, rank in ranks.items() if len(token) == 1]
        self.ordered = max(single, default=-1) < min((rank for token, rank in ranks.items() if len(token) > 1), default=1)
        self.forget()

    def forget(self) -> None:
        # A state: for each place that may still start a token, the tree node of the bytes since it and the token that ends at
        # it.  It is a dictionary of its steps, byte to (next state, length and rank of the token that can end there), under
        # LIVE its places.
        self.start = {LIVE: ((0, None),)}
        self.states, self.kept = {self.start[LIVE]: self.start}, 0

    def merged(self, piece: bytes, least: int = 1) -> list[bytes]:
        """Merges by rank, down to ``least`` parts; used for the vocabulary's own tokens and pairs, not for texts."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        rank = self.ranks.get
        while len(parts) > least:
            best, i = min((rank(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == 1 << 60:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _follows(self, before: int | None, rank: int) -> bool:
        """Whether the token may stand after the other; the first of a text, alone."""
        known = self.pairs.get((before, rank))
        if known is None:
            if before is not None and self.ordered and self._follows(None, rank):
                known = self._stands(before, rank)
            else:
                chain = [self.tokens[rank]] if before is None else [self.tokens[before], self.tokens[rank]]
                known = self.merged(b"".join(chain)) == chain
            self.pairs[before, rank] = known
        return known

    def _half(self, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes a token that is its own encoding; none for a single byte."""
        if rank not in self.halves:
            parts = self.merged(self.tokens[rank], 2)
            self.halves[rank] = tuple(self.ranks[p] for p in parts) if len(parts) == 2 else None
        return self.halves[rank]

    def _stands(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border of two tokens that are their own encodings: undoes their merges, last first, and looks
        for one across the border that would have come before the merge just undone."""
        token, rank = self.tokens, self.ranks.get
        limit = 1 << 60
        while True:
            if rank(token[left] + token[right], limit) < limit:
                return False
            a, b = self._half(left), self._half(right)
            if a and (left > right or not b):
                limit, left = left, a[1]
            elif b:
                # Of equal ranks the one further left comes first.
                limit, right = right + 1, b[0]
            else:
                return True

    def _last(self, state: dict, byte: int) -> tuple[None, int, int]:
        """The step over the last byte of a piece, whose next state nobody asks for; it is not kept."""
        for node, before in state[LIVE]:
            node = self.below[node].get(byte)
            if node is not None and (rank := self.ends[node]) is not None and self._follows(before, rank):
                return None, len(self.tokens[rank]), rank
        raise ValueError("a byte that is no token")

    def _step(self, state: dict, byte: int) -> tuple[dict, int, int]:
        ended, live, below, ends = None, [], self.below, self.ends
        for node, before in state[LIVE]:
            node = below[node].get(byte)
            if node is not None:
                rank = ends[node]
                if rank is not None and ended is None and self._follows(before, rank):
                    ended = rank
                if below[node]:
                    live.append((node, before))
        live.append((0, ended))
        new = tuple(live)
        following = self.states.get(new)
        if following is None:
            following = self.states[new] = {LIVE: new}
        out = state[byte] = (following, len(self.tokens[ended]), ended)
        self.kept += 1
        return out

    def encode(self, piece: bytes) -> list[int]:
        if piece in self.ranks:
            return [self.ranks[piece]]
        if self.kept > KEPT_STEPS:
            self.forget()
        # path[i]: the step over byte done + i; tokens before done are emitted.
        state, out, path = self.start, [], []
        body = len(piece) - 1
        for look in range(0, body, LOOK):
            for byte in piece[look:min(look + LOOK, body)]:
                step = state.get(byte) or self._step(state, byte)
                state = step[0]
                path.append(step)
            if look + LOOK < body:
                certain = self._certain(state, path)
                out += self._chain(path, certain)
                del path[:certain]
        for byte in piece[body:]:
            path.append(state.get(byte) or self._last(state, byte))
        return out + self._chain(path, len(path))

    def _certain(self, state: dict, path: list) -> int:
        """The last place that the chains to all places which may still start a token share."""
        places = {len(path) - self.depth[node] for node, _ in state[LIVE]}
        while len(places) > 1:
            last = max(places)
            places.remove(last)
            places.add(last - path[last - 1][1])
        return max(0, *places)

    def _chain(self, path: list, end: int) -> list[int]:
        out = []
        while end > 0:
            _, length, rank = path[end - 1]
            out.append(rank)
            end -= length
        out.reverse()
        return out


class Words(dict):
    """Pre-token to what ``made`` makes of its ids."""

    def __init__(self, transducer: Transducer, made: Callable = tuple):
        self.transducer, self.made = transducer, made
        self.old: dict = {}

    def __missing__(self, piece: str):
        if len(self) >= KEPT_WORDS:
            # Words met since the last change stay one change longer.
            self.old = dict(self)
            self.clear()
        found = self[piece] = self.old.pop(piece, None) or self.made(self.transducer.encode(piece.encode()))
        return found


#: What the classes of a pattern are in a text of ASCII, where the standard library's matcher takes less than half the time.
ASCII = ((r"[^\s\p{L}\p{N}]", r"[^\t-\r A-Za-z0-9]"), (r"\p{L}", "[A-Za-z]"), (r"\p{N}", "[0-9]"), (r"\s", r"[\t-\r ]"), (r"\S", r"[^\t-\r ]"))


def matcher(pattern: str) -> Callable[[str], list[str]]:
    """All matches of a pattern in a text."""
    find, plain = regex.compile(pattern).findall, pattern
    for wide, narrow in ASCII:
        plain = plain.replace(wide, narrow)
    # Any other class, group or flag is left to the general matcher alone.
    if re.search(r"\\(?![tr])|\((?!\?[!=])|\[:", plain):
        return find
    short = re.compile(plain).findall
    return lambda text: short(text) if text.isascii() else find(text)


class Codec:
    def __init__(self, data: bytes, pattern: str):
        ranks = parse_ranks(data)
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.text_of = {rank: str(rank) for rank in ranks.values()}
        transducer = Transducer(ranks)
        self.words = Words(transducer)
        self.written = Words(transducer, self._written)
        self.find = matcher(pattern)

    def _written(self, ids: list[int]) -> tuple[int, str, bytes]:
        """Number of ids, the ids in decimals, and the bytes of their tokens."""
        return len(ids), " ".join(map(self.text_of.__getitem__, ids)), b"".join(map(self.bytes_of.__getitem__, ids))

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.words.__getitem__, self.find(text))))

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        """Text as far as it is certain, chunk by chunk; bytes that are no UTF-8 become U+FFFD."""
        return self.read([self.bytes_of[i] for i in ids])

    def read(self, tokens: list[bytes]) -> Iterator[str]:
        """The same from the bytes of tokens."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for start in range(0, len(tokens), CHUNK):
            yield machine.decode(b"".join(tokens[start:start + CHUNK]))
        yield machine.decode(b"", final=True)


@lru_cache(1)
def _codec(data: bytes, pattern: str) -> Codec:
    return Codec(data, pattern)


def _shared(spark: SparkSession, path: str):
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _digest(decoded: Iterable[str]) -> str:
    """SHA-256 of the decoded text."""
    read = hashlib.sha256()
    for part in decoded:
        read.update(part.encode())
    return read.hexdigest()


def encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """Per document: id and ``ids``, its token ids; with ``decoded`` also ``decoded_sha256`` of the text they decode to."""
    vocabulary = _shared(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary.value, pattern)
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                ids = [codec.encode(x or "") for x in part.column(1).to_pylist()]
                columns, names = [part.column(0), pa.array(ids, pa.list_(pa.int32()))], [doc_id, "ids"]
                if decoded:
                    columns.append(pa.array([_digest(codec.decode(x)) for x in ids], pa.string()))
                    names.append("decoded_sha256")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[doc_id].dataType.simpleString()
    out = f"`{doc_id}` {kind}, ids array<int>" + (", decoded_sha256 string" if decoded else "")
    return docs.select(doc_id, text).mapInArrow(run, out)


def decode(encoded: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Per document: id and ``text``."""
    vocabulary = _shared(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary.value, pattern)
        for batch in batches:
            texts = ["".join(codec.decode(x or [])) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[doc_id, "text"])

    kind = encoded.schema[doc_id].dataType.simpleString()
    return encoded.select(doc_id, ids).mapInArrow(run, f"`{doc_id}` {kind}, text string")


def digests(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes and decodes again in one pass: id, ``n_tokens``, ``ids_sha256`` (decimal ids joined by a space) and
    ``decoded_sha256``; neither ids nor texts are kept."""
    vocabulary = _shared(docs.sparkSession, path)

    def one(codec: Codec, text: str) -> tuple[int, str, str]:
        found = list(map(codec.written.__getitem__, codec.find(text)))
        written = hashlib.sha256(" ".join([f[1] for f in found]).encode())
        return sum([f[0] for f in found]), written.hexdigest(), _digest(codec.read([f[2] for f in found]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary.value, pattern)
        for batch in batches:
            rows = [one(codec, x.as_py() or "") for x in batch.column(1)]
            columns = zip(*rows) if rows else ((), (), ())
            kinds = (pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                names=[doc_id, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    out = f"`{doc_id}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(run, out)
