"""Whole Arrow batches of texts as flat byte arrays: words, lines and hashes without a loop per document."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: White space of the word rule ``[^\x20\x09-\x0D]+``.
SPACES = b" \t\n\x0b\x0c\r"
#: Bytes of text worked on at once; one longer document is worked on alone.
PIECE_BYTES = 2 << 20

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
NEWLINE = 10

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64 bits (the splitmix constants): every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A random-looking 64-bit number per byte value.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B^i and B^-i modulo 2^64."""
    up, down = np.full(n, _ODD, np.uint64), np.full(n, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


class Texts:
    """The texts of a column, null as empty: ``data`` holds their bytes, document i is ``data[at[i]:at[i + 1]]``."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        self.data, self.at, self.n = data, at, len(at) - 1
        self._sums: np.ndarray | None = None

    @classmethod
    def of(cls, column: pa.Array) -> "Texts":
        column = pc.fill_null(column.cast(pa.large_string()), "")
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
        whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        return cls(whole[at[0]:at[-1]], at - at[0])

    def doc_of(self, places: np.ndarray) -> np.ndarray:
        """The document that holds each byte place."""
        return np.searchsorted(self.at, places, "right") - 1

    def count(self, flags: np.ndarray) -> np.ndarray:
        """Flagged bytes of each document."""
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[self.at[1:]] - sums[self.at[:-1]]

    def per_doc(self, doc: np.ndarray, flags: np.ndarray | None = None) -> np.ndarray:
        """Items of each document, or those with the flag."""
        return np.bincount(doc if flags is None else doc[flags], minlength=self.n).astype(np.int64)

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of flagged bytes inside one document: starts, ends and documents."""
        if not len(inside):
            none = np.zeros(0, np.int64)
            return none, none, none
        edge = np.zeros(len(inside) + 1, bool)
        edge[self.at] = True
        before = np.concatenate(([False], inside[:-1]))
        after = np.concatenate((inside[1:], [False]))
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        return starts, ends, self.doc_of(starts)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.runs(~IS_SPACE[self.data])

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        r"""The ``\n``-split parts, empty ones too; an empty document has one empty line."""
        breaks = np.flatnonzero(self.data == NEWLINE)
        doc = np.concatenate((np.arange(self.n), self.doc_of(breaks)))
        starts = np.concatenate((self.at[:-1], breaks + 1))
        order = np.lexsort((starts, doc))
        starts, doc = starts[order], doc[order]
        last = np.concatenate((doc[1:] != doc[:-1], [True])) if len(doc) else np.zeros(0, bool)
        ends = np.concatenate((starts[1:] - 1, [0])) if len(doc) else starts
        ends[last] = self.at[1:][doc[last]]
        return starts, ends, doc

    def strings(self, starts: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
        """The bytes between starts and ends, for spans in order that don't overlap."""
        at = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts, out=at[1:])
        steps, some = np.zeros(len(self.data) + 1, np.int8), ends > starts
        steps[starts[some]] += 1
        steps[ends[some]] -= 1
        inside = np.cumsum(steps[:-1], dtype=np.int8) > 0
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(self.data[inside])])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of the bytes between starts and ends, equal for equal strings wherever they stand.

        For short strings only: long ones of a regular build may share it (``digests`` tells strings of any length apart)."""
        if self._sums is None:
            size = max(PIECE_BYTES, 1 << int(len(self.data)).bit_length()) + 1
            self._up, self._down = _powers(size)
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(_BYTE[self.data] * self._up[: len(self.data)], out=self._sums[1:])
        return mix((self._sums[ends] - self._sums[starts]) * self._down[starts] + (ends - starts).astype(np.uint64))


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``limit`` bytes of text, one document at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        done = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield batch.slice(start, end - start)
        start = end


def codes(strings: pa.LargeBinaryArray) -> tuple[np.ndarray, int]:
    """A number for each string, equal for equal strings only, and how many there are."""
    known = strings.dictionary_encode()
    return known.indices.to_numpy().astype(np.int64), len(known.dictionary)


def digests(strings: pa.LargeBinaryArray) -> np.ndarray:
    """128-bit digests (XXH3), a row of two numbers for each string; equal strings are digested once."""
    known = strings.dictionary_encode()
    each = b"".join(map(xxhash.xxh3_128_digest, known.dictionary.to_pylist()))
    return np.frombuffer(each, np.uint64).reshape(-1, 2)[known.indices.to_numpy()]


def repeated(keys: np.ndarray) -> np.ndarray:
    """Flags the keys that stand twice or more."""
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def later(keys: np.ndarray) -> np.ndarray:
    """Flags the keys that stand earlier in the array too."""
    order = np.argsort(keys, kind="stable")
    out = np.zeros(len(keys), bool)
    out[order[1:][keys[order][1:] == keys[order][:-1]]] = True
    return out
