"""Words and their hashes from Arrow text columns, with numpy, in slices of bounded size.

Words are found on UTF-8 bytes: every separator of the two word classes is an
ASCII byte, so a byte class and a code-point class give the same words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 19

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words between white space: everything but 20 and 09-0D.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False

#: Words of lower-case letters, digits and everything that is not ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[0x30:0x3A] = LETTERS[0x41:0x5B] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True

U64 = np.uint64
_STEP = 0x9E3779B97F4A7C15 | 1
_STEP_BACK = pow(_STEP, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finalizer)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: A random number for each byte; upper-case ASCII has that of lower case.
BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(_STEP))[LOWER]


class _Powers:
    """Powers of an odd number modulo 2**64, and of its inverse, made once per worker and length."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            up, down = np.full(n, _STEP, U64), np.full(n, _STEP_BACK, U64)
            up[0] = down[0] = 1
            up, down = np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)
            if n > 4 * SLICE_BYTES:  # one very long text: not kept
                return up, down
            self.up, self.down = up, down
        return self.up[:n], self.down[:n]


_powers = _Powers()


@dataclass
class Slice:
    """Rows ``lo`` to ``hi`` of a batch: their bytes on end and where each text begins."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a text column (null: empty) into runs of rows of at most ``limit`` bytes; a longer text is a run of its own."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if not n:
        return
    _, ends, body = column.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield Slice(lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        lo = hi


@dataclass
class Words:
    """Byte ranges of the words of a slice; those of text i are ``first[i]`` to ``first[i + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def texts(self) -> np.ndarray:
        """The text of each word, as its place in the slice."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def find_words(part: Slice, kind: np.ndarray) -> Words:
    """All maximal runs of bytes of the class ``kind``; no word crosses a text's end."""
    inside = kind[part.data]
    n = len(inside)
    if not n:
        return Words(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(part.offsets), np.int64))
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = part.offsets[part.offsets < n]
    before[edges] = False
    after[part.offsets[part.offsets > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return Words(starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, part.offsets))


def hash_words(part: Slice, found: Words) -> np.ndarray:
    """A 64-bit hash of each word in lower case: a polynomial over its bytes, spread."""
    if not len(found.starts):
        return np.zeros(0, U64)
    up, down = _powers(len(part.data))
    sums = np.empty(len(part.data) + 1, U64)
    sums[0] = 0
    np.cumsum(BYTE_VALUES[part.data] * up, out=sums[1:])
    return mix((sums[found.ends] - sums[found.starts]) * down[found.starts])


def hash_runs(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of every ``k`` words in a row; entry i covers words i to i + k - 1, across texts too."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    total = words[:n].copy()
    for j in range(1, k):
        total *= U64(_STEP)
        total += words[j:n + j]
    return mix(total + U64(k))


def run_starts(found: Words, k: int) -> np.ndarray:
    """The words that begin a run of ``k`` words inside one text."""
    left = np.repeat(found.first[1:], found.counts) - np.arange(len(found.starts))
    return np.flatnonzero(left >= k)


def lowered(part: Slice, found: Words, lo: int, hi: int) -> list[str]:
    """Words ``lo`` to ``hi`` as strings, A-Z in lower case."""
    return [LOWER[part.data[s:e]].tobytes().decode("utf-8", "replace")
            for s, e in zip(found.starts[lo:hi], found.ends[lo:hi], strict=True)]


def held_out_expr(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text is a multiple of ``mod``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % mod == 0


def row_key(*columns: Column) -> Column:
    """A 64-bit key of a row's contents, of which null is one; equal rows share it and get equal results."""
    known = F.concat(*[F.when(c.isNull(), "0").otherwise("1") for c in columns])
    return F.xxhash64(known, *columns)
