"""Text columns as numpy arrays, inside a task.

An Arrow string column already holds all its texts as one byte buffer with
offsets. The functions here find words and lines in that buffer and hash them
without making a Python string of each. They work on a slice of a batch at a
time, so memory follows ``CHUNK_BYTES`` (or the longest single text), not the
batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15 | 1)

# Words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z are lower-cased: digits,
# a-z and every character beyond ASCII.
_b = np.arange(256)
LOWER = np.where((_b >= 65) & (_b <= 90), _b + 32, _b).astype(np.uint8)
IS_WORD = ((_b >= 48) & (_b <= 57)) | ((_b >= 97) & (_b <= 122)) | (_b >= 128)
IS_BLANK = (_b == 32) | (_b == 9) | (_b == 13)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def byte_codes(seed: int) -> np.ndarray:
    """A pseudo-random 64-bit code for each byte value."""
    return mix((np.arange(256, dtype=U64) + U64(1 + 1000 * seed)) * BASE)


CODES = (byte_codes(1), byte_codes(2))
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of BASE and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) <= n:
        size = max(n + 1, CHUNK_BYTES + 1)
        for name, base in (("up", int(BASE)), ("down", pow(int(BASE), -1, 1 << 64))):
            a = np.full(size, base, dtype=U64)
            a[0] = 1
            _powers[name] = np.multiply.accumulate(a)
    return _powers["up"], _powers["down"]


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive slices of about ``limit`` bytes."""
    data, at = texts(column)
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, side="right")) - 1)
        yield lo, hi, data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def segment_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each data[start:end], the same wherever the bytes stand."""
    n = len(data)
    up, down = powers(n)
    sums = np.zeros(n + 1, dtype=U64)
    np.cumsum(CODES[which][data] * up[:n], out=sums[1:])
    h = (sums[end] - sums[start]) * down[start]
    return mix(h + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


class Words:
    """The words of a slice of texts.

    data: the bytes with A-Z lower-cased; start, end: each word's place there;
    doc: its text; first: index of each text's first word, with one more entry
    at the end.
    """

    def __init__(self, data: np.ndarray, at: np.ndarray):
        self.data = LOWER[data]
        self.at = at
        n = len(data)
        inside = IS_WORD[self.data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[at] = True
        before = np.empty(n, dtype=bool)
        after = np.empty(n, dtype=bool)
        if n:
            before[0], before[1:] = False, inside[:-1]
            after[-1], after[:-1] = False, inside[1:]
        self.start = np.flatnonzero(inside & (~before | edge[:-1]))
        self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, at)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(at) - 1), self.count)

    def hashes(self, which: int = 0) -> np.ndarray:
        return segment_hash(self.data, self.start, self.end, which)

    def text(self, i: int, n: int = 1) -> bytes:
        """Words i..i+n-1 joined by one space."""
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.start[i : i + n], self.end[i : i + n]))


def roll(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive entries of ``h`` (its order counts)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=U64)
    acc = h[:m].copy()
    for k in range(1, n):
        acc *= BASE
        acc += h[k : k + m]
    return mix(acc)


def in_one_text(doc: np.ndarray, n: int) -> np.ndarray:
    """Which windows of n consecutive words lie in one text."""
    m = len(doc) - n + 1
    return doc[:m] == doc[n - 1 :] if m > 0 else np.zeros(0, dtype=bool)


def spread(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c, one after another."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts, counts)


def signed(h: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return h.view(np.int64)
