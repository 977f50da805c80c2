"""Arrow batches of texts as numpy arrays: bytes, words, hashes.

Texts are taken whole. Work is cut into groups of documents of a few megabytes,
so the arrays of one group stay small whatever the batch size is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

GROUP_BYTES = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_powers = np.ones(1, np.uint64)


def small_batches(spark: SparkSession, records: int = 1000) -> None:
    """Bound what one Arrow batch of texts holds, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(records))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the hash base modulo 2^64."""
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 2 * len(_powers)), _BASE, np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (in place)."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def run_index(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of consecutive runs of the given lengths."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and each text's offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a run of texts.

    ``first[i]:first[i + 1]`` are the words of text ``i``; ``start`` and ``end``
    are byte positions in ``raw``.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        base = offsets[0]
        self.raw, self.offsets = raw[base : offsets[-1]], offsets - base
        n = len(self.raw)
        space = _SPACE[self.raw]
        word = np.zeros(n + 2, bool)
        word[1:-1] = ~space
        starts = word[1:] & ~word[:-1]
        ends = word[:-1] & ~word[1:]
        cut = self.offsets[1:-1]
        cut = cut[word[cut] & word[cut + 1]]  # a text ends inside a run of word bytes
        starts[cut] = ends[cut] = True
        self.space = space
        self.start, self.end = np.flatnonzero(starts), np.flatnonzero(ends)
        self.first = np.searchsorted(self.start, self.offsets)
        self.count = np.diff(self.first)

    def doc(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)

    def hashes(self, lower: bool = False) -> np.ndarray:
        return span_hashes(_LOWER[self.raw] if lower else self.raw, self.start, self.end)


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of disjoint, ascending, non-empty byte spans."""
    if not len(start):
        return np.zeros(0, np.uint64)
    length = end - start
    at = np.repeat(start - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
    inside = at - np.repeat(start, length)
    values = _VALUE[raw[at]] * powers(int(length.max()))[inside]
    sums = np.add.reduceat(values, np.cumsum(length) - length)
    return mix(sums + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def windows(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``k``-word windows inside texts and their first words' places."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sums = np.zeros(n, np.uint64)
    for j in range(k):
        sums *= _BASE
        sums += hashes[j : j + n]
    count = np.diff(first)
    inside = np.ones(n, bool)
    for f, c in zip(first[1:-1], count[:-1]):  # windows that would cross into the next text
        inside[max(f - min(k - 1, c), 0) : f] = False
    place = np.flatnonzero(inside)
    return mix(sums[place]), place


def groups(offsets: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of about ``limit`` bytes; a longer text stands alone."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


def word_groups(column: pa.Array, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int, Words]]:
    """``(first, last, words)`` for groups of the texts of a column."""
    raw, offsets = text_buffer(column)
    for a, b in groups(offsets, limit):
        yield a, b, Words(raw, offsets[a : b + 1])


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values``, empty runs included."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]
