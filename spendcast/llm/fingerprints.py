"""Document fingerprints from prefix polynomial hashes.

A prefix array holds the polynomial hash of every prefix of a text modulo two
primes, so any two spans compare by two subtractions and a shift, and the longest
common extension of two places is found by binary search. A fingerprint keeps the
length and the prefix hashes at up to ``POINTS`` evenly stepped places; two
fingerprints are compared by common extensions on their grid.

The query also needs each document's successor by doc_id. Documents are dealt to
ranges of doc_id whose bounds are existing ids, each bound's document also going
to the range before it as its successor; texts travel compressed.

Edge cases: a null or empty text has length 0; the likeness of two empty texts is
1, of an empty and another 0; a lone document is its own successor; documents of
one doc_id follow each other in text order; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from spendcast.llm.batches import small_batches

PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)
POINTS = 64
RANGE_BYTES = 32 << 20

_powers: list[np.ndarray] = [np.ones(1, np.uint64) for _ in PRIMES]


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)


def _power(which: int, n: int) -> np.ndarray:
    """Powers 0..n of a base, by doubling."""
    have, p = _powers[which], PRIMES[which]
    while len(have) <= n:
        step = np.uint64(pow(BASES[which], len(have), p))
        have = np.concatenate([have, have * step % np.uint64(p)])
    _powers[which] = have
    return have


class PrefixHash:
    """``sums[w][i]`` is the hash of the first ``i`` code points modulo prime ``w``."""

    def __init__(self, points: np.ndarray):
        self.n = len(points)
        self.points = points
        self.sums = []
        for w, p in enumerate(PRIMES):
            # Each term is below 2^31, so 2^32 of them still fit in 64 bits.
            terms = (points.astype(np.uint64) + np.uint64(1)) * _power(w, self.n)[: self.n] % np.uint64(p)
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(terms, out=sums[1:])
            self.sums.append(sums % np.uint64(p))

    def span(self, begin: int, end: int, shift: int) -> tuple[int, ...]:
        """Hash of a span, moved to start at place ``shift`` (at least ``begin``)."""
        return tuple(
            (int(s[end]) - int(s[begin])) * int(_power(w, shift - begin)[shift - begin]) % PRIMES[w]
            for w, s in enumerate(self.sums)
        )


def equal_spans(a: PrefixHash, i: int, b: PrefixHash, j: int, length: int) -> bool:
    to = max(i, j)
    return a.span(i, i + length, to) == b.span(j, j + length, to)


def common_extension(a: PrefixHash, i: int, b: PrefixHash, j: int) -> int:
    """How far the texts agree from place ``i`` of one and ``j`` of the other."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        middle = (low + high + 1) // 2
        if equal_spans(a, i, b, j, middle):
            low = middle
        else:
            high = middle - 1
    return low


def fingerprint(h: PrefixHash) -> str:
    """``length:step:hashes``, prefix hashes at every ``step`` code points and at the end.

    The step is the smallest power of two that needs at most POINTS places, so
    the grids of any two fingerprints nest."""
    step = 1
    while h.n > step * POINTS:
        step *= 2
    at = np.append(np.arange(0, h.n, step), h.n) if h.n else np.zeros(1, np.int64)
    packed = (h.sums[0][at] << np.uint64(31)) | h.sums[1][at]
    return f"{h.n:x}:{step:x}:" + "".join(f"{x:016x}" for x in packed.tolist())


class Grid:
    """A parsed fingerprint."""

    def __init__(self, fingerprint: str):
        n, step, hashes = fingerprint.split(":")
        self.n, self.step = int(n, 16), int(step, 16)
        self.hash = [int(hashes[i : i + 16], 16) for i in range(0, len(hashes), 16)]

    def prefix(self, at: int) -> int:
        return self.hash[-1] if at == self.n else self.hash[at // self.step]

    def span(self, begin: int, end: int, shift: int) -> tuple[int, ...]:
        a, b = self.prefix(begin), self.prefix(end)
        parts = ((a >> 31, b >> 31), (a & 0x7FFFFFFF, b & 0x7FFFFFFF))
        return tuple((y - x) * pow(BASES[w], shift - begin, PRIMES[w]) % PRIMES[w] for w, (x, y) in enumerate(parts))


def likeness(first: str, second: str) -> float:
    """Share of the longer text that lies in spans equal at the same place.

    From each place the longest common extension on the common grid is found by
    binary search, one block is skipped where the texts differ, and the search
    goes on behind it."""
    if first == second:
        return 1.0
    a, b = Grid(first), Grid(second)
    if not a.n or not b.n:
        return 0.0
    step, short = max(a.step, b.step), min(a.n, b.n)
    cuts = [*range(0, short, step), short] if a.n == b.n else list(range(0, short + 1, step))
    at, shared, last = 0, 0, len(cuts) - 1
    while at < last:
        low, high = 0, last - at
        while low < high:
            middle = (low + high + 1) // 2
            i, j = cuts[at], cuts[at + middle]
            if a.span(i, j, i) == b.span(i, j, i):
                low = middle
            else:
                high = middle - 1
        shared += cuts[at + low] - cuts[at]
        at += low + 1
    return shared / max(a.n, b.n)


def edited_text(own: np.ndarray, following: np.ndarray) -> np.ndarray:
    """The last quarter replaced by as many (or all) code points of the next text."""
    cut = len(own) // 4
    return np.concatenate([own[: len(own) - cut], following[:cut]])


def range_bounds(docs: DataFrame, ranges: int) -> list[int]:
    """Existing doc_ids that cut the table into about equal ranges, the least first."""
    shares = [i / ranges for i in range(ranges)]
    found = docs.agg(F.min("doc_id"), F.percentile_approx("doc_id", shares, 20 * ranges)).first()
    return sorted({found[0], *(found[1] or [])} - {None})


def with_successors(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """``part, doc_id, after, data``: range by range in doc_id order, texts compressed.

    ``after`` marks the copy of the next range's first document. Null doc_ids
    form a range of their own at the end of the order."""
    spark = docs.sparkSession
    small_batches(spark)
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    if ranges is None:
        size = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
        ranges = max(1, -(-size // RANGE_BYTES))
    bounds = range_bounds(own, ranges)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            rows = []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = (t or "").encode()
                order, data = hashlib.md5(text).digest()[:8], pack.compress(text)
                part = len(bounds) if i is None else bisect_right(bounds, i) - 1
                rows.append((part, i, False, order, data))
                if i is not None and bounds[part] == i:
                    # The least id follows the last range, others the range before.
                    rows.append(((part or len(bounds)) - 1, i, True, order, data))
                if i is not None and bounds[0] == i:
                    rows.append((len(bounds), i, True, order, data))
            columns = zip(*rows) if rows else [[]] * 5
            types = (pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], ["part", "doc_id", "after", "place", "data"])

    dealt = own.mapInArrow(deal, "part long, doc_id long, after boolean, place binary, data binary")
    return dealt.repartition(len(bounds) + 1, "part").sortWithinPartitions("part", "after", F.col("doc_id").asc_nulls_last(), "place")


def fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()

        def compare(held, following):
            (doc_id, own, mark), (_, other, next_mark) = held, following
            edited = edited_text(own, other)
            changed = fingerprint(PrefixHash(edited))
            digest = hashlib.sha256(edited.tobytes().decode("utf-32-le").encode()).hexdigest()
            return doc_id, len(own), digest, mark, changed, likeness(mark, changed), likeness(mark, next_mark)

        part, held, closed, out = None, None, False, []
        for batch in batches:
            for p, doc_id, after, _, data in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if p != part:
                    if held is not None:  # nothing follows: the only range of an all-null table
                        out.append(compare(held, first))
                    part, held, closed = p, None, False
                if closed or after and held is None:
                    continue  # further rows of the successor's id, or a range without rows
                points = code_points(unpack.decompress(data).decode())
                this = (doc_id, points, fingerprint(PrefixHash(points)))
                if held is None:
                    first = this
                else:
                    out.append(compare(held, this))
                held, closed = (None, True) if after else (this, False)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names)
                out = []
        if held is not None:
            out.append(compare(held, first))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_successors(docs, ranges).mapInArrow(run, schema)


def fingerprint_query(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{folder}/documents.parquet"))
