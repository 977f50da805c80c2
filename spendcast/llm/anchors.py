"""Which fixed-length windows of a sequence repeat, found through shared anchors.

Every window of ``length`` symbols has an anchor: the place of its least
``part``-symbol hash. Equal windows have equal anchors at equal places, so a
window whose anchor occurs once in the corpus occurs once. Consecutive windows
with one anchor form a piece; a piece is named by a 128-bit hash of its symbols.
Pieces are some ten times fewer than windows, and those with a lone anchor are
dropped before any shuffle by a bit table of repeated anchors: its size is a
parameter, and what it lets through in error costs work, never a result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from spendcast.llm.batches import mix
from spendcast.llm.store import brief_shuffles

TABLE_BITS = 28  # 32 MiB on every worker
SLICES = 256
NO_ID = -(1 << 63)  # stands for a null doc_id between the passes

_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_INVERSE = tuple(np.uint64(pow(int(b), -1, 1 << 64)) for b in _BASES)
_tables: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    key = int(base)
    if key not in _tables or len(_tables[key]) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        _tables[key] = np.multiply.accumulate(steps)
    return _tables[key][:n]


class SpanHash:
    """128-bit hashes of spans of one array of symbols, from prefix sums."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.sums = []
        for base in _BASES:
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(symbols * _powers(base, n), out=sums[1:])
            self.sums.append(sums)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = (end - start).astype(np.uint64)
        return tuple(
            mix((s[end] - s[start]) * _powers(inverse, len(s))[start] + size)
            for s, inverse in zip(self.sums, _INVERSE)
        )


@dataclass
class Pieces:
    """``start`` and ``windows`` (how many) per piece, in symbols of the group;
    ``anchor`` is the hash of its anchor, ``at`` the anchor's place."""

    start: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray
    at: np.ndarray


def pieces(symbols: np.ndarray, first: np.ndarray, length: int, part: int) -> Pieces:
    """Pieces of the texts ``first[i]:first[i + 1]`` of an array of symbols."""
    none = np.zeros(0, np.int64)
    n = len(symbols) - length + 1
    if n <= 0:
        return Pieces(none, none, none.astype(np.uint64), none)
    base = _BASES[0]
    sums = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * _powers(base, len(symbols)), out=sums[1:])
    count = len(symbols) - part + 1
    keys = (sums[part:] - sums[:count]) * _powers(_INVERSE[0], count)
    keys = mix(keys)
    # Order by hash, then by place: the upper 40 bits and a 24-bit place.
    order = (keys & np.uint64(0xFFFFFFFFFF000000)) | (np.arange(count, dtype=np.uint64) & np.uint64(0xFFFFFF))
    span, have, least = length - part + 1, 1, order
    while 2 * have <= span:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < span:
        least = np.minimum(least[: len(least) - (span - have)], least[span - have :])
    low = np.arange(n, dtype=np.int64)
    at = low + (((least[:n] & np.uint64(0xFFFFFF)).astype(np.int64) - low) & 0xFFFFFF)
    inside = np.ones(n, bool)
    for f, c in zip(first[1:-1].tolist(), np.diff(first)[:-1].tolist()):
        inside[max(f - min(length - 1, c), 0) : f] = False
    place = np.flatnonzero(inside)
    if not len(place):
        return Pieces(none, none, none.astype(np.uint64), none)
    anchor_at = at[place]
    fresh = np.ones(len(place), bool)
    fresh[1:] = (anchor_at[1:] != anchor_at[:-1]) | (place[1:] != place[:-1] + 1)
    begin = np.flatnonzero(fresh)
    size = np.diff(np.append(begin, len(place)))
    return Pieces(place[begin], size, keys[anchor_at[begin]], anchor_at[begin])


def unpacked(packed: dict[int, bytes], bits: int) -> np.ndarray:
    """The whole of a table sent as compressed slices; absent ones are empty."""
    out = np.zeros(1 << (bits - 3), np.uint8)
    read = zstandard.ZstdDecompressor()
    for s, data in packed.items():
        part = np.frombuffer(read.decompress(data), np.uint8)
        out[s * len(part) : (s + 1) * len(part)] = part
    return out


class BitTable:
    """Membership by one bit per hash; never misses a member."""

    def __init__(self, packed: dict[int, bytes]):
        self.bits = unpacked(packed, TABLE_BITS)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - TABLE_BITS)
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bit_table(hashes: DataFrame) -> dict[int, bytes]:
    """The table of a one-column DataFrame of 64-bit hashes, in compressed slices.

    Bits are found, packed and compressed on the executors; the driver gets SLICES
    strings of at most 32 MiB together however many hashes there are."""
    column = hashes.columns[0]
    width = TABLE_BITS - SLICES.bit_length() + 1
    bits = hashes.select(F.shiftrightunsigned(column, 64 - TABLE_BITS).alias("bit")).distinct()

    def pack(key, table):
        flags = np.zeros(1 << width, np.uint8)
        flags[table.column("bit").to_numpy() & ((1 << width) - 1)] = 1
        data = zstandard.ZstdCompressor(level=1).compress(np.packbits(flags, bitorder="little").tobytes())
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int64()), "data": pa.array([data], pa.binary())})

    with brief_shuffles(hashes.sparkSession):
        sliced = bits.withColumn("slice", F.shiftright("bit", width)).groupBy("slice").applyInArrow(pack, "slice long, data binary")
        return {r["slice"]: bytes(r["data"]) for r in sliced.collect()}


def repeated_anchors(counted: DataFrame) -> dict[int, bytes]:
    """Bit table of anchors that occur at least twice; ``counted`` has ``anchor, n``."""
    twice = counted.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor")
    return bit_table(twice)
