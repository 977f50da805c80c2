"""Counting quotient filters as numpy arrays.

A fingerprint is split in a quotient, the upper bits, and a remainder. The
remainders of one quotient stand side by side, sorted, in a run of slots that begins
at the quotient's own slot or after the run before it. One bit per quotient tells
whether it has a run, one bit per slot whether a run ends there; a third tells
whether a counter above one goes with the slot. Nothing of a fingerprint is lost, so
filters of any size list their fingerprints in order, and merge by those lists.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SCHEMA = "quotient_bits int, occupied binary, run_ends binary, remainders binary, many binary, counters binary"
FIELDS = tuple(f.split()[0] for f in SCHEMA.split(", "))


def _pack(flags: np.ndarray) -> bytes:
    return np.packbits(flags, bitorder="little").tobytes()


def _places(packed: bytes) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little"))


@dataclass
class QuotientFilter:
    """A filter of 64-bit fingerprints; the fields are what is stored of it."""

    quotient_bits: int
    occupied: bytes
    run_ends: bytes
    remainders: bytes
    many: bytes
    counters: bytes

    @classmethod
    def of(cls, fingerprints: np.ndarray, counts: np.ndarray) -> QuotientFilter:
        """The filter of distinct fingerprints in ascending order, a quarter of its slots free."""
        n = len(fingerprints)
        bits = max(int(np.ceil(np.log2(max(n, 1) / 0.75))), 1)
        rest = np.uint64(64 - bits)
        quotient = (fingerprints >> rest).astype(np.int64)
        remainder = fingerprints & ((np.uint64(1) << rest) - np.uint64(1))
        number = np.arange(n)
        slot = np.maximum.accumulate(quotient - number) + number if n else number
        slots = int(slot[-1]) + 1 if n else 0
        occupied = np.zeros(1 << bits, bool)
        occupied[quotient] = True
        ends, many = np.zeros(slots, bool), np.zeros(slots, bool)
        ends[slot[np.append(quotient[1:] != quotient[:-1], True)] if n else slot] = True
        many[slot[counts > 1]] = True
        stored = np.zeros(slots, "<u8")
        stored[slot] = remainder
        width = -(-(64 - bits) // 8)
        return cls(
            bits, _pack(occupied), _pack(ends), stored.view(np.uint8).reshape(-1, 8)[:, :width].tobytes(), _pack(many),
            counts[counts > 1].astype("<i8").tobytes(),
        )

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """All fingerprints in ascending order and their counts."""
        quotient, end = _places(self.occupied), _places(self.run_ends)
        start = np.maximum(quotient, np.concatenate([[0], end[:-1] + 1]) if len(end) else end)
        size = end - start + 1
        slot = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        rest = 64 - self.quotient_bits
        width = -(-rest // 8)
        stored = np.zeros((len(self.remainders) // width, 8), np.uint8)
        stored[:, :width] = np.frombuffer(self.remainders, np.uint8).reshape(-1, width)
        remainder = stored.view("<u8").ravel()[slot]
        counts = np.ones(len(stored), np.int64)
        counts[_places(self.many)] = np.frombuffer(self.counters, "<i8")
        return np.repeat(quotient.astype(np.uint64), size) << np.uint64(rest) | remainder, counts[slot]


def summed(fingerprints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints in ascending order with their added counts."""
    order = np.argsort(fingerprints, kind="stable")
    fingerprints, counts = fingerprints[order], counts[order]
    fresh = np.flatnonzero(np.append(True, fingerprints[1:] != fingerprints[:-1])) if len(order) else order
    return fingerprints[fresh], np.add.reduceat(counts, fresh) if len(order) else counts


def merge(filters: list[QuotientFilter]) -> QuotientFilter:
    """One filter of all: their ascending lists are merged, counts add up."""
    parts = [f.entries() for f in filters]
    return QuotientFilter.of(*summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])))
