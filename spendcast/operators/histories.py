"""Whole histories in numpy: rows sorted by customer, a state per series and split.

Spark partitions the rows by customer and sorts them; a task then takes them in
batches and keeps a customer's rows together. A row enters each series once, where an
aggregation would explode it into one element per series and split. Values must be
finite, and a customer must fit one task; blocks.py sends all others another way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from spendcast.functions import ewm
from spendcast.operators.series import STATS

CHUNK = 1 << 17  # rows of whole customers taken at a time
STEPS = 256  # customers up to this long are summed side by side, longer ones one by one
T = np.array(ewm.head_weights())
POWERS = ewm.DECAY ** np.arange(ewm.HEAD)


class Segments:
    """Consecutive runs of rows of the given lengths, none of them empty."""

    def __init__(self, lengths: np.ndarray):
        self.n = lengths
        self.starts = np.cumsum(lengths) - lengths
        self.ends = self.starts + lengths - 1
        self.at = np.arange(lengths.sum()) - np.repeat(self.starts, lengths)
        after = np.repeat(lengths, lengths) - 1 - self.at
        self.head = T[np.minimum(self.at, ewm.HEAD - 1)]
        self.tail = np.where(after < ewm.HEAD, POWERS[np.minimum(after, ewm.HEAD - 1)], ewm.DECAY ** after.astype(float))

    def sum(self, x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x, self.starts)

    def running(self, x: np.ndarray) -> np.ndarray:
        """Running sums of each run, added in order so that no other run touches them."""
        out = x.copy()
        long = self.n > STEPS
        for start, end in zip(self.starts[long], self.ends[long]):
            out[start : end + 1] = np.cumsum(x[start : end + 1])
        starts, n = self.starts[~long], self.n[~long]
        for k in range(1, int(n.max(initial=1))):
            starts, n = starts[n > k], n[n > k]
            out[starts + k] += out[starts + k - 1]
        return out

    def states(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """What ``states.block_states`` says of every run, without the folds."""
        total, low, high = self.sum(x), np.minimum.reduceat(x, self.starts), np.maximum.reduceat(x, self.starts)
        apart = x - np.repeat(total / self.n, self.n)
        flat, square = low == high, apart * apart
        return {
            "n": self.n, "total": total, "low": low, "high": high,
            "m2": np.where(flat, 0.0, self.sum(square)), "m3": np.where(flat, 0.0, self.sum(square * apart)),
            "first": x[self.starts], "last": x[self.ends],
            "tail": self.sum(x * self.tail), "head": self.sum(x * self.head),
        }


def statistics(s: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The ten statistics of states, NaN where undefined."""
    n, w = s["n"].astype(float), ewm.DECAY
    with np.errstate(all="ignore"):
        skew = np.sqrt(n * (n - 1)) / (n - 2) * (s["m3"] / n) / (s["m2"] / n) ** 1.5
        following = T[np.minimum(s["n"], ewm.HEAD - 1)]
        return {
            "max": s["high"], "min": s["low"], "sum": s["total"], "mean": s["total"] / n, "count": n,
            "std": np.where(n > 1, np.sqrt(s["m2"] / (n - 1)), np.nan),
            "skew": np.where(n < 3, np.nan, np.where(s["low"] == s["high"], 0.0, skew)),
            "mean_ewm": (s["head"] - following * s["tail"] * w) / n,
            "last_ewm": s["tail"] * (1 - w) / (1 - w**n),
            "avg_diff": np.where(n > 1, (s["last"] - s["first"]) / (n - 1), np.nan),
        }


def whole_customers(batches: Iterable[pa.RecordBatch], key: str = "customer_id") -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole customers, and the number of rows of each."""
    held, size, wanted = [], 0, CHUNK
    for last, batch in _ends(batches):
        if batch is not None:
            held.append(batch)
            size += batch.num_rows
        if not size or (size < wanted and not last):
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        ids = table[key]
        turns = np.flatnonzero(pc.not_equal(ids.slice(1), ids.slice(0, size - 1)).to_numpy()) + 1
        cut = size if last else int(turns[-1]) if len(turns) else 0
        if not cut:
            held, wanted = table.to_batches(), 2 * wanted
            continue
        yield table.slice(0, cut), np.diff(np.concatenate([[0], turns[turns < cut], [cut]]))
        held, size, wanted = table.slice(cut).to_batches(), size - cut, CHUNK


def _ends(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch | None]]:
    for batch in batches:
        yield False, batch
    yield True, None


def distinct_in(runs: np.ndarray, column: pa.ChunkedArray, inside: np.ndarray, count: int) -> np.ndarray:
    """Distinct values of each run among the rows ``inside``; runs are numbered."""
    codes = column.combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
    names = np.unique((runs * (codes.max(initial=0) + 1) + codes)[inside])
    return np.bincount(names // (codes.max(initial=0) + 1), minlength=count).astype(float)


def history_rows(
    values: Sequence[str], sums: dict[str, str], lags: dict[str, str], splits: dict[str, int], uniques: dict[str, str], names: Sequence[str],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's work: one row per customer and split with all statistics.

    ``values`` are the series in order; ``sums`` are those that are running sums of a
    column by customer, ``lags`` those that are differences of a column. ``splits`` gives
    the age a row must exceed, ``uniques`` the column each distinct count is of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, lengths in whole_customers(batches):
            column = lambda c: table[c].combine_chunks().to_numpy(zero_copy_only=False)
            whole, age = Segments(lengths), column("__age")
            owner = np.repeat(np.arange(len(lengths)), lengths)
            found = {v: whole.running(column(c)) for v, c in sums.items()}
            for v, c in lags.items():
                x = column(c)
                found[v] = np.concatenate([[0.0], x[1:] - x[:-1]])  # the first of a run is dropped below
            for v in values:
                if v not in found:
                    found[v] = column(v)
            for split, oldest in splits.items():
                inside = age > oldest
                kept = np.bincount(owner[inside], minlength=len(lengths))
                at = np.flatnonzero(kept)
                if not len(at):
                    continue
                parts = [table["customer_id"].take(pa.array(whole.starts[at])).combine_chunks(), pa.array([split] * len(at))]
                segments = Segments(kept[at])
                rest = inside & (whole.at > 0)
                more = kept[at] > 1
                later = Segments(kept[at][more] - 1) if more.any() and lags else None
                for v in values:
                    if v not in lags:
                        stats = statistics(segments.states(found[v][inside]))
                    else:
                        stats = {name: np.where(more, 0.0, np.nan) for name in STATS}
                        stats["sum"], stats["count"] = np.zeros(len(at)), np.zeros(len(at))
                        for name, y in (statistics(later.states(found[v][rest])) if later else {}).items():
                            stats[name][more] = y
                    parts += [pa.array(stats[name], mask=np.isnan(stats[name])) for name in STATS]
                parts += [pa.array(distinct_in(owner, table[c], inside, len(lengths))[at]) for c in uniques.values()]
                yield pa.RecordBatch.from_arrays(parts, names=list(names))

    return run

