"""Language-model scores from a log-frequency Bloom filter.

Words are read with A-Z lower-cased; every text ends with an end token. Counts of all
words and of all word pairs are quantised on a logarithmic scale; level ``j`` of an
n-gram is a member of the filter for every ``j`` up to its own, so probing levels
until one is missing reads the count back. The filter has ``BITS_PER`` bits for each
such setting, which sets ``FLAGS`` bits in each of ``WORDS`` words of 64: an absent
level is read as set with a chance of some 1e-5, whatever the input's size. Pairs are smoothed by words, all counts read from
the filter: ``(c(h, w) + mu * p(w)) / (c(h) + mu)``.

The filter is cut by the upper bits of the n-gram's hash into slices of a few
megabytes, which stay a table. Texts are kept in groups of about a megabyte; a group
asks each slice for its distinct n-grams at once, the slice answers with a byte for
each, and the answers return to the group. Nothing is broadcast and nothing larger
than a slice is in one place; questions to one slice are spread over several tasks
once they outgrow one. Beside its bits a slice holds the exact counts of its words,
for the unigram base.

Edge cases: a null or empty text is its end token alone; rows without doc_id count
as training rows; repeated rows are scored alike and counted each; without
training rows every count is 0; an empty table gives an empty table; other columns
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from spendcast.llm.batches import GROUP_BYTES, Words, groups, mix, small_batches, text_buffer
from spendcast.llm.quotient import summed
from spendcast.llm.store import Store

BITS_PER = 28  # filter bits for every (n-gram, level) that is set
WORDS, FLAGS = 3, 4  # 64-bit words probed for one of them, bits in each
SLICE_BYTES = 4 << 20
WORD_BYTES = 6  # of text for each distinct n-gram of a group, about
ASKED = 2_000_000  # n-grams that one task answers, about
SHORT = 5  # bytes of a pair within its slice: they clash far less often than the filter errs
FLUSH = 500_000  # distinct n-grams a task gathers before it passes them on
QUANT = 1.5
MU = 50.0
HELD_OUT = (5, 1)

_GOLD = np.uint64(0x9E3779B97F4A7C15)
END, START = (mix(np.array([i], np.uint64))[0] for i in (101, 103))


def pair_key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(mix(left * _GOLD) + right)


def filter_places(keys: np.ndarray, level: int, probe: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a level of each key, the word of one probe in a slice of ``words`` words and its bits there."""
    own = mix(keys + np.uint64((level * WORDS + probe) * int(_GOLD) % (1 << 64)))
    place = ((own >> np.uint64(32)) * np.uint64(words) >> np.uint64(32)).astype(np.int64)
    bits = np.uint64(1) << (own & np.uint64(63))
    for _ in range(FLAGS - 1):
        own >>= np.uint64(6)
        bits |= np.uint64(1) << (own & np.uint64(63))
    return place, bits


def filter_width(settings: int) -> int:
    """64-bit words of a slice for so many set (n-gram, level)."""
    return max(1, -(-settings * BITS_PER // 64))


def slice_bits(settings: int) -> int:
    """Upper bits of a key that name its slice, so that slices have SLICE_BYTES at most."""
    return max(0, (settings * BITS_PER // 8 // SLICE_BYTES).bit_length())


def slice_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def shortened(keys: np.ndarray) -> bytes:
    """The lower bytes of keys, enough to tell those of one slice apart."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SHORT].tobytes()


def lengthened(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // SHORT, 8), np.uint8)
    out[:, :SHORT] = np.frombuffer(data, np.uint8).reshape(-1, SHORT)
    return out.view("<u8").ravel()


def quantised(count: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(count, 1)) / math.log(QUANT) + 1e-9).astype(np.int64)


def middle(level: np.ndarray) -> np.ndarray:
    """The geometric middle of each level, 0 for none."""
    return np.where(level == 0, 0.0, np.where(level == 1, 1.0, QUANT ** (level - 0.5)))


class LogFrequencyFilter:
    """One slice: sets the levels of n-grams and reads them back."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray) -> LogFrequencyFilter:
        level = quantised(counts)
        words = np.zeros(filter_width(int(level.sum())), np.uint64)
        for j in range(1, int(level.max(initial=0)) + 1):
            own = keys[level >= j]
            for probe in range(WORDS):
                np.bitwise_or.at(words, *filter_places(own, j, probe, len(words)))
        return cls(words)

    def levels(self, keys: np.ndarray, most: int = 127) -> np.ndarray:
        level = np.zeros(len(keys), np.uint8)
        active, held = np.arange(len(keys)), keys
        for j in range(1, most + 1):
            for probe in range(WORDS):
                place, bits = filter_places(held, j, probe, len(self.words))
                hit = self.words[place] & bits == bits
                active, held = active[hit], held[hit]
            if not len(active):
                break
            level[active] = j
        return level


def training(docs: DataFrame) -> DataFrame:
    """``doc_id, text, held_out``."""
    folds, fold = HELD_OUT
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), held.alias("held_out"))


_GROUPED = "ids array<long>, texts array<string>, held array<boolean>, size long"


def grouped(rows: DataFrame) -> DataFrame:
    """``group, ids, texts, held, size``: texts side by side, about a megabyte a row; a longer
    one stands alone. Groups get their names once the table is stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = text_buffer(batch.column(1))
            for lo, hi in groups(offsets, GROUP_BYTES):
                ends = pa.array([0, hi - lo], pa.int32())
                own = [batch.column(c).slice(lo, hi - lo) for c in range(3)]
                size = pa.array([int(offsets[hi] - offsets[lo])], pa.int64())
                yield pa.RecordBatch.from_arrays([*(pa.ListArray.from_arrays(ends, c) for c in own), size], ["ids", "texts", "held", "size"])

    return rows.mapInArrow(run, _GROUPED).withColumn("group", F.monotonically_increasing_id())


class _Gather:
    """Merges counted keys until there are enough to pass on."""

    def __init__(self):
        self.keys, self.counts, self.held = [], [], 0

    def add(self, keys: np.ndarray) -> bool:
        """Whether there are enough."""
        key, n = np.unique(keys, return_counts=True)
        self.keys.append(key)
        self.counts.append(n)
        self.held += len(key)
        if self.held > 2 * FLUSH:
            self.merge()
            return self.held > FLUSH
        return False

    def merge(self) -> None:
        key, n = summed(np.concatenate(self.keys), np.concatenate(self.counts))
        self.keys, self.counts, self.held = [key], [n], len(key)

    def take(self, bits: int, pack) -> dict[int, tuple[bytes, bytes]]:
        """Keys and their counts by slice."""
        if not self.keys:
            return {}
        self.merge()
        (key,), (n,) = self.keys, self.counts
        self.keys, self.counts, self.held = [], [], 0
        used, begin = np.unique(slice_of(key, bits), return_index=True)
        ends = np.append(begin[1:], len(key))
        return {s: (pack(key[a:b]), n[a:b].tobytes()) for s, a, b in zip(used.tolist(), begin.tolist(), ends.tolist())}


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens, of what stands before each, and the texts' offsets in them."""
    raw, offsets = text_buffer(texts)
    w = Words(raw, offsets)
    at = w.first + np.arange(len(w.first))
    tokens = np.empty(int(at[-1]), np.uint64)
    words = np.ones(len(tokens), bool)
    words[at[1:] - 1] = False
    tokens[words], tokens[~words] = w.hashes(lower=True), END
    left = np.empty_like(tokens)
    left[1:] = tokens[:-1]
    left[at[:-1]] = START
    return tokens, left, at


_COUNTED = ("words", "word_counts", "pairs", "pair_counts")


def counted(texts: DataFrame, bits: int) -> DataFrame:
    """``slice`` and the words and pairs of the training texts in it with their counts,
    in one pass; a task passes on what it has gathered, cut by slice."""
    schema = "slice long, " + ", ".join(f"{c} binary" for c in _COUNTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs = _Gather(), _Gather()

        def passed() -> pa.RecordBatch:
            found = [words.take(bits, np.ndarray.tobytes), pairs.take(bits, shortened)]
            used = sorted(set(found[0]) | set(found[1]))
            blobs = [[f.get(s, (b"", b""))[i] for s in used] for f in found for i in (0, 1)]
            return pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), *(pa.array(b, pa.binary()) for b in blobs)], ["slice", *_COUNTED])

        for batch in batches:
            for row, held in zip(batch.column(0), batch.column(1)):
                train = row.values.filter(pc.invert(held.values))
                if len(train):
                    tokens, left, _ = tokens_of(train)
                    words.add(tokens)
                    if pairs.add(pair_key(left, tokens)):
                        yield passed()
        yield passed()

    return texts.select("texts", "held").mapInArrow(run, schema)


def slices_of(counts: DataFrame) -> DataFrame:
    """``slice, bits, words, counts, tokens, distinct``: the filter of a slice, the exact
    counts of its words, and what they add up to."""
    names = ["slice", "bits", "words", "counts", "tokens", "distinct"]

    def run(key, table):
        whole = [b"".join(table.column(c).to_pylist()) for c in _COUNTED]
        words, n = summed(np.frombuffer(whole[0], np.uint64), np.frombuffer(whole[1], np.int64))
        pairs, m = summed(lengthened(whole[2]), np.frombuffer(whole[3], np.int64))
        held = LogFrequencyFilter.of(np.concatenate([words, pairs]), np.concatenate([n, m])).words
        blobs = [pa.array([x.tobytes()], pa.binary()) for x in (held, words, n)]
        return pa.table([pa.array([key[0].as_py()]), *blobs, pa.array([int(n.sum())]), pa.array([len(words)])], names)

    return counts.groupBy("slice").applyInArrow(run, "slice long, bits binary, words binary, counts binary, tokens long, distinct long")


def questions(texts: DataFrame, bits: int, parts: int) -> DataFrame:
    """``slice, part, group, words, pairs``: the distinct n-grams of each group, sorted,
    cut by slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, row in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens, left, _ = tokens_of(row.values)
                asked = [np.unique(tokens), np.unique(pair_key(left, tokens))]
                number = [slice_of(k, bits) for k in asked]
                used = np.union1d(*number)
                cuts = [(np.searchsorted(s, used, "left").tolist(), np.searchsorted(s, used, "right").tolist()) for s in number]
                blobs = [[pack(k[a:b]) for a, b in zip(*c)] for pack, k, c in zip((np.ndarray.tobytes, shortened), asked, cuts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used), pa.array(np.full(len(used), group % parts)), pa.array(np.full(len(used), group)), *(pa.array(b, pa.binary()) for b in blobs)],
                    ["slice", "part", "group", "words", "pairs"],
                )

    return texts.select("group", "texts").mapInArrow(run, "slice long, part long, group long, words binary, pairs binary")


def answers(asked: DataFrame, slices: DataFrame, parts: int) -> DataFrame:
    """``group, slice, counts, words, pairs``: exact counts of the words asked for, and
    the levels of words and pairs, a byte each."""

    def run(key, left, right):
        slots = [np.frombuffer(right.column(c)[0].as_py(), kind) if right.num_rows else np.zeros(0, kind) for c, kind in (("bits", np.uint64), ("words", np.uint64), ("counts", np.int64))]
        held, known, counts = LogFrequencyFilter(slots[0]) if len(slots[0]) else None, *slots[1:]
        out = []
        for column, size in (("words", 8), ("pairs", SHORT)):
            # Groups ask for much the same: each n-gram is looked up once.
            blobs = left.column(column).to_pylist()
            whole = b"".join(blobs)
            keys, back = np.unique(lengthened(whole) if size == SHORT else np.frombuffer(whole, np.uint64), return_inverse=True)
            cut = np.cumsum([0, *(len(b) // size for b in blobs)]).tolist()
            levels = held.levels(keys) if held else np.zeros(len(keys), np.uint8)
            found = [levels]
            if column == "words":
                place = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
                exact = np.where(known[place] == keys, counts[place], 0) if len(known) else np.zeros(len(keys), np.int64)
                found = [exact, levels]
            out += [[x[back[a:b]].tobytes() for a, b in zip(cut[:-1], cut[1:])] for x in found]
        return pa.table([left.column("group"), left.column("slice"), *(pa.array(c, pa.binary()) for c in out)], ["group", "slice", "counts", "words", "pairs"])

    dealt = slices.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    schema = "group long, slice long, counts binary, words binary, pairs binary"
    return asked.groupBy("slice", "part").cogroup(dealt.groupBy("slice", "part")).applyInArrow(run, schema)


def model_scores(word: np.ndarray, context: np.ndarray, pair: np.ndarray, scale: float) -> np.ndarray:
    """log10 probability of tokens from the quantised counts of the token, of what stands
    before it and of both."""
    base = (word + 0.5) / scale
    return np.log10((np.minimum(pair, context) + MU * base) / (context + MU))


def finished(texts: DataFrame, told: DataFrame, tokens: int, scale: float) -> DataFrame:
    """Scores of all texts from the answers to their groups."""
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(key, left, right):
        right = right.sort_by("slice")
        counts, words, pairs = (
            np.frombuffer(b"".join(right.column(c).to_pylist()), kind) for c, kind in (("counts", np.int64), ("words", np.uint8), ("pairs", np.uint8))
        )
        ids, rows, held = (left.column(c)[0].values for c in ("ids", "texts", "held"))
        own, before, at = tokens_of(rows)
        distinct, place = np.unique(own, return_inverse=True)
        _, which = np.unique(pair_key(before, own), return_inverse=True)
        exact, quant = counts[place], middle(words)
        # What stands before a token is the token before it, or the start: as often as an end.
        context = np.empty(len(own))
        context[1:] = quant[place[:-1]]
        context[at[:-1]] = quant[np.searchsorted(distinct, END)]
        by = np.repeat(np.arange(len(rows)), np.diff(at))
        sums = [np.bincount(by, x, len(rows)) for x in (np.log10((exact + 0.5) / scale), model_scores(quant[place], context, middle(pairs)[which], scale))]
        known = np.bincount(by, exact > 0, len(rows)).astype(np.int64)
        return pa.table([ids, held, pa.array(np.diff(at)), pa.array(known), pa.array(np.full(len(rows), tokens)), *map(pa.array, sums)], names)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return texts.groupBy("group").cogroup(told.groupBy("group")).applyInArrow(run, schema)


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    spark = docs.sparkSession
    small_batches(spark)
    store = Store(spark)
    texts = store.put(grouped(training(docs)), "text-groups", "zstd")
    asked = texts.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] // WORD_BYTES
    bits = slice_bits(asked)
    slices = store.put(slices_of(counted(texts, bits)), "filter-slices", "zstd")
    tokens, distinct = slices.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "distinct"))).first()
    parts = max(1, -(-asked // (ASKED << bits)))
    told = store.put(answers(questions(texts, bits, parts), slices, parts), "answers", "zstd")
    store.drop("filter-slices")
    out = store.put(finished(texts, told, tokens, tokens + 0.5 * (distinct + 1)), "scores")
    store.drop("answers", "text-groups")
    return out


def lm_query(spark: SparkSession, folder: str) -> DataFrame:
    return score(spark.read.parquet(f"{folder}/documents.parquet"))
