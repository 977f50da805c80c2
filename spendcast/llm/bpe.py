"""Byte-level BPE by merge replay over the distinct pieces of many texts.

Texts are cut by the tokenizer's pattern. The distinct pieces of some megabytes of texts stand
in one array of token ids linked to their neighbours; an inverted index leads
from each mergeable pair to where it stands. Merges are taken in rank order, each
applied to all pieces at once, and only the touched neighbours enter the
index anew. Pieces of extreme length are replayed one by one.

The work is a map over documents: no shuffle, nothing on the driver. Tasks read
the rank file, which must lie at the same path on every worker.

Edge cases: a null or empty text has no tokens; a lone piece of any length takes
time in proportion to its merges; repeated rows get equal ids; an empty table
gives an empty table; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from spendcast.llm.batches import run_index, small_batches

FLUSH_BYTES = 4 << 20
LONG_PIECE = 256


class MergeReplay:
    """Encodes and decodes by the ranks of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        pairs = {
            (ranks[t[:c]] << 32) | ranks[t[c:]]: i
            for t, i in ranks.items() for c in range(1, len(t)) if t[:c] in ranks and t[c:] in ranks
        }
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_token = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token that each pair makes, or -1."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_token[at], -1)

    def replay(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and how many each has.

        A step takes the lowest rank and merges its leftmost place in every piece
        that has one; further places wait, as a merge may make a lower rank."""
        length = np.array([len(p) for p in pieces], np.int64)
        size = int(length.sum())
        ids = np.full(size + 1, -1, np.int64)
        ids[:size] = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        piece = np.full(size + 1, -1, np.int64)
        piece[:size] = np.repeat(np.arange(len(pieces)), length)
        after, before = np.arange(1, size + 2), np.arange(-1, size)
        makes = np.full(size + 1, -1, np.int64)  # the token of the pair that starts here
        beside = np.flatnonzero(piece[:-1] == piece[1:])
        makes[beside] = self.merged(ids[beside], ids[beside + 1])
        places: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def index(tokens: np.ndarray, at: np.ndarray) -> None:
            order = np.argsort(tokens, kind="stable")
            tokens, at = tokens[order], at[order]
            cut = np.flatnonzero(tokens[1:] != tokens[:-1]) + 1
            for token, a, b in zip(tokens[np.concatenate([[0], cut])].tolist(), [0, *cut.tolist()], [*cut.tolist(), len(at)]):
                if token in places:
                    places[token].append(at[a:b])
                else:
                    places[token] = [at[a:b]]
                    heapq.heappush(queue, token)

        first = np.flatnonzero(makes >= 0)
        if len(first):
            index(makes[first], first)
        while queue:
            token = heapq.heappop(queue)
            found = places.pop(token)
            at = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
            at = at[makes[at] == token]
            if not len(at):
                continue
            own = piece[at]
            if len(at) > 1:
                lead = np.ones(len(at), bool)
                lead[1:] = own[1:] != own[:-1]
                if not lead.all():
                    places[token] = [at[~lead]]
                    heapq.heappush(queue, token)
                    at, own = at[lead], own[lead]
            gone = after[at]
            right, left = after[gone], before[at]
            ids[at], ids[gone], makes[gone], makes[at] = token, -1, -1, -1
            after[at], before[right] = right, at
            r, l = piece[right] == own, piece[left] == own
            a, h = at[r], left[l]
            makes[a] = self.merged(ids[a], ids[right[r]])
            makes[h] = self.merged(ids[h], ids[at[l]])
            touched = np.concatenate([a, h])
            new = makes[touched]
            touched, new = touched[new >= 0], new[new >= 0]
            if len(new):
                index(new, touched)
        stay = ids[:size] >= 0
        return ids[:size][stay], np.bincount(piece[:size][stay], minlength=len(pieces))

    def replay_one(self, piece: bytes) -> list[int]:
        """The same for one long piece, place by place from a heap."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        size, bytes_of, ranks = len(ids), self.bytes_of, self.ranks
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        token = lambda i, j: ranks.get(bytes_of[ids[i]] + bytes_of[ids[j]], -1)
        heap = [(t, i) for i in range(size - 1) if (t := token(i, i + 1)) >= 0]
        heapq.heapify(heap)
        while heap:
            t, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= size or token(i, j) != t:
                continue
            ids[i], ids[j], k, h = t, -1, after[j], before[i]
            after[i] = k
            if k < size:
                before[k] = i
                if (new := token(i, k)) >= 0:
                    heapq.heappush(heap, (new, i))
            if h >= 0 and (new := token(h, i)) >= 0:
                heapq.heappush(heap, (new, h))
        return [i for i in ids if i >= 0]

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text."""
        number: dict[str, int] = defaultdict(count().__next__)
        cut = [np.fromiter(map(number.__getitem__, self.pattern.findall(t)), np.int32) for t in texts]
        pieces = [p.encode() for p in number]
        whole = [self.ranks.get(p, -1) for p in pieces]
        long = {n: self.replay_one(p) for n, p in enumerate(pieces) if len(p) >= LONG_PIECE and whole[n] < 0}
        rest = [n for n, w in enumerate(whole) if w < 0 and n not in long]
        flat, counts = self.replay([pieces[n] for n in rest])
        size = np.ones(len(pieces), np.int64)
        size[rest] = counts
        for n, ids in long.items():
            size[n] = len(ids)
        start = np.cumsum(size) - size
        tokens = np.repeat(np.array(whole, np.int64), size)
        tokens[np.repeat(start[rest], counts) + run_index(counts)] = flat
        for n, ids in long.items():
            tokens[start[n] : start[n] + len(ids)] = ids
        for c in cut:
            yield tokens[np.repeat(start[c], size[c]) + run_index(size[c])] if len(c) else tokens[:0]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def coded(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
        """Keys (first column) and ids of the texts (second), some megabytes at a time."""
        keys, texts, held = [], [], 0
        for batch in batches:
            keys += batch.column(0).to_pylist()
            texts += [t or "" for t in batch.column(1).to_pylist()]
            held += batch.nbytes
            if held >= FLUSH_BYTES:
                yield keys, self.encode(texts)
                keys, texts, held = [], [], 0
        if keys:
            yield keys, self.encode(texts)


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> MergeReplay:
    """The vocabulary at ``path``, once per Python worker."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, map(bytes.strip, lines)))}
    return MergeReplay(ranks, pattern)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` of every document."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path, pattern)
        for keys, coded in model.coded(batches):
            ids = [x.astype(np.int32) for x in coded]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, data`` (bytes) of every row of ``doc_id, ids``."""
    small_batches(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path, pattern)
        for batch in batches:
            data = [model.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def round_trip(docs: DataFrame, path: str, pattern: str, ids: bool = False) -> DataFrame:
    """Token count and digests of the ids and of the bytes decoded from them, and
    the ids themselves if asked for."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path, pattern)
        for keys, coded in model.coded(batches):
            counts, sent, back, held = [], [], [], []
            for found in coded:
                tokens = found.tolist()
                counts.append(len(tokens))
                sent.append(hashlib.sha256(",".join(map(str, tokens)).encode()).hexdigest())
                back.append(hashlib.sha256(model.decode(tokens)).hexdigest())
                if ids:
                    held.append(found.astype(np.int32))
            columns = [pa.array(keys, pa.int64()), pa.array(counts, pa.int64()), pa.array(sent, pa.string()), pa.array(back, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                columns.append(pa.array(held, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def default_vocabulary() -> tuple[str, str]:
    """Path and pattern of the installed multilingual byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def bpe_query(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{folder}/documents.parquet"), *default_vocabulary())
