"""Removal of byte strings that occur more than once, by suffix arrays.

Only pieces of texts whose anchor repeats (see anchors.py) can hold a repeated
string. Equal pieces are found by name; of pieces that differ but share an anchor,
one copy each goes, as bytes, into shards of bounded size. A shard's suffix array
is made by Larsson-Sadakane refinement (prefix doubling that sorts only the groups
not yet told apart), its common prefixes by Kasai's walk, taken along all pieces
in step. An anchor lives in one shard unless it has too many bytes for one; the
shards of such an anchor merge by binary search of their sorted string names.

Edge cases: null or empty texts and texts shorter than the string length keep
everything; repeated rows are separate copies, so long ones lose everything;
different texts that share a doc_id, or have none, are texts of their own, told apart
by a hash; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from spendcast.llm.anchors import NO_ID, BitTable, SpanHash, bit_table, pieces, repeated_anchors
from spendcast.llm.batches import _VALUE, groups, small_batches, text_buffer
from spendcast.llm.substring_dedup import _batch, _joined, _texts, split_by_table, spot, spots_of
from spendcast.llm.store import Store

LENGTH, PART = 400, 48
SHARD_BYTES = 2 << 20
SLICE_NAMES = 1 << 18
PIECES = 1 << 12  # pieces a task passes on at once


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted suffixes and each place's first eight bytes as a number.

    Larsson-Sadakane: each round doubles the sorted depth, only groups of suffixes
    not yet told apart are sorted again. Ties must be broken to the end, or the
    common prefixes below would not carry over."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    head = np.zeros(n, np.uint64)
    for k in range(8):
        head = (head << np.uint64(8)) | padded[k : k + n].astype(np.uint64)
    order = np.argsort(head, kind="stable")
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    split = np.ones(n, bool)
    split[1:] = head[order[1:]] != head[order[:-1]]
    rank[order] = np.maximum.accumulate(np.where(split, np.arange(n), 0))
    done = 8
    while True:
        last = np.append(split[1:], True)
        open_ = np.flatnonzero(~(split & last))  # places in groups of several
        if not len(open_):
            break
        members = order[open_]
        own, then = rank[members], rank[np.minimum(members + done, n)]
        by = np.argsort(own * (n + 1) + then + 1, kind="stable")
        members, own, then = members[by], own[by], then[by]
        order[open_] = members
        fresh = np.ones(len(open_), bool)
        fresh[1:] = (own[1:] != own[:-1]) | (then[1:] != then[:-1])
        split[open_] = fresh
        rank[members] = np.maximum.accumulate(np.where(fresh, open_, 0))
        done *= 2
    return order, head


def common_prefixes(text: np.ndarray, order: np.ndarray, head: np.ndarray, start: np.ndarray, size: np.ndarray, most: int) -> np.ndarray:
    """Kasai: length shared with the suffix before in the array, at most ``most``,
    for every place of the text, which the pieces cover.

    From one place to the next the length falls by one at most, so each piece
    goes on from what it had; all pieces walk side by side."""
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int64)
    by = np.argsort(-size, kind="stable")
    start, size = start[by], size[by]
    have = np.zeros(len(start), np.int64)
    at_least = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), "left")
    for t, active in enumerate(at_least.tolist()):  # pieces longer than t
        p = start[:active] + t
        q = before[p]
        h = np.maximum(have[:active] - 1, 0)
        h[q < 0] = 0
        go = np.flatnonzero(q >= 0)
        while len(go):  # eight bytes at a time
            x, y = p[go] + h[go], q[go] + h[go]
            fits = (np.maximum(x, y) + 8 <= n) & (h[go] < most)
            go, x, y = go[fits], x[fits], y[fits]
            same = head[x] == head[y]
            go = go[same]
            h[go] += 8
        go = np.flatnonzero(q >= 0)
        while len(go):
            x, y = p[go] + h[go], q[go] + h[go]
            fits = (np.maximum(x, y) < n) & (h[go] < most)
            go, x, y = go[fits], x[fits], y[fits]
            go = go[text[x] == text[y]]
            h[go] += 1
        have[:active] = np.minimum(h, most)
        out[p] = have[:active]
    return out


def repeated_strings(text: np.ndarray, start: np.ndarray, strings: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the strings of ``length`` bytes that start in a shard's pieces.

    Piece ``i`` has ``strings[i]`` of them. Returns the places where strings start
    and the class of each."""
    order, head = suffix_array(text)
    shared = common_prefixes(text, order, head, start, strings + length - 1, length)
    number = np.empty(len(text), np.int64)
    number[order] = np.cumsum(shared[order] < length)
    place = np.repeat(start - (np.cumsum(strings) - strings), strings) + np.arange(int(strings.sum()))
    return place, number[place]


def _byte_groups(column) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    raw, offsets = text_buffer(column)
    for lo, hi in groups(offsets):
        yield lo, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]


def anchor_counts(docs: DataFrame, length: int, part: int) -> DataFrame:
    schema = "anchor long, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [pieces(_VALUE[raw], first, length, part).anchor for _, raw, first in _byte_groups(batch.column(1))]
            key, n = np.unique(_joined(found, np.uint64), return_counts=True)
            yield _batch(schema, anchor=key, n=n.astype(np.int64))

    return _texts(docs).mapInArrow(run, schema)


def named_pieces(docs: DataFrame, table, length: int, part: int) -> DataFrame:
    """Pieces whose anchor may repeat, by the 128-bit name of their bytes."""
    schema = "a long, b long, anchor long, doc long, mark long, start int, n int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = BitTable(table.value)
        for batch in batches:
            doc_ids, marks = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for lo, raw, first in _byte_groups(batch.column(1)):
                symbols = _VALUE[raw]
                p = pieces(symbols, first, length, part)
                keep = known.has(p.anchor)
                if not keep.any():
                    continue
                start, n = p.start[keep], p.windows[keep]
                owner = np.searchsorted(first, start, "right") - 1
                a, b = SpanHash(symbols)(start, start + n + length - 1)
                yield _batch(schema, a=a, b=b, anchor=p.anchor[keep], doc=doc_ids[lo + owner], mark=marks[lo + owner], start=start - first[owner], n=n)

    return _texts(docs).mapInArrow(run, schema)


def piece_bytes(docs: DataFrame, spots, table, length: int, part: int) -> DataFrame:
    """The bytes of the pieces whose coordinates are in the table ``spots``."""
    names = ["anchor", "doc", "mark", "start", "n", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, known = BitTable(spots.value), BitTable(table.value)
        for batch in batches:
            doc_ids, marks = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for lo, raw, first in _byte_groups(batch.column(1)):
                p = pieces(_VALUE[raw], first, length, part)
                owner = np.searchsorted(first, p.start, "right") - 1
                start = p.start - first[owner]
                keep = np.flatnonzero(known.has(p.anchor) & wanted.has(spot(doc_ids[lo + owner], marks[lo + owner], start)))
                # Neighbouring pieces share bytes, so little is held at once.
                for at in range(0, len(keep), PIECES):
                    k = keep[at : at + PIECES]
                    size = p.windows[k] + length - 1
                    data = b"".join([raw[s : s + z].tobytes() for s, z in zip(p.start[k].tolist(), size.tolist())])
                    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                    binary = pa.Array.from_buffers(pa.binary(), len(k), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(p.anchor[k].view(np.int64)), pa.array(doc_ids[lo + owner[k]]), pa.array(marks[lo + owner[k]]),
                         pa.array(start[k], pa.int32()), pa.array(p.windows[k], pa.int32()), binary],
                        names,
                    )

    return _texts(docs).mapInArrow(run, "anchor long, doc long, mark long, start int, n int, data binary")


def sharded(found: DataFrame, shard_bytes: int, length: int) -> tuple[DataFrame, int]:
    """Add ``shard`` and ``wide`` (the anchor is spread over several shards), and
    tell into how many slices the names of wide anchors' strings are to be cut.

    Anchors share shards by hash; one with more than ``shard_bytes`` gets as many
    parts as it fills, its pieces dealt by a hash of their coordinates."""
    size = F.col("n") + F.lit(length - 1)
    anchors = found.groupBy("anchor").agg(F.sum(size).alias("bytes")).withColumn("parts", F.ceil(F.col("bytes") / shard_bytes).cast("int"))
    total, wide = anchors.agg(F.sum("bytes"), F.sum(F.when(F.col("parts") > 1, F.col("bytes")))).first()
    shards = max(1, -(-2 * (total or 0) // shard_bytes))
    dealt = F.pmod(F.xxhash64("doc", "mark", "start"), F.col("parts"))
    rows = found.join(anchors.drop("bytes"), "anchor").withColumn("wide", F.col("parts") > 1).withColumn(
        "shard", F.when(F.col("wide"), F.xxhash64("anchor", dealt)).otherwise(F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    ).drop("parts")
    return rows, max(1, -(-(wide or 0) // SLICE_NAMES))


def shard_strings(rows: DataFrame, length: int, slices: int) -> DataFrame:
    """Per shard: ``doc, mark, start, n`` of repeated strings (``slice`` null), and a sorted
    run of names and places per slice (``run``): one string of each class of wide
    anchors, for merging with other shards."""
    schema = pa.schema([("doc", pa.int64()), ("mark", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("slice", pa.int64()), ("run", pa.binary())])

    def run(table):
        table = table.combine_chunks()
        raw, offsets = text_buffer(table.column("data"))
        text = raw[offsets[0] : offsets[-1]]
        begin = offsets[:-1] - offsets[0]
        strings = table.column("n").to_numpy().astype(np.int64)
        place, number = repeated_strings(text, begin, strings, length)
        owner = np.repeat(np.arange(len(strings)), strings)
        doc, mark, base = (table.column(c).to_numpy() for c in ("doc", "mark", "start"))
        start = base[owner] + place - begin[owner]
        times = np.bincount(number, minlength=int(number.max()) + 1 if len(number) else 0)
        twice = np.flatnonzero(times[number] > 1)
        # Runs of neighbouring repeated strings of one piece become one row.
        head = np.ones(len(twice), bool)
        head[1:] = (twice[1:] != twice[:-1] + 1) | (owner[twice[1:]] != owner[twice[:-1]])
        at = np.flatnonzero(head)
        size = np.diff(np.append(at, len(twice)))
        none = [pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.binary())]
        out = pa.table([pa.array(doc[owner[twice[at]]]), pa.array(mark[owner[twice[at]]]), pa.array(start[twice[at]], pa.int32()), pa.array(size, pa.int32()), *none], schema=schema)
        wide = np.flatnonzero(table.column("wide").to_numpy(zero_copy_only=False)[owner])
        if len(wide):
            _, one = np.unique(number[wide], return_index=True)
            one = wide[one]
            a, b = SpanHash(_VALUE[text])(place[one], place[one] + length)
            slice_ = (a % np.uint64(slices)).astype(np.int64)
            order = np.lexsort((b, a, slice_))
            packed = np.stack([a.view(np.int64), b.view(np.int64), doc[owner[one]], mark[owner[one]], start[one].astype(np.int64)], 1)[order]
            cut = np.searchsorted(slice_[order], np.arange(slices + 1))
            used = np.flatnonzero(np.diff(cut))
            none = [pa.nulls(len(used), t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int32())]
            more = pa.table([*none, pa.array(used), pa.array([packed[cut[s] : cut[s + 1]].tobytes() for s in used], pa.binary())], schema=schema)
            out = pa.concat_tables([out, more])
        return out

    return rows.groupBy("shard").applyInArrow(run, "doc long, mark long, start int, n int, slice long, run binary")


def merged(runs: DataFrame) -> DataFrame:
    """Strings that stand in several shards of one anchor: ``doc, mark, start, n``.

    A slice merges the shards' sorted runs and looks each name up in the whole by
    binary search; a shard gives a name once, so more places mean more shards."""

    def run(table):
        rows = np.concatenate([np.frombuffer(x, np.int64).reshape(-1, 5) for x in table.column("run").to_pylist()])
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        fresh = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])
        name = np.cumsum(np.concatenate([[False], fresh]))
        twice = np.searchsorted(name, name, "right") - np.searchsorted(name, name, "left") > 1
        found = rows[twice]
        return pa.table({"doc": pa.array(found[:, 2]), "mark": pa.array(found[:, 3]), "start": pa.array(found[:, 4], pa.int32()), "n": pa.array(np.ones(len(found)), pa.int32())})

    return runs.groupBy("slice").applyInArrow(run, "doc long, mark long, start int, n int")


def repeated_spans(docs: DataFrame, length: int = LENGTH, part: int = PART, shard_bytes: int = SHARD_BYTES, store: Store | None = None) -> DataFrame:
    """``doc, mark, start, bytes``: bytes covered by strings that occur elsewhere."""
    context = docs.sparkSession.sparkContext
    store = store or Store(docs.sparkSession)
    table = context.broadcast(repeated_anchors(anchor_counts(docs, length, part)))
    found = store.put(named_pieces(docs, table, length, part), "pieces")
    names = store.put(
        found.groupBy("a", "b").agg(F.min(F.struct("doc", "mark", "start")).alias("first"), F.count(F.lit(1)).alias("times"), F.first("anchor").alias("anchor")),
        "piece-names",
    )
    whole = found.join(names.filter("times > 1").select("a", "b"), ["a", "b"]).select("doc", "mark", "start", "n")
    # Different pieces with one anchor, if one of them is not yet known to repeat.
    forks = names.groupBy("anchor").agg(F.count(F.lit(1)).alias("names"), F.min("times").alias("least")).filter("names > 1 AND least = 1").select("anchor")
    forked = names.join(forks, "anchor").select("first.*")
    spots = context.broadcast(bit_table(spots_of(forked)))
    rows = store.put(piece_bytes(docs, spots, table, length, part), "piece-bytes")
    dealt, slices = sharded(rows, shard_bytes, length)
    inside = store.put(shard_strings(dealt, length, slices), "shard-strings")
    across = merged(inside.filter("slice IS NOT NULL").select("slice", "run"))
    spans = whole.unionByName(inside.filter("slice IS NULL").select("doc", "mark", "start", "n")).unionByName(across)
    out = store.put(spans.distinct().select("doc", "mark", "start", (F.col("n") + F.lit(length - 1)).alias("bytes")), "byte-spans")
    store.drop("pieces", "piece-names", "piece-bytes", "shard-strings")
    return out


def remove_strings(docs: DataFrame, length: int = LENGTH, part: int = PART, shard_bytes: int = SHARD_BYTES, texts: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (bytes, if ``texts``) and ``kept_sha256``."""
    small_batches(docs.sparkSession)
    spans = repeated_spans(docs, length, part, shard_bytes)
    own = spans.groupBy("doc", "mark").agg(F.collect_list(F.struct("start", "bytes")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            removes = batch.column(3).to_pylist()
            counts, removed, runs, kept, hashes = [], [], [], [], []
            for i, spans in enumerate(removes):
                text = raw[offsets[i] : offsets[i + 1]]
                keep = np.ones(len(text) + 1, bool)
                for x in spans or ():
                    keep[x["start"] : x["start"] + x["bytes"]] = False
                keep[-1] = True
                left = text[keep[:-1]].tobytes()
                counts.append(len(text))
                removed.append(len(text) - len(left))
                runs.append(int((~keep[:-1] & keep[1:]).sum()))
                kept.append(left if texts else None)
                hashes.append(hashlib.sha256(left).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (counts, removed, runs)), pa.array(kept, pa.binary()), pa.array(hashes, pa.string())],
                ["doc", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
            )

    schema = "doc long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    touched, rest = split_by_table(_texts(docs), own)
    nothing = F.lit(None).cast("array<struct<start:int,bytes:int>>").alias("spans")
    joined = touched.join(own, ["doc", "mark"], "left").select("doc", "text", "mark", "spans")
    done = joined.mapInArrow(run, schema).unionByName(rest.select("doc", "text", "mark", nothing).mapInArrow(run, schema))
    return done.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256")


def suffix_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return remove_strings(docs, texts=False).drop("kept")
