"""Removal of repeated word windows by de Bruijn compaction.

Every window of ``length`` words is an edge between its first and last
``length - 1`` words. Edges come as local paths (pieces, see anchors.py) without
branches inside. Repeated paths are those whose 128-bit name occurs twice; where
different paths share an anchor, their edges are compared one by one. Each
repeated edge learns the coordinates of its first occurrence; paths whose sources
continue each other compact into long spans, read in order of their starts. Every
span is then verified at its source coordinates on the texts themselves.

Edge cases: null or empty texts and texts shorter than a window lose nothing;
rows equal in doc_id and text are one document; different texts that share a doc_id,
or have none, are documents of their own, ordered by a hash of the text; a null doc_id
sorts first; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from spendcast.llm.anchors import NO_ID, BitTable, SpanHash, bit_table, pieces, repeated_anchors
from spendcast.llm.batches import mix, per_text, run_index, small_batches, word_groups
from spendcast.llm.store import Store

LENGTH, PART = 20, 8


def _texts(docs: DataFrame) -> DataFrame:
    """``doc, text, mark``: a text is named by its doc_id, NO_ID for none, and a hash of
    itself, so that different texts that share an id, or lack one, stay apart."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.col("text").cast("string").alias("text"),
        F.xxhash64(F.col("text").cast("string")).alias("mark"),
    )


def _batch(schema: str, **columns) -> pa.RecordBatch:
    types = {"long": pa.int64(), "int": pa.int32()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[n].view(np.int64) if columns[n].dtype == np.uint64 else columns[n], types[t]) for n, t in fields], [n for n, _ in fields]
    )


def _joined(parts: list, kind=np.int64) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def anchor_counts(docs: DataFrame, length: int, part: int) -> DataFrame:
    schema = "anchor long, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [pieces(w.hashes(), w.first, length, part).anchor for _, _, w in word_groups(batch.column(1))]
            key, n = np.unique(_joined(found, np.uint64), return_counts=True)
            yield _batch(schema, anchor=key, n=n.astype(np.int64))

    return _texts(docs).mapInArrow(run, schema)


def repeated_paths(docs: DataFrame, table, length: int, part: int) -> DataFrame:
    """Pieces whose anchor may repeat, with their coordinates."""
    schema = "a long, b long, anchor long, doc long, mark long, start int, n int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = BitTable(table.value)
        for batch in batches:
            doc_ids, marks, out = batch.column(0).to_numpy(), batch.column(2).to_numpy(), {c: [] for c in ("a", "b", "anchor", "doc", "mark", "start", "n")}
            for lo, _, w in word_groups(batch.column(1)):
                h = w.hashes()
                p = pieces(h, w.first, length, part)
                keep = known.has(p.anchor)
                start, n = p.start[keep], p.windows[keep]
                owner = np.searchsorted(w.first, start, "right") - 1
                a, b = SpanHash(h)(start, start + n + length - 1)
                for c, v in zip(out, (a, b, p.anchor[keep], doc_ids[lo + owner], marks[lo + owner], start - w.first[owner], n)):
                    out[c].append(v)
            yield _batch(schema, **{c: _joined(v, np.uint64 if c in ("a", "b", "anchor") else np.int64) for c, v in out.items()})

    return _texts(docs).mapInArrow(run, schema)


def edges_at(docs: DataFrame, spots, table, length: int, part: int) -> DataFrame:
    """Single edges of the pieces whose coordinates are in the table ``spots``."""
    schema = "a long, b long, doc long, mark long, start int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, known = BitTable(spots.value), BitTable(table.value)
        for batch in batches:
            doc_ids, marks, out = batch.column(0).to_numpy(), batch.column(2).to_numpy(), {c: [] for c in ("a", "b", "doc", "mark", "start")}
            for lo, _, w in word_groups(batch.column(1)):
                h = w.hashes()
                p = pieces(h, w.first, length, part)
                owner = np.searchsorted(w.first, p.start, "right") - 1
                keep = known.has(p.anchor) & wanted.has(spot(doc_ids[lo + owner], marks[lo + owner], p.start - w.first[owner]))
                n = p.windows[keep]
                start = np.repeat(p.start[keep], n) + run_index(n)
                owner = np.repeat(owner[keep], n)
                a, b = SpanHash(h)(start, start + length)
                for c, v in zip(out, (a, b, doc_ids[lo + owner], marks[lo + owner], start - w.first[owner])):
                    out[c].append(v)
            yield _batch(schema, **{c: _joined(v, np.uint64 if c in ("a", "b") else np.int64) for c, v in out.items()})

    return _texts(docs).mapInArrow(run, schema)


def spot(doc: np.ndarray, mark: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A hash of coordinates."""
    text = mix(doc.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mark.astype(np.int64).view(np.uint64))
    return mix(text + start.astype(np.uint64))


def spots_of(rows: DataFrame) -> DataFrame:
    """``spot`` of ``doc, mark, start`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch("spot long", spot=spot(*(batch.column(c).to_numpy() for c in range(3))))

    return rows.select("doc", "mark", "start").mapInArrow(run, "spot long")


def split_by_table(texts: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``doc, text, mark`` that may be in ``wanted (doc, mark)`` and those that can't,
    so that only the former are shuffled to be joined."""
    ids = spots_of(wanted.select("doc", "mark", F.lit(0).alias("start")))
    table = texts.sparkSession.sparkContext.broadcast(bit_table(ids))

    def side(inside: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = BitTable(table.value)
            for batch in batches:
                doc, mark = batch.column(0).to_numpy(), batch.column(2).to_numpy()
                yield batch.filter(pa.array(known.has(spot(doc, mark, np.zeros(len(doc), np.int64))) == inside))

        return texts.mapInArrow(run, texts.schema)

    return side(True), side(False)


def claims(docs: DataFrame, length: int, part: int, store: Store) -> DataFrame:
    """``doc, mark, start, n, source, source_mark, origin``: ``n`` windows from word
    ``start`` that equal earlier ones, from word ``origin`` of ``source``."""
    context = docs.sparkSession.sparkContext
    table = context.broadcast(repeated_anchors(anchor_counts(docs, length, part)))
    found = store.put(repeated_paths(docs, table, length, part), "paths")
    at = F.struct("doc", "mark", "start")
    first = F.min(at)
    source = (F.col("first.doc").alias("source"), F.col("first.mark").alias("source_mark"), F.col("first.start").alias("origin"))
    paths = store.put(
        found.groupBy("a", "b").agg(first.alias("first"), F.count(F.lit(1)).alias("times"), F.first("anchor").alias("anchor"), F.first("n").alias("n")),
        "path-names",
    )
    whole = found.join(paths.filter("times > 1").select("a", "b", "first"), ["a", "b"]).filter(at > F.col("first"))
    whole = whole.select("doc", "mark", "start", "n", *source)
    # Different paths with one anchor: their edges are compared one by one.
    forks = paths.groupBy("anchor").agg(F.count(F.lit(1)).alias("paths")).filter("paths > 1").select("anchor")
    forked = paths.join(forks, "anchor").select("first.*")
    spots = context.broadcast(bit_table(spots_of(forked)))
    edges = store.put(edges_at(docs, spots, table, length, part), "edges")
    sources = edges.groupBy("a", "b").agg(first.alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1").drop("times")
    single = edges.join(sources, ["a", "b"]).filter(at > F.col("first"))
    single = single.select("doc", "mark", "start", F.lit(1).alias("n"), *source)
    out = store.put(whole.unionByName(single), "claims")
    store.drop("paths", "path-names", "edges")
    return out


def compact(found: DataFrame, length: int) -> DataFrame:
    """Long spans ``doc, mark, start, words, source, source_mark, origin`` out of adjoining claims.

    Claims of one (document, source, shift) in order of their starts: one that begins
    beyond all before it begins a path, any other goes on with the path before."""
    same = ["doc", "mark", "source", "source_mark", "shift"]
    keyed = found.withColumn("shift", F.col("start") - F.col("origin")).select(*same, "start", (F.col("start") + F.col("n")).alias("until"))
    by_start = Window.partitionBy(*same).orderBy("start")
    reached = F.max("until").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("start") <= reached, 0).otherwise(1)
    paths = keyed.withColumn("fresh", fresh).withColumn("path", F.sum("fresh").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    spans = paths.groupBy(*same, "path").agg(F.min("start").alias("start"), F.max("until").alias("until"))
    return spans.select(
        "doc", "mark", "start", (F.col("until") - F.col("start") + length - 1).alias("words"), "source", "source_mark", (F.col("start") - F.col("shift")).alias("origin")
    )


def _spaced(w) -> tuple[np.ndarray, np.ndarray]:
    """All words of a group with a space after each, and where each begins."""
    begin = np.concatenate([[0], np.cumsum(w.end - w.start + 1)])
    letter = np.ones(begin[-1], bool)
    letter[begin[1:] - 1] = False
    out = np.full(begin[-1], 0x20, np.uint8)
    out[letter] = w.raw[~w.space]
    return out, begin


def _cut(docs: DataFrame, spans: DataFrame, texts: bool) -> DataFrame:
    """Every document without its spans, and digests of its spans and of those
    that others claim to repeat: ``doc, mark, n_words, n_removed, kept, kept_sha256, digests``."""
    own = spans.groupBy("doc", "mark").agg(F.collect_set(F.struct("start", "words")).alias("spans"))
    asked = spans.select(F.col("source").alias("doc"), F.col("source_mark").alias("mark"), F.col("origin").alias("start"), "words").distinct()
    asked = asked.groupBy("doc", "mark").agg(F.collect_list(F.struct("start", "words")).alias("asked"))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("digest", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removes, requests = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            counts, removed, kept, hashes, digests = [], [], [], [], []
            for lo, hi, w in word_groups(batch.column(1)):
                data, begin = _spaced(w)
                whole = data.tobytes()
                mine = [{(x["start"], x["words"]) for x in removes[i] or ()} for i in range(lo, hi)]
                keep = np.ones(len(w.start), bool)
                for i, spans in enumerate(mine):
                    for start, words in spans:
                        keep[w.first[i] + start : w.first[i] + start + words] = False
                left = whole if keep.all() else data[np.repeat(keep, np.diff(begin))].tobytes()
                cut = np.concatenate([[0], np.cumsum(np.diff(begin) * keep)])[w.first].tolist()
                stay = per_text(keep, w.first)
                counts += w.count.tolist()
                removed += (w.count - stay).tolist()
                for i, spans in enumerate(mine):
                    own = left[cut[i] : max(cut[i + 1] - 1, cut[i])]
                    kept.append(own.decode() if texts else None)
                    hashes.append(hashlib.sha256(own).hexdigest())
                    told, base = spans | {(x["start"], x["words"]) for x in requests[lo + i] or ()}, int(w.first[i])
                    digests.append([{"start": s, "words": k, "digest": hashlib.blake2b(whole[begin[base + s] : begin[base + s + k] - 1], digest_size=16).digest()} for s, k in told])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), pa.array(hashes, pa.string()), pa.array(digests, kind)],
                ["doc", "mark", "n_words", "n_removed", "kept", "kept_sha256", "digests"],
            )

    schema = "doc long, mark long, n_words long, n_removed long, kept string, kept_sha256 string, digests array<struct<start:int,words:int,digest:binary>>"
    wanted = own.join(asked, ["doc", "mark"], "full")
    touched, rest = split_by_table(_texts(docs), wanted)
    nothing = "array<struct<start:int,words:int>>"
    plain = rest.withColumns({c: F.lit(None).cast(nothing) for c in ("spans", "asked")})
    joined = touched.join(wanted, ["doc", "mark"], "left").select("doc", "text", "mark", *(F.col(c).cast(nothing) for c in ("spans", "asked")))
    return joined.mapInArrow(run, schema).unionByName(plain.mapInArrow(run, schema))


def remove_repeats(docs: DataFrame, length: int = LENGTH, part: int = PART, texts: bool = True) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` (words joined by one space, if ``texts``)
    and ``kept_sha256`` of every row, windows that start earlier removed."""
    small_batches(docs.sparkSession)
    store = Store(docs.sparkSession)
    spans = store.put(compact(claims(docs, length, part, store), length), "spans")
    store.drop("claims")
    while True:
        done = store.put(_cut(docs, spans, texts), "cut")
        told = done.select("doc", "mark", F.explode("digests").alias("d")).select("doc", "mark", "d.*").distinct()
        here = told.withColumnRenamed("digest", "own")
        there = told.select(F.col("doc").alias("source"), F.col("mark").alias("source_mark"), F.col("start").alias("origin"), "words", "digest")
        false = spans.join(here, ["doc", "mark", "start", "words"]).join(there, ["source", "source_mark", "origin", "words"]).filter("own <> digest")
        false = store.put(false.select(*spans.columns), "false-spans")
        if false.isEmpty():
            break
        spans = store.put(spans.join(false, spans.columns, "left_anti"), "spans")
    return done.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "n_words", "n_removed", "kept", "kept_sha256")


def substring_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return remove_repeats(docs, texts=False).drop("kept")
