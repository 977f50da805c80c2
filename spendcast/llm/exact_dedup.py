"""Exact duplicates by counting quotient filters and verification of bytes.

Texts are equal if they are so after every character of ``[\\x20\\x09-\\x0D]`` is
deleted. Each task fills a counting quotient filter with its rows' 64-bit
fingerprints; cut into slices by the upper bits, the filters of all tasks merge
slice by slice without loss. Only rows whose fingerprint counts more than one are
read again and compared as bytes, in a partial aggregation with the text as key, so
that a text of any number of copies is passed on once per task. Fingerprints never
reach the driver: a bit table of fixed size (see anchors.py) names the repeated ones,
its errors cost work and never a result.

Of equal texts the row with the most code points stays, then the least doc_id, a
missing one last; of rows equal in both, exactly one.

Edge cases: null, empty and blank texts are equal to one another; a row without
doc_id is a document of its own and ``keep_id`` is null where it stays; repeated
rows are copies, of which one is kept; an empty table gives an empty table; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from spendcast.llm.anchors import BitTable, bit_table
from spendcast.llm.batches import groups, per_text, small_batches, text_buffer
from spendcast.llm.quotient import FIELDS, SCHEMA, QuotientFilter, merge, summed
from spendcast.llm.store import Store

BLANK = b" \t\n\v\f\r"
FILTER_ROWS = 1 << 20  # fingerprints of a task's filter and, on average, of a slice
HOT_CLASSES = 1 << 10  # classes of more than this part of all rows are joined by broadcast


def fingerprint(digest: bytes, bits: int) -> int:
    return int.from_bytes(digest[:8], "big") >> 64 - bits << 64 - bits


def _normalised(column: pa.Array) -> Iterator[tuple[bytes, bytes, int]]:
    """Normalised text, its SHA-256 and the code points of the original, per text."""
    raw, offsets = text_buffer(column)
    for lo, hi in groups(offsets):
        part, at = raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        chars = per_text((part & 0xC0) != 0x80, at).tolist()
        for a, b, n in zip(at[:-1].tolist(), at[1:].tolist(), chars):
            text = part[a:b].tobytes().translate(None, BLANK)
            yield text, hashlib.sha256(text).digest(), n


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def digests(docs: DataFrame, bits: int = 64) -> DataFrame:
    """``row, doc_id, n_chars, sha, mark`` of every row; ``mark`` is the fingerprint
    and ``row`` names a row once the table is stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            found = [(sha, n) for _, sha, n in _normalised(batch.column(1))]
            marks = np.array([fingerprint(sha, bits) for sha, _ in found], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + len(found))), batch.column(0), pa.array([n for _, n in found], pa.int64()), pa.array([s for s, _ in found], pa.binary()), pa.array(marks)],
                ["row", "doc_id", "n_chars", "sha", "mark"],
            )
            row += len(found)

    return _texts(docs).mapInArrow(run, "row long, doc_id long, n_chars long, sha binary, mark long")


def _slice_bits(rows: int) -> int:
    return max(0, (rows // FILTER_ROWS).bit_length())


def quotient_filters(marks: DataFrame, slice_bits: int) -> DataFrame:
    """The merged counting quotient filter of a column of fingerprints, one row per slice."""
    names = ["slice", *FIELDS]
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * (len(FIELDS) - 1)]

    def record(slices: list[int], filters: list[QuotientFilter]) -> list[pa.Array]:
        return [pa.array(v, k) for v, k in zip([slices, *([getattr(f, n) for f in filters] for n in FIELDS)], kinds)]

    def cut(marks: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        # What is left of a fingerprint in its slice begins at the upper bits again.
        number = (marks >> np.uint64(64 - slice_bits)).astype(np.int64) if slice_bits else np.zeros(len(marks), np.int64)
        used, begin = np.unique(number, return_index=True)
        bounds = np.append(begin, len(marks)).tolist()
        own = marks << np.uint64(slice_bits)
        return pa.RecordBatch.from_arrays(record(used.tolist(), [QuotientFilter.of(own[a:b], counts[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]), names)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts, waiting = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        parts = []
        for batch in batches:
            parts.append(batch.column(0).to_numpy().view(np.uint64))
            waiting += len(parts[-1])
            if waiting >= FILTER_ROWS:
                held, counts = summed(np.concatenate([held, *parts]), np.concatenate([counts, np.ones(waiting, np.int64)]))
                parts, waiting = [], 0
                if len(held) >= FILTER_ROWS:
                    yield cut(held, counts)
                    held, counts = held[:0], counts[:0]
        yield cut(*summed(np.concatenate([held, *parts]), np.concatenate([counts, np.ones(waiting, np.int64)])))

    def merged(key, table):
        filters = [QuotientFilter(**r) for r in table.select(list(FIELDS)).to_pylist()]
        return pa.Table.from_arrays(record([key[0].as_py()], [merge(filters)]), names)

    schema = f"slice long, {SCHEMA}"
    return marks.mapInArrow(fill, schema).groupBy("slice").applyInArrow(merged, schema)


def repeated_marks(filters: DataFrame, slice_bits: int) -> DataFrame:
    """``mark, n`` of the fingerprints that count more than one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                marks, counts = QuotientFilter(**{f: r[f] for f in FIELDS}).entries()
                if slice_bits:
                    marks = marks >> np.uint64(slice_bits) | np.uint64(r["slice"]) << np.uint64(64 - slice_bits)
                twice = counts > 1
                yield pa.RecordBatch.from_arrays([pa.array(marks[twice].view(np.int64)), pa.array(counts[twice])], ["mark", "n"])

    return filters.mapInArrow(run, "mark long, n long")


def verified(docs: DataFrame, marks: DataFrame, bits: int = 64) -> DataFrame:
    """``sha, n`` of the texts that several rows have, compared as bytes."""
    table = docs.sparkSession.sparkContext.broadcast(bit_table(marks.select("mark")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = BitTable(table.value)
        for batch in batches:
            copies: dict[tuple[bytes, bytes], int] = {}
            found = list(_normalised(batch.column(0)))
            hit = known.has(np.array([fingerprint(sha, bits) for _, sha, _ in found], np.uint64))
            for i in np.flatnonzero(hit).tolist():
                text, sha, _ = found[i]
                copies[sha, text] = copies.get((sha, text), 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in copies], pa.binary()), pa.array([k[1] for k in copies], pa.binary()), pa.array(list(copies.values()), pa.int64())], ["sha", "text", "n"]
            )

    same = docs.select(F.col("text").cast("string")).mapInArrow(run, "sha binary, text binary, n long")
    classes = same.groupBy("sha", "text").agg(F.sum("n").alias("n"))
    named = classes.groupBy("sha").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("n"))
    clash = F.raise_error(F.lit("different texts have one SHA-256"))
    return named.filter("n > 1").select("sha", F.when(F.col("texts") == 1, F.col("n")).otherwise(clash.cast("long")).alias("n"))


def exact_duplicates(docs: DataFrame, bits: int = 64) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    store = Store(spark)
    rows = store.put(digests(docs, bits), "digests")
    n = rows.count()
    slice_bits = _slice_bits(n)
    filters = store.put(quotient_filters(rows.select("mark"), slice_bits), "quotient-filters")
    same = store.put(verified(docs, repeated_marks(filters, slice_bits), bits), "verified")
    # Bitwise not turns the order of ids round without overflow.
    order = F.struct(F.col("n_chars"), F.col("doc_id").isNotNull(), F.bitwise_not(F.col("doc_id")).alias("id"), F.bitwise_not(F.col("row")).alias("row"))
    best = rows.groupBy("sha").agg(F.max(order).alias("best"))
    classes = same.join(best, "sha").select(
        "sha", "n", F.bitwise_not(F.col("best.id")).alias("keep_id"), F.bitwise_not(F.col("best.row")).alias("keep_row")
    )
    classes = store.put(classes, "classes")
    # Classes above one of HOT_CLASSES equal parts of the rows are fewer than HOT_CLASSES.
    limit = max(HOT_CLASSES, n // HOT_CLASSES)
    hot, rest = F.broadcast(classes.filter(F.col("n") > limit)), classes.filter(F.col("n") <= limit)
    joined = rows.join(hot, "sha").unionByName(rows.join(hot, "sha", "left_anti").join(rest, "sha", "left"))
    alone = F.col("n").isNull()
    return joined.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )


def exact_query(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(spark.read.parquet(f"{folder}/documents.parquet"))


EXACT_SQL = r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), ranked AS (
  SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
    first_value(doc_id) OVER same AS keep_id, row_number() OVER same AS place
  FROM texts WINDOW same AS (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM ranked
"""
