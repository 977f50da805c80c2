"""Near-duplicate groups by circulant MinHash, banding and exact confirmation.

A document is the set of its distinct word shingles. One permutation scatters the
shingles over a circle; a second one, turned by 0, 1, 2, ... places, gives every
signature coordinate. Documents that agree on a band of coordinates are compared
on their full sets, and confirmed links join into components.

Equal sets form a class first, so copies are never paired. In a bucket each class
is compared with a few leaders. Classes still apart afterwards are compared with
each other unless what both share with a leader, and with each other beside it,
is too little for a link. Nothing is capped.

Edge cases: null or empty texts and texts without words have the empty set and
are linked with nothing; with fewer words than a shingle the sequence is one
shingle; rows without doc_id are linked like others, but give a component its id only
where no row has one (null then); repeated rows are one class; different texts that
share a doc_id are told apart by a hash; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from spendcast.llm.anchors import NO_ID, BitTable, bit_table
from spendcast.llm.batches import mix, small_batches, windows, word_groups
from spendcast.llm.components import components
from spendcast.llm.substring_dedup import _texts, spot, spots_of
from spendcast.llm.store import Store


@dataclass(frozen=True)
class Similarity:
    """``percent``: least Jaccard similarity of a link, in percent. A pair at that
    similarity misses every band with chance ``(1 - s^rows)^bands``."""

    words: int = 5
    percent: int = 80
    bands: int = 30
    rows: int = 4


QUERY = Similarity(words=3, percent=85, bands=26, rows=5)  # misses 2.4e-7
STAGE = Similarity(words=5, percent=80, bands=30, rows=4)  # misses 1.4e-7
LEADERS = 3  # classes that a bucket is compared with before the rest is sought out


def shingle_sets(column: pa.Array, words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per group of texts: sorted distinct shingle hashes and each text's size."""
    for _, _, w in word_groups(column):
        hashes, doc = w.hashes(lower=True), w.doc()
        key, place = windows(hashes, w.first, words)
        owner = doc[place]
        few = np.flatnonzero((w.count > 0) & (w.count < words))
        if len(few):
            whole = np.zeros(len(few), np.uint64)
            for j in range(words - 1):
                has = w.count[few] > j
                whole[has] = whole[has] * np.uint64(0x9E3779B97F4A7C15) + hashes[w.first[few][has] + j]
            key, owner = np.concatenate([key, mix(whole + w.count[few].astype(np.uint64))]), np.concatenate([owner, few])
        order = np.lexsort((key, owner))
        key, owner = key[order], owner[order]
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
        yield key[fresh], np.bincount(owner[fresh], minlength=len(w.count))


def signatures(shingles: np.ndarray, sizes: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash of consecutive non-empty sets: one row per set."""
    # Scatter: a bijection of 64 bits, of which the upper 32 are the place.
    place = (mix(shingles * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum(sizes) - sizes
    out = np.empty((coordinates, len(sizes)), np.uint32)
    value, high = np.empty_like(place), np.empty_like(place)
    for k in range(coordinates):
        np.add(place, np.uint32(k), out=value)  # the circle turned by k places
        for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
            np.right_shift(value, np.uint32(shift), out=high)
            np.bitwise_xor(value, high, out=value)
            np.multiply(value, np.uint32(factor), out=value)
        np.right_shift(value, np.uint32(16), out=high)
        np.bitwise_xor(value, high, out=value)
        np.minimum.reduceat(value, starts, out=out[k])
    return out.T


def band_keys(signature: np.ndarray, how: Similarity) -> np.ndarray:
    """One 64-bit key per band, distinct between bands."""
    parts = signature.reshape(len(signature), how.bands, how.rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(how.bands, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(how.rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r] + np.uint64(1))
    return key.view(np.int64)


def sketches(docs: DataFrame, how: Similarity) -> DataFrame:
    """``doc_id, mark, n, key, bands``; ``key`` names the set, null if it is empty,
    ``mark`` the text."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, keys, bands = [], [], []
            for shingles, sizes in shingle_sets(batch.column(1), how.words):
                cut = np.concatenate([[0], np.cumsum(sizes)])
                data = shingles.tobytes()
                keys += [hashlib.md5(data[8 * a : 8 * b]).digest() if b > a else None for a, b in zip(cut[:-1], cut[1:])]
                found = np.full((len(sizes), how.bands), 0, np.int64)
                some = sizes > 0
                if some.any():
                    found[some] = band_keys(signatures(shingles, sizes[some], how.bands * how.rows), how)
                counts.append(sizes)
                bands.append(found)
            n = len(keys)
            flat = np.concatenate(bands).ravel() if bands else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * how.bands, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(np.concatenate(counts) if counts else [], pa.int64()), pa.array(keys, pa.binary()), lists],
                ["doc_id", "mark", "n", "key", "bands"],
            )

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), text, F.xxhash64(text).alias("mark"))
    return rows.mapInArrow(run, "doc_id long, mark long, n long, key binary, bands array<long>")


def repeated_bands(classes: DataFrame) -> DataFrame:
    """``band, rep, n, key`` of the bands that more than one class has.

    Bands are counted alone first; a bit table of those that repeat then drops
    the others before they are shuffled with their classes."""
    spark = classes.sparkSession
    twice = classes.select(F.explode("bands").alias("band")).groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    table = spark.sparkContext.broadcast(bit_table(twice.select("band")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = BitTable(table.value)
        for batch in batches:
            bands = batch.column(3)
            flat = bands.flatten().to_numpy(zero_copy_only=False)
            hit = np.flatnonzero(known.has(flat.view(np.uint64)))
            owner = pa.array(hit // (len(flat) // max(batch.num_rows, 1)))
            yield pa.RecordBatch.from_arrays([pa.array(flat[hit]), *(batch.column(c).take(owner) for c in range(3))], ["band", "rep", "n", "key"])

    found = classes.select("rep", "n", "key", "bands").mapInArrow(run, "band long, rep long, n long, key binary")
    return found.join(found.groupBy("band").agg(F.count(F.lit(1)).alias("classes")).filter("classes > 1"), "band")


def full_sets(docs: DataFrame, how: Similarity, wanted: DataFrame) -> DataFrame:
    """``key, shingles`` of the texts in ``wanted (doc, mark)`` and, through errors of a
    bit table, of a few more. No text is shuffled."""
    table = docs.sparkSession.sparkContext.broadcast(bit_table(spots_of(wanted.withColumn("start", F.lit(0)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = BitTable(table.value)
        for batch in batches:
            ids, marks = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            batch = batch.filter(pa.array(known.has(spot(ids, marks, np.zeros(len(ids), np.int64)))))
            keys, lists = [], []
            for shingles, sizes in shingle_sets(batch.column(1), how.words):
                cut = np.concatenate([[0], np.cumsum(sizes)])
                for a, b in zip(cut[:-1], cut[1:]):
                    if b > a:
                        keys.append(hashlib.md5(shingles[a:b].tobytes()).digest())
                        lists.append(shingles[a:b].view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(lists, pa.list_(pa.int64()))], ["key", "shingles"])

    return _texts(docs).mapInArrow(run, "key binary, shingles array<long>").dropDuplicates(["key"])


def near_duplicates(docs: DataFrame, how: Similarity) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, mark, stays`` for every row of ``docs``.

    ``mark`` hashes the text; ``stays`` holds for one (doc_id, mark) of each component,
    the least, ids before none, and for every row with the empty set."""
    store = Store(docs.sparkSession)
    rows = store.put(sketches(docs, how), "sketches")
    some = rows.filter("key IS NOT NULL")
    classes = store.put(some.groupBy("key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("best"), F.first("n").alias("n"), F.first("bands").alias("bands")
    ).withColumn("rep", F.col("best.doc_id")), "classes")
    found = store.put(repeated_bands(classes), "bands")
    company = found.groupBy("key").agg(F.sum("classes").alias("company"))
    banded = store.put(found.drop("classes").join(company, "key"), "buckets")
    seats = classes.join(banded.select("key").distinct(), "key").select(F.coalesce("rep", F.lit(NO_ID)).alias("doc"), F.col("best.mark").alias("mark"))
    sets = store.put(full_sets(docs, how, seats), "sets")

    def fits(a: str, b: str):
        return F.least(a, b) * 100 >= F.greatest(a, b) * how.percent

    inter = F.size(F.array_intersect("x", "y")).cast("long")
    total = (F.size("x") + F.size("y")).cast("long")
    enough = F.col("inter") * (100 + how.percent) >= F.col("total") * how.percent  # inter / (total - inter) >= s

    def sides(pairs: DataFrame) -> DataFrame:
        return pairs.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("x")), "a").join(
            sets.select(F.col("key").alias("b"), F.col("shingles").alias("y")), "b"
        )

    def compared(pairs: DataFrame) -> DataFrame:
        """What both share, and what ``b`` has beside ``a``."""
        return sides(pairs).select("a", "b", inter.alias("inter"), total.alias("total"), F.array_except("y", "x").alias("own"))

    def linked(found: DataFrame) -> DataFrame:
        return found.filter(enough).select(F.col("a").alias("u"), F.col("b").alias("v"))

    # A bucket is compared with its class of the largest company over all bands, in a
    # group of copies one near their common origin; then with the same of what
    # is linked to none of its leaders yet, and so on.
    members, leads, tested = banded, None, None
    for r in range(LEADERS):
        leaders = members.groupBy("band").agg(F.max(F.struct("company", "rep", "n", "key")).alias("lead"))
        pairs = banded.join(leaders, "band").filter(F.col("key") != F.col("lead.key")).filter(fits("n", "lead.n"))
        pairs = pairs.select(F.col("lead.key").alias("a"), F.col("key").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")
        now = store.put(compared(pairs), f"tested-{r}")
        own = store.put(leaders.select("band", F.col("lead.key").alias("lead")), f"leads-{r}")
        tested = now if tested is None else tested.unionByName(now)
        leads = own if leads is None else leads.unionByName(own)
        # Whatever is linked to its bucket's leader needs no other one.
        met = members.join(own, "band").filter(F.col("key") != F.col("lead"))
        known_links = linked(tested).select(F.col("u").alias("lead"), F.col("v").alias("key"))
        members = store.put(met.join(known_links, ["lead", "key"], "left_anti").select(*banded.columns), f"left-{r}")
        if members.isEmpty():
            break
    roots = components(linked(tested)).withColumnRenamed("node", "key")
    rooted = banded.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    # Classes of one bucket that are still apart. Of two, one is outside the component
    # that has most of the bucket and is no leader, for a leader has met its whole bucket.
    mixed = rooted.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("band")
    inside = store.put(rooted.join(mixed, "band").select("band", "key", "n", "root"), "mixed")
    most = inside.groupBy("band", "root").agg(F.count(F.lit(1)).alias("size")).groupBy("band").agg(F.max_by("root", F.struct("size", "root")).alias("main"))
    outside = inside.join(most, "band").filter("root <> main").select("band", "key").join(
        leads.withColumnRenamed("lead", "key"), ["band", "key"], "left_anti"
    )
    # A bucket with such classes is seen from one pivot. Each of them proposes, of all
    # leaders it was compared with in whichever bucket, the one that met most classes, if
    # they are at least half alike, or else any leader of its buckets; then that leader's
    # own choice, so that pivots are few. Most votes decide.
    meetings = tested.groupBy("a").agg(F.count(F.lit(1)).alias("times"))
    alike = F.col("inter") / (F.col("total") - F.col("inter"))
    known = tested.join(meetings, "a").select("a", F.col("b").alias("key"), F.when(alike >= 0.5, F.col("times")).otherwise(0).alias("times"), alike.alias("alike"))
    known = store.put(known.groupBy("key").agg(F.max_by(F.struct(F.col("a").alias("lead"), "times"), F.struct("times", "alike", "a")).alias("best")), "known")
    spare = outside.join(leads, "band").groupBy("key").agg(F.max("lead").alias("spare"))
    pivots = spare.join(known, "key", "left").select("key", F.coalesce("best.lead", "spare").alias("lead"))
    higher = known.join(meetings.select(F.col("a").alias("key"), F.col("times").alias("own_times")), "key").filter("best.times > own_times")
    higher = higher.select(F.col("key").alias("lead"), F.col("best.lead").alias("next"))
    for _ in range(LEADERS):
        pivots = pivots.join(higher, "lead", "left").select("key", F.coalesce("next", "lead").alias("lead"))
    votes = outside.join(pivots, "key").groupBy("band", "lead").agg(F.count(F.lit(1)).alias("votes"))
    chosen = store.put(votes.groupBy("band").agg(F.max_by("lead", F.struct("votes", "lead")).alias("lead")), "pivots")
    mates = inside.join(chosen, "band").join(outside.withColumn("near", F.lit(True)), ["band", "key"], "left").filter("key <> lead")
    mates = mates.groupBy("lead", "key").agg(F.first("n").alias("n"), F.first("root").alias("root"), F.coalesce(F.max("near"), F.lit(False)).alias("near"))
    mates = store.put(mates, "mates")
    fresh = mates.select(F.col("lead").alias("a"), F.col("key").alias("b")).join(tested.select("a", "b"), ["a", "b"], "left_anti")
    tested = tested.unionByName(store.put(compared(fresh), "tested"))
    met = store.put(mates.join(tested.select(F.col("a").alias("lead"), F.col("b").alias("key"), "inter", "own"), ["lead", "key"]), "met")
    # What most of them have beside the pivot joins its set, a common origin's words
    # that the pivot lacks: two classes share at most what both share with that set plus
    # what they share beside it, whatever the set is.
    crowd = met.groupBy("lead").agg(F.count(F.lit(1)).alias("crowd"))
    beside = met.select("lead", "key", "near", F.explode("own").alias("extra"))
    holders = beside.groupBy("lead", "extra").agg(F.count(F.lit(1)).alias("holders"), F.max("near").alias("wanted")).filter("holders > 1")
    holders = holders.join(crowd, "lead").select("lead", "extra", "wanted", (2 * F.col("holders") > F.col("crowd")).alias("common"))
    beside = store.put(beside.join(holders.filter("common OR wanted"), ["lead", "extra"]), "beside")
    gained = beside.filter("common").groupBy("lead", "key").agg(F.count(F.lit(1)).alias("gained"))
    short = met.drop("own").join(gained, ["lead", "key"], "left").withColumn("inter", F.col("inter") + F.coalesce("gained", F.lit(0)))
    # ``most``: the largest size of a partner that shares nothing more.
    short = store.put(short.drop("gained").withColumn("most", F.floor(F.col("inter") * (100 + how.percent) / how.percent - F.col("n"))), "short")
    different = (F.col("x.key") != F.col("y.key")) & (F.col("x.root") != F.col("y.root")) & fits("x.n", "y.n")
    least = F.ceil(F.col("n") * how.percent / 100)
    sized = short.filter("near").withColumn("least", least).filter("most >= least").withColumn(
        "size", F.explode(F.sequence("least", F.least("most", F.floor(F.col("n") * 100 / how.percent))))
    )
    lone = sized.alias("x").join(
        short.alias("y"), (F.col("x.lead") == F.col("y.lead")) & (F.col("x.size") == F.col("y.n")) & different & (F.col("x.n") <= F.col("y.most"))
    ).select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b"))
    rare = beside.filter("NOT common").select("lead", "key", "extra").join(short, ["lead", "key"])
    shared = rare.filter("near").alias("x").join(rare.alias("y"), (F.col("x.lead") == F.col("y.lead")) & (F.col("x.extra") == F.col("y.extra")) & different)
    both = shared.groupBy(
        F.col("x.lead"), F.col("x.key").alias("x_key"), F.col("y.key").alias("y_key"), F.col("x.n"), F.col("y.n").alias("m"), F.least("x.inter", "y.inter").alias("inter")
    ).agg(F.count(F.lit(1)).alias("more"))
    both = both.filter((F.col("inter") + F.col("more")) * (100 + how.percent) >= (F.col("n") + F.col("m")) * how.percent)
    both = both.select(F.least("x_key", "y_key").alias("a"), F.greatest("x_key", "y_key").alias("b"))
    done = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = store.put(lone.union(both).distinct().join(done, ["a", "b"], "left_anti"), "rest")
    more = linked(sides(pairs).select("a", "b", inter.alias("inter"), total.alias("total")))
    roots = components(linked(tested).unionByName(more)).withColumnRenamed("node", "key")
    store.drop(*(name for name in list(store.paths) if name not in ("sketches", "classes")))
    # The least document of each component of classes.
    reps = classes.select("key", "best").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    least = reps.groupBy("root").agg(F.min("best").alias("first"))
    named = reps.join(least, "root").select("key", "first")
    first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark"))
    placed = some.join(named, "key").select("doc_id", "n", F.col("first.doc_id").alias("component_id"), "mark", first.alias("stays"))
    alone = rows.filter("key IS NULL").select("doc_id", "n", F.col("doc_id").alias("component_id"), "mark", F.lit(True).alias("stays"))
    return placed.unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "mark", "stays"
    )


def near_dup_query(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{folder}/documents.parquet"), QUERY).drop("mark", "stays")
