"""Divergence of sources by count-level bitmaps.

Every source of a language gives each term a smoothed probability; two sources differ
by a sum over all terms. Terms are dealt to shards and numbered there, frequent ones
first, so that 64 neighbours have few different counts. For every (group, count) a
shard stores the set of its terms as bits, 64 to a word; the terms a group lacks are
the complement of all its sets. ANDing the words of two groups and counting bits gives
how many terms have each pair of counts, and each such cell adds its size times the
value of one term. Shards add up in Spark. The same words, read term by term, give the
terms that a source has more of than its language.

Counting: a task counts its own texts and passes on one row per (language, source,
term); rows of one term meet spread over sources, so a hot term or source is many
small rows. Terms are the bytes of ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z
lower-cased. Every number is a whole one: ``p = 1 + floor(1e9 (count + 1) / (N + V))``.

Edge cases: null text, lang and source count as empty; a group without terms has all
counts 0; a language without kept terms has pairs of value 0; repeated rows count as
documents of their own; a language with one source has no pairs; an empty table
gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from spendcast.llm.batches import run_index, small_batches
from spendcast.llm.store import Store

LEAST_DOCS = 3
RANKS = 200
SCALE = 10**9
HELD = 300_000  # (group, term) counts a task gathers before it passes them on
SHARD_CELLS = 250_000
PIECE = 1 << 20  # bytes of a text cut into terms at once
EXPANDED = 1 << 20  # word pairs compared at once
WORD = 64

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
_COUNTS = "lang string, source string, term string, n long, docs long"
_LEVELS = "shard long, lang string, source string, word int, count long, bits long, terms array<string>, totals array<long>"


def text_terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded length."""
    plain, at = text.translate(_LETTERS), 0
    while at < len(plain):
        to = plain.find(b" ", at + PIECE)
        to = len(plain) if to < 0 else to
        yield plain[at:to].split()
        at = to


class _Counts:
    """Counts of terms and of documents with them, per group, until passed on."""

    def __init__(self):
        self.groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        self.held = 0

    def add(self, group: tuple[str, str], text: bytes) -> None:
        n, docs = self.groups.setdefault(group, (Counter(), Counter()))
        before, seen = len(n), set()
        for terms in text_terms(text):
            n.update(terms)
            seen.update(terms)
        docs.update(seen)
        self.held += len(n) - before

    def take(self) -> pa.RecordBatch:
        """All counts, and a row without term for every group."""
        columns: list[list] = [[] for _ in range(5)]
        for (lang, source), (n, docs) in self.groups.items():
            size = len(n) + 1
            for column, values in zip(columns, ([lang] * size, [source] * size, [None, *n], [0, *n.values()], [0, *(docs[t] for t in n)])):
                column.extend(values)
        self.groups, self.held = {}, 0
        lang, source, term, n, docs = columns
        arrays = [pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(term, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences, and documents with the term.
    A row without term stands for each group that occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts()
        for batch in batches:
            langs, sources, texts = (c.to_pylist() for c in batch.columns)
            for group, text in zip(zip(langs, sources), texts):
                counts.add(group, text)
                if counts.held > HELD:
                    yield counts.take()
        yield counts.take()

    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = docs.select(empty("lang"), empty("source"), empty("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def count_levels(counts: DataFrame, shards: int) -> DataFrame:
    """The bitmaps: ``bits`` of ``word`` are the terms with ``count`` occurrences in a
    group. Rows without source hold the kept terms of a word and their totals."""
    names = [f.split()[0] for f in _LEVELS.split(", ")]

    def run(key, table):
        shard = key[0].as_py()
        table = table.combine_chunks()
        (lang, langs), (source, sources), (term, terms) = (
            (c.indices.to_numpy().astype(np.int64), c.dictionary.to_pylist())
            for c in (table.column(x).combine_chunks().dictionary_encode() for x in ("lang", "source", "term"))
        )
        n, docs = table.column("n").to_numpy(), table.column("docs").to_numpy()
        pair, at = np.unique(lang * len(terms) + term, return_inverse=True)
        total, spread = np.zeros(len(pair), np.int64), np.zeros(len(pair), np.int64)
        np.add.at(total, at, n)
        np.add.at(spread, at, docs)
        # Numbers within the language, by falling total.
        kept = np.flatnonzero(spread >= LEAST_DOCS)
        order = kept[np.lexsort((pair[kept], -total[kept], pair[kept] // len(terms)))]
        of = pair[order] // len(terms)
        number = np.full(len(pair), -1, np.int64)
        number[order] = run_index(np.unique(of, return_counts=True)[1])
        cell = np.flatnonzero(number[at] >= 0)
        own = number[at[cell]]
        word, bit = own // WORD, np.uint64(1) << (own % WORD).astype(np.uint64)
        by = np.lexsort((n[cell], word, source[cell], lang[cell]))
        keys = np.stack([lang[cell], source[cell], word, n[cell]])[:, by]
        fresh = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(0))) if len(by) else by
        bits = np.bitwise_or.reduceat(bit[by], fresh) if len(by) else bit
        keys = keys[:, fresh]
        # The kept terms themselves.
        place = number[order]
        head = np.flatnonzero(place % WORD == 0)
        size = np.diff(np.append(head, len(order)))
        offsets = pa.array(np.append(head, len(order)), pa.int32())
        whole = np.where(size == WORD, np.uint64(2**64 - 1), (np.uint64(1) << (size % WORD).astype(np.uint64)) - np.uint64(1))
        levels, words = len(fresh), len(head)
        pick = lambda values, index: pa.array(values, pa.string()).take(pa.array(index))
        return pa.table(
            [
                pa.array(np.full(levels + words, shard)),
                pa.concat_arrays([pick(langs, keys[0]), pick(langs, of[head])]),
                pa.concat_arrays([pick(sources, keys[1]), pa.nulls(words, pa.string())]),
                pa.array(np.concatenate([keys[2], place[head] // WORD]), pa.int32()),
                pa.array(np.concatenate([keys[3], np.zeros(words, np.int64)])),
                pa.array(np.concatenate([bits, whole]).view(np.int64)),
                pa.concat_arrays([pa.nulls(levels, pa.list_(pa.string())), pa.ListArray.from_arrays(offsets, pick(terms, pair[order] % len(terms)))]),
                pa.concat_arrays([pa.nulls(levels, pa.list_(pa.int64())), pa.ListArray.from_arrays(offsets, pa.array(total[order]))]),
            ],
            names,
        )

    dealt = counts.filter("term IS NOT NULL").withColumn("shard", F.pmod(F.xxhash64("lang", "term"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(run, _LEVELS)


def group_sizes(counts: DataFrame, levels: DataFrame) -> DataFrame:
    """``lang, source, n, lang_n, v``: kept occurrences of the group and of its
    language, and kept terms of the language."""
    own = levels.filter("source IS NOT NULL").groupBy("lang", "source").agg(F.sum(F.bit_count("bits") * F.col("count")).alias("n"))
    terms = levels.filter("source IS NULL").groupBy("lang").agg(F.sum(F.bit_count("bits").cast("long")).alias("v"))
    whole = own.groupBy("lang").agg(F.sum("n").alias("lang_n"))
    groups = counts.filter("term IS NULL").select("lang", "source")
    return groups.join(own, ["lang", "source"], "left").join(whole, "lang", "left").join(terms, "lang", "left").fillna(0, ["n", "lang_n", "v"])


def probabilities(count: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``1 + floor(1e9 (count + 1) / size)``, exact."""
    more = count + 1
    if len(more) and int(more.max()) > 2**63 // SCALE:
        return np.array([1 + SCALE * c // s for c, s in zip(more.tolist(), size.tolist())], np.int64)
    return 1 + SCALE * more // size


def term_values(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def pair_values(word: np.ndarray, group: np.ndarray, p: np.ndarray, bits: np.ndarray, groups: int) -> np.ndarray:
    """Sums over all terms for every two groups, as a square table.

    ``bits`` of the terms that have probability ``p`` in ``group``; the sets of a group
    and word are all of its terms. Words are compared within themselves only."""
    order = np.argsort(word, kind="stable")
    word, group, p, bits = word[order], group[order], p[order], bits[order]
    first = np.searchsorted(word, word, "left")
    partners = np.searchsorted(word, word, "right") - first
    out = np.zeros(groups * groups, np.int64)
    cost, at = np.cumsum(partners), 0
    while at < len(word):
        to = max(at + 1, int(np.searchsorted(cost, (cost[at - 1] if at else 0) + EXPANDED, "right")))
        size = partners[at:to]
        left = np.repeat(np.arange(at, to), size)
        right = np.repeat(first[at:to], size) + run_index(size)
        terms = np.bitwise_count(bits[left] & bits[right])
        some = np.flatnonzero((terms > 0) & (group[left] != group[right]))
        left, right = left[some], right[some]
        np.add.at(out, group[left] * groups + group[right], terms[some].astype(np.int64) * term_values(p[left], p[right]))
        at = to
    return out.reshape(groups, groups)


def _top_terms(group, p, bits, word, base, q, terms):
    """The RANKS best terms of each group in a shard: groups, terms, values."""
    rank = np.empty(len(terms), np.int64)
    rank[np.array(sorted(range(len(terms)), key=terms.__getitem__), np.int64)] = np.arange(len(terms))
    found = []
    for lo in range(0, len(group), EXPANDED // WORD):
        part = slice(lo, lo + EXPANDED // WORD)
        flags = np.unpackbits(np.ascontiguousarray(bits[part]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, bit = np.nonzero(flags)
        term = base[word[part][row]] + bit
        own, usual = p[part][row], q[term]
        more = own > usual
        found.append(np.stack([group[part][row][more], term[more], term_values(own[more], usual[more])]))
    own, term, value = np.concatenate(found, 1)
    order = np.lexsort((rank[term], -value, own))
    own, term, value = own[order], term[order], value[order]
    best = run_index(np.unique(own, return_counts=True)[1]) < RANKS
    return own[best], term[best], value[best]


def shard_sums(levels: DataFrame, groups: DataFrame, shards: int) -> DataFrame:
    """``lang, source, part, item, value``: a shard's share of every pair, and its best terms."""

    def run(key, table, sizes):
        found = []
        groups_of: dict[str, list] = {}
        for r in sizes.to_pylist():
            groups_of.setdefault(r["lang"], []).append(r)
        rows = table.combine_chunks()
        langs = rows.column("lang").to_numpy()
        for lang, members in groups_of.items():
            members.sort(key=lambda r: r["source"])
            names = [r["source"] for r in members]
            mine = rows.filter(pa.array(langs == lang)) if len(langs) else rows
            shared = np.zeros((len(names), len(names)), np.int64)
            if mine.num_rows:
                size = np.array([r["n"] + r["v"] for r in members])
                is_term = mine.column("source").is_null().to_numpy()
                words, sets = mine.filter(pa.array(is_term)).sort_by("word"), mine.filter(pa.array(~is_term))
                whole = words.column("bits").to_numpy().view(np.uint64)
                place = {s: i for i, s in enumerate(names)}
                group = np.array([place[s] for s in sets.column("source").to_pylist()], np.int64)
                word, count = sets.column("word").to_numpy().astype(np.int64), sets.column("count").to_numpy()
                bits = sets.column("bits").to_numpy().view(np.uint64)
                p = probabilities(count, size[group])
                # What a group has in no set, it has 0 times.
                present = np.zeros((len(names), len(whole)), np.uint64)
                np.bitwise_or.at(present, (group, word), bits)
                none, at = np.nonzero(whole & ~present)
                absent = (whole & ~present)[none, at]
                nothing = probabilities(np.zeros(len(none), np.int64), size[none])
                shared = pair_values(*(np.concatenate(x) for x in ((word, at), (group, none), (p, nothing), (bits, absent))), len(names))
                terms = words.column("terms").combine_chunks().flatten().to_pylist()
                totals = words.column("totals").combine_chunks().flatten().to_numpy()
                usual = probabilities(totals, np.full(len(totals), members[0]["lang_n"] + members[0]["v"]))
                own, term, value = _top_terms(group, p, bits, word, np.arange(len(whole)) * WORD, usual, terms)
                found += [(lang, names[g], "term", terms[t], v) for g, t, v in zip(own.tolist(), term.tolist(), value.tolist())]
            if mine.num_rows or key[0].as_py() == 0:  # one shard names every pair
                found += [(lang, a, "pair", b, v) for a, line in zip(names, shared.tolist()) for b, v in zip(names, line) if a != b]
        columns = list(zip(*found)) or [[]] * 5
        kinds = [pa.string()] * 4 + [pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "source", "part", "item", "value"])

    everywhere = groups.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    return levels.groupBy("shard").cogroup(everywhere.groupBy("shard")).applyInArrow(run, "lang string, source string, part string, item string, value long")


def divergences(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every group of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    store = Store(spark)
    counts = store.put(term_counts(docs), "term-counts")
    shards = max(1, -(-counts.count() // SHARD_CELLS))
    levels = store.put(count_levels(counts, shards), "count-levels")
    groups = store.put(group_sizes(counts, levels), "group-sizes")
    shares = store.put(shard_sums(levels, groups, shards), "shard-sums")
    store.drop("term-counts", "count-levels", "group-sizes")
    pairs = shares.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(ranked).alias("rank")
    terms = shares.filter("part = 'term'").select("*", rank).filter(F.col("rank") <= RANKS)
    return pairs.select("*", rank).unionByName(terms)


def divergence_query(spark: SparkSession, folder: str) -> DataFrame:
    return divergences(spark.read.parquet(f"{folder}/documents.parquet"))


DIVERGENCE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 3
), cells AS (
  SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS n
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN cells c USING (lang, source) GROUP BY g.lang, g.source
), vocabulary AS (
  SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang
), spread AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.n + v.v) AS p
  FROM groups g JOIN vocabulary v USING (lang) JOIN kept k USING (lang) LEFT JOIN cells c USING (lang, source, term)
), whole AS (
  SELECT k.lang, k.term, 1 + (1000000000::HUGEINT * (sum(c.n) + 1)) // (any_value(t.n) + any_value(v.v)) AS q
  FROM kept k JOIN cells c USING (lang, term) JOIN vocabulary v USING (lang)
    JOIN (SELECT lang, sum(n) AS n FROM groups GROUP BY lang) t USING (lang)
  GROUP BY k.lang, k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM spread a JOIN spread b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT s.lang, s.source, 'term', s.term, ((s.p - w.q) * (s.p - w.q)) // w.q
  FROM spread s JOIN whole w USING (lang, term) WHERE s.n > 0 AND s.p > w.q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
