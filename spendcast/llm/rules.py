"""Quality rules as weak supervision.

Each rule votes a document good (1), bad (-1) or abstains (0) from exact counts
over its whole text. Expectation-maximisation estimates, without labels, how
often each rule is right on good and on bad documents; the posterior probability
of good replaces a filter that asks every rule to pass. Vote patterns are counted
in Spark first, so the estimation sees at most 3^rules rows whatever the corpus.

Edge cases: a null or empty text has no words and fails the base test; repeated
rows are judged alike; an empty table gives an empty table; other columns pass
through or are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from spendcast.llm.batches import per_text, small_batches, span_hashes, text_buffer, windows, word_groups

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_upper", "n_letters", "n_bars", "n_marked", "n_shout", "n_lines", "n_distinct", "n_stutter")
RULES = ("symbols", "marks", "tables", "shouting", "capitals", "lines", "repeats", "lengths", "variety", "stutter")

_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_MARK = np.isin(np.arange(256), np.frombuffer(b"#*$%&<>@^~_=+\\", np.uint8))
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_LETTER = _UPPER | ((np.arange(256) >= 97) & (np.arange(256) <= 122))


def repeated_per_text(keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """True where a key occurs more than once in its text."""
    if not len(keys):
        return np.zeros(0, bool)
    order = np.lexsort((keys, doc))
    k, d = keys[order], doc[order]
    same = (k[1:] == k[:-1]) & (d[1:] == d[:-1])
    twice = np.zeros(len(keys), bool)
    twice[1:] |= same
    twice[:-1] |= same
    out = np.empty(len(keys), bool)
    out[order] = twice
    return out


def distinct_per_text(keys: np.ndarray, doc: np.ndarray, texts: int) -> np.ndarray:
    order = np.lexsort((keys, doc))
    k, d = keys[order], doc[order]
    fresh = np.ones(len(k), bool)
    fresh[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
    return np.bincount(d[fresh], minlength=texts)


def text_counts(column: pa.Array, window: int = 8) -> dict[str, np.ndarray]:
    """Exact counts of each text of a column."""
    found = {c: [] for c in (*COUNTS, *MORE)}
    for _, _, w in word_groups(column):
        texts, raw, at = len(w.count), w.raw, w.offsets
        doc, hashes = w.doc(), w.hashes()
        place_of = lambda flags: per_text(flags, at)
        upper, letter = _UPPER[raw], _LETTER[raw]
        last = raw[w.end - 1] if len(w.end) else raw[:0]
        runs = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[np.stack([w.start, w.end])], axis=0)[0]
        ups, letters = runs(upper), runs(letter)
        again = np.zeros(len(hashes), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
        key, place = windows(hashes, w.first, window)
        twice = repeated_per_text(key, doc[place])
        cover = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(cover, place[twice], 1)
        np.add.at(cover, place[twice] + window, -1)
        # Lines with a word: a line is known by where its first word stands.
        breaks = np.cumsum(raw == 10)
        line = breaks[w.start] if len(w.start) else breaks[:0]
        fresh = np.ones(len(line), bool)
        fresh[1:] = (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])
        lines_doc = doc[fresh]
        edges = np.concatenate([np.flatnonzero(raw == 10) + 1, at[:-1]])
        edges = np.unique(edges)
        begin = edges[np.searchsorted(edges, w.start[fresh], "right") - 1]
        stops = np.unique(np.concatenate([np.flatnonzero(raw == 10), at[1:]]))
        stop = stops[np.searchsorted(stops, w.start[fresh], "right")] if fresh.any() else begin
        line_keys = span_hashes(raw, begin, stop)
        n_lines = np.bincount(lines_doc, minlength=texts)
        put = {
            "n_words": w.count,
            "word_chars": place_of(~w.space & ((raw & 0xC0) != 0x80)),
            "n_symbols": place_of(_SYMBOL[raw]),
            "n_dup_lines": n_lines - distinct_per_text(line_keys, lines_doc, texts),
            "n_repeat_words": per_text(np.cumsum(cover[:-1]) > 0, w.first),
            "n_upper": place_of(upper), "n_letters": place_of(letter),
            "n_bars": place_of(raw == ord("|")),
            "n_marked": per_text(_MARK[last], w.first),
            "n_shout": per_text((ups >= 2) & (ups == letters), w.first),
            "n_lines": n_lines,
            "n_distinct": distinct_per_text(hashes, doc, texts),
            "n_stutter": per_text(again, w.first),
        }
        for c, v in put.items():
            found[c].append(np.asarray(v, np.int64))
    return {c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in found.items()}


def votes(n: dict[str, np.ndarray]) -> np.ndarray:
    """One column of votes per rule; thresholds are shares of words or lines."""
    words = np.maximum(n["n_words"], 1)
    share = lambda c, of=words: n[c] / np.maximum(of, 1)
    mean = n["word_chars"] / words

    def rule(value, bad, good):
        return np.where(value > bad, -1, np.where(value <= good, 1, 0))

    out = [
        rule(share("n_symbols"), 0.1, 0.02),
        rule(share("n_marked"), 0.1, 0.02),
        rule(share("n_bars"), 0.1, 0.01),
        rule(share("n_shout"), 0.3, 0.1),
        rule(share("n_upper", n["n_letters"]), 0.4, 0.15),
        rule(share("n_dup_lines", n["n_lines"]), 0.3, 0.1),
        rule(share("n_repeat_words"), 0.3, 0.1),
        np.where((mean < 2) | (mean > 12), -1, np.where((mean >= 3) & (mean <= 9), 1, 0)),
        # Few distinct words count against longer texts only.
        np.where(n["n_words"] < 50, 0, rule(-share("n_distinct"), -0.15, -0.3)),
        rule(share("n_stutter"), 0.2, 0.05),
    ]
    return np.stack(out, 1).astype(np.int8)


def base_failed(n: dict[str, np.ndarray]) -> np.ndarray:
    return (n["n_words"] < 20) | (100 * n["n_repeat_words"] > 30 * n["n_words"])


def pattern_codes(v: np.ndarray) -> np.ndarray:
    return (v.astype(np.int64) + 1) @ (3 ** np.arange(v.shape[1]))


class VoteModel:
    """Class prior and each rule's chance of voting good, per class."""

    def __init__(self, patterns: np.ndarray, weight: np.ndarray, rounds: int = 50, prior: float = 0.9):
        """Estimate from distinct vote patterns and how many documents have each.

        A document with any bad vote starts as likely bad. Pseudo-counts keep
        chances off 0 and 1 and settle rules that never vote."""
        good = np.where((patterns < 0).any(1), 0.1, 0.95)
        self.prior = prior
        for _ in range(rounds):
            chance = []
            for q in (1 - good, good):
                mass = (q * weight)[:, None]
                chance.append(((mass * (patterns > 0)).sum(0) + 1) / ((mass * (patterns != 0)).sum(0) + 2))
            self.bad, self.good = chance
            self.prior = ((good * weight).sum() + 9 * 1.0) / (weight.sum() + 10)
            good = self.posterior(patterns)

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """Probability that a document is good, given its votes."""
        yes, no = v > 0, v < 0
        log = lambda p: yes @ np.log(p) + no @ np.log1p(-p)
        odds = log(self.good) - log(self.bad) + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit_votes(docs: DataFrame) -> VoteModel:
    """Count the vote patterns of the whole table and estimate the model."""
    small_batches(docs.sparkSession)

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            n = text_counts(batch.column(0))
            code, times = np.unique(pattern_codes(votes(n)[~base_failed(n)]), return_counts=True)
            for c, t in zip(code.tolist(), times.tolist()):
                seen[c] = seen.get(c, 0) + t
        yield pa.RecordBatch.from_pydict({"code": pa.array(list(seen), pa.int64()), "n": pa.array(list(seen.values()), pa.int64())})

    counted = docs.select("text").mapInArrow(patterns, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    rows = sorted(tuple(r) for r in counted.collect())  # at most 3^rules rows
    code = np.array([r[0] for r in rows], np.int64)
    table = (code[:, None] // 3 ** np.arange(len(RULES)) % 3 - 1).reshape(-1, len(RULES))
    return VoteModel(table, np.array([r[1] for r in rows], float))


def judge(docs: DataFrame, model: VoteModel, threshold: float = 0.5) -> DataFrame:
    """Counts, votes' posterior and verdict of every document."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = text_counts(batch.column(1))
            failed, quality = base_failed(n), model.posterior(votes(n))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(n[c]) for c in COUNTS), pa.array(failed), pa.array(quality), pa.array(~failed & (quality >= threshold))],
                ["doc_id", *COUNTS, "base_failed", "quality", "kept"],
            )

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, quality double, kept boolean"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def keep_good(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that the model keeps, all columns as they were."""
    model = fit_votes(docs)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = text_counts(batch.column(place))
            good = ~base_failed(n) & (model.posterior(votes(n)) >= threshold)
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)


def rules_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return judge(docs, fit_votes(docs))
