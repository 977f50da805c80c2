"""Quality classifier: ridge regression on random Fourier features.

Statistics of whole texts are standardised and mapped to cosines of random
projections, whose inner products approximate a Gaussian kernel. Partitions sum
their normal equations, Spark adds the sums, and the driver solves systems of one
fixed size. Each training fold is scored by the fit of the others; isotonic
regression of labels on those scores (in bins of fixed number) turns scores into
probabilities.

Edge cases: a null or empty text has statistics of 0 and gets a score like any
other; documents without a label or doc_id are only scored; repeated labels of a
document count once, by their majority; without training labels every score is
the prior; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from spendcast.llm.batches import small_batches
from spendcast.llm.rules import text_counts
from spendcast.sources.scratch import scratch_folder

STATS = (
    "words", "mean_word", "symbols", "dup_lines", "repeats", "upper", "letters", "bars", "marked", "shout",
    "lines", "words_per_line", "variety", "stutter",
)
FEATURES = 256
WIDTH = 4.0  # of the Gaussian kernel, on standardised statistics
RIDGE = 1.0
FOLDS = 5
BINS = 1000
PRIOR = 0.85
HELD_OUT = (5, 0)


def text_statistics(column: pa.Array) -> np.ndarray:
    """One row of STATS per text; shares and logarithms, finite for any text."""
    n = {c: v.astype(float) for c, v in text_counts(column).items()}
    words, lines = np.maximum(n["n_words"], 1), np.maximum(n["n_lines"], 1)
    chars, letters = np.maximum(n["word_chars"], 1), np.maximum(n["n_letters"], 1)
    return np.stack(
        [
            np.log1p(n["n_words"]), np.log1p(n["word_chars"] / words), np.sqrt(n["n_symbols"] / words), np.sqrt(n["n_dup_lines"] / lines),
            np.sqrt(n["n_repeat_words"] / words), np.sqrt(n["n_upper"] / letters), n["n_letters"] / chars, np.sqrt(n["n_bars"] / words),
            np.sqrt(n["n_marked"] / words), np.sqrt(n["n_shout"] / words), np.log1p(n["n_lines"]), np.log1p(n["n_words"] / lines),
            np.sqrt(n["n_distinct"] / words), np.sqrt(n["n_stutter"] / words),
        ],
        1,
    )


def statistics_table(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, stats`` of every row."""
    small_batches(docs.sparkSession)
    folds, fold = HELD_OUT
    number = F.crc32(F.col("doc_id").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = text_statistics(batch.column(1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(stats) + 1) * len(STATS), pa.int32()), pa.array(stats.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), lists], ["doc_id", "held_out", "fold", "stats"])

    rows = docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.coalesce(number % folds == fold, F.lit(False)).alias("held_out"),
        F.coalesce(F.floor(number / folds) % FOLDS, F.lit(0)).cast("int").alias("fold"),
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, fold int, stats array<double>")


@dataclass
class Classifier:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of all training rows
    knots: np.ndarray  # scores
    chances: np.ndarray  # calibrated probabilities at the knots

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = fourier(stats, self.mean, self.scale) @ self.weights
        return np.clip(np.interp(raw, self.knots, self.chances), 0.0, 1.0)


def fourier(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of a Gaussian kernel, a constant and the statistics."""
    rng = np.random.default_rng(7)
    turn = rng.standard_normal((len(mean), FEATURES)) / WIDTH
    shift = rng.uniform(0, 2 * np.pi, FEATURES)
    z = np.clip((stats - mean) / scale, -8, 8)
    return np.hstack([np.cos(z @ turn + shift) * np.sqrt(2 / FEATURES), z / 10, np.ones((len(z), 1))])


def _matrix(column) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATS))


def isotonic(scores: np.ndarray, hits: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators of hits / total along ascending scores."""
    blocks: list[list[float]] = []
    for s, h, n in zip(scores, hits, total):
        blocks.append([s * n, h, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def fit(train: DataFrame) -> Classifier:
    """From ``fold, stats, label``; the driver sees sums of fixed size only."""
    size = len(STATS)
    sums = train.select(F.posexplode("stats")).groupBy("pos").agg(F.avg("col").alias("m"), F.stddev_pop("col").alias("s"))
    mean, scale = np.zeros(size), np.ones(size)
    for r in sums.collect():  # one row per statistic
        mean[r.pos], scale[r.pos] = r.m, r.s if r.s > 1e-9 else 1.0
    width = FEATURES + size + 1
    flat = width * width + width

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FOLDS, flat))
        for batch in batches:
            fold, label = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            z = fourier(_matrix(batch.column(1)), mean, scale)
            for f in np.unique(fold):
                own = z[fold == f]
                total[f] += np.concatenate([(own.T @ own).ravel(), own.T @ label[fold == f]])
        used = np.flatnonzero(np.abs(total).sum(1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([total[f].tobytes() for f in used], pa.binary())], ["fold", "sums"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for f, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values = np.frombuffer(data)
                total[f] = total[f] + values if f in total else values.copy()
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], ["fold", "sums"])

    kind = "fold int, sums binary"
    parts = train.select("fold", "stats", F.col("label").cast("double")).mapInArrow(equations, kind)
    # Added in a tree: tasks of the second level, then one per fold.
    for n in (64, FOLDS):
        parts = parts.repartition(n, *(["fold"] if n == FOLDS else [])).mapInArrow(added, kind)
    total = np.zeros((FOLDS, flat))
    for fold, data in parts.toLocalIterator():
        total[fold] += np.frombuffer(data)

    def solve(flat_sums: np.ndarray) -> np.ndarray:
        gram, right = flat_sums[: width * width].reshape(width, width), flat_sums[width * width :]
        return np.linalg.solve(gram + RIDGE * np.eye(width) * 1e-2, right)

    whole = total.sum(0)
    if not whole.any():
        return Classifier(mean, scale, np.zeros(width), np.zeros(1), np.full(1, PRIOR))
    folds = np.stack([solve(whole - total[f]) for f in range(FOLDS)])

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = fourier(_matrix(batch.column(1)), mean, scale)
            raw = (z * folds[batch.column(0).to_numpy()]).sum(1)
            yield pa.RecordBatch.from_arrays([pa.array(raw), batch.column(2)], ["raw", "label"])

    scored = train.select("fold", "stats", F.col("label").cast("double")).mapInArrow(held, "raw double, label double")
    bins = scored.groupBy(F.floor(F.greatest(F.lit(-0.5), F.least(F.lit(1.5), "raw")) * (BINS / 2)).alias("bin")).agg(
        F.avg("raw").alias("raw"), F.sum("label").alias("hits"), F.count(F.lit(1)).alias("n")
    )
    rows = np.array(sorted(tuple(r)[1:] for r in bins.collect()), float)  # BINS rows at most
    knots, chances = isotonic(*rows.T)
    return Classifier(mean, scale, solve(whole), knots, chances)


def majority(labels: DataFrame) -> DataFrame:
    """One ``doc_id, label`` per labelled document."""
    return labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        (F.avg("quality") >= 0.5).cast("int").alias("label")
    )


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    spark = docs.sparkSession
    path = scratch_folder(spark, "statistics")
    statistics_table(docs).write.parquet(path)
    stats = spark.read.parquet(path)
    train = stats.filter("NOT held_out").join(majority(labels), "doc_id").select("fold", "stats", "label")
    model = fit(train)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_matrix(batch.column(2)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"]
            )

    return stats.select("doc_id", "held_out", "stats").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def classifier_query(spark: SparkSession, folder: str) -> DataFrame:
    return classify(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
