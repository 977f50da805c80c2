"""Folds, metrics, curves and blends on tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from spendcast.operators.scan import DEFAULT_LIMITS, ScanLimits, scan
from spendcast.session import cut_lineage


def seeded_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")))


def stratified_folds(
    df: DataFrame, folds: int = 10, seed: int = 42, key: str = "customer_id",
    limits: ScanLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Add ``fold`` (0..folds-1): rows of each label in a seeded random order,
    dealt round robin, so fold sizes differ by at most one per label.

    Only the keys of a label and how often they occur are put in order. The rows, wide
    as they may be, meet their key's place among few others."""
    name = F.struct("label", key)
    counts = df.groupBy(name.alias("__name")).agg(F.count(F.lit(1)).alias("__n"))
    keyed = counts.select("__name", "__n", "__name.label", f"__name.{key}").withColumn("__hash", seeded_hash(key, seed))
    placed = scan(cut_lineage(keyed), ["label"], ["__hash", key], sums={"__upto": "__n"}, limits=limits)
    starts = placed.select("__name", (F.col("__upto") - F.col("__n")).alias("__start"))
    own = F.row_number().over(Window.partitionBy("__name").orderBy("__name"))
    rows = df.withColumn("__name", name).withColumn("__rn", own).join(starts, "__name")
    return rows.withColumn("fold", ((F.col("__start") + F.col("__rn") - 1) % folds).cast("int")).drop("__name", "__start", "__rn")


def confusion(scores: DataFrame, threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp of ``score > threshold``."""
    said = F.col("score") > threshold
    real = F.col("label") == 1
    return scores.groupBy(*by).agg(
        F.count_if(~said & ~real).alias("tn"),
        F.count_if(said & ~real).alias("fp"),
        F.count_if(~said & real).alias("fn"),
        F.count_if(said & real).alias("tp"),
    )


def score_metrics(scores: DataFrame, threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts with precision, recall, true-negative rate and F1.
    Precision, recall and F1 are 0 where undefined."""
    zero = lambda num, den: f"coalesce(try_divide({num}, {den}), 0D)"
    return confusion(scores, threshold, by).selectExpr(
        *by, "tn", "fp", "fn", "tp",
        f"{zero('tp', 'tp + fp')} AS precision",
        f"{zero('tp', 'tp + fn')} AS recall",
        "try_divide(tn, tn + fp) AS true_negative_rate",
        f"{zero('2 * tp', '2 * tp + fp + fn')} AS f1",
    )


def _score_counts(scores: DataFrame, by: Sequence[str], limits: ScanLimits) -> DataFrame:
    """Per distinct score: positives, negatives, their running counts in score
    order, key totals, and the counts of the next lower score."""
    counts = scores.groupBy(*by, "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg")
    )
    # Scores may come from models: they are stored before they are counted and scanned.
    return scan(
        cut_lineage(counts), by, ["score"],
        sums={"pos_upto": "pos", "neg_upto": "neg"},
        lags={"pos_lower": "pos", "neg_lower": "neg"},
        totals={"pos_all": F.col("pos"), "neg_all": F.col("neg")},
        limits=limits,
    )


def auc(scores: DataFrame, by: Sequence[str] = (), limits: ScanLimits = DEFAULT_LIMITS) -> DataFrame:
    """Area under the ROC curve; ties count half. Null with one class only."""
    wins = F.col("pos") * (F.col("neg_upto") - F.col("neg") / 2)
    counted = _score_counts(scores, by, limits).withColumn("wins", wins)
    return counted.groupBy(*by).agg(
        F.try_divide(F.sum("wins"), F.sum("pos") * F.sum("neg").cast("double")).alias("auc")
    )


def auc_fold_mean(scores: DataFrame, limits: ScanLimits = DEFAULT_LIMITS) -> DataFrame:
    return auc(scores, ["fold"], limits).agg(F.avg("auc").alias("auc"))


def roc_curve(scores: DataFrame, limits: ScanLimits = DEFAULT_LIMITS) -> DataFrame:
    """False- and true-positive rate at each distinct score, highest first,
    starting at (0, 0) with an infinite threshold.

    A point is dropped when its step equals the next one; the first and the
    last point always stay.
    """
    c = _score_counts(scores, [], limits)
    fp = F.col("neg_all") - F.col("neg_upto") + F.col("neg")
    tp = F.col("pos_all") - F.col("pos_upto") + F.col("pos")
    highest = (F.col("neg_upto") == F.col("neg_all")) & (F.col("pos_upto") == F.col("pos_all"))
    turns = (F.col("pos") != F.col("pos_lower")) | (F.col("neg") != F.col("neg_lower"))
    points = c.filter(highest | F.col("pos_lower").isNull() | turns).select(
        F.col("score").alias("threshold"),
        F.try_divide(fp, F.col("neg_all")).alias("fpr"),
        F.try_divide(tp, F.col("pos_all")).alias("tpr"),
    )
    origin = "double('inf') AS threshold", "0D AS fpr", "0D AS tpr"
    return points.unionByName(scores.sparkSession.range(1).selectExpr(*origin))


def fold_average(fold_scores: DataFrame) -> DataFrame:
    """Mean of the fold models' scores per customer."""
    return fold_scores.groupBy("customer_id").agg(F.avg("probability").alias("probability"))


def importance_mean(importances: DataFrame) -> DataFrame:
    """Mean importance per feature over folds."""
    return importances.groupBy("feature").agg(F.avg("importance").alias("importance"))


def top_trials(trials: DataFrame, n: int = 30) -> DataFrame:
    return trials.orderBy(F.desc("value"), "trial").limit(n)


def blend(members: Sequence[DataFrame]) -> DataFrame:
    """Mean probability per customer over the members, joined by customer.

    Every member must score a customer; one missing a member is left out. A
    member that scores a customer several times counts with its mean.
    """
    stacked = reduce(
        DataFrame.unionByName,
        (m.select("customer_id", "probability", F.lit(i).alias("member")) for i, m in enumerate(members)),
    )
    return (
        stacked.groupBy("customer_id", "member")
        .agg(F.avg("probability").alias("probability"))
        .groupBy("customer_id")
        .agg(F.avg("probability").alias("probability"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") == len(members))
        .drop("n")
    )
