"""Classifiers on feature tables, trained by Spark ML.

The boosted variants keep the published settings of three gradient boosters
where Spark's has the same knob: learning rate, row and column sampling, depth.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import SparkContext
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from spendcast.operators.evaluate import (
    auc, confusion, importance_mean, roc_curve, score_metrics, seeded_hash, stratified_folds,
)
from spendcast.operators.scan import DEFAULT_LIMITS, ScanLimits, scan
from spendcast.session import cut_lineage

# Learning rate, row sampling, column sampling, depth.
BOOSTING = {
    "ordered": (0.03571297756501696, 0.9867267702203111, 1.0, 6),
    "leafwise": (0.06163827164757535, 0.8, 0.8, 5),
    "levelwise": (0.06806593719106756, 0.9527699531356614, 0.6666816689708133, 5),
}
# Fixed value: the most rounds of boosting; ``out_of_fold`` stops long before.
ROUNDS = 10_000
# Search ranges of the learning rate and the row sampling.
SEARCH = {"learning_rate": (0.03, 0.07), "subsample": (0.5, 1.0)}


def boosted_trees(
    variant: str = "ordered",
    *,
    rounds: int = ROUNDS,
    depth: int | None = None,
    learning_rate: float | None = None,
    subsample: float | None = None,
    seed: int = 42,
) -> GBTClassifier:
    rate, rows, columns, default_depth = BOOSTING[variant]
    return GBTClassifier(
        stepSize=learning_rate or rate,
        subsamplingRate=subsample or rows,
        featureSubsetStrategy="all" if columns == 1.0 else str(columns),
        maxDepth=depth or default_depth,
        maxIter=rounds,
        seed=seed,
    )


def perceptron(features: int, *, hidden: int = 16, rounds: int = 100, seed: int = 42):
    """Neural member of the blend; meant for quantile-scaled features."""
    return MultilayerPerceptronClassifier(
        layers=[features, hidden, 2], maxIter=rounds, blockSize=64, seed=seed
    )


def candidates(rounds: int = 20, depth: int = 3, seed: int = 42) -> dict[str, Estimator]:
    """Classifiers compared by the leaderboard."""
    return {
        "logistic_regression": LogisticRegression(maxIter=rounds, regParam=0.01),
        "random_forest": RandomForestClassifier(numTrees=rounds, maxDepth=depth, seed=seed),
        "boosted_trees": boosted_trees(rounds=rounds, depth=depth, seed=seed),
        "linear_svc": LinearSVC(maxIter=rounds, regParam=0.01),
    }


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Pack features into one vector column, keeping keys, label and fold.

    Feature names hold characters the assembler reads as paths, so they are
    numbered for it.
    """
    keep = [c for c in ("customer_id", "label", "fold") if c in df.columns]
    numbered = df.selectExpr(*keep, *(f"double(`{c}`) AS f{i}" for i, c in enumerate(features)))
    packer = VectorAssembler(inputCols=[f"f{i}" for i in range(len(features))], outputCol="features")
    return packer.transform(numbered).select(*keep, "features")


def score(model: Model, df: DataFrame, keep: Sequence[str] = ("customer_id", "label", "fold")) -> DataFrame:
    """``customer_id[, label, fold], score``: the positive class's probability,
    or its margin for models without probabilities."""
    column = "probability" if model.hasParam("probabilityCol") else "rawPrediction"
    scored = model.transform(df)
    return scored.select(*(c for c in keep if c in df.columns), vector_to_array(column)[1].alias("score"))


@dataclass(frozen=True)
class OutOfFold:
    """Held-out scores of the train table, each fold model's scores of the test
    table, and feature importances per fold (None for models without any)."""

    train: DataFrame
    test: DataFrame | None
    importances: DataFrame | None
    models: Sequence[Model]


def best_round(losses: Sequence[float], patience: int) -> int:
    """Rounds to keep: the least loss before ``patience`` rounds without a better one."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def first_trees(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model that boosting had after its first rounds; nothing is fitted again."""
    if rounds >= model.getNumTrees:
        return model
    context = SparkContext._active_spark_context
    jvm, trees, weights = context._jvm, model._java_obj.trees(), model.treeWeights
    kept = context._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    heavy = context._gateway.new_array(jvm.double, rounds)
    for i in range(rounds):
        kept[i], heavy[i] = trees[i], float(weights[i])
    cut = jvm.org.apache.spark.ml.classification.GBTClassificationModel(model.uid, kept, heavy, model.numFeatures, model.numClasses)
    return GBTClassificationModel(model._java_obj.copyValues(cut, jvm.org.apache.spark.ml.param.ParamMap()))


@dataclass(frozen=True)
class Staged:
    """A boosted model cut to its best round, how many rounds were fitted to find it
    (those of the last stage, which holds all earlier ones), and each round's AUC."""

    model: GBTClassificationModel
    fitted: int
    scores: Sequence[float]


def fit_staged(estimator: GBTClassifier, train: DataFrame, held: DataFrame, patience: int = 100, stage: int | None = None, metric: str = "auc") -> Staged:
    """Boost in growing stages until ``patience`` rounds bring no better AUC on ``held``,
    or no lower loss with the metric ``log_loss`` (scores are then losses turned negative).

    A stage has twice the rounds of the one before, so all stages together fit less
    than twice the rounds of the last, however many rounds ``maxIter`` would allow; the
    first is long enough for a best round up to ``patience``. The
    same seed grows the same first trees, so only new trees are judged."""
    most, rounds = estimator.getMaxIter(), stage or max(2 * patience, 1)
    margins = cut_lineage(held.select("label", "features", F.lit(0.0).alias("margin")))
    scores: list[float] = []
    while True:
        rounds = min(rounds, most)
        model = estimator.copy({estimator.maxIter: rounds}).fit(train)
        if metric == "auc":
            found, margins = round_scores(model, margins, len(scores))
            scores += found
        else:
            scores = [-x for x in model.evaluateEachIteration(held)]
        best = best_round([-x for x in scores], patience)
        if rounds - best >= patience or rounds >= most:
            return Staged(first_trees(model, best), rounds, scores)
        rounds *= 2


def fit_until(estimator: Estimator, train: DataFrame, held: DataFrame, patience: int = 100, metric: str = "auc") -> Model:
    """The fitted model; tree boosting ends by what ``held`` says, if it has rows."""
    if not isinstance(estimator, GBTClassifier) or held.isEmpty():
        return estimator.fit(train)
    return fit_staged(estimator, train, held, patience, metric=metric).model


def round_scores(model: GBTClassificationModel, margins: DataFrame, done: int) -> tuple[list[float], DataFrame]:
    """AUC after each round from ``done`` on, and the margins after the last. ``margins``
    has the sum of the trees before. One pass scores all new trees; a held-out fold
    with one class only scores 0 throughout."""
    new = list(zip(model.trees, model.treeWeights))[done:]
    scored, terms = margins, []
    for i, (tree, weight) in enumerate(new):
        scored = tree.setPredictionCol(f"t{i}").transform(scored)
        terms.append(f"t{i} * {float(weight)!r}D")
    last = f"array({', '.join(terms)})"
    summed = scored.selectExpr("label", "features", f"margin + aggregate({last}, 0D, (a, x) -> a + x) AS margin", "margin AS start", f"{last} AS steps")
    summed = cut_lineage(summed)
    running = (
        "aggregate(steps, struct(start AS s, cast(array() AS array<double>) AS a), "
        "(acc, x) -> struct(acc.s + x AS s, concat(acc.a, array(acc.s + x)) AS a), acc -> acc.a)"
    )
    rounds = summed.selectExpr("label", f"posexplode({running}) AS (round, score)")
    found = {r["round"]: r["auc"] or 0.0 for r in auc(rounds, ["round"]).collect()}  # one row per round
    return [found.get(i, 0.0) for i in range(len(new))], summed.select("label", "features", "margin")


def out_of_fold(
    train: DataFrame,
    estimator: Estimator,
    *,
    test: DataFrame | None = None,
    names: Sequence[str] | None = None,
    folds: int = 10,
    early_stop: bool = True,
    patience: int = 100,
    metric: str = "auc",
    parallelism: int = 4,
) -> OutOfFold:
    """Train one model per fold on the other folds and score what it has not seen.

    ``train`` has ``customer_id, label, fold, features``. Tree boosting ends where the
    AUC of the held-out fold has not risen for ``patience`` rounds, and keeps its best
    round, unless ``early_stop`` is off. The metric may be ``log_loss`` instead.
    """
    if metric not in ("auc", "log_loss"):
        raise ValueError("metric must be 'auc' or 'log_loss'")

    def fit(fold: int) -> Model:
        others = train.filter(F.col("fold") != fold)
        held = train.filter(F.col("fold") == fold)
        return fit_until(estimator, others, held, patience, metric) if early_stop else estimator.fit(others)

    with ThreadPoolExecutor(parallelism) as pool:
        models = list(pool.map(fit, range(folds)))
    held_out = [score(m, train.filter(F.col("fold") == i)) for i, m in enumerate(models)]
    test_scores = None
    if test is not None:
        keys = test.select("customer_id", "features")
        test_scores = reduce(
            DataFrame.unionByName,
            (
                score(m, keys).select(
                    "customer_id", F.lit(i).alias("fold"), F.col("score").alias("probability")
                )
                for i, m in enumerate(models)
            ),
        )
    importances = None
    if names and hasattr(models[0], "featureImportances"):
        rows = [
            (name, i, float(value))
            for i, m in enumerate(models)
            for name, value in zip(names, m.featureImportances.toArray())
        ]
        importances = train.sparkSession.createDataFrame(
            rows, "feature string, fold int, importance double"
        )
    return OutOfFold(reduce(DataFrame.unionByName, held_out), test_scores, importances, models)


def diagnostics(result: OutOfFold, threshold: float = 0.5) -> dict[str, DataFrame]:
    """All tables that show how one model does: ``roc``, ``confusion``, ``fold_metrics``,
    ``auc`` (pooled and per fold) and ``importance``, if the model has any.

    The held-out scores are computed once and stored; every table reads those."""
    scored = cut_lineage(result.train.select("fold", "label", "score"))
    pooled = auc(scored).select(F.lit(None).cast("int").alias("fold"), "auc")
    tables = {
        "roc": roc_curve(scored),
        "confusion": confusion(scored, threshold),
        "fold_metrics": score_metrics(scored, threshold, ["fold"]),
        "auc": auc(scored, ["fold"]).unionByName(pooled),
    }
    return tables | ({} if result.importances is None else {"importance": importance_mean(result.importances)})


def fold_table(
    df: DataFrame, features: Sequence[str], folds: int = 10, seed: int = 42,
    limits: ScanLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Train table with folds and a feature vector, cut from its lineage: the
    learners read it many times."""
    return cut_lineage(assemble(stratified_folds(df, folds, seed, limits=limits), features))


PART_VALUES = 1 << 20  # feature values in a task of a learner, at least


def in_parts(table: DataFrame, width: int) -> DataFrame:
    """A stored table in as few partitions as its size asks for: boosting runs jobs by the
    thousand on it, and each partition is a task in every one of them."""
    return table.coalesce(max(1, table.count() * width // PART_VALUES))


def mean_auc(scores: DataFrame) -> float:
    return auc(scores, ["fold"]).agg(F.avg("auc")).first()[0]


def trial_parameters(
    spark: SparkSession, trials: int = 100, seed: int = 42, ranges: Mapping[str, tuple[float, float]] = SEARCH
) -> DataFrame:
    """Parameters of each trial, uniform in their ranges, from a hash of seed, trial and
    name: any trial can be drawn anywhere, and more trials leave the first as they are."""
    names = [
        f"{low!r}D + {high - low!r}D * (conv(substring(md5(concat('{seed}-', id, '-{name}')), 1, 8), 16, 10) / {float(1 << 32)!r}D) AS {name}"
        for name, (low, high) in ranges.items()
    ]
    return spark.range(trials).selectExpr("int(id) AS trial", *names)


def search_trials(
    train: DataFrame,
    build: Callable[..., Estimator],
    *,
    trials: int = 100,
    folds: int = 10,
    seed: int = 42,
    ranges: Mapping[str, tuple[float, float]] = SEARCH,
    rungs: Sequence[int] = (),
    parallelism: int = 4,
) -> DataFrame:
    """Random search: one row per trial with its parameters and mean fold AUC.

    With ``rungs``, ascending numbers of rounds passed on as ``rounds``, all trials run
    the first of them and the better half goes on to the next. A row then has the rounds
    and the value of the last rung its trial ran; all share the one fold table."""
    drawn = {r["trial"]: r.asDict() for r in trial_parameters(train.sparkSession, trials, seed, ranges).collect()}
    done: dict[int, tuple[int | None, float]] = {}
    alive = sorted(drawn)
    for rung in rungs or (None,):
        for trial in alive:
            given = {n: drawn[trial][n] for n in ranges} | ({} if rung is None else {"rounds": rung})
            result = out_of_fold(train, build(**given), folds=folds, early_stop=rung is None, parallelism=parallelism)
            done[trial] = rung, mean_auc(result.train)
        alive = sorted(alive, key=lambda t: (-done[t][1], t))[: -(-len(alive) // 2)]
    rows = [(t, *(p[n] for n in ranges), *done[t]) for t, p in drawn.items()]
    schema = "trial int, " + ", ".join(f"{n} double" for n in ranges) + ", rounds int, value double"
    return train.sparkSession.createDataFrame(rows, schema)


def tune(train: DataFrame, build: Callable[..., Estimator], **options) -> Estimator:
    """The estimator with the best parameters a search finds, those of the last rung."""
    found = search_trials(train, build, **options)
    best = found.orderBy(F.desc("rounds"), F.desc("value"), "trial").first().asDict()
    return build(**{k: v for k, v in best.items() if k not in ("trial", "value") and v is not None})


def leaderboard(
    train: DataFrame, estimators: Mapping[str, Estimator], *, folds: int = 10, parallelism: int = 4
) -> DataFrame:
    """Mean fold AUC and pooled out-of-fold AUC per classifier, best first."""
    rows = []
    for name, estimator in estimators.items():
        held_out = out_of_fold(train, estimator, folds=folds, parallelism=parallelism).train
        rows.append((name, mean_auc(held_out), auc(held_out).first()["auc"]))
    board = train.sparkSession.createDataFrame(rows, "model string, auc_fold_mean double, auc_pooled double")
    return board.orderBy(F.desc("auc_fold_mean"), "model")


def permutation_importance(
    df: DataFrame,
    features: Sequence[str],
    model: Model,
    *,
    seed: int = 42,
    batch: int = 16,
    limits: ScanLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """AUC lost when a feature's values are dealt to other rows; ``df`` should be rows
    the model has not seen.

    Rows get one seeded random order. Each batch of features is shifted along it by one
    random distance: a donor table ``(position, values)`` joins once, and every row then
    takes its donor's value of one feature at a time, so that a batch is one join and one
    scoring pass."""
    kept = [c for c in ("customer_id", "label") if c in df.columns]
    values = f"array({', '.join(f'double(`{c}`)' for c in features)}) AS x"
    hashed = df.selectExpr(*kept, values).withColumn("__hash", seeded_hash("customer_id", seed))
    placed = cut_lineage(scan(hashed, [], ["__hash", "customer_id"], position="__rn", limits=limits).drop("__hash"))
    n = placed.count()
    draw = random.Random(seed)
    found = []
    for start in range(0, len(features), batch):
        last = min(start + batch, len(features))
        shift = draw.randrange(1, n) if n > 1 else 0
        donor = placed.selectExpr(f"(__rn + {shift} - 1) % {n} + 1 AS __rn", f"slice(x, {start + 1}, {last - start}) AS given")
        # Variant -1 of the first batch is the table as it is.
        variants = f"explode(sequence({-1 if start == 0 else start}, {last - 1})) AS f"
        spliced = placed.join(donor, "__rn").selectExpr("label", "x", "given", variants).filter(f"f = -1 OR f >= {start}").selectExpr(
            "label", "f", f"transform(x, (v, i) -> if(i = f, given[f - {start}], v)) AS x"
        )
        scores = score(model, spliced.select("label", "f", array_to_vector("x").alias("features")), ("label", "f"))
        found.append(auc(scores, ["f"], limits))
    base = found[0].filter("f = -1").first()["auc"]
    named = f"array({', '.join(repr(c) for c in features)})[f] AS feature"
    lost = reduce(DataFrame.unionByName, found).filter("f >= 0")
    return lost.selectExpr(named, f"{base!r}D - auc AS auc_drop" if base is not None else "cast(null AS double) AS auc_drop")


def select_and_retrain(
    df: DataFrame, features: Sequence[str], estimator: Estimator, *, folds: int = 10, seed: int = 42, limits: ScanLimits = DEFAULT_LIMITS,
    patience: int = 100,
) -> tuple[list[str], OutOfFold]:
    """Fit on all folds but the first, drop the features whose shuffling costs that fold
    no AUC, and train out of fold on the rest. All are kept if none matters. Tree boosting
    ends as in ``out_of_fold``, for the first fit too."""
    dealt = cut_lineage(stratified_folds(df, folds, seed, limits=limits))
    packed = in_parts(cut_lineage(assemble(dealt, features)), len(features))
    model = fit_until(estimator, packed.filter("fold <> 0"), packed.filter("fold = 0"), patience)
    drops = permutation_importance(dealt.filter("fold = 0"), features, model, seed=seed, limits=limits)
    kept = select_features(drops) or list(features)
    train = in_parts(cut_lineage(assemble(dealt, kept)), len(kept))
    return kept, out_of_fold(train, estimator, names=kept, folds=folds, patience=patience)


def select_features(importances: DataFrame) -> list[str]:
    """Features whose shuffling costs AUC."""
    return [r["feature"] for r in importances.filter("auc_drop > 0").orderBy("feature").collect()]
