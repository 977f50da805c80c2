import hashlib
import random

import pytest

from spendcast.operators import evaluate, models, prep
from spendcast.operators.scan import ScanLimits
from spendcast.plans import training
from spendcast.sources import tables
from spendcast.sources.log import star_log
from spendcast.sources.scratch import scratch_folder
from tests.conftest import SF


def test_whole_job_scores_every_key_and_importance_sums_to_one(spark):
    keys = spark.read.parquet(f"{SF}/customer.parquet").selectExpr("c_custkey AS customer_id")
    output = scratch_folder(spark, "scores")
    result, scores = training.train_and_score(
        star_log(spark, SF), "2001-08", 1e5, models.boosted_trees(rounds=2, depth=2),
        keys=keys, output=output, folds=2, blocks=("habits",),
    )
    held_out = result.train.toPandas()
    assert held_out.customer_id.is_unique and held_out.score.between(0, 1).all()
    assert set(held_out.fold) == {0, 1}
    stored = tables.read_scores(spark, output)
    assert stored.count() == keys.count() == scores.count()
    mean = evaluate.importance_mean(result.importances).toPandas().importance
    assert mean.sum() == pytest.approx(1.0)


def test_shuffling_an_unused_feature_costs_nothing(spark):
    rows = [(i, i % 2, float(i % 2), 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, "customer_id long, label int, used double, flat double")
    model = models.boosted_trees(rounds=2, depth=2).fit(models.assemble(df, ["used", "flat"]))
    drops = models.permutation_importance(df, ["used", "flat"], model)
    got = {r.feature: r.auc_drop for r in drops.collect()}
    assert got["used"] > 0 and got["flat"] == pytest.approx(0)
    assert models.select_features(drops) == ["used"]


def test_boosting_keeps_its_best_round(spark):
    rows = [(i, int((i * 37) % 100 < 50 + (i % 11 == 0) * 30), i % 3, float((i * 37) % 100), float(i % 7)) for i in range(600)]
    df = spark.createDataFrame(rows, "customer_id long, label int, fold int, x double, y double")
    train = models.assemble(df, ["x", "y"])
    result = models.out_of_fold(train, models.boosted_trees(rounds=12, depth=2), folds=3, names=["x", "y"], metric="log_loss")
    assert all(m.getNumTrees > 3 for m in result.models)
    assert models.best_round([5, 4, 3, 3.5, 3.4, 2], patience=2) == 3
    assert models.best_round([5, 4, 3, 3.5, 3.4, 2], patience=3) == 6


def noisy(spark, n=900, folds=3):
    rng = random.Random(5)
    rows = [(i, int(rng.random() < (0.85 if i % 10 < 5 else 0.2)), i % folds, float(i % 10), rng.random()) for i in range(n)]
    return models.assemble(spark.createDataFrame(rows, "customer_id long, label int, fold int, x double, y double"), ["x", "y"])


def test_boosting_stops_once_patience_is_over(spark):
    """Far fewer rounds than allowed are fitted, and the model keeps its best one."""
    train = noisy(spark)
    others, held = train.filter("fold <> 0"), train.filter("fold = 0")
    found = models.fit_staged(models.boosted_trees(rounds=10_000, depth=2), others, held, patience=4)
    assert found.fitted < 100 and len(found.scores) == found.fitted
    best = max(range(found.fitted), key=lambda i: (found.scores[i], -i)) + 1
    assert found.model.getNumTrees == best <= found.fitted - 4
    again = models.boosted_trees(rounds=best, depth=2).fit(others)
    scores = [{r.customer_id: r.score for r in models.score(m, held).collect()} for m in (found.model, again)]
    assert scores[0] == pytest.approx(scores[1])
    assert evaluate.auc(models.score(again, held)).first()["auc"] == pytest.approx(found.scores[best - 1])
    assert sum(found.model.featureImportances.toArray()) == pytest.approx(1)


def test_stages_end_at_the_most_rounds(spark):
    train = noisy(spark, 300)
    found = models.fit_staged(models.boosted_trees(rounds=5, depth=1), train.filter("fold <> 0"), train.filter("fold = 0"), patience=100)
    assert found.fitted == 5 and 1 <= found.model.getNumTrees <= 5


def test_trial_parameters_come_from_a_hash(spark):
    rows = models.trial_parameters(spark, 100).collect()
    assert len(rows) == 100
    for r in rows:
        for name, (low, high) in models.SEARCH.items():
            u = int(hashlib.md5(f"42-{r.trial}-{name}".encode()).hexdigest()[:8], 16) / 2**32
            assert r[name] == pytest.approx(low + (high - low) * u, rel=1e-15)
    assert [tuple(r) for r in models.trial_parameters(spark, 3).collect()] == [tuple(r) for r in rows[:3]]


def test_half_of_the_trials_reach_the_next_rung(spark):
    train = noisy(spark, 300)
    build = lambda **params: models.boosted_trees(depth=1, **params)
    options = {"trials": 4, "folds": 3, "rungs": (1, 2, 3)}
    found = models.search_trials(train, build, **options).toPandas()
    assert sorted(found.rounds) == [1, 1, 2, 3] and found.value.between(0, 1).all()
    best = models.tune(train, build, **options)
    top = found[found.rounds == 3].iloc[0]
    assert best.getStepSize() == top.learning_rate and best.getMaxIter() == 3


def test_selection_drops_noise_and_trains_again(spark):
    rng = random.Random(6)
    rows = [(i, int(i % 10 < 5), float(i % 10), 1.0, rng.random()) for i in range(400)]
    df = spark.createDataFrame(rows, "customer_id long, label int, used double, flat double, noise double")
    kept, result = models.select_and_retrain(df, ["used", "flat", "noise"], models.boosted_trees(rounds=2, depth=2), folds=3)
    assert kept == ["used"]
    assert evaluate.auc(result.train).first()["auc"] > 0.99 and result.train.count() == 400


def test_permutation_in_batches_of_any_size(spark):
    rows = [(i, i % 2, float(i % 2), 1.0, float(i % 7)) for i in range(60)]
    df = spark.createDataFrame(rows, "customer_id long, label int, a double, b double, c double")
    model = models.boosted_trees(rounds=1, depth=1).fit(models.assemble(df, ["a", "b", "c"]))
    found = []
    for batch in (1, 16):
        drops = models.permutation_importance(df, ["a", "b", "c"], model, batch=batch)
        found.append({r.feature: r.auc_drop for r in drops.collect()})
    assert all(set(f) == {"a", "b", "c"} and f["b"] == pytest.approx(0) and f["a"] > 0 for f in found)


@pytest.mark.parametrize("limits", [ScanLimits(), ScanLimits(15)])
def test_no_row_sees_its_own_label(spark, limits):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), int(rng.random() < 0.4)) for i in range(120)]
    df = spark.createDataFrame(rows, "customer_id long, kind string, label int")
    got = {r.customer_id: r.kind_target for r in prep.ordered_target(df, ["kind"], limits=limits).collect()}
    order = sorted(rows, key=lambda r: hashlib.md5(f"{r[0]}-42".encode()).hexdigest())
    earlier = {}
    for i, kind, label in order:
        n, s = earlier.get(kind, (0, 0))
        assert got[i] == pytest.approx((s + 0.5) / (n + 1))
        earlier[kind] = n + 1, s + label
    flipped = df.withColumn("label", 1 - df.label)
    first = {}
    for i, kind, _ in order:
        first.setdefault(kind, i)
    other = {r.customer_id: r.kind_target for r in prep.ordered_target(flipped, ["kind"], limits=limits).collect()}
    assert all(other[i] == got[i] == 0.5 for i in first.values())
    test = spark.createDataFrame([(1, "a"), (2, "new"), (3, None)], "customer_id long, kind string")
    means = {r.customer_id: r.kind_target for r in prep.target_means(df, test, ["kind"]).collect()}
    for i, kind in ((1, "a"), (3, None)):
        assert means[i] == pytest.approx((earlier[kind][1] + 0.5) / (earlier[kind][0] + 1))
    assert means[2] == 0.5


def test_string_features_reach_a_learner(spark):
    from spendcast.plans.features import OPTIONAL, feature_table

    table = feature_table(star_log(spark, SF), "2001-08", 1e5, blocks=("habits", *OPTIONAL))
    data = training.model_input(table, folds=2)
    assert "total_sum_per_count_using_shopping_cat_target" in data.features and "last_month_shopping" in data.features
    assert data.train.first().features.size == len(data.features) == 6


def test_diagnostics_equal_the_single_operators(spark):
    result = models.out_of_fold(noisy(spark, 300), models.boosted_trees(rounds=2, depth=2), folds=3, names=["x", "y"])
    found = {name: df.toPandas() for name, df in models.diagnostics(result).items()}
    assert set(found) == {"roc", "confusion", "fold_metrics", "auc", "importance"}
    scored = result.train.cache()
    same = lambda a, b, keys: a.sort_values(keys).reset_index(drop=True).equals(b.sort_values(keys).reset_index(drop=True))
    assert same(found["roc"], evaluate.roc_curve(scored).toPandas(), ["fpr", "tpr"])
    assert same(found["confusion"], evaluate.confusion(scored).toPandas(), ["tn"])
    assert same(found["fold_metrics"], evaluate.score_metrics(scored, by=["fold"]).toPandas(), ["fold"])
    pooled = found["auc"][found["auc"].fold.isna()].auc.iloc[0]
    assert pooled == evaluate.auc(scored).first()["auc"] and len(found["auc"]) == 4
    assert found["importance"].importance.sum() == pytest.approx(1)


def test_model_queries_run_the_published_settings(monkeypatch):
    """All blocks and ten folds, and as many rounds as the held-out fold asks for."""
    import __spark_entry__ as registered

    seen = {}
    monkeypatch.setattr(registered, "star_log", lambda *a: None)
    monkeypatch.setattr(registered, "customers", lambda *a: type("Keys", (), {"selectExpr": lambda self, *e: None})())
    monkeypatch.setattr(training, "train_and_score", lambda *a, **options: seen.update(job=(a[3], options)))
    registered.gbt_run(None, SF)
    estimator, options = seen["job"]
    assert estimator.getMaxIter() == models.ROUNDS and estimator.getMaxDepth() == 5
    assert options.get("folds", 10) == 10 and "blocks" not in options

    class Data:
        raw_train, features = None, ["x"]

    monkeypatch.setattr(registered.features, "feature_table", lambda *a, **options: seen.update(table=options))
    monkeypatch.setattr(training, "model_input", lambda table, **options: seen.update(input=options) or Data)
    monkeypatch.setattr(
        models, "select_and_retrain",
        lambda df, names, learner, **options: seen.update(selection=(learner, options)) or (names, type("Found", (), {"train": None})),
    )
    registered.selected_scores(None, SF)
    learner, options = seen["selection"]
    assert learner.getMaxIter() == models.ROUNDS and learner.getMaxDepth() == 6
    assert options.get("folds", 10) == seen["input"].get("folds", 10) == 10 and "blocks" not in seen["table"]


def test_selection_stops_once_patience_is_over(spark, monkeypatch):
    """The first fit ends early too, where it would go through all rounds allowed."""
    fitted = []
    staged = models.fit_staged
    monkeypatch.setattr(models, "fit_staged", lambda *a, **options: fitted.append(staged(*a, **options)) or fitted[-1])
    rng = random.Random(7)
    rows = [(i, int(rng.random() < (0.85 if i % 10 < 5 else 0.2)), float(i % 10), rng.random()) for i in range(400)]
    df = spark.createDataFrame(rows, "customer_id long, label int, used double, noise double")
    kept, result = models.select_and_retrain(df, ["used", "noise"], models.boosted_trees(rounds=10_000, depth=1), folds=2, patience=2)
    assert "used" in kept and result.train.count() == 400
    assert len(fitted) == 3 and all(f.fitted < 100 for f in fitted)
