"""Profiling, preparation, evaluation and blending against brute force."""

import math
import random

import numpy as np
import pytest

from spendcast.operators import evaluate, prep, profile
from spendcast.operators.quantiles import exact_quantiles, quantile_knots
from spendcast.operators.scan import ScanLimits

SMALL = ScanLimits(20)


@pytest.fixture(scope="module")
def scores(spark):
    rng = random.Random(1)
    rows = [(i, i % 3, int(rng.random() < 0.3), rng.randrange(40) / 40) for i in range(400)]
    return rows, spark.createDataFrame(rows, "customer_id long, fold int, label int, score double")


def brute_auc(rows):
    pos = [r[3] for r in rows if r[2]]
    neg = [r[3] for r in rows if not r[2]]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("limits", [ScanLimits(), SMALL])
def test_auc(spark, scores, limits):
    rows, df = scores
    assert evaluate.auc(df, limits=limits).first()["auc"] == pytest.approx(brute_auc(rows))
    folds = [brute_auc([r for r in rows if r[1] == f]) for f in range(3)]
    assert evaluate.auc_fold_mean(df, limits).first()["auc"] == pytest.approx(sum(folds) / 3)
    flipped = df.withColumn("score", -df.score)
    assert evaluate.auc(flipped).first()["auc"] == pytest.approx(1 - brute_auc(rows))


@pytest.mark.parametrize("limits", [ScanLimits(), SMALL])
def test_roc_curve(spark, scores, limits):
    rows, df = scores
    p, n = sum(r[2] for r in rows), sum(1 - r[2] for r in rows)
    points = [(math.inf, 0.0, 0.0)]
    levels = sorted({r[3] for r in rows}, reverse=True)
    steps = [(sum(r[2] for r in rows if r[3] == s), sum(1 - r[2] for r in rows if r[3] == s)) for s in levels]
    for i, s in enumerate(levels):
        if i in (0, len(levels) - 1) or steps[i] != steps[i + 1]:
            tp = sum(a for a, _ in steps[: i + 1])
            fp = sum(b for _, b in steps[: i + 1])
            points.append((s, fp / n, tp / p))
    got = [tuple(r) for r in evaluate.roc_curve(df, limits).orderBy("fpr", "tpr", "threshold").collect()]
    assert len(got) == len(points)
    for a, b in zip(sorted(got), sorted(points)):
        assert a == pytest.approx(b)


@pytest.mark.parametrize("limits", [ScanLimits(), SMALL])
def test_folds_are_balanced(spark, scores, limits):
    _, df = scores
    folded = evaluate.stratified_folds(df.drop("fold"), 10, limits=limits).toPandas()
    sizes = folded.groupby(["label", "fold"]).size().unstack()
    assert ((sizes.max(axis=1) - sizes.min(axis=1)) <= 1).all() and len(folded) == 400


def test_blend_needs_every_member(spark):
    a = spark.createDataFrame([(1, 0.2), (2, 0.4)], "customer_id long, probability double")
    b = spark.createDataFrame([(1, 0.4), (3, 0.9)], "customer_id long, probability double")
    assert [tuple(r) for r in evaluate.blend([a, b]).collect()] == [(1, pytest.approx(0.3))]


@pytest.mark.parametrize("limits", [ScanLimits(), SMALL])
def test_exact_quantiles(spark, limits):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(0, 10, 333), 1)
    df = spark.createDataFrame([(float(v), 5.0) for v in x] + [(None, 5.0)], "x double, c double")
    got = {r["column"]: r for r in exact_quantiles(df, ["x", "c"], {"a": 0.25, "b": 0.9}, limits).collect()}
    assert got["x"]["a"] == pytest.approx(np.quantile(x, 0.25))
    assert got["x"]["b"] == pytest.approx(np.quantile(x, 0.9))
    assert got["c"]["a"] == 5.0
    knots = quantile_knots(df, ["x"], 50, limits).orderBy("knot").collect()
    assert [k.value for k in knots] == pytest.approx(list(np.quantile(x, np.linspace(0, 1, 50))))


def test_quantile_scale_is_mid_rank_on_small_tables(spark):
    x = [3.0, 1.0, 2.0, 2.0, 9.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "customer_id int, f double")
    got = prep.scale(df, df, ["f"], "quantile")[0].orderBy("customer_id").toPandas().f.tolist()
    assert got == pytest.approx([0.75, 0.0, 0.375, 0.375, 1.0])


def test_constant_columns(spark):
    df = spark.createDataFrame([(1, 4.0), (2, 4.0)], "customer_id int, f double")
    for method, value in (("min_max", -1.0), ("standard", 0.0), ("robust", 0.0), ("quantile", 0.0)):
        assert prep.scale(df, df, ["f"], method)[0].toPandas().f.tolist() == [value, value]


def test_impute_uses_the_train_table(spark):
    train = spark.createDataFrame([(1.0,), (2.0,), (9.0,), (None,)], "f double")
    test = spark.createDataFrame([(None,), (7.0,)], "f double")
    for strategy, value in (("zero", 0.0), ("mean", 4.0), ("median", 2.0)):
        a, b = prep.impute(train, test, ["f"], strategy)
        assert sorted(r.f for r in a.collect()) == sorted([1.0, 2.0, 9.0, value])
        assert sorted(r.f for r in b.collect()) == sorted([value, 7.0])


def test_histogram_matches_numpy(spark):
    x = np.random.default_rng(5).gamma(2, 3, 500)
    df = spark.createDataFrame([(float(v),) for v in x], "price double")
    got = profile.histogram(df, "price", 20).orderBy("bin").toPandas()
    counts, edges = np.histogram(x, 20)
    assert got["count"].tolist() == counts.tolist()
    assert np.allclose(got["left"], edges[:-1])
    assert np.allclose(got["density"], np.histogram(x, 20, density=True)[0])


def test_null_counts_as_a_distinct_value(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, None)], "customer_id int, product_id string")
    got = {r["column"]: r["distinct_values"] for r in profile.distinct_keys(df).collect()}
    assert got == {"customer_id": 2, "product_id": 2}


@pytest.mark.parametrize("limits", [ScanLimits(), SMALL])
def test_bracketed_quantiles_are_exact(spark, monkeypatch, limits):
    from spendcast.operators import quantiles

    monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", 100)
    rng = np.random.default_rng(4)
    x = np.where(rng.random(5000) < 0.3, 7.0, rng.normal(0, 50, 5000))
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    levels = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.99, "e": 1.0}
    got = exact_quantiles(df, ["x"], levels, limits).first()
    for name, p in levels.items():
        assert got[name] == pytest.approx(np.quantile(x, p))


def test_a_missed_bracket_falls_back_to_ranks(spark, monkeypatch):
    from spendcast.operators import quantiles

    monkeypatch.setattr(quantiles, "_brackets", lambda df, columns, p: {"x": (101, [(90.0, 95.0)])})
    df = spark.range(101).selectExpr("double(id) AS x")
    assert exact_quantiles(df, ["x"], {"m": 0.5}).first()["m"] == 50.0


def test_only_keys_are_put_in_order_for_folds(spark, monkeypatch):
    """Wide rows never meet in one task per label; repeated and null keys keep all rows."""
    ranked = []
    scan = evaluate.scan
    monkeypatch.setattr(evaluate, "scan", lambda rows, *a, **k: ranked.append(rows.columns) or scan(rows, *a, **k))
    rows = [(None if i % 10 == 0 else i // 2, None if i % 7 == 0 else i % 2, float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "customer_id long, label int, wide double")
    folded = evaluate.stratified_folds(df, 4).toPandas()
    assert "wide" not in ranked[0]
    assert sorted(folded.wide) == [r[2] for r in rows]
    sizes = folded.groupby(["label", "fold"], dropna=False).size().unstack(fill_value=0)
    assert ((sizes.max(axis=1) - sizes.min(axis=1)) <= 1).all()
