import numpy as np
import pandas as pd
import pytest

from spendcast.operators.scan import ScanLimits
from spendcast.operators.series import STATS, series_stats


def reference(x: pd.Series) -> pd.Series:
    e = x.ewm(com=9.5).mean()
    return pd.Series(
        dict(
            max=x.max(), min=x.min(), sum=x.sum(), mean=x.mean(), count=float(x.count()),
            std=x.std(), skew=x.skew(), mean_ewm=e.mean(), last_ewm=e.iloc[-1],
            avg_diff=(x - x.shift(1)).mean(),
        )
    )


def check(spark, series, limits=ScanLimits()):
    rows = [
        (k, i, None if np.isnan(v) else float(v))
        for k, s in series.items()
        for i, v in enumerate(s)
    ]
    df = spark.createDataFrame(rows, "k long, i long, x double").repartition(4)
    got = series_stats(df, ["k"], ["i"], ["x"], limits=limits).toPandas()
    got = got.set_index("k").sort_index()[list(STATS)].astype(float)
    want = pd.DataFrame({k: reference(s) for k, s in series.items()}).T.sort_index()
    assert (got.isna() == want[list(STATS)].isna()).all().all()
    assert np.allclose(got.fillna(0), want[list(STATS)].fillna(0), rtol=1e-9, atol=1e-7)


@pytest.mark.parametrize("limits", [ScanLimits(), ScanLimits(150)])
@pytest.mark.parametrize("nulls", [False, True])
def test_random_series_match_pandas(spark, nulls, limits):
    rng = np.random.default_rng(0)
    series = {}
    for k in range(14):
        n = int(rng.integers(1, 900)) if k < 10 else k - 9
        s = pd.Series(rng.normal(3e3, 1e4, n))
        if nulls and k % 2 == 0:
            s[rng.random(n) < 0.3] = np.nan
        series[k] = s
    check(spark, series, limits)


def test_known_series(spark):
    check(
        spark,
        {
            1: pd.Series([5.0]),
            2: pd.Series([5.0, 7.0]),
            3: pd.Series([4.0, 4.0, 4.0]),
            4: pd.Series([1.0, 2.0, 9.0]),
            5: pd.Series([np.nan, 1.0, np.nan, 4.0]),
            6: pd.Series([np.nan, np.nan]),
        },
    )
    assert reference(pd.Series([1.0, 2.0, 9.0]))["skew"] == pytest.approx(1.6300591617118865)
    assert reference(pd.Series([np.nan, 1.0, np.nan, 4.0]))["last_ewm"] == pytest.approx(2.649625935162095)


def test_null_run_longer_than_a_fold_block(spark):
    s = pd.Series(np.arange(9500, dtype=float))
    s[50:9300] = np.nan
    check(spark, {1: s})


@pytest.mark.parametrize("values, nulls", [(4096, 4204), (4100, 9000), (8200, 3)])
def test_null_run_after_values_on_both_sides_of_a_block_border(spark, values, nulls):
    rng = np.random.default_rng(values)
    check(spark, {1: pd.Series(np.concatenate([rng.normal(100, 50, values), np.full(nulls, np.nan), [7.0]][: 2 + (nulls < 10)]))})
