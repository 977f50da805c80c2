import pandas as pd
import pytest
from pyspark.sql import functions as F

from spendcast.operators.scan import HOT_ROWS, ScanLimits, hot_keys, scan


def expected(pdf):
    pdf = pdf.sort_values(["k", "i"], na_position="first").copy()
    groups = pdf.groupby("k", dropna=False)
    pdf["pos"] = groups.cumcount() + 1
    pdf["run"] = groups.x.cumsum()
    pdf["prev"] = groups.x.shift(1)
    pdf["tot"] = groups.x.transform("size")
    return pdf


@pytest.mark.parametrize("limits", [ScanLimits(), ScanLimits(40)])
@pytest.mark.parametrize("by", [["k"], []])
def test_scan_does_not_depend_on_limits(spark, limits, by):
    rows = [
        (None if i % 9 == 0 else (1 if i % 3 else i % 7), i, None if i % 11 == 4 else i * 0.5)
        for i in range(700)
    ]
    df = spark.createDataFrame(rows, "k int, i int, x double").repartition(5)
    got = scan(
        df, by, ["i"], position="pos", sums={"run": "x"}, lags={"prev": "x"},
        totals={"tot": F.lit(1)}, limits=limits,
    ).toPandas()
    pdf = pd.DataFrame(rows, columns=["k", "i", "x"])
    if not by:
        pdf["k"] = 0
    want = expected(pdf).sort_values("i")
    got = got.sort_values("i")
    for c in ("pos", "run", "prev", "tot"):
        assert got[c].astype(float).reset_index(drop=True).equals(
            want[c].astype(float).reset_index(drop=True)
        ), c


def test_hot_keys_come_with_their_rows(spark):
    df = spark.range(1000).selectExpr("if(id % 2 = 0, 0, id) AS k")
    assert [(r.k, r[HOT_ROWS]) for r in hot_keys(df, ["k"], ScanLimits(100)).collect()] == [(0, 500)]


def test_keys_are_counted_by_bucket_first(spark, monkeypatch):
    """Without a large key no table of all keys is shuffled."""
    from spendcast.operators import scan as module

    counted = []
    cut = module.cut_lineage
    monkeypatch.setattr(module, "cut_lineage", lambda df: counted.append(df.columns) or cut(df))
    assert hot_keys(spark.range(1000), ["id"], ScanLimits(100)).count() == 0
    assert counted == [["name", "bucket", "n"]]
