import numpy as np
import pandas as pd
import pytest

from spendcast.functions.months import shift_month
from spendcast.operators import blocks
from spendcast.operators.scan import ScanLimits
from spendcast.plans.features import feature_table
from spendcast.sources.log import star_log
from tests.conftest import SF
from tests.frames import make_log, row, skewed_rows
from tests.test_series import reference

MONTH = "2001-05"


def to_frame(df):
    return df.toPandas().sort_values(["customer_id", "split"]).reset_index(drop=True)


def same(a, b):
    assert list(a.columns) == list(b.columns) and len(a) == len(b)
    for c in a.columns:
        if a[c].dtype.kind == "f":
            assert np.allclose(a[c].fillna(-1e9), b[c].fillna(-1e9), rtol=1e-8, atol=1e-6), c
        else:
            assert a[c].equals(b[c]), c


@pytest.mark.parametrize("nulls", [False, True])
def test_hot_keys_give_the_same_table(spark, nulls):
    log = make_log(spark, skewed_rows(nulls=nulls))
    plain = to_frame(feature_table(log, MONTH, 300.0))
    split = to_frame(feature_table(log, MONTH, 300.0, limits=ScanLimits(120)))
    assert plain.shape[1] == 4 + 438
    same(plain, split)


@pytest.mark.parametrize("nulls", [False, True])
def test_blocks_match_pandas(spark, nulls):
    rows = skewed_rows(500, nulls=nulls)
    log = make_log(spark, rows)
    table = to_frame(feature_table(log, MONTH, 300.0)).set_index(["customer_id", "split"])
    pdf = pd.DataFrame(
        rows, columns="customer_id order_id product_id order_date quantity price total line_number".split()
    )
    pdf["ym"] = pdf.order_date.dt.strftime("%Y-%m")
    pdf = pdf.sort_values(["order_date", "order_id", "line_number"])
    for split, cut in (("train", shift_month(MONTH, -1)), ("test", MONTH)):
        past = pdf[pdf.ym < cut].copy()
        for name, key in (("cust_id", "customer_id"), ("prod_id", "product_id"), ("order_id", "order_id")):
            past[f"cumsum_total_by_{name}"] = past.groupby(key)["total"].cumsum()
        past["total_diff"] = past.groupby("customer_id")["total"].diff()
        past["order_ts"] = past.order_date.astype("datetime64[s]").astype("int64").astype(float)
        past["order_ts_diff"] = past.groupby("customer_id")["order_ts"].diff()
        ranges = {f"total:-{i}": (shift_month(cut, -k), "9") for i, k in enumerate((1, 2, 3, 5, 7, 12, 20, 23))}
        ranges |= {f"total:-season{i}": (shift_month(cut, -k - 2), shift_month(cut, -k)) for i, k in enumerate((1, 12))}
        ranges |= {
            f"{c}:": ("", "9")
            for c in ("cumsum_total_by_cust_id", "cumsum_total_by_prod_id", "cumsum_total_by_order_id", "total_diff", "order_ts_diff")
        }
        for name, (lo, hi) in ranges.items():
            value, suffix = name.split(":")
            inside = past[(past.ym >= lo) & (past.ym <= hi)]
            want = {k: reference(g[value]) for k, g in inside.groupby("customer_id")}
            if suffix == "-season0":
                lo1, hi1 = ranges["total:-season1"]
                kept = set(past[(past.ym >= lo1) & (past.ym <= hi1)].customer_id)
                want = {k: v for k, v in want.items() if k in kept}
            for customer in past.customer_id.unique():
                for stat in ("mean_ewm", "last_ewm", "avg_diff", "std", "skew", "sum", "count", "max"):
                    got = table.loc[(customer, split), f"{value}-{stat}{suffix}"]
                    expected = want[customer][stat] if customer in want else 0.0
                    expected = 0.0 if np.isnan(expected) else expected
                    assert np.isclose(got, expected, rtol=1e-8, atol=1e-6), (customer, split, name, stat)
        uniques = past.groupby("customer_id")[["order_id", "product_id"]].nunique()
        for customer, u in uniques.iterrows():
            assert table.loc[(customer, split), "order_id-nunique"] == u.order_id
            assert table.loc[(customer, split), "product_id-nunique"] == u.product_id


def test_season_only_in_recent_months(spark):
    log = make_log(spark, [row(1, 1, "2001-04-03"), row(2, 2, "2001-04-03"), row(2, 3, "2000-04-01")])
    right = to_frame(blocks.season_stats(log, MONTH)).query("split == 'test'")
    assert list(right.customer_id) == [2]
    outer = to_frame(blocks.season_stats(log, MONTH, keep="outer")).query("split == 'test'")
    assert list(outer.customer_id) == [1, 2]
    assert outer["total-sum-season0"].tolist() == [1.0, 1.0]
    table = to_frame(feature_table(log, MONTH, 1.0)).query("split == 'test'").set_index("customer_id")
    assert table["total-sum-season0"].to_dict() == {1: 0.0, 2: 1.0}


def test_small_histories(spark):
    log = make_log(
        spark,
        [
            row(1, 1, "2001-04-03", total=5.0),  # one row
            row(2, 2, "1998-01-03", total=7.0),  # older than every window
            row(3, 3, "2001-05-03", total=9.0),  # first seen in the target month
            row(4, 4, "2001-04-03", total=300.0, line=1),
            row(4, 5, "2001-05-03", total=300.0),  # equal to the threshold
            row(5, 9, "2001-04-03", total=1.0),
            row(5, 8, "2001-04-03", total=4.0),  # same date: order id decides
        ],
    )
    test = to_frame(feature_table(log, MONTH, 300.0)).query("split == 'test'").set_index("customer_id")
    assert sorted(test.index) == [1, 2, 4, 5]
    assert test.label.tolist() == [0, 0, 0, 0]
    assert test.loc[1, ["total-std-0", "total-skew-0", "total-avg_diff-0", "total_diff-sum"]].tolist() == [0, 0, 0, 0]
    assert test.loc[2, "total-count-7"] == 0 and test.loc[2, "cumsum_total_by_cust_id-max"] == 7
    assert test.loc[5, "total_diff-sum"] == -3.0


def test_features_ignore_the_future(spark):
    log = star_log(spark, SF)
    blocks_ = ("seasons", "habits")
    full = to_frame(feature_table(log, "2000-06", 1e5, blocks=blocks_))
    past = to_frame(feature_table(log.filter("year_month < '2000-06'"), "2000-06", 1e5, blocks=blocks_))
    features = [c for c in full.columns if c not in ("label", "year_month")]
    same(full[features], past[features])


def test_windows_are_nested(spark):
    wide = to_frame(blocks.window_stats(star_log(spark, SF), "2000-06"))
    for i in range(7):
        narrow, wider = wide[f"total-count-{i}"].fillna(0), wide[f"total-count-{i + 1}"].fillna(0)
        assert (narrow <= wider).all()
        both = wide[wide[f"total-max-{i}"].notna()]
        assert (both[f"total-max-{i}"] <= both[f"total-max-{i + 1}"]).all()


def test_no_shuffle_between_customer_scan_and_statistics(spark):
    log = star_log(spark, SF)
    frames = blocks.window_frames("2000-06")
    plan = blocks.frame_features(log, "2000-06", frames)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(customer_id") == 1


def test_whole_histories_are_not_exploded(spark):
    """Sums by order and product leave the columns that break ties behind, and no row is
    exploded into its series; customers with odd values are summed by Spark."""
    rows = [row(c, 10 * c + i // 2, f"2000-0{1 + i}-01", 1.0 + i, 2.0 * c, product=i, line=i) for c in (1, 2, 3) for i in range(6)]
    odd = [row(4, 50, "2000-03-01", 1.0, float("inf"), product=1), row(5, 60, "2000-03-02", 2.0, 3.0, product=None), row(5, 61, "2000-04-02", 2.0, 5.0)]
    plain = blocks.cumsum_features(make_log(spark, rows), MONTH)
    plan = plain._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "posexplode" not in plan
    log = make_log(spark, rows + odd)
    quick, slow = (to_frame(blocks.cumsum_features(log, MONTH, limits=limits)) for limits in (ScanLimits(), ScanLimits(1)))
    quick, slow = (df[df.customer_id != 4].reset_index(drop=True) for df in (quick, slow))
    assert len(quick) == 8
    same(quick[sorted(quick.columns)], slow[sorted(slow.columns)])
