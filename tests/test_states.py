"""Month states and the feature store against single rows and a full build."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendcast.functions import ewm
from spendcast.functions.months import shift_month
from spendcast.operators import blocks, states
from spendcast.operators.scan import ScanLimits
from spendcast.plans.features import feature_table
from spendcast.plans.store import FeatureStore
from spendcast.sources.log import month_range, read_log_parquet, row_order, write_log
from spendcast.sources.scratch import scratch_folder
from tests.frames import make_log, row, skewed_rows
from tests.test_features import MONTH, same, to_frame


def test_offset_weights_hold_at_every_offset(spark):
    """A block's sums give its share of the head sum wherever it starts."""
    rng = np.random.default_rng(2)
    x = rng.uniform(-5, 50, 600)
    rows = spark.createDataFrame([(1, i + 1, float(v)) for i, v in enumerate(x)], "customer_id long, k int, x double")
    state = states.block_states(rows, ["customer_id"], "k", f"({len(x)} - k)")
    offsets = [0, 1, 2, 7, 60, 399, 400, 401, 5000]
    share = ewm.offset_head("total", "head", "folds", "o")
    got = {r.o: r.share for r in state.selectExpr("*", f"explode(array({', '.join(map(str, offsets))})) AS o").selectExpr("o", f"{share} AS share").collect()}
    weight = np.ones(8000)
    following = 1.0
    for j in range(7999, 0, -1):
        following = (1 - ewm.DECAY) / (1 - ewm.DECAY**j) + ewm.DECAY * following
        weight[j] = following
    for o in offsets:
        assert got[o] == pytest.approx(float(x @ weight[o + 1 : o + 601]), rel=1e-12)


def test_month_states_hold_one_row_per_customer_month_and_measure(spark):
    log = make_log(spark, skewed_rows(400))
    found = states.measure_states(states.month_states(log, row_order(log))).toPandas()
    pdf = log.toPandas()
    assert len(found) == 3 * len(pdf[["customer_id", "year_month"]].drop_duplicates())
    groups = pdf.sort_values(["order_date", "order_id", "line_number"]).groupby(["customer_id", "year_month"])["total"]
    for _, s in found[found.measure == "total"].iterrows():
        x = groups.get_group((s.customer_id, s.year_month)).to_numpy()
        d = x - x.mean()
        assert (s["rows"], s["first"], s["last"], s.low, s.high) == (len(x), x[0], x[-1], x.min(), x.max())
        skew = 0 if x.min() == x.max() else (d**3).mean() / (d**2).mean() ** 1.5
        decayed = (x * (1 - 1 / 10.5) ** np.arange(len(x))[::-1]).sum()
        assert np.allclose([s.total, s["mean"], s.variance, s.skewness, s.decayed], [x.sum(), x.mean(), (d**2).mean(), skew, decayed], rtol=1e-9, atol=1e-7)


def test_ranges_of_states_match_ranges_of_rows(spark):
    """The same statistics by merged states and by one element per row and range."""
    log = blocks.prepared(make_log(spark, skewed_rows(900)))
    frames = blocks.window_frames(MONTH) + blocks.season_frames(MONTH)
    keys = ["customer_id", "split", "kind"]
    for limits in (ScanLimits(), ScanLimits(120)):
        merged, single = (f(log, MONTH, frames, limits).toPandas().sort_values(keys).reset_index(drop=True) for f in (blocks.monthly_stats, blocks.row_stats))
        assert len(merged) == len(single) > 500
        for c in single.columns:
            assert np.allclose(merged[c].astype(float).fillna(-7e7), single[c].astype(float).fillna(-7e7), rtol=1e-8, atol=1e-6), c


def test_rows_add_the_same_elements_however_many_windows(spark):
    log = blocks.prepared(make_log(spark, skewed_rows(200)))

    def elements(frames):
        plan = blocks.monthly_stats(log, MONTH, frames)._jdf.queryExecution().optimizedPlan().toString()
        return [line.split("posexplode(array(")[1].split(")")[0].count("cast") for line in plan.splitlines() if "Generate posexplode" in line]

    assert elements(blocks.window_frames(MONTH)[:1]) == elements(blocks.window_frames(MONTH) + blocks.season_frames(MONTH))


@pytest.mark.parametrize("limits", [ScanLimits(), ScanLimits(90)])
def test_store_matches_a_full_build(spark, limits):
    log = make_log(spark, skewed_rows(700))
    store = FeatureStore(spark, scratch_folder(spark, "store"), limits)
    store.begin(log, shift_month(MONTH, -2))
    for back in (-2, -1, 0):
        store.advance(log, shift_month(MONTH, back))
    for month in (shift_month(MONTH, -1), MONTH):
        full = to_frame(feature_table(log, month, 300.0))
        kept = to_frame(store.feature_table(month, 300.0))
        assert full.shape[1] == 4 + 438
        same(full, kept[full.columns])


def test_next_month_reads_one_month_of_the_log(spark):
    """The store goes on from the folders of single months, and its own rows are all it asks for."""
    log = make_log(spark, skewed_rows(300))
    path = scratch_folder(spark, "log-by-month")
    write_log(log, path)
    before, month = (shift_month(MONTH, -1), MONTH)
    store = FeatureStore(spark, scratch_folder(spark, "store"))
    store.begin(read_log_parquet(spark, path), before)
    asked = month_range(read_log_parquet(spark, path), before, month)
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert f"(year_month#" in plan and f">= {before}" in plan.split("PartitionFilters")[1].split("]")[0]
    for m in (before, month):
        store.advance(read_log_parquet(spark, f"{path}/year_month={m}"), m)
    full = to_frame(feature_table(log, month, 300.0))
    same(full, to_frame(store.feature_table(month, 300.0))[full.columns])


def test_store_with_quiet_months_and_new_customers(spark):
    rows = [row(1, 1, "2001-01-03", total=5.0), row(1, 2, "2001-04-03", total=7.0, line=2), row(2, 3, "2001-04-09", total=400.0)]
    log = make_log(spark, rows)
    store = FeatureStore(spark, scratch_folder(spark, "store"))
    store.begin(log, "2001-02")
    for month in ("2001-02", "2001-03", "2001-04", "2001-05"):
        store.advance(log, month)
    full = to_frame(feature_table(log, "2001-05", 300.0))
    same(full, to_frame(store.feature_table("2001-05", 300.0))[full.columns])


def test_store_refuses_null_measures(spark):
    log = make_log(spark, [row(1, 1, "2001-01-03")]).withColumn("total", F.lit(None).cast("double"))
    with pytest.raises(ValueError):
        FeatureStore(spark, scratch_folder(spark, "store")).begin(log, "2001-02")
