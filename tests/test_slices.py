"""Tables written slice by slice: the same rows, and nothing left behind."""

import os
import time

import pytest
from pyspark.sql import functions as F

from spendcast.functions.months import shift_month
from spendcast.operators import blocks
from spendcast.operators.scan import ScanLimits
from spendcast.plans.features import feature_table
from spendcast.plans.store import FeatureStore
from spendcast.sources import bucketed, scratch
from spendcast.sources.log import row_order
from tests.frames import make_log, skewed_rows
from tests.test_features import MONTH, same, to_frame


def shuffles(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n.split("_")[1] for n in names if n.startswith("shuffle_")}


def in_many(monkeypatch, n=3):
    monkeypatch.setattr("spendcast.plans.features.slices_of", lambda df: n)
    monkeypatch.setattr("spendcast.plans.store.slices_of", lambda df: n)
    monkeypatch.setattr("spendcast.operators.blocks.slices_of", lambda df: n)
    monkeypatch.setattr(scratch, "slices_of", lambda df: n)


def test_slices_hold_every_row_once(spark):
    rows = [(None if i % 7 == 0 else i % 5, i) for i in range(100)]
    df = spark.createDataFrame(rows, "key long, x int")
    for slices in (1, 4):
        found = scratch.stored(df.repartition(3), "rows", "key", slices)
        assert sorted(found.collect(), key=repr) == sorted(df.collect(), key=repr)
    assert scratch.slices_of(df) == 1


def test_slices_follow_the_size_of_the_files(spark, monkeypatch):
    path = scratch.scratch_folder(spark, "sized")
    spark.range(20_000).selectExpr("id", "rand() AS x").write.parquet(path)
    read = spark.read.parquet(path)
    size = sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.endswith(".parquet"))
    monkeypatch.setattr(scratch, "SLICE_BYTES", size // 4)
    assert scratch.slices_of(read) in (4, 5)
    assert scratch.slices_of(read.groupBy("id").count()) in (4, 5)


@pytest.mark.parametrize("limits", [ScanLimits(), ScanLimits(120)])
def test_feature_table_in_slices(spark, monkeypatch, limits):
    """The same table, ready to be read without any exchange."""
    log = make_log(spark, skewed_rows(500))
    full = to_frame(feature_table(log, MONTH, 300.0, limits=limits))
    in_many(monkeypatch)
    table = feature_table(log, MONTH, 300.0, limits=limits)
    assert "Exchange" not in table._jdf.queryExecution().executedPlan().toString()
    same(full, to_frame(table)[full.columns])


def test_store_in_slices(spark, monkeypatch):
    log = make_log(spark, skewed_rows(500))
    full = to_frame(feature_table(log, MONTH, 300.0))
    in_many(monkeypatch)
    store = FeatureStore(spark, scratch.scratch_folder(spark, "store"))
    before = shift_month(MONTH, -1)
    store.begin(log, before)
    for month in (before, MONTH):
        store.advance(log, month)
    table = store.feature_table(MONTH, 300.0)
    assert "Exchange" not in table._jdf.queryExecution().executedPlan().toString()
    same(full, to_frame(table)[full.columns])


def test_sums_of_orders_are_deleted_once_read(spark, monkeypatch):
    log = blocks.prepared(make_log(spark, skewed_rows(300)))
    facts = blocks.LogFacts.of(log, blocks.RUNNING_KEYS.values())
    dropped = []
    monkeypatch.setattr(blocks, "drop_folder", lambda s, path: dropped.append(path) or scratch.drop_folder(s, path))
    rows, _, folder = blocks.by_order_and_product(log, row_order(log), ScanLimits(), facts, 3)
    assert [os.path.exists(p) for p in dropped] == [False] and os.path.exists(folder)
    assert rows.count() == log.count()


def test_slices_let_go_of_their_shuffles(spark):
    """At most the last write's files stay, and those until the next one."""
    df = spark.range(1000).withColumn("customer_id", F.col("id") % 97)
    for write in (
        lambda: scratch.stored(df.groupBy("customer_id").count(), "sums", "customer_id", 6),
        lambda: scratch.in_slices(df, "customer_id", 6, lambda part, _: part.repartition(3, "id"), "rows"),
        lambda: [bucketed.write_bucketed(df, bucketed.table_name("rows"), scratch.scratch_folder(spark, "rows"), buckets=4) for _ in range(4)],
    ):
        before = shuffles(spark)
        write()
        for _ in range(40):  # files are removed on the side
            if len(shuffles(spark) - before) <= 1:
                break
            time.sleep(0.25)
        assert len(shuffles(spark) - before) <= 1
