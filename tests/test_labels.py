import pytest

from spendcast.functions.bands import spend_band
from spendcast.functions.months import seasons, shift_month, trailing_windows
from spendcast.operators import labels
from tests.frames import make_log, row


def test_month_arithmetic():
    assert shift_month("2001-01", -1) == "2000-12"
    assert shift_month("2001-12", 1) == "2002-01"
    assert [w.first for w in trailing_windows("2001-08")][:3] == ["2001-07", "2001-06", "2001-05"]
    assert [(s.first, s.until) for s in seasons("2001-08")] == [("2001-05", "2001-08"), ("2000-06", "2000-09")]


def test_labels(spark):
    log = make_log(
        spark,
        [
            row(1, 1, "2001-01-01"),
            row(1, 2, "2001-05-02", total=300.0),
            row(2, 3, "2001-01-01"),
            row(2, 4, "2001-05-02", total=200.0),
            row(2, 5, "2001-05-03", total=100.01),
            row(3, 6, "2001-05-03", total=999.0),
            row(4, 7, "2001-02-03"),
        ],
    )
    got = {r.customer_id: (r.total, r.label) for r in labels.label_month(log, "2001-05").collect()}
    assert got == {1: (300.0, 0), 2: (pytest.approx(300.01), 1), 4: (0.0, 0)}
    nobody = labels.label_month(log, "2001-09").collect()
    assert len(nobody) == 4 and not any(r.label for r in nobody)


def test_recency_counts_months_only(spark):
    log = make_log(spark, [row(1, 1, "2001-03-01"), row(2, 2, "2000-02-01"), row(3, 3, "2001-04-01")])
    got = {(r.customer_id, r.split): r.last_month_shopping for r in labels.recency_score(log, "2001-05").collect()}
    assert got == {(1, "train"): 23, (1, "test"): 23, (2, "train"): 22, (2, "test"): 22, (3, "test"): 24}


def test_bands(spark):
    rows = spark.createDataFrame([(v,) for v in (-1.0, 19.99, 20.0, 999.0, 1000.0)], "a double")
    got = [r[0] for r in rows.select(spend_band(rows.a)).collect()]
    assert got == ["minus", "very low", "low", "super high", "epic high"]
