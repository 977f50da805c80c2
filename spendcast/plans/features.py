"""The point-in-time feature table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from types import MappingProxyType

from pyspark.sql import DataFrame, functions as F

from spendcast.functions.bands import spend_band
from spendcast.functions.months import cutoffs, month_number, shift_month
from spendcast.operators import blocks as B
from spendcast.operators.labels import THRESHOLD, customer_months, customer_summary
from spendcast.operators.scan import DEFAULT_LIMITS, ScanLimits
from spendcast.sources.scratch import slices_of, stored

BLOCKS = ("windows", "seasons", "running", "differences", "habits")
# Built on demand: the band of the spend per active month (a string), and the recency score.
OPTIONAL = ("bands", "recency")


def block_frames(month: str, blocks: Sequence[str]) -> list[B.Frame]:
    whole = (B.RUNNING_VALUES if "running" in blocks else ()) + (
        B.DIFF_VALUES if "differences" in blocks else ()
    )
    return [
        *(B.window_frames(month) if "windows" in blocks else ()),
        *(B.season_frames(month) if "seasons" in blocks else ()),
        *(B.history_frames(month, whole) if whole else ()),
    ]


# Habit feature names.
HABITS = (
    "total_over_300", "count_using_shopping",
    "total_sum_per_count_using_shopping", "total_over_300_ratio",
)


def feature_table(
    log: DataFrame,
    month: str,
    threshold: float = THRESHOLD,
    *,
    habit_threshold: float | None = None,
    blocks: Sequence[str] = BLOCKS,
    keep: str = "right",
    limits: ScanLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Labels and features of both splits, one row per (customer, split).

    Each split sees only months before its cutoff: the month before ``month``
    for train, ``month`` for test. Values a customer lacks are 0.

    ``habit_threshold`` is the limit of the "months over" habits; by default it
    follows ``threshold``.
    """
    if habit_threshold is None:
        habit_threshold = threshold
    log = B.prepared(log, until=shift_month(month, 1))
    slices = slices_of(log)
    base = customer_summary(customer_months(log), month, threshold, habit_threshold)
    if slices > 1:
        base = stored(base, "summary", "customer_id", slices)
    chosen = {"label": "label"} | ({n: n for n in HABITS} if "habits" in blocks else {})
    if "running" in blocks:
        chosen |= B.DISTINCT_COLUMNS
    if "differences" in blocks:
        chosen |= B.SPAN_COLUMNS

    frames = block_frames(month, blocks)
    ranges, series = B.month_frames(frames), B.whole_frames(frames)
    if series:
        # Every labelled customer has a history, so the rows of the series are the
        # right ones already and join on the key they are partitioned by.
        wide, columns = B.packed_features(log, month, series, limits=limits)
        joined = wide.join(base, "customer_id")
        if "running" in blocks:
            joined = joined.withColumns({f"{s}_{c}": F.col(f"`{out}`") for s in B.SPLITS for out, c in B.DISTINCT_COLUMNS.items()})
    else:
        columns = {}
        joined = base.selectExpr("*", f"explode(array({', '.join(map(repr, B.SPLITS))})) AS split").filter(
            "if(split = 'train', train_label, test_label) IS NOT NULL"
        )
    if ranges:
        joined, found = joined.join(range_map(log, month, ranges, limits), "customer_id", "left"), B.feature_columns(ranges, RANGE_ENTRY)
        # In the order of the blocks: ranges before whole histories.
        columns = (B.keep_seasons(found, keep) if "seasons" in blocks else found) | columns
    more = {}
    if "bands" in blocks:
        joined = joined.withColumns({f"{s}_band": spend_band(F.col(f"{s}_total_sum_per_count_using_shopping")) for s in B.SPLITS})
        more["total_sum_per_count_using_shopping_cat"] = "if(split = 'train', train_band, test_band)"
    if "recency" in blocks:
        more["last_month_shopping"] = recency_of("if(split = 'train', train_last, test_last)", month)
    found = labelled(joined, month, chosen, columns, more)
    return found if slices == 1 else stored(found, "features", "customer_id", slices)


def recency_of(seconds: str, month: str) -> str:
    """SQL of the recency score (see ``labels.recency_score``) from the time of the last order."""
    day = f"date_add(date'1970-01-01', int(floor({seconds} / 86400)))"
    return f"24 - ({month_number(shift_month(month, -1))} - (year({day}) * 12 + month({day}) - 1)) % 12"


KINDS = 1000  # more than any kind of a series
RANGE_ENTRY = f"ranges[{{}} + if(split = 'train', 0, {KINDS})]"


def range_map(log: DataFrame, month: str, frames: Sequence[B.Frame], limits: ScanLimits = DEFAULT_LIMITS) -> DataFrame:
    """``customer_id, ranges``: statistics of month ranges of both splits in one map,
    so that they join on the customer alone."""
    return packed_ranges(B.monthly_stats(log, month, frames, limits))


def packed_ranges(stats: DataFrame) -> DataFrame:
    kind = f"kind + split * {KINDS}"
    return stats.selectExpr("customer_id", f"{kind} AS kind", *B.STATS).groupBy("customer_id").agg(F.expr(f"{B.STATS_MAP} AS ranges"))


def labelled(
    joined: DataFrame, month: str, chosen: dict[str, str], columns: dict[str, str], more: Mapping[str, str] = MappingProxyType({})
) -> DataFrame:
    """Keys, label and features of rows ``(customer_id, split, ...)``; what a customer lacks is 0.
    ``chosen`` names the ``train_``/``test_`` columns, ``columns`` has the SQL of the rest,
    ``more`` that of features every customer has."""
    cut = cutoffs(month)
    return joined.selectExpr(
        "customer_id",
        "split",
        f"if(split = 'train', '{cut['train']}', '{cut['test']}') AS year_month",
        *(
            f"if(split = 'train', coalesce(train_{n}, 0), coalesce(test_{n}, 0)) AS `{out}`"
            for out, n in chosen.items()
        ),
        *(f"coalesce({e}, 0D) AS `{name}`" for name, e in columns.items()),
        *(f"{e} AS `{name}`" for name, e in more.items()),
    )
