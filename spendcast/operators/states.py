"""Month states: all that a customer's rows of one month add to any month range.

A state holds count, sum, central moments, extremes, first and last value and the
decayed sums of one measure over one month of one customer. States of consecutive
months merge, so a window is an aggregation over its months' states: a log row is
read once however many windows there are, and a customer has at most one state per
month and measure. The exponentially weighted means need the position of a row in its
window; a state keeps what it adds to them at every offset (see functions/ewm.py).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from spendcast.functions import ewm
from spendcast.operators.scan import DEFAULT_LIMITS, ScanLimits, scan
from spendcast.operators.series import STATS
from spendcast.sources.log import MEASURES

KEYS = ("customer_id", "year_month", "item")
# Columns of a state; ``item`` is the place of the value among those it is made of.
STATE = ("n", "total", "m2", "m3", "low", "high", "first", "last", "tail", "head", "folds")


def block_states(rows: DataFrame, keys: Sequence[str], position: str, after: str, offsets: bool = True) -> DataFrame:
    """States of blocks from long rows ``(keys, x)`` without nulls, with the SQL of the
    1-based position in the block and of the rows after it. Without ``offsets`` the
    states can only come first in a series."""
    k, r = position, after
    spread = "var_pop(x) * count(x)"
    sums = {
        "n": "count(x)",
        "total": "sum(x)",
        "m2": spread,
        "m3": f"coalesce(if(min(x) = max(x), 0D, skewness(x) * pow({spread}, 1.5D) / sqrt(count(x))), 0D)",
        "low": "min(x)",
        "high": "max(x)",
        "first": f"max(if({k} = 1, x, null))",
        "last": f"max(if({r} = 0, x, null))",
        "tail": f"sum(x * {ewm.tail_weight(r)})",
        "head": f"sum(x * {ewm.head_weight(k)})",
    }
    folds = f"array({', '.join(ewm.block_folds('x', k))})" if offsets else "cast(null AS array<double>)"
    return rows.groupBy(*keys).agg(*(F.expr(e).alias(c) for c, e in sums.items()), F.expr(folds).alias("folds"))


def month_states(
    log: DataFrame, order: Sequence[str], *, hot: DataFrame | None = None, limits: ScanLimits = DEFAULT_LIMITS
) -> DataFrame:
    """``customer_id, year_month, item`` and a state; items are places in MEASURES.

    A month of a customer is the largest thing one task holds; ``scan`` splits those
    beyond the limit. Measures must not be null."""
    rows = log.select("customer_id", "year_month", *dict.fromkeys([*order, *MEASURES]))
    placed = scan(
        rows, ["year_month", "customer_id"], order, position="__rn",
        totals={"__n": F.lit(1).cast("long")}, hot=hot, limits=limits,
    )
    values = ", ".join(f"double({m})" for m in MEASURES)
    long = placed.selectExpr("customer_id", "year_month", "__rn", "__n - __rn AS __after", f"posexplode(array({values})) AS (item, x)")
    return block_states(long, ["year_month", "customer_id", "item"], "__rn", "__after").select(*KEYS, *STATE)


def merged(states: DataFrame, keys: Sequence[str], offset: str, after: str) -> DataFrame:
    """One state of each key's consecutive states, as it is when it comes first.

    ``offset`` and ``after`` are the rows of the key before and after a state;
    ``reference``, a column of any value near the key's mean, keeps the central
    moments of large numbers exact."""
    apart = states.withColumn("d", F.col("total") / F.col("n") - F.col("reference"))
    head = ewm.offset_head("total", "head", "folds", offset)
    sums = {
        "n": "sum(n)",
        "total": "sum(total)",
        "low": "min(low)",
        "high": "max(high)",
        "first": f"max(if({offset} = 0, first, null))",
        "last": f"max(if({after} = 0, last, null))",
        "tail": f"sum(tail * {ewm.tail_weight(after)})",
        "head": f"sum({head})",
        "__m2": "sum(m2)",
        "__m3": "sum(m3)",
        "__m2d": "sum(m2 * d)",
        "__d": "sum(n * d)",
        "__d2": "sum(n * d * d)",
        "__d3": "sum(n * d * d * d)",
    }
    added = apart.groupBy(*keys).agg(*(F.expr(e).alias(c) for c, e in sums.items()))
    mean = "(__d / n)"
    m2 = f"__m2 + __d2 - n * {mean} * {mean}"
    m3 = f"__m3 + 3 * __m2d - 3 * {mean} * __m2 + __d3 - 3 * {mean} * __d2 + 2 * n * {mean} * {mean} * {mean}"
    flat = "low = high"
    return added.selectExpr(
        *keys, "n", "total", f"if({flat}, 0D, greatest({m2}, 0D)) AS m2", f"if({flat}, 0D, {m3}) AS m3",
        "low", "high", "first", "last", "tail", "head", "cast(null AS array<double>) AS folds",
    )


def state_stats(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The ten statistics of states that come first in their series."""
    skew = "sqrt(n * (n - 1D)) / (n - 2) * (m3 / n) / pow(m2 / n, 1.5D)"
    stats = {
        "max": "high",
        "min": "low",
        "sum": "total",
        "mean": "total / n",
        "count": "double(n)",
        "std": "if(n > 1, sqrt(m2 / (n - 1)), null)",
        "skew": f"if(n < 3, null, if(low = high, 0D, {skew}))",
        "mean_ewm": ewm.average_mean("head", "tail", "n"),
        "last_ewm": ewm.last_mean("tail", "n"),
        "avg_diff": "if(n > 1, (last - first) / (n - 1), null)",
    }
    return states.selectExpr(*keys, *(f"{stats[s]} AS {s}" for s in STATS))


def range_stats(states: DataFrame, age: str, frames_by_age: str, ages: Sequence[int], width: int) -> DataFrame:
    """Ten statistics of month ranges ``(customer_id, split, kind)`` from month states.

    ``age`` is the SQL of a state's months before the target, ``frames_by_age`` the
    ranges that hold a month of an age (an array constant of ``split, slot, first,
    until``), ``ages`` the ages at which ranges start or end, in the order ``first``
    and ``until`` count them. All states of a customer meet once, in one exchange."""
    own = "(PARTITION BY customer_id, item)"
    older = ", ".join(f"coalesce(sum(if({age} > {a}, n, 0)) OVER {own}, 0)" for a in ages)
    placed = states.repartition("customer_id").selectExpr(
        "customer_id", "item", f"{age} AS age", *STATE,
        f"coalesce(sum(n) OVER (PARTITION BY customer_id, item ORDER BY {age} DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before",
        f"array(0L, {older}) AS older",
        f"sum(total) OVER {own} / sum(n) OVER {own} AS reference",
    )
    inside = placed.selectExpr("*", f"explode({frames_by_age}[least(age, {ages[-1] + 1})]) AS f").selectExpr(
        "customer_id", "f.split AS split", f"f.slot * {width} + item AS kind", *STATE, "reference",
        "before - older[f.first] AS offset", "older[f.until] - before - n AS after",
    )
    keys = ["customer_id", "split", "kind"]
    return state_stats(merged(inside, keys, "offset", "after"), keys)


def measure_states(states: DataFrame, names: Mapping[int, str] = dict(enumerate(MEASURES))) -> DataFrame:
    """States with the measure's name and readable moments, one row per customer,
    month and measure."""
    cases = " ".join(f"WHEN {i} THEN '{n}'" for i, n in names.items())
    return states.selectExpr(
        "customer_id", "year_month", f"CASE item {cases} END AS measure", "n AS rows", "total", "total / n AS mean", "m2 / n AS variance",
        "if(low = high, 0D, m3 / n / pow(m2 / n, 1.5D)) AS skewness", "low", "high", "first", "last", "tail AS decayed",
    )
