"""Ten statistics of an ordered series.

Input is long: one row per series element with its value ``x``, its 1-based
position among the values (``j``) and the number of rows after it (``r``).
Every statistic is then an ordinary aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from spendcast.functions import ewm
from spendcast.operators.scan import DEFAULT_LIMITS, ScanLimits, scan

# The statistics in feature names, in order.
STATS = ("max", "min", "sum", "mean", "count", "std", "skew", "mean_ewm", "last_ewm", "avg_diff")
ORDERED_STATS = ("mean_ewm", "last_ewm", "avg_diff")
FOLD_BLOCK = 4096


def sample_skew(x: str) -> str:
    """Bias-adjusted skew: null below three values, 0 for a constant series."""
    n = f"count({x})"
    adjusted = f"skewness({x}) * sqrt({n} * ({n} - 1)) / nullif({n} - 2, 0)"
    return f"if({n} < 3, null, if(min({x}) = max({x}), 0D, {adjusted}))"


def plain_stats(x: str) -> dict[str, str]:
    """SQL text of the statistics that do not depend on row order."""
    return {
        "max": f"max({x})",
        "min": f"min({x})",
        "sum": f"coalesce(sum({x}), 0D)",
        "mean": f"avg({x})",
        "count": f"double(count({x}))",
        "std": f"stddev_samp({x})",
        "skew": sample_skew(x),
    }


def all_stats(x: str = "x", j: str = "j", r: str = "r") -> dict[str, str]:
    """All ten statistics of a series whose nulls, if any, all come first."""
    n = f"count({x})"
    head = f"sum({x} * {ewm.head_weight(j)})"
    tail = f"sum({x} * {ewm.tail_weight(r)})"
    ends = f"max(if({r} = 0, {x}, null)) - max(if({j} = 1, {x}, null))"
    return plain_stats(x) | {
        "mean_ewm": f"if({n} > 0, {ewm.average_mean(head, tail, n)}, null)",
        "last_ewm": f"if({n} > 0, {ewm.last_mean(tail, n)}, null)",
        "avg_diff": f"if({n} > 1, ({ends}) / ({n} - 1), null)",
    }


def summarise(
    long: DataFrame, keys: Sequence[str], *, gaps: Column | None = None
) -> DataFrame:
    """Ten statistics per key from long rows ``(keys, x, j, r)``.

    ``gaps`` marks rows of keys that hold nulls between values. The weighted
    sums do not hold for those, so their three ordered statistics are folded;
    a null there keeps decaying the weights and repeats the last mean. Pass
    None when the input has no such nulls.
    """
    stats = long.groupBy(*keys).agg(*(F.expr(e).alias(n) for n, e in all_stats().items()))
    if gaps is None:
        return stats
    # __folded tells a folded null from a key that was not folded at all
    folded = fold(long.filter(gaps), keys).withColumn("__folded", F.lit(True))
    renamed = folded.withColumnsRenamed({c: f"__{c}" for c in ORDERED_STATS})
    picked = {
        c: F.when(F.col("__folded"), F.col(f"__{c}")).otherwise(F.col(c)) for c in ORDERED_STATS
    }
    return stats.join(renamed, list(keys), "left").withColumns(picked).select(*keys, *STATS)


def fold(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ordered statistics of series with nulls anywhere.

    Rows are folded in blocks of bounded length. Means and weights of blocks add
    up, so a block starts from what the blocks before it end in. Two of those
    with a value are enough: a third weighs below 1e-170 of the last one's least
    weight. Only these narrow states are ordered by window, never the rows.
    """
    keys = list(keys)
    block = F.floor(F.col("j") / FOLD_BLOCK)
    blocks = long.groupBy(*keys, block.alias("b")).agg(
        F.array_sort(F.collect_list(F.struct("j", "x"))).alias("v")
    )

    def advance(acc: Column, x: Column) -> tuple[Column, Column]:
        """Mean and total weight after one element; a null only decays."""
        old = acc["den"] * F.lit(ewm.DECAY)
        value = F.when(old > 0, (old * acc["y"] + x) / (old + 1.0)).otherwise(x)
        return F.coalesce(value, acc["y"]), old + x.isNotNull().cast("double")

    def end_state(acc: Column, e: Column) -> Column:
        y, den = advance(acc, e["x"])
        return F.struct(y.alias("y"), den.alias("den"))

    nothing = F.lit(None).cast("double")
    empty = F.struct(nothing.alias("y"), F.lit(0.0).alias("den"))
    ordered = Window.partitionBy(*keys).orderBy("b")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    ended = blocks.withColumns(
        {"end": F.aggregate("v", empty, end_state), "tip": F.element_at("v", -1)["x"]}
    )
    states = ended.select(*keys, "b", "end", "tip")
    own = F.when(F.col("end.y").isNotNull(), F.struct("b", "end.y", "end.den"))
    # What the last block with a value ends in, with the one before it added.
    older = states.withColumns({"own": own, "p": F.last(own, ignorenulls=True).over(before)})
    faded = F.col("p.den") * F.pow(F.lit(ewm.DECAY), (F.col("b") - F.col("p.b")) * FOLD_BLOCK)
    weight = F.col("own.den") + F.coalesce(faded, F.lit(0.0))
    mean = (F.col("own.den") * F.col("own.y") + F.coalesce(faded * F.col("p.y"), F.lit(0.0))) / weight
    carry = F.when(F.col("own").isNotNull(), F.struct("b", mean.alias("y"), weight.alias("den")))
    carried = older.withColumn("carry", carry).select(
        *(F.col(k).alias(f"__{k}") for k in keys), F.col("b").alias("__b"),
        F.last("carry", ignorenulls=True).over(before).alias("c"), F.lag("tip").over(ordered).alias("px"),
    )
    match = F.col("b") == F.col("__b")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"__{k}"))
    started = blocks.join(carried, match).drop("__b", *(f"__{k}" for k in keys))
    gap = F.pow(F.lit(ewm.DECAY), (F.col("b") - F.col("c.b") - 1) * FOLD_BLOCK)
    start = F.struct(
        F.col("c.y").alias("y"),
        F.coalesce(F.col("c.den") * gap, F.lit(0.0)).alias("den"),
        F.lit(0.0).alias("sum"),
        F.lit(0).cast("long").alias("n"),
        F.col("px").alias("px"),
        F.lit(0.0).alias("dsum"),
        F.lit(0).cast("long").alias("dn"),
    )

    def step(acc: Column, e: Column) -> Column:
        y, den = advance(acc, e["x"])
        d = e["x"] - acc["px"]
        return F.struct(
            y.alias("y"),
            den.alias("den"),
            (acc["sum"] + F.coalesce(y, F.lit(0.0))).alias("sum"),
            (acc["n"] + y.isNotNull().cast("long")).alias("n"),
            e["x"].alias("px"),
            (acc["dsum"] + F.coalesce(d, F.lit(0.0))).alias("dsum"),
            (acc["dn"] + d.isNotNull().cast("long")).alias("dn"),
        )

    done = started.withColumn("s", F.aggregate("v", start, step))
    return done.groupBy(*keys).agg(
        F.try_divide(F.sum("s.sum"), F.sum("s.n")).alias("mean_ewm"),
        F.max_by("s.y", "b").alias("last_ewm"),
        F.try_divide(F.sum("s.dsum"), F.sum("s.dn")).alias("avg_diff"),
    )


def has_nulls(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether any of the columns holds a null; stops at the first one found."""
    condition = F.lit(False)
    for c in columns:
        condition = condition | F.col(c).isNull()
    return not df.filter(condition).select(F.lit(1)).isEmpty()


def series_stats(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    *,
    limits: ScanLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Ten statistics of each value column per key, rows taken in ``order``.

    Output: keys, ``series`` (the value column's name) and the ten statistics.
    """
    keys = list(keys)
    needed = list(dict.fromkeys([*keys, *order, *values]))
    nulls = has_nulls(df, values)
    rows = df.select(*needed)
    any_null = F.lit(False)
    for c in values:
        any_null = any_null | F.col(c).isNull()
    placed = scan(
        rows, keys, order, position="__rn",
        totals={"__n": F.lit(1).cast("long"), "__nulls": any_null.cast("long")}, limits=limits,
    )
    elements = F.array(
        *(
            F.struct(F.lit(c).alias("series"), F.col(c).cast("double").alias("x"))
            for c in values
        )
    )
    long = placed.select(
        *keys, F.col("__rn").alias("j"), (F.col("__n") - F.col("__rn")).alias("r"), "__nulls",
        F.inline(elements),
    )
    return summarise(
        long, [*keys, "series"], gaps=F.col("__nulls") > 0 if nulls else None
    )
