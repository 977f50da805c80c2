"""Exact quantiles without gathering a column in one place.

Columns are read as long rows ``(place, value)`` and numbers per column are looked up
in constant arrays, so the code of a job does not grow with the number of columns.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from spendcast.operators.scan import DEFAULT_LIMITS, ScanLimits, scan


def unpivot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long ``(column, value)`` rows of numeric columns, nulls left out."""
    pairs = ", ".join(f"struct('{c}' AS column, double(`{c}`) AS value)" for c in columns)
    return df.selectExpr(f"inline(array({pairs}))").filter("value IS NOT NULL")


def value_ranks(
    df: DataFrame, columns: Sequence[str], limits: ScanLimits = DEFAULT_LIMITS
) -> DataFrame:
    """Distinct values with their ranks: ``column, value, count, upto, previous, n``.

    Values are counted first (map-side), then cumulated by the skew-safe scan.
    A value holds the 0-based ranks ``upto - count`` to ``upto - 1`` of ``n``.
    """
    counts = unpivot(df, columns).groupBy("column", "value").count()
    return scan(
        counts, ["column"], ["value"], sums={"upto": "count"}, lags={"previous": "value"},
        totals={"n": F.col("count")}, limits=limits,
    )


SKETCH_ACCURACY = 10_000


def long_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``place, value`` of every non-null value, ``place`` counting the columns from 0."""
    values = ", ".join(f"double(`{c}`)" for c in columns)
    return df.selectExpr(f"posexplode(array({values})) AS (place, value)").filter("value IS NOT NULL")


def constants(values: Sequence[float]) -> str:
    """An array of doubles as one literal."""
    return "cast(split('{}', ',') AS array<double>)".format(",".join(repr(float(v)) for v in values))


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: dict[str, float],
    limits: ScanLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Linearly interpolated quantiles, one row per column.

    Two narrow passes that don't shuffle the rows: sketches bracket each quantile; then
    values below each bracket are counted, and only values inside one are told apart.
    Should a bracket miss, its column is ranked in full.
    """
    names = list(probabilities)
    brackets = _brackets(df, columns, probabilities)
    k = len(names)
    nothing = [(math.inf, -math.inf)] * k
    low, high = (constants([(brackets[c][1] or nothing)[q][side] for c in columns for q in range(k)]) for side in (0, 1))
    found: dict[tuple[int, int], float] = {}
    if any(n for n, _ in brackets.values()):
        spots = f"transform(sequence(0, {k - 1}), q -> struct(q AS quantile, {low}[place * {k} + q] AS low, {high}[place * {k} + q] AS high))"
        # Below a bracket a value only counts, inside it is kept apart.
        seen = long_rows(df, columns).selectExpr("place", "value", f"explode({spots}) AS s").filter("value <= s.high").selectExpr(
            "place", "s.quantile AS quantile", "if(value >= s.low, value, null) AS value"
        )
        counts = seen.groupBy("place", "quantile", "value").count()
        ranks = scan(counts, ["place", "quantile"], ["value"], sums={"upto": "count"}, limits=limits)
        sizes = constants([brackets[c][0] for c in columns])
        levels = constants([probabilities[n] for n in names])
        # Nulls, the values below, come first in the order.
        ends = ranks.selectExpr("*", f"({sizes}[place] - 1) * {levels}[quantile] AS rank").groupBy("place", "quantile").agg(
            F.expr("coalesce(max(if(value IS NULL, upto, null)), 0) <= floor(max(rank)) AS hit"),
            F.expr("min(if(value IS NOT NULL AND upto > floor(rank), value, null)) AS lo"),
            F.expr("min(if(value IS NOT NULL AND upto > ceil(rank), value, null)) AS hi"),
            F.expr("max(rank) - floor(max(rank)) AS part"),
        )
        for r in ends.collect():  # one row per column and quantile
            if r["hit"] and r["lo"] is not None and r["hi"] is not None:
                found[r["place"], r["quantile"]] = r["lo"] + (r["hi"] - r["lo"]) * r["part"]
    missed = [
        c for i, c in enumerate(columns)
        if brackets[c][0] and any((i, q) not in found for q in range(k))
    ]
    values = {c: [found.get((i, q)) for q in range(k)] for i, c in enumerate(columns)}
    if missed:
        for r in ranked_quantiles(df, missed, probabilities, limits).collect():
            values[r["column"]] = [r[n] for n in names]
    schema = "column string, " + ", ".join(f"`{n}` double" for n in names)
    return df.sparkSession.createDataFrame([(c, *values[c]) for c in columns], schema)


def _brackets(
    df: DataFrame, columns: Sequence[str], probabilities: dict[str, float]
) -> dict[str, tuple[int, list[tuple[float, float]]]]:
    """Row count per column and a value range sure to hold each quantile: from a sketch,
    or all values of a column that is smaller than a sketch."""
    slack = 2 / SKETCH_ACCURACY
    edges = [min(max(p + d, 0.0), 1.0) for p in probabilities.values() for d in (-slack, slack)]
    sketch = f"percentile_approx(value, array({', '.join(f'{e!r}D' for e in edges)}), {SKETCH_ACCURACY}) AS e"
    rows = long_rows(df, columns).groupBy("place").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), F.expr(sketch)
    )
    found = {c: (0, []) for c in columns}
    for r in rows.collect():  # one row per column
        e, small = r["e"], r["n"] < SKETCH_ACCURACY
        ranges = [(r["low"], r["high"]) if small else (e[2 * q], e[2 * q + 1]) for q in range(len(probabilities))]
        found[columns[r["place"]]] = r["n"], ranges
    return found


def ranked_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: dict[str, float],
    limits: ScanLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """The same quantiles from the ranks of all distinct values."""
    ranks = value_ranks(df, columns, limits)
    ends = []
    for name, p in probabilities.items():
        at = f"((n - 1) * {p!r}D)"
        for side, f in (("lo", "floor"), ("hi", "ceil")):
            ends.append(F.expr(f"min(if(upto > {f}{at}, value, null))").alias(f"{name}_{side}"))
    found = ranks.groupBy("column").agg(F.max("n").alias("n"), *ends)
    return found.selectExpr(
        "column",
        *(
            f"`{name}_lo` + (`{name}_hi` - `{name}_lo`) * (((n - 1) * {p!r}D) % 1) AS `{name}`"
            for name, p in probabilities.items()
        ),
    )


def quantile_knots(
    df: DataFrame, columns: Sequence[str], knots: int = 1000, limits: ScanLimits = DEFAULT_LIMITS
) -> DataFrame:
    """Values at ``min(knots, n)`` evenly spaced ranks: ``column, knot, knots, value``.

    Each value yields the knots between the previous value's last rank and its
    own last rank, so every knot comes out once.
    """
    ranks = value_ranks(df, columns, limits).withColumn("k", F.least(F.lit(knots), F.col("n")))
    first, last, steps = "(upto - count)", "(upto - 1)", "greatest(n - 1, 1)"
    start = f"if({first} = 0, 0, ({first} - 1) * (k - 1) div {steps} + 1)"
    stop = f"if(n = 1, 0, {last} * (k - 1) div {steps})"
    spread = ranks.withColumns({"start": F.expr(start), "stop": F.expr(stop)}).filter("start <= stop")
    at = f"(knot * (n - 1) / greatest(k - 1, 1))"
    return spread.selectExpr("*", "explode(sequence(start, stop)) AS knot").selectExpr(
        "column", "int(knot) AS knot", "int(k) AS knots",
        f"if({at} >= {first}, value, previous + ({at} - {first} + 1) * (value - previous)) AS value",
    )
