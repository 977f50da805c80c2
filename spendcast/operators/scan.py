"""Ordered scans: row positions, running sums, lags and key totals.

A plain window puts each key's rows in one task. That is right for keys of
bounded size, so keys above a row limit take another way: their rows are range
partitioned on the full row order (which splits a single key), scanned per
piece, and corrected by what the earlier pieces of the key add up to. Results
do not depend on the limit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from spendcast.session import cut_lineage


@dataclass(frozen=True)
class ScanLimits:
    """``group_rows``: rows of one key that one task may hold, at any table size."""

    group_rows: int = 2_000_000


DEFAULT_LIMITS = ScanLimits()
PIECE = "__piece"
HOT_ROWS = "__rows"


def scan(
    rows: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    *,
    position: str | None = None,
    sums: Mapping[str, str] | None = None,
    lags: Mapping[str, str] | None = None,
    totals: Mapping[str, Column] | None = None,
    hot: DataFrame | None = None,
    limits: ScanLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Add ordered columns per key; an empty ``by`` scans the whole table.

    ``position``: 1-based row number. ``sums``: output -> column, inclusive
    running sum, null where the column is null. ``lags``: output -> column of
    the previous row. ``totals``: output -> numeric expression summed over the
    whole key. ``order`` must be a total order. ``hot`` is what ``hot_keys`` found,
    looked up here when not given; rows that are costly to derive should be
    stored before, as they are counted and then read.
    """
    sums, lags, totals = dict(sums or {}), dict(lags or {}), dict(totals or {})
    by, order = list(by), list(order)
    def in_windows(df: DataFrame, keys: list[str]) -> DataFrame:
        ordered = Window.partitionBy(*keys).orderBy(*order)
        running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        out = {} if position is None else {position: F.row_number().over(ordered).cast("long")}
        out |= {n: F.when(F.col(c).isNotNull(), F.sum(c).over(running)) for n, c in sums.items()}
        out |= {n: F.lag(c).over(ordered) for n, c in lags.items()}
        out |= {n: F.sum(e).over(whole) for n, e in totals.items()}
        return df.withColumns(out)

    if by:
        if hot is None:
            hot = hot_keys(rows, by, limits)
        hot_rows_n = hot.agg(F.sum(HOT_ROWS)).first()[0]
        if not hot_rows_n:
            return in_windows(rows, by)
        rows = cut_lineage(rows)
        match = [F.col(f"r.{c}").eqNullSafe(F.col(f"h.{c}")) for c in by]
        condition = match[0]
        for m in match[1:]:
            condition = condition & m
        keys = hot.drop(HOT_ROWS).alias("h")
        cold_rows = rows.alias("r").join(keys, condition, "left_anti")
        hot_rows = rows.alias("r").join(keys, condition, "left_semi")
        pieces = [1 + 2 * hot_rows_n // limits.group_rows]
    else:
        # A whole table is cut into the session's shuffle partitions.
        cold_rows, hot_rows, pieces = None, cut_lineage(rows), []

    # One struct names a key's piece: it stays comparable when a key is null.
    name = F.struct(*by, F.spark_partition_id().alias("piece"))
    split = cut_lineage(
        hot_rows.repartitionByRange(*pieces, *by, *order).withColumn(PIECE, name)
    )
    done = _carry(in_windows, split, by, order, position, sums, lags, totals)
    return done if cold_rows is None else in_windows(cold_rows, by).unionByName(done)


BUCKETS = 1 << 16


def bucket_of(by: Sequence[str]) -> str:
    return f"pmod(xxhash64({', '.join(f'`{c}`' for c in by)}), {BUCKETS})"


def hot_keys(rows: DataFrame, by: Sequence[str], limits: ScanLimits = DEFAULT_LIMITS) -> DataFrame:
    """Stored keys with more rows than one task may hold, and their row counts.

    Such a key makes its bucket of keys as large, so the first pass counts a fixed
    number of buckets, and only keys of large buckets are counted one by one."""
    return hot_by_keys(rows, {"": by}, limits)[""]


def hot_by_keys(rows: DataFrame, keys: Mapping[str, Sequence[str]], limits: ScanLimits = DEFAULT_LIMITS) -> dict[str, DataFrame]:
    """``hot_keys`` of several keys, whose buckets are counted in one pass."""
    named = ", ".join(f"struct('{name}' AS name, {bucket_of(by)} AS bucket)" for name, by in keys.items())
    counts = rows.selectExpr(f"inline(array({named}))").groupBy("name", "bucket").agg(F.count(F.lit(1)).alias("n"))
    large = cut_lineage(counts.filter(F.col("n") > limits.group_rows))
    some = {r["name"] for r in large.select("name").distinct().collect()}  # at most one per key
    found = {}
    for name, by in keys.items():
        exact = rows.groupBy(*by).agg(F.count(F.lit(1)).alias(HOT_ROWS)).filter(F.col(HOT_ROWS) > limits.group_rows)
        if name in some:
            bucket = large.filter(F.col("name") == name).select("bucket")
            inside = rows.select(*by).withColumn("bucket", F.expr(bucket_of(by))).join(bucket, "bucket", "left_semi")
            exact = cut_lineage(inside.groupBy(*by).agg(F.count(F.lit(1)).alias(HOT_ROWS)).filter(F.col(HOT_ROWS) > limits.group_rows))
        else:
            nothing = (F.lit(None).cast(f.dataType).alias(f.name) for f in exact.schema.fields)
            exact = rows.sparkSession.range(0).select(*nothing)
        found[name] = exact
    return found


def _carry(in_windows, split, by, order, position, sums, lags, totals) -> DataFrame:
    """Scan each piece of a hot key and add what the key's earlier pieces hold."""
    last = []
    if lags:
        values = F.struct(*(F.col(c).alias(n) for n, c in lags.items()))
        last = [F.max_by(values, F.struct(*order)).alias("__last")]
    pieces = split.groupBy(PIECE).agg(
        F.count(F.lit(1)).alias("__count"),
        *(F.sum(c).alias(f"__sum_{n}") for n, c in sums.items()),
        *(F.sum(e).alias(f"__total_{n}") for n, e in totals.items()),
        *last,
    )
    key = Window.partitionBy(*(F.col(f"{PIECE}.{c}") for c in by))
    ordered = key.orderBy(f"{PIECE}.piece")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.select(
        PIECE,
        F.coalesce(F.sum("__count").over(earlier), F.lit(0)).alias("__before"),
        *(
            F.coalesce(F.sum(f"__sum_{n}").over(earlier), F.lit(0)).alias(f"__sum_{n}")
            for n in sums
        ),
        *(F.sum(f"__total_{n}").over(key).alias(f"__total_{n}") for n in totals),
        *(F.lag("__last").over(ordered).alias("__last") for _ in last),
    )
    local = in_windows(split, [PIECE])
    if lags:
        local = local.withColumn(
            "__row", F.row_number().over(Window.partitionBy(PIECE).orderBy(*order))
        )
    joined = local.alias("l").join(carried.alias("c"), PIECE)
    new = {*sums, *lags, *totals, *([position] if position else [])}
    out = [F.col(f"l.{c}") for c in split.columns if c != PIECE and c not in new]
    if position:
        out.append((F.col(f"l.{position}") + F.col("c.__before")).alias(position))
    out += [(F.col(f"l.{n}") + F.col(f"c.__sum_{n}")).alias(n) for n in sums]
    out += [
        F.when(F.col("l.__row") == 1, F.col(f"c.__last.{n}")).otherwise(F.col(f"l.{n}")).alias(n)
        for n in lags
    ]
    out += [F.col(f"c.__total_{n}").alias(n) for n in totals]
    return joined.select(*out)
