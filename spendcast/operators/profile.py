"""Profiling of a log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from spendcast.operators.quantiles import exact_quantiles, unpivot
from spendcast.operators.scan import DEFAULT_LIMITS, ScanLimits


def _per_column(df: DataFrame, columns: Sequence[str], aggregate, name: str) -> DataFrame:
    one_row = df.agg(*(aggregate(c).alias(c) for c in columns))
    pairs = ", ".join(f"struct('{c}' AS column, `{c}` AS {name})" for c in columns)
    return one_row.selectExpr(f"inline(array({pairs}))")


def column_info(df: DataFrame) -> DataFrame:
    """Name, type and non-null count of every column."""
    types = F.create_map(*(F.lit(v) for pair in df.dtypes for v in pair))
    counts = _per_column(df, df.columns, F.count, "non_null")
    return counts.select("column", types[F.col("column")].alias("type"), "non_null")


def null_counts(df: DataFrame) -> DataFrame:
    return _per_column(df, df.columns, lambda c: F.count_if(F.col(c).isNull()), "nulls")


def null_ratio(df: DataFrame) -> DataFrame:
    ratio = lambda c: F.avg(F.col(c).isNull().cast("int"))
    return _per_column(df, df.columns, ratio, "null_ratio")


def describe_numeric(
    df: DataFrame, columns: Sequence[str], limits: ScanLimits = DEFAULT_LIMITS
) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum."""
    moments = (
        unpivot(df, columns)
        .groupBy("column")
        .agg(
            F.count("value").alias("count"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
    quartiles = exact_quantiles(df, columns, {"25%": 0.25, "50%": 0.5, "75%": 0.75}, limits)
    return moments.join(quartiles, "column").select(
        "column", "count", "mean", "std", "min", "`25%`", "`50%`", "`75%`", "max"
    )


def table_shape(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns")
    )


def key_coverage(keys: DataFrame, log: DataFrame, column: str = "customer_id") -> DataFrame:
    """How many of the keys occur in the log."""
    seen = log.select(column).distinct()
    return keys.join(seen, column, "left_semi").agg(F.count(F.lit(1)).alias("keys_in_log"))


def date_range(df: DataFrame) -> DataFrame:
    return df.agg(F.min("order_date").alias("first"), F.max("order_date").alias("last"))


def distinct_keys(df: DataFrame, columns: Sequence[str] = ("customer_id", "product_id")) -> DataFrame:
    """Distinct values per column; null counts as one value.

    Values are grouped per column before they are counted, so no task sees more
    than its share of one column.
    """
    pairs = ", ".join(f"struct('{c}' AS column, string(`{c}`) AS value)" for c in columns)
    values = df.selectExpr(f"inline(array({pairs}))").distinct()
    return values.groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"))


def monthly_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("year_month").agg(F.coalesce(F.sum("total"), F.lit(0.0)).alias("total"))


def histogram(df: DataFrame, column: str, bins: int = 500) -> DataFrame:
    """Equal-width bins, the last one closed, with counts and densities.

    Only the two bounds and the row count reach the driver.
    """
    values = df.select(F.col(column).cast("double").alias("x")).filter("x IS NOT NULL")
    low, high, n = values.agg(F.min("x"), F.max("x"), F.count("x")).first()
    spark = df.sparkSession
    if n == 0:
        return spark.range(0).selectExpr(
            "int(id) AS bin", "double(id) AS left", "id AS count", "double(id) AS density"
        )
    if low == high:  # a constant column gets a unit range around it
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    placed = values.select(
        F.least(F.floor((F.col("x") - low) / width), F.lit(bins - 1)).cast("int").alias("bin")
    )
    counts = placed.groupBy("bin").count()
    every = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * width).alias("left"),
        F.coalesce("count", F.lit(0)).alias("count"),
        (F.coalesce("count", F.lit(0)) / (n * width)).alias("density"),
    )


def first_customer_rows(log: DataFrame) -> DataFrame:
    """All rows of the smallest customer id."""
    smallest = log.agg(F.min("customer_id").alias("customer_id"))
    return log.join(F.broadcast(smallest), "customer_id", "left_semi")


def alphabetic_codes(df: DataFrame, column: str = "product_id") -> DataFrame:
    """Distinct codes made of letters only."""
    return df.select(column).distinct().filter(F.col(column).rlike(r"^\p{L}+$"))


def head(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)
