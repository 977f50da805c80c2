"""Labels and spend habits, all from one (customer, month) total table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spendcast.functions.bands import spend_band
from spendcast.functions.months import cutoffs, month_number, month_number_sql, shift_month
from spendcast.operators.blocks import order_seconds
from spendcast.sources.log import month_range

THRESHOLD = 300.0


def customer_months(log: DataFrame) -> DataFrame:
    """Summed total and order span per customer and month. A month of null
    totals sums to 0."""
    known = F.col("customer_id").isNotNull() & F.col("year_month").isNotNull()
    return (
        log.filter(known)
        .groupBy("customer_id", "year_month")
        .agg(
            F.coalesce(F.sum("total"), F.lit(0.0)).alias("total"),
            F.min("order_date").alias("first"),
            F.max("order_date").alias("last"),
        )
    )


def customer_month_totals(log: DataFrame) -> DataFrame:
    return customer_months(log).select("customer_id", "year_month", "total")


def label_month(log: DataFrame, month: str, threshold: float = THRESHOLD) -> DataFrame:
    """Every customer seen before the month, with the month's spend and whether
    it exceeds the threshold (strictly). No purchase counts as spend 0.

    One aggregation: being seen and the month's total are both per customer.
    """
    in_month = F.col("year_month") == month
    spent = (
        month_range(log, until=shift_month(month, 1))
        .filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count_if(F.col("year_month") < month).alias("earlier"),
            F.coalesce(F.sum(F.when(in_month, F.col("total"))), F.lit(0.0)).alias("total"),
        )
        .filter(F.col("earlier") > 0)
    )
    return spent.select(
        "customer_id",
        F.lit(month).alias("year_month"),
        "total",
        (F.col("total") > threshold).cast("int").alias("label"),
    )


def _habits(cut: str, threshold: float) -> dict[str, Column]:
    seen = F.col("year_month") < cut
    over = F.count_if(seen & (F.col("total") > threshold)).cast("double")
    active = F.count_if(seen).cast("double")
    return {
        "total_over_300": over,
        "count_using_shopping": active,
        "total_sum_per_count_using_shopping": F.try_divide(
            F.sum(F.when(seen, F.col("total"))), active
        ),
        "total_over_300_ratio": F.try_divide(over, active),
    }


def habits(totals: DataFrame, cutoff: str, threshold: float = THRESHOLD) -> DataFrame:
    """Months over the threshold, months active, spend per active month and the
    share of months over, from the months before the cutoff."""
    return (
        totals.filter(F.col("year_month") < cutoff)
        .groupBy("customer_id")
        .agg(*(c.alias(n) for n, c in _habits(cutoff, threshold).items()))
    )


def customer_summary(
    months: DataFrame, month: str, label_threshold: float, habit_threshold: float
) -> DataFrame:
    """Label, habits and order span of both splits, one row per customer, columns
    ``{split}_{name}``; ``{split}_label`` is null when the split has no history."""
    columns = []
    for split, cut in cutoffs(month).items():
        seen = F.col("year_month") < cut
        spend = F.coalesce(F.sum(F.when(F.col("year_month") == cut, F.col("total"))), F.lit(0.0))
        label = F.when(F.count_if(seen) > 0, (spend > label_threshold).cast("int"))
        columns.append(label.alias(f"{split}_label"))
        columns += [c.alias(f"{split}_{n}") for n, c in _habits(cut, habit_threshold).items()]
        for name, f in (("first", F.min), ("last", F.max)):
            columns.append(order_seconds(f(F.when(seen, F.col(name)))).alias(f"{split}_{name}"))
    return months.groupBy("customer_id").agg(*columns)


def spend_bands(totals: DataFrame, cutoff: str) -> DataFrame:
    """Spend per active month, and its band."""
    average = habits(totals, cutoff).select("customer_id", "total_sum_per_count_using_shopping")
    return average.withColumn(
        "total_sum_per_count_using_shopping_cat",
        spend_band(F.col("total_sum_per_count_using_shopping")),
    )


def recency_score(log: DataFrame, month: str) -> DataFrame:
    """24 minus the months since the last purchase, for both splits.

    Years do not count (13 months score as 1), and the test split also measures
    from the month before the target, where a purchase scores 24.
    """
    base = month_number(shift_month(month, -1))
    bought = F.expr(month_number_sql("year_month"))
    last = log.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        *(
            F.max(F.when(F.col("year_month") < cut, bought)).alias(split)
            for split, cut in cutoffs(month).items()
        )
    )
    pieces = ", ".join(
        f"struct('{s}' AS split, 24 - ({base} - {s}) % 12 AS last_month_shopping)"
        for s in cutoffs(month)
    )
    return last.selectExpr("customer_id", f"inline(array({pieces}))").filter(
        "last_month_shopping IS NOT NULL"
    )
