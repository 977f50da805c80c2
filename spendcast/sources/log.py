"""The transaction log: schema, readers and the total row order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

LOG_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("order_date", T.TimestampNTZType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("country", T.StringType()),
        T.StructField("total", T.DoubleType()),
    ]
)

MEASURES = ("quantity", "price", "total")

# Running sums, differences and weighted means depend on row order, and Spark
# has no file order. These columns rank first; TIE_BREAKERS follow where present.
ORDER = ("order_date", "order_id")
TIE_BREAKERS = (
    "line_number", "product_id", "supplier_id", "quantity", "total", "price",
    "discount", "tax", "ship_date", "return_flag", "line_status",
)


def row_order(df: DataFrame) -> list[str]:
    """Total order over the rows of a log, from the columns it has."""
    return [*ORDER, *(c for c in TIE_BREAKERS if c in df.columns)]


def with_month(df: DataFrame) -> DataFrame:
    """Add ``year_month`` (``YYYY-MM``); its string order is time order.

    Built from date parts: a date format costs several times as much per row.
    """
    month = "concat(lpad(year(order_date), 4, '0'), '-', lpad(month(order_date), 2, '0'))"
    return df.withColumn("year_month", F.expr(month))


def month_range(df: DataFrame, first: str | None = None, until: str | None = None) -> DataFrame:
    """Rows with ``first <= year_month < until``.

    The same bounds on ``order_date`` reach the file scan as pushed filters;
    those on ``year_month`` prune folders of a log stored by month.
    """
    for month, sign in ((first, ">="), (until, "<")):
        if month is not None:
            df = df.filter(
                f"year_month {sign} '{month}' AND order_date {sign} timestamp_ntz'{month}-01 00:00:00'"
            )
    return df


def read_log_csv(spark: SparkSession, path: str, schema: T.StructType = LOG_SCHEMA) -> DataFrame:
    """Scan a CSV log by header name, with fixed types (no inference pass)."""
    header = spark.read.option("header", True).csv(path).columns
    fields = {f.name: f for f in schema.fields}
    ordered = T.StructType([fields.get(c, T.StructField(c, T.StringType())) for c in header])
    return with_month(spark.read.schema(ordered).option("header", True).csv(path))


def read_log_parquet(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df if "year_month" in df.columns else with_month(df)


def write_log(df: DataFrame, path: str) -> None:
    """Store a log partitioned by month, so month cuts prune whole folders.

    Range partitioning keeps files even: a month or customer holding much of
    the data is split over several tasks by the later sort columns.
    """
    df.repartitionByRange("year_month", "customer_id", *row_order(df)).write.mode(
        "overwrite"
    ).partitionBy("year_month").parquet(path)


def star_log(spark: SparkSession, folder: str, details: bool = False) -> DataFrame:
    """Log view over the star-schema tables, one row per order line.

    ``details`` adds the two descriptive columns (country, description), which
    no feature reads; without it the three dimension tables are not touched.
    """
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    log = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    columns = {
        "customer_id": F.col("o_custkey"),
        "order_id": F.col("l_orderkey"),
        "product_id": F.col("l_partkey"),
        "order_date": F.col("o_orderdate"),
        "quantity": F.col("l_quantity"),
        "price": F.try_divide("l_extendedprice", "l_quantity"),
        "total": F.col("l_extendedprice"),
        "line_number": F.col("l_linenumber"),
        "supplier_id": F.col("l_suppkey"),
        "discount": F.col("l_discount"),
        "tax": F.col("l_tax"),
        "ship_date": F.col("l_shipdate"),
        "return_flag": F.col("l_returnflag"),
        "line_status": F.col("l_linestatus"),
    }
    if details:
        read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
        log = (
            log.join(read("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(read("part"), F.col("l_partkey") == F.col("p_partkey"))
        )
        columns |= {"country": F.col("n_name"), "description": F.col("p_name")}
    return with_month(log.select(*(c.alias(name) for name, c in columns.items())))
