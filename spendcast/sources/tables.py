"""Feature-table, key-list and score-table sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

ID_COLUMNS = ("customer_id", "year_month", "label", "split")


def feature_columns(df: DataFrame) -> list[str]:
    """Every column that is neither a key, a month, a split nor the label."""
    return [c for c in df.columns if c not in ID_COLUMNS]


def write_features(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One folder per split. Parquet is the stage boundary; CSV is for export."""
    writer = df.write.mode("overwrite").partitionBy("split")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def read_features(
    spark: SparkSession, path: str, split: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Scan a stored feature table; a split reads only its own folder.

    CSV is read by header name with fixed types, without an inference pass."""
    if fmt == "csv":
        header = spark.read.option("header", True).csv(path).columns
        kinds = {"customer_id": T.LongType(), "label": T.IntegerType(), "year_month": T.StringType(), "split": T.StringType()}
        schema = T.StructType([T.StructField(c, kinds.get(c, T.DoubleType())) for c in header])
        df = spark.read.schema(schema).option("header", True).csv(path)
    else:
        df = spark.read.parquet(path)
    return df if split is None else df.filter(F.col("split") == split)


def features_and_label(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Model input (keys, label, features) and the feature list."""
    features = feature_columns(df)
    keys = [c for c in ("customer_id", "label") if c in df.columns]
    return df.select(*keys, *(F.col(f"`{c}`") for c in features)), features


def read_keys(spark: SparkSession, path: str) -> DataFrame:
    """Customers to score, from a CSV with a ``customer_id`` column."""
    header = spark.read.option("header", True).csv(path).columns
    schema = T.StructType(
        [T.StructField(c, T.LongType() if c == "customer_id" else T.StringType()) for c in header]
    )
    return spark.read.schema(schema).option("header", True).csv(path).select("customer_id")


SCORE_SCHEMA = "customer_id bigint, probability double"


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCORE_SCHEMA).option("header", True).csv(path)


def attach_scores(keys: DataFrame, scores: DataFrame) -> DataFrame:
    """Key list with its scores, joined by customer and never by row position."""
    return keys.select("customer_id").join(
        scores.select("customer_id", "probability"), "customer_id", "left"
    )


def write_scores(df: DataFrame, path: str) -> None:
    df.select("customer_id", "probability").write.mode("overwrite").option("header", True).csv(path)
