"""Folders for tables a job writes and reads back."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Input bytes of one slice. What a slice shuffles and spills is gone before the next one starts.
SLICE_BYTES = 256 << 20


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; a local session without one
    uses a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{tempfile.mkdtemp(prefix='spendcast-')}/{name}"


def drop_shuffles(spark: SparkSession) -> None:
    """Let shuffle files of finished writes go. Spark removes them once the driver's JVM
    collects the plans they belong to, which a large heap may put off to the end of the job."""
    spark._jvm.System.gc()


def slices_of(df: DataFrame) -> int:
    """Slices by the bytes of the files a table is made from."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    # A source that does not know its size says the most a long holds.
    return max(1, -(-sum(n for n in sizes if n < 1 << 60) // SLICE_BYTES))


def slice_condition(by: str, slices: int, i: int) -> Column:
    """Rows of the ``i``-th slice of the column ``by``; null is a value like others."""
    return F.expr(f"pmod(xxhash64(`{by}`), {slices}) = {i}")


def write_slices(df: DataFrame, path: str, by: str, slices: int | None = None) -> None:
    """Replace the table under ``path`` by ``df``, one slice of the column ``by`` after the other.

    Rows of one value of ``by`` must not depend on those of others: the filter then reaches
    the scan, and a slice reads, shuffles and sorts its own rows only."""
    slices = slices or slices_of(df)
    for i in range(slices):
        part = df if slices == 1 else df.filter(slice_condition(by, slices, i))
        part.write.mode("append" if i else "overwrite").option("compression", "zstd").parquet(path)
        if slices > 1:
            drop_shuffles(df.sparkSession)


def stored(df: DataFrame, name: str, by: str, slices: int | None = None) -> DataFrame:
    """The table written to a new scratch folder by ``write_slices`` and read back, which also cuts its lineage."""
    path = scratch_folder(df.sparkSession, name)
    write_slices(df, path, by, slices)
    return df.sparkSession.read.parquet(path)


def in_slices(
    rows: DataFrame, by: str, slices: int, work: Callable[[DataFrame, Column | None], DataFrame], name: str
) -> tuple[DataFrame, str | None]:
    """``work`` done on each slice of the column ``by`` and stored, and the folder; a single
    slice stays a plan. ``work`` gets the rows and the condition that chose them."""
    if slices == 1:
        return work(rows, None), None
    path = scratch_folder(rows.sparkSession, name)
    for i in range(slices):
        chosen = slice_condition(by, slices, i)
        work(rows.filter(chosen), chosen).write.mode("append").option("compression", "zstd").parquet(path)
        drop_shuffles(rows.sparkSession)
    return rows.sparkSession.read.parquet(path), path


def drop_folder(spark: SparkSession, path: str | None) -> None:
    """Delete a scratch folder that nothing reads any more."""
    if path:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
