"""Tables that a job writes to the shared scratch folder and reads back."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from spendcast.sources.scratch import scratch_folder


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of an action go when it ends, not when the driver
    happens to collect its garbage. For actions whose result is stored or small."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


class Store:
    """Keeps the tables of one job by name and drops those no longer needed.

    A stored table cuts the lineage: what is lost with an executor is read again."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def put(self, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
        path = scratch_folder(self.spark, name)
        with brief_shuffles(self.spark):
            df.write.parquet(path, compression=compression)
        self.paths[name] = path
        return self.spark.read.parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables by name; nothing may read them afterwards."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
