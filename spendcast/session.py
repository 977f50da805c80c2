"""Session helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
}


def build_session(master: str | None = None, app: str = "spendcast", **conf: str) -> SparkSession:
    """A session with the settings the library relies on; extra settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint to the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: executors on
    other machines could not read it.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="spendcast-checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint()
