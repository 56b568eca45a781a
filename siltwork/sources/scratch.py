"""Folders for what a job writes on its way."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share, by spark.checkpoint.dir; a local one only on a local master (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="siltwork-")
    return f"{at}/{name}-{uuid.uuid4().hex}"


#: Spark removes the shuffles of a query when it has ended; without this they stay until the driver collects garbage.
REMOVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffles of what runs in here go from the executors' disks as soon as it has run."""
    old = spark.conf.get(REMOVED, None)
    spark.conf.set(REMOVED, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(REMOVED)
        else:
            spark.conf.set(REMOVED, old)


def written(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared folder and read again: what several later steps read. Its shuffles are removed then."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
