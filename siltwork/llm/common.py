"""What the training-data operators share: table reads, folds and a place for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, n: int) -> Column:
    """crc32 of the key as text, modulo n; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n


def unused(taken: Iterable[str], name: str) -> str:
    """The name, with as many underscores after it as it takes to clash with no column; case does not tell names apart."""
    lowered = {c.lower() for c in taken}
    while name.lower() in lowered:
        name += "_"
    return name


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, by spark.checkpoint.dir; one of our own only on a local master (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        at = spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="siltwork-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(at)
    return at


def stored(df: DataFrame, *, partitions: int | None = None) -> DataFrame:
    """df written as Parquet to the shared folder and read again: cuts the lineage and survives a lost executor."""
    path = f"{shared_dir(df.sparkSession)}/siltwork-{uuid.uuid4().hex}"
    (df if partitions is None else df.coalesce(partitions)).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame) -> DataFrame:
    """df as a checkpoint in the shared folder; for small frames that later steps read more than once."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
