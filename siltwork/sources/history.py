"""An SCD2 history as a versioned table that never rewrites what is closed, nor the buckets that a run does not reach.

Version n of the table has the rows of one run in hash buckets of the keys (``buckets``), each by kind: ``kept`` and
``opened`` are the current rows of the bucket after it, ``closed`` those that the run closed. The history at n is the
current rows of n, each bucket where its last run left it, and what the versions up to n closed; what a run changed is its
``opened`` and ``closed`` rows, so the next layer reads a range of folders, not the history. A version counts once it is
finished; one that a crash left half-written is neither read nor in the way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltwork.operators import scd2
from siltwork.operators.scd2 import CLOSED, KIND, OPENED
from siltwork.sources import buckets

VERSION = "v"
_EXTRA = T.StructType([T.StructField(KIND, T.StringType())])
_HOW = {"below": [KIND]}


def _current() -> Column:
    return F.col(KIND) != CLOSED


def create(rows: DataFrame, path: str, version: int | None = None, *, keys: Sequence[str] = (), per_bucket: int = buckets.ROWS, redo: bool = False) -> int:
    """The first version: every row is opened. Without keys the current rows are one bucket, which each run rewrites."""
    return buckets.create(rows.withColumn(KIND, F.lit(OPENED)), path, keys, version, per_bucket=per_bucket, counted=_current(), redo=redo, **_HOW)


def append(tagged: DataFrame, path: str, version: int | None = None, *, redo: bool = False) -> int:
    """All current rows after a run and those that it closed, with their kinds, as the next version."""
    done = versions(tagged.sparkSession, path)
    before = max(v for v in done if version is None or v < version)
    return buckets.replace(buckets.everything(tagged.sparkSession, path, before), tagged, path, version, counted=_current(), redo=redo, **_HOW)


def run(spark: SparkSession, path: str, feed: DataFrame, keys: Sequence[str], business: Sequence[str], ts: str, before: int, version: int | None = None, *, redo: bool = False) -> int:
    """The feed's changes as the version after ``before``: only the buckets of its keys are read and written."""
    into = buckets.reach(spark, path, feed, before, _EXTRA)
    now = into.rows.where(_current()).drop(KIND)
    return buckets.replace(into, scd2.run(now, feed, keys, business, ts), path, version, counted=_current(), redo=redo, **_HOW)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Finished versions."""
    return buckets.versions(spark, path)


def _rows(spark: SparkSession, path: str, after: int | None, version: int) -> DataFrame:
    """Rows of the versions in (after, version] with their kinds; other folders are not listed."""
    wanted = [k for k in versions(spark, path) if k <= version and (after is None or k > after)]
    of = buckets.layout(spark, path, version)
    schema = T.StructType([*of.schema.fields, T.StructField(VERSION, T.IntegerType()), T.StructField(buckets.BUCKET, T.IntegerType()), *_EXTRA.fields])
    if not wanted:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/v={k}" for k in wanted]).drop(buckets.BUCKET)


def current(spark: SparkSession, path: str, version: int | None = None) -> tuple[DataFrame, int]:
    """(current rows, version): only the folders that hold a bucket now are read."""
    n = max(versions(spark, path)) if version is None else version
    return buckets.read(spark, path, n, _EXTRA).where(_current()).drop(KIND), n


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The whole history at a version."""
    rows, n = current(spark, path, version)
    return rows.unionByName(_rows(spark, path, None, n).where(F.col(KIND) == CLOSED).drop(KIND, VERSION))


def changes(spark: SparkSession, path: str, from_version: int, to_version: int) -> DataFrame:
    """Rows that the versions in (from, to] opened or closed, with the version as ``v``."""
    return _rows(spark, path, from_version, to_version).where(F.col(KIND).isin(OPENED, CLOSED)).drop(KIND)
