"""Tables as versioned Parquet folders, appends and partitioned logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def files(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def numbered(spark: SparkSession, path: str) -> dict[int, bool]:
    """Versions of a table and whether each is finished, by Hadoop's file systems, so any store that Spark reads will do."""
    fs, at = files(spark, path)
    if not fs.exists(at):
        return {}
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    found = [s.getPath() for s in fs.listStatus(at) if s.getPath().getName().startswith("v=")]
    return {int(p.getName()[2:]): fs.exists(new(p, "_SUCCESS")) for p in found}


def versions(spark: SparkSession, path: str) -> list[int]:
    """Finished versions of a table."""
    return sorted(n for n, finished in numbered(spark, path).items() if finished)


def write_version(df: DataFrame, path: str, version: int | None = None, *, partition_by: Sequence[str] = (), redo: bool = False) -> int:
    """df as a new version beside the older ones; a finished version is never touched.

    A new number is above every folder's, also those that a crash left half-written; a given number's half-written
    folder is written anew. redo: so is a finished one, of a run that never became visible.
    """
    there = numbered(df.sparkSession, path)
    n = max(there, default=-1) + 1 if version is None else version
    if there.get(n) and not redo:
        raise ValueError(f"version {n} of {path} is finished")
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/v={n}")
    return n


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> tuple[DataFrame, int]:
    """(table, version): pinned before reading, so rows and watermark agree."""
    n = max(versions(spark, path)) if version is None else version
    return spark.read.parquet(f"{path}/v={n}"), n


def append_rows(df: DataFrame, path: str, columns: Sequence[str], *, fmt: str = "parquet") -> None:
    df.select(*columns).write.mode("append").format(fmt).save(path)


def insert_by_position(df: DataFrame, table: str, *, overwrite: bool = False) -> None:
    """Into a catalog table by position; columns are put into the table's order by name first."""
    df.select(*df.sparkSession.table(table).columns).write.insertInto(table, overwrite=overwrite)


def overwrite_full(df: DataFrame, path: str) -> int:
    """A derived table recomputed: the next version."""
    return write_version(df, path)


def append_merge_schema(df: DataFrame, path: str) -> None:
    """Append where later runs may have more columns."""
    df.write.mode("append").parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def with_day(df: DataFrame, at: str, prefix: str) -> DataFrame:
    """df with <prefix>_year, _month and _day as text of one timestamp."""
    return df.withColumns({f"{prefix}_{k}": F.date_format(at, f) for k, f in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))})


def append_partitioned_log(df: DataFrame, path: str, at: str, prefix: str) -> None:
    with_day(df, at, prefix).write.mode("append").partitionBy(*[f"{prefix}_{k}" for k in ("year", "month", "day")]).parquet(path)


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def write_changes(feed: DataFrame, path: str) -> None:
    """A change feed partitioned by version, so that a range of versions is a range of folders."""
    feed.write.mode("append").partitionBy("_commit_version").parquet(path)
