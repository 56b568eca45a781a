"""Watermarks, flags, logs and drift of schemas."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FLAGS = "job_name string, key string, value string, insertion_timestamp timestamp"
SCHEMAS = "table_name string, column_name string, column_type string"


def latest_flag(flags: DataFrame) -> DataFrame:
    """(job_name, key, value): the last value of each flag."""
    return flags.groupBy("job_name", "key").agg(F.max_by("value", F.struct("insertion_timestamp", "value")).alias("value"))


def watermark(flags: DataFrame, job: str, key: str = "last_processed_version") -> int | None:
    """The position up to which a job has read; one row."""
    found = flags.where((F.col("job_name") == job) & (F.col("key") == key)).agg(F.max_by("value", F.struct("insertion_timestamp", "value"))).first()[0]
    return None if found is None else int(found)


def watermark_advance(changes: DataFrame, job: str, from_version: int | None, to_version: int, ts: str) -> DataFrame | None:
    """The row that moves a watermark to the end of the range read, also if no change was in it; None if there is nothing to read."""
    if from_version is not None and from_version >= to_version:
        return None
    top = changes.agg(F.greatest(F.coalesce(F.max("_commit_version"), F.lit(to_version)), F.lit(to_version)).alias("v"))
    return top.select(F.lit(job).alias("job_name"), F.lit("last_processed_version").alias("key"), F.col("v").cast("string").alias("value"), F.lit(ts).cast("timestamp").alias("insertion_timestamp"))


def check_bootstrap(exists: bool, mark: int | None) -> None:
    """A watermark without its table means that the table was lost: an error, not a silent reload."""
    if not exists and mark is not None:
        raise ValueError(f"the table is missing but its watermark stands at {mark}")


def freshness(refresh_log: DataFrame, now: str, limit_minutes: int = 60) -> DataFrame:
    """(object_fqn, minutes, stale) since each object's last refresh."""
    minutes = F.floor((F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.max("refreshed_at"))) / 60)
    return refresh_log.groupBy("object_fqn").agg(minutes.alias("minutes")).withColumn("stale", F.col("minutes") > limit_minutes)


def log_join(audit_log: DataFrame, gate_log: DataFrame) -> DataFrame:
    """Writes with the gate that let them through, by target table and run."""
    return audit_log.join(gate_log, ["target_table", "run_id"])


def recent(log: DataFrame, at: str, tie: str, n: int = 10) -> DataFrame:
    return log.orderBy(F.desc(at), F.desc(tie)).limit(n)


def schema_rows(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, column_type) of frames."""
    return spark.createDataFrame([(t, f.name, f.dataType.simpleString()) for t, df in tables.items() for f in df.schema], SCHEMAS)


def schema_snapshot(df: DataFrame) -> str:
    """A frame's columns and types as JSON text, which a flag holds until the next run."""
    return json.dumps({f.name: f.dataType.simpleString() for f in df.schema})


def snapshot_rows(spark: SparkSession, table: str, snapshot: str) -> DataFrame:
    """The rows of a held snapshot."""
    return spark.createDataFrame([(table, c, t) for c, t in json.loads(snapshot).items()], SCHEMAS)


def flag(spark: SparkSession, job: str, key: str, value: str, ts: str) -> DataFrame:
    """One row of the flags."""
    return spark.createDataFrame([(job, key, value)], "job_name string, key string, value string").withColumn("insertion_timestamp", F.lit(ts).cast("timestamp"))


def schema_drift(before: DataFrame, live: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """(table_name, column_name, change_type, old_type, new_type) between two tables of schemas, for all tables at once."""
    a = before.where(~F.col("column_name").isin(list(ignore))).withColumnRenamed("column_type", "old_type") if ignore else before.withColumnRenamed("column_type", "old_type")
    b = live.where(~F.col("column_name").isin(list(ignore))).withColumnRenamed("column_type", "new_type") if ignore else live.withColumnRenamed("column_type", "new_type")
    both = a.join(b, ["table_name", "column_name"], "full_outer")
    kind = F.when(F.col("old_type").isNull(), "COLUMN_ADDED").when(F.col("new_type").isNull(), "COLUMN_DROPPED").when(F.upper("old_type") != F.upper("new_type"), "TYPE_CHANGED")
    return both.withColumn("change_type", kind).where(F.col("change_type").isNotNull()).select("table_name", "column_name", "change_type", "old_type", "new_type")


def schema_contract(config: DataFrame, live: DataFrame, *, ignore: Sequence[str] = (), halt_on: Sequence[str] = ("COLUMN_DROPPED", "TYPE_CHANGED")) -> tuple[DataFrame, list[str]]:
    """Drift of live schemas from the declared ones, and why to halt, a line for each column (logged first by the caller)."""
    drift = schema_drift(config, live, ignore)
    return drift, [f"{r.table_name}.{r.column_name}: {r.change_type}" for r in drift.where(F.col("change_type").isin(list(halt_on))).orderBy("table_name", "column_name").toLocalIterator()]
