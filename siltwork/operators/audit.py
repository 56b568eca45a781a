"""The audit log: what was written to which table, how many rows, whether it went well and how long it took."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.functions.hashing import log_id

MERGE_ACTIONS = ("merge_insert", "merge_update", "merge_delete")
MAX_MESSAGE = 4000


def _stamped(rows: DataFrame, ts: str, run_id: str | None) -> DataFrame:
    rows = rows.withColumns({"event_timestamp": F.lit(ts).cast("timestamp"), "run_id": F.lit(run_id).cast("string"), "actor": F.current_user()})
    return rows.withColumn("audit_id", log_id("table_name", "action", "status", "actor", "event_timestamp"))


def entry(spark: SparkSession, table: str, action: str, rows: int, ts: str, *, status: str = "success", duration_ms: int = 0, error: BaseException | None = None, run_id: str | None = None) -> DataFrame:
    """One row of the log."""
    values = [(table, action, rows, status, type(error).__name__ if error else None, str(error)[:MAX_MESSAGE] if error else None, duration_ms)]
    return _stamped(spark.createDataFrame(values, "table_name string, action string, row_count long, status string, error_type string, error_message string, duration_ms long"), ts, run_id)


def merge_entries(metrics: DataFrame, table: str, ts: str, *, run_id: str | None = None) -> DataFrame:
    """Three rows for a merge from its metrics (action, rows), zeros included, so that a quiet run shows."""
    none = F.lit(None).cast("string")
    rows = metrics.select(F.lit(table).alias("table_name"), F.concat(F.lit("merge_"), F.lower("action")).alias("action"), F.col("rows").cast("long").alias("row_count"), F.lit("success").alias("status"), none.alias("error_type"), none.alias("error_message"), F.lit(0).cast("long").alias("duration_ms"))
    return _stamped(rows, ts, run_id)


def refresh_entry(spark: SparkSession, table: str, rows: int, ts: str) -> DataFrame:
    """One row of the refresh log, which freshness is measured by."""
    return spark.createDataFrame([(table, rows)], "object_fqn string, row_count long").withColumn("refreshed_at", F.lit(ts).cast("timestamp"))
