"""Change feeds: rows with ``_change_type`` (insert, update_postimage, delete), ``_commit_version`` and more."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltwork.functions.hashing import row_hash

CHANGE_TYPE, VERSION = "_change_type", "_commit_version"
INSERT, UPDATE, DELETE = "insert", "update_postimage", "delete"


def priority(change_type: str = CHANGE_TYPE) -> Column:
    return F.when(F.col(change_type) == DELETE, 3).when(F.col(change_type) == UPDATE, 2).otherwise(1)


def read_changes(feed: DataFrame, from_version: int | None, to_version: int) -> DataFrame:
    """Changes with a version in (from, to], without preimages. On a feed partitioned by version this prunes files."""
    rows = feed.where((F.col(VERSION) <= to_version) & F.col(CHANGE_TYPE).isin(INSERT, UPDATE, DELETE))
    return rows if from_version is None else rows.where(F.col(VERSION) > from_version)


def snapshot_as_changes(snapshot: DataFrame, version: int) -> DataFrame:
    """A whole table as inserts at one version: what a reader without a watermark gets."""
    return snapshot.withColumns({CHANGE_TYPE: F.lit(INSERT), VERSION: F.lit(version).cast("long")})


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], version: int, exclude: Sequence[str] = ()) -> DataFrame:
    """The change feed between two snapshots: one full outer join on the keys, NULL keys alike, rows compared by hash."""
    columns = new.columns
    business = [c for c in columns if c not in exclude]
    a = old.select(*[F.col(c).alias(f"_old_{c}") for c in columns], row_hash(business).alias("_old_hash"))
    b = new.select(*columns, row_hash(business).alias("_new_hash"))
    on = [b[k].eqNullSafe(a[f"_old_{k}"]) for k in keys]
    kind = F.when(F.col("_new_hash").isNull(), DELETE).when(F.col("_old_hash").isNull(), INSERT).when(F.col("_old_hash") != F.col("_new_hash"), UPDATE)
    both = b.join(a, on, "full_outer").withColumn(CHANGE_TYPE, kind).where(F.col(CHANGE_TYPE).isNotNull())
    gone = F.col(CHANGE_TYPE) == DELETE
    return both.select(*[F.when(gone, F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c) for c in columns], CHANGE_TYPE, F.lit(version).cast("long").alias(VERSION))


def latest_per_key(changes: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """The last change of each key: by version, then by priority, then by further order columns.

    The filter on the rank stands right on the window, so each task keeps one row a key before the shuffle.
    """
    by = list(order) if order is not None else [F.desc(VERSION), priority().desc()]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    return changes.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")
