"""Merges of a current-state table, as joins and unions: plain Parquet has no MERGE."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _on(a: DataFrame, b: DataFrame, keys: Sequence[str], null_safe: bool) -> list[Column]:
    return [a[k].eqNullSafe(b[f"_src_{k}"]) if null_safe else a[k] == b[f"_src_{k}"] for k in keys]


def _source_keys(source: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    return source.select(*[F.col(k).alias(f"_src_{k}") for k in keys], *more)


def apply_changes(target: DataFrame, source: DataFrame, keys: Sequence[str], delete_when: str | Column, *, null_safe: bool = True) -> DataFrame:
    """target after upserts and deletes by key; source has one row a key. A delete of an unknown key does nothing."""
    gone = F.coalesce(F.expr(delete_when) if isinstance(delete_when, str) else delete_when, F.lit(False))
    touched = _source_keys(source, keys)
    kept = target.join(touched, _on(target, touched, keys, null_safe), "left_anti")
    return kept.unionByName(source.where(~gone).select(*target.columns))


def merge_metrics(target: DataFrame, source: DataFrame, keys: Sequence[str], delete_when: str | Column) -> DataFrame:
    """(action, rows): what the merge inserts, updates and deletes, zeros included."""
    gone = F.coalesce(F.expr(delete_when) if isinstance(delete_when, str) else delete_when, F.lit(False))
    of = _source_keys(source, keys, gone.alias("_gone"))
    marked = target.select(*keys, F.lit(True).alias("_there"))
    there = F.coalesce(F.col("_there"), F.lit(False))
    joined = of.join(marked, _on(marked, of, keys, True), "left")
    one = joined.agg(F.count_if(~there & ~F.col("_gone")).alias("INSERT"), F.count_if(there & ~F.col("_gone")).alias("UPDATE"), F.count_if(there & F.col("_gone")).alias("DELETE"))
    return one.select(F.explode(F.create_map(*[x for k in ("INSERT", "UPDATE", "DELETE") for x in (F.lit(k), F.col(k))])).alias("action", "rows"))


def duplicate_sources(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, copies) of the keys that a merge's source has more than once."""
    return source.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def guard_source(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """source, if it has one row a key; else an error."""
    some = duplicate_sources(source, keys).limit(3).collect()
    if some:
        raise ValueError(f"the source of the merge has keys more than once: {[tuple(r) for r in some]}")
    return source


def full_snapshot_merge(target: DataFrame, snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge of a complete snapshot: (columns, _merge_action); keys that it lacks are deletes. Never for a batch of changes."""
    b = snapshot.select(*[F.col(c).alias(f"_src_{c}") for c in target.columns], F.lit(True).alias("_src"))
    a = target.withColumn("_tgt", F.lit(True))
    both = a.join(b, _on(a, b, keys, True), "full_outer")
    same = F.lit(True)
    for c in target.columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_src_{c}"))
    action = F.when(F.col("_src").isNull(), "DELETE").when(F.col("_tgt").isNull(), "INSERT").when(same, "NONE").otherwise("UPDATE")
    return both.withColumn("_merge_action", action).select(*[F.when(F.col("_src").isNull(), F.col(c)).otherwise(F.col(f"_src_{c}")).alias(c) for c in target.columns], "_merge_action")
