"""Projections of one layer to the next."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwork.operators import scd2

#: Silver's names for Bronze's lineage columns.
LINEAGE = {scd2.FROM: "_record_effective_date", scd2.INGESTED: "_ingested_at", scd2.HASH: "_row_hash"}
PROCESSED, REFRESHED = "_silver_processed_at", "_gold_refreshed_at"
#: Sensitivities that a published view may show.
PUBLIC = ("public", "confidential")


def silver_rows(bronze: DataFrame, business: Sequence[str], ts: str | Column) -> DataFrame:
    """Bronze rows in Silver's shape; whether they are current is the caller's filter."""
    return bronze.select(*business, *[F.col(a).alias(b) for a, b in LINEAGE.items()], scd2.moment(ts).alias(PROCESSED))


def silver_bootstrap(history: DataFrame, business: Sequence[str], ts: str | Column) -> DataFrame:
    return silver_rows(scd2.current_rows(history), business, ts)


def gold_rows(silver: DataFrame, columns: Sequence[str], formulas: Mapping[str, str], ts: str | Column) -> DataFrame:
    """Columns by name, calculated ones by their formula, and the refresh stamp."""
    return silver.select(*[F.expr(formulas[c]).alias(c) if c in formulas else F.col(c) for c in columns], scd2.moment(ts).alias(REFRESHED))


def enforce_columns(df: DataFrame, declared: Sequence[str]) -> DataFrame:
    """df in the declared order; an error names what is missing or too much."""
    missing, extra = [c for c in declared if c not in df.columns], [c for c in df.columns if c not in declared]
    if missing or extra:
        raise ValueError(f"columns differ from the contract: missing {missing}, extra {extra}")
    return df.select(*declared)


def cast_to_contract(df: DataFrame, types: Mapping[str, str], *, safe: bool = False) -> DataFrame:
    """Each declared column cast to its type; safe: what can't be cast is NULL."""
    enforced = enforce_columns(df, list(types))
    return enforced.select(*[(F.col(c).try_cast(t) if safe else F.col(c).cast(t)).alias(c) for c, t in types.items()])


def scope(predicate: str, scope_filter: str) -> str:
    """A check's predicate (true: pass) that rows outside the scope pass."""
    return f"(NOT coalesce(({scope_filter}), false)) OR ({predicate})"


def project_by_sensitivity(df: DataFrame, tags: Mapping[str, str], allowed: Sequence[str] = PUBLIC) -> DataFrame | None:
    """df without columns whose tag is not allowed, unknown or missing; None if none is left."""
    keep = [c for c in df.columns if tags.get(c) in allowed]
    return df.select(*keep) if keep else None


def publish_decision(wanted: DataFrame, published: DataFrame) -> DataFrame:
    """(object, decision) from (object, hash) of tables and of their views: create, unchanged or update; no hash: update."""
    a, b = wanted.select("object", F.col("hash").alias("_a")), published.select("object", F.col("hash").alias("_b"), F.lit(True).alias("_there"))
    decision = F.when(F.col("_there").isNull(), "create").when(F.col("_a") == F.col("_b"), "unchanged").otherwise("update")
    return a.join(b, "object", "left").select("object", decision.alias("decision"))


def cleanse_text(column: str) -> Column:
    return F.trim(F.upper(F.col(column)))


def missing_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """df with _is_missing_<column> of each column and _is_incomplete."""
    flags = {f"_is_missing_{c}": F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "") for c in columns}
    any_ = F.lit(False)
    for f in flags.values():
        any_ = any_ | f
    return df.withColumns({**flags, "_is_incomplete": any_})


def key_not_null_gate(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))
