"""Comparisons of two tables.

``differing`` finds where two tables differ without a shuffle of their rows: each side is summed up by ranges of a hash of
the keys, in digests that do not depend on the order of the rows, and only ranges whose digests differ are looked into,
first by finer ranges, then row by row. What is shuffled is one row a task and range, however large the tables are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltwork.functions.checks import differs
from siltwork.operators.dataset_checks import aggregated


def compare_datasets(
    df: DataFrame, ref: DataFrame, columns: Sequence[str], ref_columns: Sequence[str] | None = None, *, check_missing_records: bool = True, exclude_columns: Sequence[str] = (), abs_tolerance: float | None = None, rel_tolerance: float | None = None
) -> DataFrame:
    """(keys, status, changed): rows that differ. status: extra (not in ref), missing (in ref only) or changed; changed: per column as JSON."""
    ref_columns = list(ref_columns or columns)
    numeric = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float", "integer", "long", "short", "byte") or f.dataType.typeName() == "decimal"}
    compared = [c for c in df.columns if c not in columns and c not in exclude_columns and c in ref.columns]
    a = df.select(*columns, *compared, F.lit(True).alias("_a"))
    b = ref.select(*[F.col(r).alias(f"_ref_{k}") for k, r in zip(columns, ref_columns, strict=True)], *[F.col(c).alias(f"_ref_{c}") for c in compared], F.lit(True).alias("_b"))
    both = a.join(b, [a[k].eqNullSafe(b[f"_ref_{k}"]) for k in columns], "full_outer" if check_missing_records else "left")

    def changed(c: str) -> Column:
        x, y = F.col(c), F.col(f"_ref_{c}")
        if c in numeric and (abs_tolerance or rel_tolerance):
            return F.coalesce(differs(x.cast("double"), y.cast("double"), abs_tolerance, rel_tolerance), ~x.eqNullSafe(y))
        return ~x.eqNullSafe(y)

    detail = F.map_from_entries(F.filter(F.array(*[F.when(changed(c), F.struct(F.lit(c).alias("c"), F.struct(F.col(c).cast("string").alias("df"), F.col(f"_ref_{c}").cast("string").alias("ref")).alias("d"))) for c in compared]).cast("array<struct<c:string,d:struct<df:string,ref:string>>>"), lambda x: x.isNotNull()))
    rows = both.withColumn("_detail", detail)
    status = F.when(F.col("_b").isNull(), "extra").when(F.col("_a").isNull(), "missing").when(F.size("_detail") > 0, "changed")
    rows = rows.withColumn("status", status).where(F.col("status").isNotNull())
    return rows.select(*[F.coalesce(F.col(k), F.col(f"_ref_{k}")).alias(k) for k in columns], "status", F.when(F.col("status") == "changed", F.to_json("_detail")).alias("changed"))


#: Ranges of the first level, and finer ranges of each of them.
RANGES = 1024


def _plain(c: Column, kind: T.DataType) -> Column:
    """A column as what a hash takes; values that compare alike give the same."""
    return F.to_json(c) if "map" in kind.simpleString() or kind.typeName() == "variant" else c


def _digests(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """For each range the number of rows, the sum of their hashes and their parity: alike for the same rows in any order."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.sum(F.col("_hash").cast("decimal(38,0)")).alias("s"), F.bit_xor("_hash").alias("x"))


def _unlike(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """The ranges whose digests differ, or that only one side has."""
    of = b.select(*[F.col(c).alias(f"_ref_{c}") for c in b.columns])
    both = a.join(of, [a[c] == of[f"_ref_{c}"] for c in by], "full_outer")
    same = F.lit(True)
    for c in ("n", "s", "x"):
        same = same & F.col(c).eqNullSafe(F.col(f"_ref_{c}"))
    return both.where(~same).select(*[F.coalesce(F.col(c), F.col(f"_ref_{c}")).alias(c) for c in by])


def differing(df: DataFrame, ref: DataFrame, columns: Sequence[str], ref_columns: Sequence[str] | None = None, compared: Sequence[str] | None = None, *, ranges: int = RANGES) -> tuple[DataFrame, DataFrame]:
    """(rows of df, rows of ref) in the ranges of keys where the two differ; no row that differs is left out.

    Rows are told by their keys, NULL keys alike; compared: the columns that count (all that both have, without the keys).
    Each side is read once for the digests, once more for the finer ones if any range differs, and once for what is left.
    At most ``ranges`` numbers of ranges are held on the driver; finer ranges are joined, by size, never collected.
    """
    ref_columns = list(ref_columns or columns)
    compared = [c for c in df.columns if c not in columns and c in ref.columns] if compared is None else list(compared)
    alike = all(df.schema[k].dataType == ref.schema[r].dataType for k, r in zip(columns, ref_columns, strict=True))

    def hashed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        key = F.xxhash64(*[_plain(F.col(k) if alike else F.col(k).cast("string"), rows.schema[k].dataType) for k in keys])
        # A hash skips NULLs, so whether a column is NULL is hashed too.
        parts = [p for c in [*keys, *compared] for p in (F.col(c).isNull(), _plain(F.col(c), rows.schema[c].dataType))]
        rows = rows.withColumns({"_key": key, "_hash": F.xxhash64(*parts)})
        return rows.withColumns({"_range": F.pmod("_key", F.lit(ranges)), "_finer": F.pmod(F.shiftrightunsigned("_key", 20), F.lit(ranges))}).drop("_key")

    a, b = hashed(df, columns), hashed(ref, ref_columns)
    unlike = [r[0] for r in _unlike(_digests(a, ["_range"]), _digests(b, ["_range"]), ["_range"]).collect()]
    if not unlike:
        return df.where(F.lit(False)), ref.where(F.lit(False))
    a, b = (x.where(F.col("_range").isin(unlike)) if len(unlike) < ranges else x for x in (a, b))
    both = ["_range", "_finer"]
    finer = _unlike(_digests(a, both), _digests(b, both), both)
    return tuple(x.join(finer, both, "left_semi").drop("_hash", *both) for x in (a, b))


def compare_by_digest(df: DataFrame, ref: DataFrame, columns: Sequence[str], ref_columns: Sequence[str] | None = None, *, exclude_columns: Sequence[str] = (), ranges: int = RANGES, **how: Any) -> DataFrame:
    """The rows of ``compare_datasets``, of which only ranges of keys with a difference are joined.

    Equal tables shuffle digests only; with changes all over, each finer range holds a change and all rows are joined as
    there. Keys must tell rows apart: where a key stands several times and both sides have the same rows, none is told.
    """
    compared = [c for c in df.columns if c not in columns and c not in exclude_columns and c in ref.columns]
    a, b = differing(df, ref, columns, ref_columns, compared, ranges=ranges)
    return compare_datasets(a, b, columns, ref_columns, exclude_columns=exclude_columns, **how)


def aggr_matches_dataset(df: DataFrame, ref: DataFrame, column: str, ref_column: str | None = None, *, aggr_type: str = "count", group_by: Sequence[str] = (), ref_group_by: Sequence[str] | None = None, abs_tolerance: float | None = None, rel_tolerance: float | None = None) -> DataFrame:
    """(group, value, ref_value) of the groups where the same aggregate of two tables differs or is missing in one."""
    a = aggregated(df, list(group_by), aggr_type, column, "value")
    names = list(ref_group_by or group_by)
    b = aggregated(ref.withColumns({f"_ref_{k}": F.col(r) for k, r in zip(group_by, names, strict=True)}), [f"_ref_{k}" for k in group_by], aggr_type, ref_column or column, "ref_value")
    if not group_by:  # two rows
        a, b, on = a.withColumn("_one", F.lit(1)), b.withColumn("_two", F.lit(1)), [F.col("_one") == F.col("_two")]
    else:
        on = [a[k].eqNullSafe(b[f"_ref_{k}"]) for k in group_by]
    bad = F.coalesce(differs(F.col("value").cast("double"), F.col("ref_value").cast("double"), abs_tolerance, rel_tolerance), ~F.col("value").eqNullSafe(F.col("ref_value")))
    return a.join(b, on, "full_outer").where(bad).select(*[F.coalesce(F.col(k), F.col(f"_ref_{k}")).alias(k) for k in group_by], "value", "ref_value")


def reconcile_layers(layers: Mapping[str, DataFrame], amount: str) -> DataFrame:
    """(layer, n, total_cents) of each layer in one frame."""
    frames = [df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.round(F.col(amount).cast("decimal(18,2)") * 100).cast("long")), F.lit(0)).alias("total_cents")).select(F.lit(name).alias("layer"), "n", "total_cents") for name, df in layers.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
