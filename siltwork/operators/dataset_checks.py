"""Checks that need all rows. Each adds one boolean column, true where a row (or its group) fails; no row is added or lost."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltwork.functions.checks import differs
from siltwork.sources.scratch import written

DATASET_CHECKS: dict[str, Callable[..., DataFrame]] = {}


def check(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    DATASET_CHECKS[f.__name__] = f
    return f


def aggregate(aggr_type: str, column: str) -> Column:
    """One of count, count_distinct, sum, avg, min, max, stddev over a column or ``*``; medians are no plain aggregate here (``aggregated``)."""
    if column == "*":
        return F.count("*")
    kinds = {"count": F.count, "count_distinct": F.countDistinct, "sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "stddev": F.stddev}
    return kinds[aggr_type](F.expr(column))


def _histogram(df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """(keys, _x, _n): each group's different values; NULL and NaN are none."""
    rows = df.select(*keys, value.cast("double").alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    return rows.groupBy(*keys, "_x").agg(F.count("*").alias("_n"))


def _middles(histogram: DataFrame, keys: Sequence[str], into: str) -> DataFrame:
    """(keys, into): the median of each group of a histogram, by rank selection.

    The different values are put in order over all tasks, by group and value, so a large group lies in many partitions.
    A row for each group and partition tells how many values come before it, and so which one or two partitions hold the
    group's middle ranks; only these slices are counted through. No task sees all values of a group, nor of the table.
    """
    ranged = histogram.repartitionByRange(*keys, "_x").withColumn("_p", F.spark_partition_id())
    ranged = written(ranged, "ranks")  # the numbers of partitions hold for all that follows
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("_m").over(group.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = ranged.groupBy(*keys, "_p").agg(F.sum("_n").alias("_m"))
    sizes = sizes.withColumns({"_before": before, "_total": F.sum("_m").over(group)})
    sizes = sizes.withColumns({"_low": F.expr("(_total - 1) div 2"), "_high": F.expr("_total div 2")})
    wanted = sizes.where((F.col("_before") <= F.col("_high")) & (F.col("_before") + F.col("_m") > F.col("_low")))
    wanted = wanted.select(*[F.col(k).alias(f"_w_{k}") for k in keys], F.col("_p").alias("_w_p"), "_before", "_low", "_high")
    slices = ranged.join(wanted, [ranged["_p"] == wanted["_w_p"], *[ranged[k].eqNullSafe(wanted[f"_w_{k}"]) for k in keys]])
    upto = F.col("_before") + F.sum("_n").over(Window.partitionBy(*keys, "_p").orderBy("_x"))
    placed = slices.withColumn("_upto", upto)
    at = lambda rank: F.max(F.when((F.col("_upto") > F.col(rank)) & (F.col("_upto") - F.col("_n") <= F.col(rank)), F.col("_x")))
    return placed.groupBy(*keys).agg(((at("_low") + at("_high")) / 2).alias(into))


def medians(df: DataFrame, keys: Sequence[str], column: str | Column, into: str = "_value") -> DataFrame:
    """(keys, into): exact medians of groups, NULL keys too; a group without values has NULL."""
    value = F.expr(column) if isinstance(column, str) else column
    found = _middles(_histogram(df, keys, value), keys, into)
    if not keys:
        return found
    groups = df.select(*[F.col(k).alias(f"_g_{k}") for k in keys]).distinct()
    return groups.join(found, [groups[f"_g_{k}"].eqNullSafe(found[k]) for k in keys], "left").select(*[F.col(f"_g_{k}").alias(k) for k in keys], into)


def exact_median(values: DataFrame, column: str) -> float | None:
    """The median of a column, nulls and NaN left out; of an even number of values the mean of the middle two, which for two infinities of unlike sign is NaN."""
    found = _middles(_histogram(values, [], F.col(column)), [], "m").first()
    return found[0] if found else None


def aggregated(df: DataFrame, keys: Sequence[str], aggr_type: str, column: str, into: str = "_value") -> DataFrame:
    """(keys, into): an aggregate of groups, or one row without keys."""
    if aggr_type == "median" and column != "*":
        return medians(df, keys, column, into)
    return df.groupBy(*keys).agg(aggregate(aggr_type, column).alias(into))


def _marked(df: DataFrame, bad: DataFrame, keys: Sequence[str], into: str, *, null_safe: bool = True) -> DataFrame:
    """df with ``into`` true on the rows whose keys are in bad (keys, distinct)."""
    marks = bad.select(*[F.col(k).alias(f"_bad_{k}") for k in keys]).withColumn("_bad", F.lit(True))
    on = [df[k].eqNullSafe(marks[f"_bad_{k}"]) if null_safe else df[k] == marks[f"_bad_{k}"] for k in keys]
    return df.join(marks, on, "left").withColumn(into, F.coalesce("_bad", F.lit(False))).drop("_bad", *[f"_bad_{k}" for k in keys])


@check
def is_unique(df: DataFrame, into: str, columns: Sequence[str], nulls_distinct: bool = True) -> DataFrame:
    """Only the keys are grouped; the few that repeat are joined back."""
    rows = df.dropna(subset=list(columns)) if nulls_distinct else df
    twice = rows.groupBy(*columns).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    return _marked(df, twice, columns, into, null_safe=not nulls_distinct)


@check
def foreign_key(df: DataFrame, into: str, columns: Sequence[str], ref: DataFrame, ref_columns: Sequence[str], negate: bool = False, null_safe: bool = False) -> DataFrame:
    """Rows whose parent is missing (negate: there). Rows with a NULL key pass unless null_safe."""
    parents = ref.select(*[F.col(r).alias(f"_ref_{k}") for k, r in zip(columns, ref_columns, strict=True)])
    if not null_safe:
        parents = parents.dropna()
    parents = parents.distinct().withColumn("_parent", F.lit(True))
    on = [df[k].eqNullSafe(parents[f"_ref_{k}"]) if null_safe else df[k] == parents[f"_ref_{k}"] for k in columns]
    there, known = F.col("_parent").isNotNull(), F.lit(True)
    if not null_safe:
        for k in columns:
            known = known & F.col(k).isNotNull()
    return df.join(parents, on, "left").withColumn(into, (there if negate else ~there) & known).drop("_parent", *[f"_ref_{k}" for k in columns])


def _aggregated(df: DataFrame, into: str, column: str, aggr_type: str, group_by: Sequence[str] | None, fails: Callable[[Column], Column]) -> DataFrame:
    groups = aggregated(df, list(group_by or ()), aggr_type, column)
    if not group_by:  # one row: a value that the plan reads once, no join
        return df.withColumn(into, F.coalesce(groups.agg(F.first(F.coalesce(fails(F.col("_value")), F.lit(False)))).scalar(), F.lit(False)))
    return _marked(df, groups.where(fails(F.col("_value"))), list(group_by), into)


@check
def is_aggr_not_greater_than(df: DataFrame, into: str, column: str, limit: float, aggr_type: str = "count", group_by: Sequence[str] | None = None) -> DataFrame:
    return _aggregated(df, into, column, aggr_type, group_by, lambda v: v > limit)


@check
def is_aggr_not_less_than(df: DataFrame, into: str, column: str, limit: float, aggr_type: str = "count", group_by: Sequence[str] | None = None) -> DataFrame:
    return _aggregated(df, into, column, aggr_type, group_by, lambda v: v < limit)


@check
def is_aggr_equal(df: DataFrame, into: str, column: str, limit: float, aggr_type: str = "count", group_by: Sequence[str] | None = None, abs_tolerance: float | None = None, rel_tolerance: float | None = None) -> DataFrame:
    return _aggregated(df, into, column, aggr_type, group_by, lambda v: differs(v, F.lit(limit), abs_tolerance, rel_tolerance))


@check
def is_aggr_not_equal(df: DataFrame, into: str, column: str, limit: float, aggr_type: str = "count", group_by: Sequence[str] | None = None, abs_tolerance: float | None = None, rel_tolerance: float | None = None) -> DataFrame:
    return _aggregated(df, into, column, aggr_type, group_by, lambda v: ~differs(v, F.lit(limit), abs_tolerance, rel_tolerance))


@check
def has_no_outliers(df: DataFrame, into: str, column: str, threshold: float = 3.5) -> DataFrame:
    """Modified z-score ``0.6745 * |x - median| / MAD`` over the threshold, by exact medians."""
    counts = written(_histogram(df, [], F.col(column)), "outliers")
    m = _middles(counts, [], "m").first()
    # Deviations come from the different values, not from the rows again.
    off = None if m is None else counts.select(F.abs(F.col("_x") - m[0]).alias("_x"), "_n").where(~F.isnan("_x")).groupBy("_x").agg(F.sum("_n").alias("_n"))
    mad = None if off is None else _middles(off, [], "m").first()
    m, mad = (None if r is None else r[0] for r in (m, mad))
    if not mad or not (math.isfinite(m) and math.isfinite(mad)):  # no spread, or none that can be measured
        return df.withColumn(into, F.lit(False))
    return df.withColumn(into, F.coalesce(0.6745 * F.abs(F.col(column) - m) / mad > threshold, F.lit(False)))


@check
def has_no_aggr_outliers(
    df: DataFrame, into: str, column: str, time_column: str, aggr_type: str = "sum", sigma: float = 3.0, lookback_num_intervals: int = 14, warmup_num_intervals: int = 7, time_interval: str = "day"
) -> DataFrame:
    """Rows of time buckets whose aggregate is off the mean of the buckets before by more than sigma deviations.

    The window without a partition is over one row for each bucket. The buckets that fail are written first: their size
    is known then, so the rows need no shuffle to meet a few of them.
    """
    bucket = F.date_trunc(time_interval, F.col(time_column).cast("timestamp"))
    buckets = aggregated(df.where(F.col(time_column).isNotNull()).withColumn("_bucket", bucket), ["_bucket"], aggr_type, column)
    before = Window.orderBy("_bucket").rowsBetween(-lookback_num_intervals, -1)
    base = buckets.withColumns({"_mean": F.avg("_value").over(before), "_sd": F.stddev("_value").over(before), "_n": F.count("_value").over(before)})
    bad = base.where((F.col("_n") >= warmup_num_intervals) & (F.abs(F.col("_value") - F.col("_mean")) > sigma * F.col("_sd")))
    return _marked(df.withColumn("_bucket", bucket), written(bad.select("_bucket"), "buckets"), ["_bucket"], into, null_safe=False).drop("_bucket")


def rolling_baseline(df: DataFrame, column: str, time_column: str, lookback: int, time_interval: str = "day") -> DataFrame:
    """(bucket, total, mean and n of the buckets before it)."""
    bucket = F.date_trunc(time_interval, F.col(time_column))
    buckets = df.groupBy(bucket.alias("bucket")).agg(F.sum(column).alias("total"))
    before = Window.orderBy("bucket").rowsBetween(-lookback, -1)
    return buckets.withColumns({"mean_before": F.avg("total").over(before), "n_before": F.count("total").over(before)})


def windows_filled(df: DataFrame, column: str, window_minutes: int, group_by: Sequence[str] = ()) -> DataFrame:
    """(group, window_start, n) of the windows that have rows."""
    start = F.window(F.col(column), f"{window_minutes} minutes").start
    return df.where(F.col(column).isNotNull()).groupBy(*group_by, start.alias("window_start")).agg(F.count("*").alias("n"))


def is_data_fresh_per_time_window(df: DataFrame, column: str, window_minutes: int, min_records_per_window: int, lookback_windows: int | None = None, curr_timestamp: Any = None) -> DataFrame:
    """(window_start, n) of windows from the first to the last (or the last few before now) with too few rows, empty ones included."""
    filled = windows_filled(df, column, window_minutes)
    step, size = F.expr(f"interval {window_minutes} minutes"), 60 * window_minutes
    last = F.max("window_start")
    if curr_timestamp is not None:
        now = F.unix_timestamp(F.lit(curr_timestamp).cast("timestamp"))
        last = F.max(F.timestamp_seconds(F.floor(now / size) * size))
    first = F.min("window_start") if lookback_windows is None else last - F.expr(f"interval {window_minutes * (lookback_windows - 1)} minutes")
    spine = filled.agg(F.sequence(first, last, step).alias("s")).select(F.explode("s").alias("window_start"))
    counted = spine.join(filled, "window_start", "left").select("window_start", F.coalesce("n", F.lit(0)).alias("n"))
    return counted.where(F.col("n") < min_records_per_window)


def has_no_gaps_per_time_window(df: DataFrame, column: str, window_minutes: int, group_by: Sequence[str] = (), trailing_gap_until: Any = None) -> DataFrame:
    """(group, gap_after, next_window, empty_windows): runs of empty windows between filled ones; with a time, also the last run up to it."""
    filled = windows_filled(df, column, window_minutes, group_by)
    lead = F.lead("window_start").over(Window.partitionBy(*group_by).orderBy("window_start"))
    if trailing_gap_until is not None:
        lead = F.coalesce(lead, F.timestamp_seconds(F.floor(F.unix_timestamp(F.lit(trailing_gap_until).cast("timestamp")) / (60 * window_minutes)) * 60 * window_minutes))
    rows = filled.withColumn("next_window", lead)
    empty = (F.unix_timestamp("next_window") - F.unix_timestamp("window_start")) / (60 * window_minutes) - 1
    return rows.withColumn("empty_windows", empty.cast("long")).where(F.col("empty_windows") > 0).select(*group_by, F.col("window_start").alias("gap_after"), "next_window", "empty_windows")


@check
def has_valid_schema(df: DataFrame, into: str, expected_schema: str | T.StructType, strict: bool = False, exclude_columns: Sequence[str] = ()) -> DataFrame:
    """All rows fail or none: expected columns and types are there; strict: no other ones, in order."""
    want = expected_schema if isinstance(expected_schema, T.StructType) else T.StructType.fromDDL(expected_schema)
    want = [(f.name, f.dataType.simpleString()) for f in want if f.name not in exclude_columns]
    have = [(f.name, f.dataType.simpleString()) for f in df.schema if f.name not in exclude_columns]
    ok = want == have if strict else set(want) <= set(have)
    return df.withColumn(into, F.lit(not ok))


@check
def sql_query(df: DataFrame, into: str, query: str, condition_column: str, merge_columns: Sequence[str] | None = None, negate: bool = False) -> DataFrame:
    """A query over ``{input_view}`` tells by its condition column which keys fail; without merge columns all rows do or none."""
    found = df.sparkSession.sql(query.replace("{{ input_view }}", "{input_view}"), input_view=df)
    bad = found.where(~F.col(condition_column) if negate else F.col(condition_column))
    if not merge_columns:
        return df.withColumn(into, bad.agg(F.count("*") > 0).scalar())
    return _marked(df, bad.select(*merge_columns).distinct(), list(merge_columns), into)


#: Rows of a code table up to which it is broadcast.
BROADCAST_CODES = 100_000


@check
def is_valid_code(df: DataFrame, into: str, column: str, ref: DataFrame, code_column: str, country_column: str | None = None, ref_country_column: str | None = None, case_sensitive: bool = True) -> DataFrame:
    """Rows whose code is not in a code table, or is there under another country than the row's; NULL codes and countries pass.

    The table is counted first: up to BROADCAST_CODES rows it goes to the rows, a larger one is joined by a shuffle.
    """
    fold = (lambda c: c) if case_sensitive else F.lower
    parts = [(column, code_column), *([(country_column, ref_country_column)] if country_column else [])]
    codes = ref.select(*[fold(F.col(r).cast("string")).alias(f"_code{i}") for i, (_, r) in enumerate(parts)]).dropna().distinct().withColumn("_there", F.lit(True))
    if codes.count() <= BROADCAST_CODES:
        codes = F.broadcast(codes)
    known = F.lit(True)
    for c, _ in parts:
        known = known & F.col(c).isNotNull()
    found = df.join(codes, [fold(F.col(c).cast("string")) == F.col(f"_code{i}") for i, (c, _) in enumerate(parts)], "left")
    return found.withColumn(into, F.col("_there").isNull() & known).drop("_there", *[f"_code{i}" for i in range(len(parts))])


@check
def dup_over_partition(df: DataFrame, into: str, columns: Sequence[str]) -> DataFrame:
    """``count(*) over (partition by ...) > 1``, written as a group of the keys and a join back."""
    return is_unique(df, into, columns, nulls_distinct=False)
