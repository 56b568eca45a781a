"""SCD2 history: each version of a row with the time that it was valid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltwork.functions.hashing import row_hash
from siltwork.operators.changes import CHANGE_TYPE, DELETE, latest_per_key

FROM, TO, CURRENT, HASH, INGESTED = "_bronze_valid_from", "_bronze_valid_to", "_bronze_is_current", "_bronze_hash", "_bronze_ingested_at"
NEW, CHANGED, DELETED, UNCHANGED = "NEW", "CHANGED", "DELETED", "UNCHANGED"
#: What a run made of a row.
KIND, KEPT, OPENED, CLOSED = "_kind", "kept", "opened", "closed"


def moment(ts: str | Column) -> Column:
    return F.lit(ts).cast("timestamp") if isinstance(ts, str) else ts


def bootstrap(snapshot: DataFrame, business: Sequence[str], ts: str | Column, exclude: Sequence[str] = ()) -> DataFrame:
    """First load: every row is an open version from ``ts``."""
    return snapshot.select(
        *business,
        moment(ts).alias(FROM),
        F.lit(None).cast("timestamp").alias(TO),
        F.lit(True).alias(CURRENT),
        row_hash(business, exclude).alias(HASH),
        moment(ts).alias(INGESTED),
    )


def current_rows(history: DataFrame) -> DataFrame:
    return history.where(F.col(CURRENT))


def classify(changes: DataFrame, history: DataFrame, keys: Sequence[str], business: Sequence[str], exclude: Sequence[str] = ()) -> DataFrame:
    """The last change of each key with ``_action`` and its hash, against the current versions. NULL keys match NULL keys."""
    latest = latest_per_key(changes, keys).withColumn(HASH, row_hash(business, exclude))
    now = current_rows(history).select(*[F.col(k).alias(f"_now_{k}") for k in keys], F.col(HASH).alias("_now_hash"))
    action = F.when(F.col(CHANGE_TYPE) == DELETE, DELETED).when(F.col("_now_hash").isNull(), NEW).when(F.col("_now_hash") != F.col(HASH), CHANGED).otherwise(UNCHANGED)
    joined = latest.join(now, [latest[k].eqNullSafe(now[f"_now_{k}"]) for k in keys], "left")
    return joined.withColumn("_action", action).drop("_now_hash", *[f"_now_{k}" for k in keys])


def close(history: DataFrame, close_keys: DataFrame, keys: Sequence[str], ts: str | Column) -> DataFrame:
    """history with the current versions of the (distinct) keys closed at ``ts``. NULL keys match NULL keys."""
    marks = close_keys.select(*[F.col(k).alias(f"_close_{k}") for k in keys]).distinct().withColumn("_close", F.lit(True))
    # Closed versions can't be closed again: they need no join.
    is_now = current_rows(history)
    joined = is_now.join(marks, [is_now[k].eqNullSafe(marks[f"_close_{k}"]) for k in keys], "left")
    shut = F.coalesce(F.col("_close"), F.lit(False))
    closed = joined.withColumns({TO: F.when(shut, moment(ts)).otherwise(F.col(TO)), CURRENT: ~shut}).select(*history.columns)
    return closed.unionByName(history.where(~F.col(CURRENT)))


def apply(history: DataFrame, changes: DataFrame, keys: Sequence[str], business: Sequence[str], ts: str | Column, exclude: Sequence[str] = ()) -> DataFrame:
    """One run: closes what changed or went, opens what changed or is new, at one time. Applying it again changes nothing."""
    return run(current_rows(history), changes, keys, business, ts, exclude).drop(KIND).unionByName(history.where(~F.col(CURRENT)))


def run(current: DataFrame, changes: DataFrame, keys: Sequence[str], business: Sequence[str], ts: str | Column, exclude: Sequence[str] = ()) -> DataFrame:
    """The current rows after one run and the rows that it closed, with ``_kind``: kept, opened or closed.

    One full outer join of the current rows with the last change of each key; a pair gives the closed and the opened row.
    """
    types = {f.name: f.dataType for f in current.schema}
    opened = bootstrap(latest_per_key(changes, keys).withColumn("_type", F.col(CHANGE_TYPE)), [*business, "_type"], ts, [*exclude, "_type"])
    row = lambda kind: F.struct(*[F.col(c).cast(types[c]).alias(c) for c in current.columns], F.lit(kind).alias(KIND))
    now = current.select(row(KEPT).alias("_now"), *[F.col(k).alias(f"_now_{k}") for k in keys])
    new = opened.select(row(OPENED).alias("_new"), "_type", *[F.col(k).alias(f"_new_{k}") for k in keys])
    both = now.join(new, [now[f"_now_{k}"].eqNullSafe(new[f"_new_{k}"]) for k in keys], "full_outer")
    gone = F.col("_type") == DELETE
    differs = F.col("_now").isNotNull() & (gone | (F.col(f"_now.{HASH}") != F.col(f"_new.{HASH}")))
    shut = F.col("_now").withField(TO, moment(ts).cast(types[TO])).withField(CURRENT, F.lit(False)).withField(KIND, F.lit(CLOSED))
    before = F.when(F.coalesce(differs, F.lit(False)), shut).otherwise(F.col("_now"))
    after = F.when(~gone & (F.col("_now").isNull() | differs), F.col("_new"))
    return both.select(F.explode(F.array_compact(F.array(before, after))).alias("_r")).select("_r.*")


def history_view(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Versions of each key, numbered from the oldest."""
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(FROM, HASH))
    return history.select(*keys, F.col(FROM).alias("effective_from"), F.col(TO).alias("effective_to"), F.col(CURRENT).alias("is_current_version"), number.alias("version_number"))


def version_lifetime(history: DataFrame, keys: Sequence[str], as_of: str | Column) -> DataFrame:
    """Seconds that each version was valid, open ones up to ``as_of``."""
    seconds = F.unix_timestamp(F.coalesce(F.col(TO), moment(as_of))) - F.unix_timestamp(FROM)
    return history.select(*keys, F.col(FROM).alias("valid_from"), seconds.alias("seconds"))


def mass_closure(history: DataFrame, window: int = 7, factor: float = 3.0) -> DataFrame:
    """Rows closed at each time, and whether they are more than ``factor`` times the mean of the ``window`` times before.

    The window without a partition is over one row for each run, not over the history.
    """
    counts = history.where(F.col(TO).isNotNull()).groupBy(F.col(TO).alias("closed_at")).agg(F.count("*").alias("closed"))
    before = Window.orderBy("closed_at").rowsBetween(-window, -1)
    rows = counts.withColumns({"_sum": F.sum("closed").over(before), "_n": F.count("closed").over(before)})
    spike = F.coalesce(F.col("closed") * F.col("_n") > F.lit(factor) * F.col("_sum"), F.lit(False))
    return rows.select("closed_at", "closed", spike.alias("is_spike"))


def synthetic_key(rows: DataFrame, business: Sequence[str]) -> DataFrame:
    """rows without a primary key, keyed by their hash and the number of their copies: one row of each."""
    return rows.withColumn("row_key", row_hash(business)).groupBy("row_key", *business).agg(F.count("*").alias("copies"))
