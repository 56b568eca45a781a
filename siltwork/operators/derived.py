"""Published tables that are joined or aggregated from others."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.functions.money import average, cents, total
from siltwork.operators.deltas import on_keys, only
from siltwork.operators.merge import apply_changes


def derived_sql(spark: SparkSession, text: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """A table's SQL text over frames named in braces."""
    return spark.sql(text, **tables)


def transaction_detail(transaction: DataFrame, position: DataFrame, owner: DataFrame, asset: DataFrame) -> DataFrame:
    """Each transaction with its position, owner and asset. The facts join first; the optimizer broadcasts what is small."""
    t, p = transaction, position.select(F.col("entity_master_position_id").alias("position_id"), "owner_id", "asset_id")
    o = owner.select(F.col("entity_master_owner_id").alias("owner_id"), "owner_name")
    a = asset.select(F.col("entity_master_asset_id").alias("asset_id"), "asset_name", "asset_type")
    joined = t.join(p, "position_id").join(o, "owner_id").join(a, "asset_id")
    return joined.select("transaction_id", "trade_date", "transaction_type", "amount", "currency", "position_id", "owner_id", "owner_name", "asset_id", "asset_name", "asset_type")


def order_status_summary(orders: DataFrame) -> DataFrame:
    return orders.groupBy("status").agg(F.count("*").alias("order_count"), total(F.col("amount")).alias("total_amount"), average(F.col("amount")).alias("avg_amount"))


def owner_exposure(transaction: DataFrame, position: DataFrame, owner: DataFrame) -> DataFrame:
    """Per owner. Transactions are summed per position before the joins, so a busy owner's rows shrink first."""
    per = transaction.groupBy("position_id").agg(F.count("*").alias("n"), F.sum(cents(F.col("amount"))).alias("c"), F.count("amount").alias("k"), F.max("trade_date").alias("d"))
    of = position.select(F.col("entity_master_position_id").alias("position_id"), "owner_id")
    names = owner.select(F.col("entity_master_owner_id").alias("owner_id"), "owner_name")
    sums = per.join(of, "position_id").groupBy("owner_id").agg(F.sum("n").alias("txn_count"), F.sum("c").alias("c"), F.sum("k").alias("k"), F.max("d").alias("last_trade_date"))
    mean = F.signum(F.col("c").cast("double")) * F.floor((2 * F.abs("c") + F.col("k")).cast("double") / (2 * F.col("k")).cast("double")) / 100
    return sums.join(names, "owner_id").select("owner_id", "owner_name", "txn_count", (F.col("c").cast("double") / 100).alias("total_amount"), mean.alias("avg_amount"), "last_trade_date")


def customer_sales(sales: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Orders with customers and products, per customer and region."""
    joined = sales.join(customers, "customer_id").join(products, "product_id")
    return joined.groupBy("customer_id", "region").agg(F.count("*").alias("order_count"), total(F.col("quantity") * F.col("unit_price")).alias("total_sales"))


def recompute_changed_groups(base: DataFrame, current: DataFrame, changed: DataFrame, keys: Sequence[str], aggregate: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """current (an aggregate of an older base) after recomputing only the groups that changes touched.

    A touched group without rows left goes; a NULL key is a group. ``aggregate`` maps base rows to rows of current's columns.
    """
    touched = changed.select(*keys).distinct()
    fresh = aggregate(only(base, touched, keys))
    marks = fresh.select(*[F.col(k).alias(f"_new_{k}") for k in keys], *[c for c in fresh.columns if c not in keys], F.lit(True).alias("_alive"))
    source = touched.join(marks, on_keys(touched, marks, keys, "_new_"), "left")
    return apply_changes(current, source, keys, F.col("_alive").isNull())


def quality_kpis(flagged: DataFrame, by: Sequence[str], incomplete: str, at: str) -> DataFrame:
    """Per dimension: incomplete records, the share of complete ones in percent, and the latest time."""
    n, bad = F.count("*"), F.count_if(F.col(incomplete))
    share: Column = F.floor((n - bad) * 10000 / n) / 100
    return flagged.groupBy(*by).agg(bad.alias("incomplete_records"), share.alias("data_quality_pct"), F.max(at).alias("latest_data_at"))
