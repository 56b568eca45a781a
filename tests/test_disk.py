"""What jobs leave on disk and send through shuffles, and odd rows through the queries that go by whole-number keys."""

import os
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from siltwork.operators import dataset_checks
from siltwork.plans import queries as registry
from siltwork.sources import keyed, scratch


def blocks(spark):
    """Files in the executors' own folders: shuffles, mostly."""
    return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()


def shuffled_rows(spark):
    sc = spark.sparkContext
    store = sc._jsc.sc().statusStore()
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = store.stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_shuffles_of_a_written_frame_are_removed(spark):
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))
    before = blocks(spark)
    kept = scratch.written(rows, "kept")
    for _ in range(100):
        if blocks(spark) <= before:
            break
        time.sleep(0.1)
    assert blocks(spark) <= before
    assert kept.count() == 7
    assert spark.conf.get(scratch.REMOVED, None) is None


@pytest.fixture(scope="module")
def odd_dir(tmp_path_factory, sf_dir):
    """The small tables with orders of two customers, lines without an order or a supplier or there twice, owners and parts without a name, missing or there twice."""
    at = str(tmp_path_factory.mktemp("odd"))
    c = duckdb.connect()
    for t in ("customer", "orders", "lineitem", "part", "supplier", "nation", "region"):
        c.execute(f"CREATE TABLE {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    c.execute("INSERT INTO orders SELECT * REPLACE (CASE WHEN o_custkey = 9 THEN 10 ELSE 9 END AS o_custkey) FROM orders WHERE o_orderkey % 20 = 3")
    c.execute("INSERT INTO lineitem SELECT * REPLACE (l_extendedprice + 1 AS l_extendedprice, l_shipdate + INTERVAL 2 DAY AS l_shipdate) FROM lineitem WHERE l_orderkey % 9 = 1")
    c.execute("INSERT INTO lineitem SELECT * REPLACE (NULL AS l_suppkey, l_linenumber + 50 AS l_linenumber) FROM lineitem WHERE l_orderkey % 10 = 2")
    c.execute("INSERT INTO lineitem SELECT * REPLACE (90000000 + l_orderkey AS l_orderkey) FROM lineitem WHERE l_orderkey % 10 = 4")
    c.execute("DELETE FROM customer WHERE c_custkey % 17 = 2")
    c.execute("UPDATE customer SET c_name = NULL WHERE c_custkey % 11 = 1")
    c.execute("DELETE FROM part WHERE p_partkey % 19 = 3")
    c.execute("UPDATE part SET p_name = NULL WHERE p_partkey % 7 = 1")
    c.execute("INSERT INTO part SELECT * FROM part WHERE p_partkey % 23 = 4")
    for t in ("customer", "orders", "lineitem", "part", "supplier", "nation", "region"):
        c.execute(f"COPY {t} TO '{at}/{t}.parquet' (FORMAT parquet)")
    return at


def same_as_sql(spark, at, name):
    from test_queries import canonical

    c = duckdb.connect()
    for f in os.listdir(at):
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{at}/{f}'")
    got, want = registry.QUERIES[name](spark, at).toPandas(), c.execute(registry.ORACLE_SQL[name]).df()
    assert len(got) and canonical(got) == canonical(want)


def test_exposure_by_changes_on_odd_rows(spark, odd_dir):
    same_as_sql(spark, odd_dir, "delta_owner_exposure")


def test_exposure_by_changes_sends_each_line_few_times(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    before = shuffled_rows(spark)
    registry.QUERIES["delta_owner_exposure"](spark, sf_dir).collect()
    assert shuffled_rows(spark) - before < 10 * lines


def test_details_by_numbers_on_odd_rows(spark, odd_dir):
    def rows(df):
        named = [F.col(c).isNotNull().cast("string").alias(c) for c in ("owner_name", "asset_name")]
        return sorted(map(str, df.select("transaction_id", F.col("trade_date").cast("string").alias("d"), "amount", *named).collect()))

    got = rows(keyed.details(spark, odd_dir))
    assert len(got) > 1000 and got == rows(registry.detail(spark, odd_dir))


def test_gate_of_details_sends_each_line_few_times(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    before = shuffled_rows(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as at a size where no table is small
    try:
        registry.QUERIES["gate_transaction_detail"](spark, sf_dir).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shuffled_rows(spark) - before < 12 * lines


def test_rows_meet_the_buckets_that_fail_without_a_shuffle(spark):
    day = F.expr("date_add(DATE'2024-01-01', CAST(id % 40 AS INT))")
    rows = spark.range(4000).select(day.alias("d"), F.when(F.col("id") % 40 == 30, 1000).otherwise(F.col("id") % 5).alias("x"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10k")  # less than the rows take, more than the days that fail
    try:
        marked = dataset_checks.has_no_aggr_outliers(rows, "bad", "x", "d")
        assert "SortMergeJoin" not in marked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [str(r.d) for r in marked.where("bad").select("d").distinct().collect()] == ["2024-01-31"]
