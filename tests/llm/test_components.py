"""Components of edge tables: right, and in few tasks, as each task costs files and log whatever its rows."""

import random

from pyspark.sql import functions as F

from siltwork.llm.components import smallest_reachable


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


def test_components_of_chains_hubs_loops_and_repeats(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(100, 170)] + [(1000, k) for k in range(1001, 1200)] + [(5000, 5000), (7, -9), (7, -9), (-9, 7), (-9, -9)]
    edges += [(rng.randrange(20_000, 20_400), rng.randrange(20_000, 20_400)) for _ in range(250)]
    rng.shuffle(edges)
    got = smallest_reachable(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == brute(edges) and len(got) == len(brute(edges))
    assert smallest_reachable(spark.createDataFrame([], "a long, b long")).count() == 0
    assert smallest_reachable(spark.createDataFrame([(3, 3)], "a long, b long")).count() == 0


def test_components_take_few_tasks(spark):
    edges = spark.range(4000).select((F.col("id") * 10).alias("a"), (F.col("id") * 10 + 1 + F.col("id") % 3).alias("b"))
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    sc = spark.sparkContext
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        sc.setJobGroup("components", "components")
        assert smallest_reachable(edges).where("node <> root").count() == 4000
    finally:
        sc._jsc.clearJobGroup()
        for k, v in before.items():
            spark.conf.set(k, v)
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("components") for s in tracker.getJobInfo(j).stageIds}
    done = sum(i.numCompletedTasks for i in map(tracker.getStageInfo, stages) if i)
    # Stars already: stored, looked at once, and read.
    assert done < 300, done
