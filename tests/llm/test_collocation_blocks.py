"""Counts travel in blocks: few rows however many phrases, and what is merged is exact, as to shards too."""

import random
from collections import Counter

import numpy as np

from siltwork.llm import collocation


def sent(entries, task, bits):
    """A task's counts as rows of COUNTS without the block."""
    key, check, n = (np.array(c, kind) for c, kind in zip(zip(*sorted(entries), strict=True), (np.uint64, np.int32, np.int64), strict=True))
    return [r for batch in collocation.blocks(key, check, n, task, bits) for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]


def test_merged_counts_are_those_of_a_plain_sum():
    rng, by_shard, tasks, rows = random.Random(3), Counter(), {}, []
    keys = [rng.getrandbits(64) for _ in range(300)]
    for task in range(7):
        # Some keys have two checks; sums past 32 bits.
        entries = {(rng.choice(keys), rng.choice([5, -9])): rng.choice([1, 4, 14, 1 << 33]) for _ in range(400)}
        for (key, check), n in entries.items():
            by_shard[key, check, task % 2] += n
            tasks.setdefault((key, check), set()).add(task)
        rows += sent([(*x, n) for x, n in entries.items()], task, 3)
    assert len(rows) <= 7 * 8
    want = {x: f for x in tasks if (f := by_shard[*x, 0] + by_shard[*x, 1]) >= 30 and max(by_shard[*x, 0], by_shard[*x, 1]) >= 17}
    got = {}
    for block in range(8):
        found = collocation.merged([r[1:] for r in rows if r[0] == block], 2, 17, 30, 20)
        for key, check, f, task in zip(*(c.tolist() for c in found), strict=True):
            assert key >> 61 == block and task in tasks[key, check] and (key, check) not in got
            got[key, check] = f
    assert got == want and 50 < len(want) < len(tasks)
    assert not list(collocation.blocks(np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int64), 0, 8))


def test_the_shuffle_gets_blocks_and_no_phrases(spark):
    rng = random.Random(4)
    docs = [("aa", " ".join(f"w{rng.randrange(3000)}" for _ in range(200))) for _ in range(300)]
    rows = spark.createDataFrame(docs, "lang string, text string").selectExpr("lang", "cast(text AS binary) AS text").repartition(4)
    got = rows.mapInArrow(collocation._mine(2, None, 6), collocation.COUNTS).selectExpr("count(*) AS rows", "sum(length(keys) div 8) AS phrases").first()
    assert got.rows <= 4 * 64 and got.phrases > 50_000
