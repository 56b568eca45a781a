"""Connected components of an edge table, in rounds of joins and grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.llm.common import stored

#: Rounds after which a graph counts as broken; each round at least halves the depth of most trees.
MAX_ROUNDS = 60


def _small_star(down: DataFrame) -> DataFrame:
    """down: edges (u, v) with u > v. Each u and its smaller neighbours hang on u's smallest neighbour; an edge gives an edge."""
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))


def _large_star(down: DataFrame) -> DataFrame:
    """Each node's larger neighbours hang on the smallest of the node and its neighbours; an edge gives an edge."""
    ends = F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))))
    both = down.select(ends.alias("e")).select("e.*")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _finished(down: DataFrame) -> bool:
    """Whether each node above another hangs on one node only, and nothing hangs on it: all trees are stars."""
    ends = F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))))
    of = down.select(ends.alias("e")).select("e.*").groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return of.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).agg(F.count("*")).first()[0] == 0


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of edges (a, b): root is the smallest node of its component.

    Large-star and small-star rounds until all trees are stars; each round's edges are stored in the shared
    folder. Loops and repeated edges do no harm; a node without edges has no row.
    """
    down = stored(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(MAX_ROUNDS):
        if _finished(down):
            return down.select(F.col("u").alias("node"), F.col("v").alias("root")).union(down.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        down = stored(_small_star(_large_star(down)).distinct())
    raise RuntimeError(f"no components after {MAX_ROUNDS} rounds")
