"""Approximate nearest neighbours by multi-index hashing.

Vectors are scaled to length one, and turned by a learned rotation (principal directions, then
iterative quantisation on a bounded sample); the signs of the turned coordinates are a 64-bit code. Codes are split
into four substrings of 16 bits, and each substring has an index: the rows of each of its 65536 values. If two codes
differ in at most r bits, one of their substrings differs in at most r // 4 bits, the first r % 4 + 1 of them, or
r // 4 - 1 bits, so probing those values finds every code within the radius. What is found and is within the radius
of the whole code is reranked by the cosine of the original vectors in double precision. The radius is learned too:
the least that holds nearly all true neighbours of the sample's queries; a query that finds too few rows within it
probes with the next radius, at last all.

Rows stay in the tasks that read them: a bounded block of queries is broadcast to all of them (``scan``), and a task
takes its rows in shards of a bounded size, indexes each and answers the block's queries from it. It keeps a query's best
so far and sends only these, so what is shuffled grows with the queries, by a fixed number of tasks. Equal vectors are
equal rows of an index, never pairs; a hot vector or id lies wherever the table has it.

Vectors that are null, zero, or hold null or non-finite components take no part; finite ones of any size do, as each
is scaled by a power of two first, which changes no cosine. Ties go to the smaller vec_id. A repeated vec_id is a
candidate as often as it occurs, but never its own query's. Equal rows ask once; rows of one id with different vectors
are different queries, which query_hash tells apart. Only the id and the vector are read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltwork.llm.scan import BLOCK_BYTES, in_place

BITS, PARTS = 64, 4
WIDTH = BITS // PARTS
#: Vectors that the rotation and the radius are learned from, at most.
SAMPLE = 4096
#: Share of the sample's true neighbours that must lie within the radius.
RECALL = 0.985
SHARD_ROWS = 8192
NEIGHBOURS, EVERY = 5, 50


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that their largest component is near one: squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(-1, keepdims=True))[1]) if x.size else x


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


class Hasher:
    """The rotation and the radius of the codes."""

    def __init__(self, turn: np.ndarray, radius: int):
        self.turn, self.radius = turn, radius

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """The code of each row, as four substrings."""
        if not len(unit):
            return np.zeros((0, PARTS), np.uint16)
        return np.packbits(unit @ self.turn > 0, axis=1, bitorder="little").view("<u2")


def learn(sample: np.ndarray, neighbours: int = NEIGHBOURS, seed: int = 5, rounds: int = 25) -> Hasher:
    """Principal directions turned by iterative quantisation; more bits than dimensions get random directions."""
    rng = np.random.default_rng(seed)
    unit = unit_rows(sample)
    d = unit.shape[1]
    _, axes = np.linalg.eigh(unit.T @ unit)
    base = axes[:, ::-1][:, :BITS]
    if d < BITS:
        base = np.concatenate([base, np.linalg.qr(rng.standard_normal((BITS, BITS)))[0][:d, : BITS - d]], 1)
    v = unit @ base
    turn = np.linalg.qr(rng.standard_normal((BITS, BITS)))[0]
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.where(v @ turn > 0, 1.0, -1.0).T @ v)
        turn = (left @ right).T
    hasher = Hasher(base @ turn, BITS)
    queries = unit[:256]
    cosines = queries @ unit.T
    cosines[np.arange(len(queries)), np.arange(len(queries))] = -2
    k = min(neighbours, len(unit) - 1)
    if k > 0:
        codes = hasher.codes(unit).view(np.uint64)[:, 0]
        best = np.argpartition(-cosines, k - 1, 1)[:, :k]
        distances = np.bitwise_count(codes[: len(queries), None] ^ codes[best])
        hasher.radius = int(np.quantile(distances, RECALL, method="higher"))
    return hasher


@lru_cache(maxsize=32)
def flips(most: int) -> np.ndarray:
    """All 16-bit masks of at most so many bits."""
    if most < 0:
        return np.zeros(0, np.uint16)
    if 2 * most >= WIDTH:
        masks = np.arange(1 << WIDTH, dtype=np.uint32)
        return masks[np.bitwise_count(masks) <= most].astype(np.uint16)
    return np.array([sum(1 << b for b in some) for n in range(most + 1) for some in combinations(range(WIDTH), n)], np.uint16)


class MultiIndex:
    """Four indices over the codes of one shard: rows sorted by substring, and where each value's rows begin."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes.view(np.uint64)[:, 0]
        self.rows = [np.argsort(codes[:, k], kind="stable").astype(np.int32) for k in range(PARTS)]
        self.starts = [np.concatenate([[0], np.bincount(codes[:, k], minlength=1 << WIDTH).cumsum()]).astype(np.int32) for k in range(PARTS)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose codes differ in at most ``radius`` bits from a code (four substrings)."""
        if radius >= BITS:
            return np.arange(len(self.codes))
        found = np.zeros(len(self.codes), bool)
        for k in range(PARTS):
            values = flips(radius // PARTS - (k > radius % PARTS)) ^ code[k]
            start = self.starts[k][values]
            size = self.starts[k][values.astype(np.int64) + 1] - start
            some = size > 0
            start, size = start[some], size[some]
            ends = size.cumsum()
            if len(ends):
                found[self.rows[k][np.repeat(start - (ends - size), size) + np.arange(ends[-1])]] = True
        rows = np.flatnonzero(found)
        return rows[np.bitwise_count(self.codes[rows] ^ code.view(np.uint64)[0]) <= radius]


def cosine(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosines of rows with one vector: sums of products row by row, so that equal rows give equal values."""
    x, q = scaled(x), scaled(q)
    return (x * q).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((q * q).sum()))


def _search(hasher: Hasher, ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(place of the query, vec_id, score) of each query's k best rows of one shard."""
    unit = unit_rows(x)
    unit_queries = unit_rows(queries)
    index, codes = MultiIndex(hasher.codes(unit)), hasher.codes(unit_queries)
    for i, query_id in enumerate(query_ids):
        radius = hasher.radius
        while True:
            rows = index.within(codes[i], radius)
            rows = rows[ids[rows] != query_id]
            if len(rows) >= k or radius >= BITS:
                break
            radius = min(radius + 6, BITS)
        if not len(rows):
            continue
        rough = unit[rows] @ unit_queries[i]
        if len(rows) > k:
            rows = rows[rough >= np.partition(rough, -k)[-k] - 1e-9]
        scores = cosine(x[rows], queries[i])
        order = np.lexsort((ids[rows], -scores))[:k]
        yield np.full(len(order), i), ids[rows][order], scores[order]


def _shards(batches: Iterator[pa.RecordBatch], d: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of so many rows at a time."""
    ids, x, held = [], [], 0
    for batch in batches:
        flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
        keys = batch.column(0).to_numpy()
        for lo in range(0, len(keys), size):
            ids.append(keys[lo : lo + size])
            x.append(flat[lo : lo + size])
            held += len(ids[-1])
            if held >= size:
                yield np.concatenate(ids), np.concatenate(x)
                ids, x, held = [], [], 0
    if held:
        yield np.concatenate(ids), np.concatenate(x)


def _answers(hasher: Hasher | None, d: int, k: int, size: int):
    def run(block: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = block.value
        if not len(asked) or hasher is None:
            return
        query_ids, marks = asked.column("id").to_numpy(), asked.column("mark").to_numpy()
        queries = asked.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
        best = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        for ids, x in _shards(batches, d, size):
            at, found, scores = (np.concatenate(c) for c in zip(best, *_search(hasher, ids, x, query_ids, queries, k), strict=True))
            order = np.lexsort((found, -scores, at))
            start = np.flatnonzero(np.diff(at[order], prepend=-1))
            nth = np.arange(len(order)) - np.repeat(start, np.diff(start, append=len(order)))
            first = order[nth < k]
            best = [at[first], found[first], scores[first]]
        yield pa.RecordBatch.from_arrays([pa.array(query_ids[best[0]]), pa.array(marks[best[0]]), pa.array(best[1]), pa.array(best[2])], names=["query_id", "query_hash", "vec_id", "score"])

    return run


def usable(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, x): the rows that take part, their vectors as arrays of doubles."""
    x = F.col(vector).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(x, lambda c: c != 0)
    return vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & F.coalesce(fine, F.lit(False))).select(F.col(key).cast("long").alias("id"), x.alias("x"))


def nearest(vectors: DataFrame, *, k: int = NEIGHBOURS, every: int = EVERY, key: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(query_id, query_hash, rank, vec_id, score): the k nearest found of each row whose id is divisible by ``every``."""
    rows = usable(vectors, key=key, vector=vector)
    # Vectors of another length than the most frequent one can't be compared with its.
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    d = sizes[0]["d"] if sizes else 1
    rows = rows.where(F.size("x") == d)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow().column("x").combine_chunks()
    hasher = learn(sample.flatten().to_numpy().reshape(-1, d), k) if len(sample) else None
    asked = rows.where(F.col("id") % every == 0).dropDuplicates(["id", "x"]).select("id", F.xxhash64("x").alias("mark"), "x")
    found = in_place(rows, asked, _answers(hasher, d, k, shard_rows), "query_id long, query_hash long, vec_id long, score double", row_bytes=8 * d + 16, block_bytes=block_bytes)
    # The limit on the rank is applied in each task before the shuffle, so a query's rows stay few.
    rank = F.row_number().over(Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "query_hash")
