"""Searches in place: rows stay in the tasks that read them, and bounded blocks of queries are broadcast to them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.llm.common import stored, unused

#: Bytes of one broadcast block of queries, about.
BLOCK_BYTES = 1 << 24
#: Tasks that scan the rows, for each of the cluster's cores. Each sends its best rows of a query, so a fixed number keeps that linear.
TASKS_A_CORE = 4

Search = Callable[[Broadcast, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def matrix(column: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    """Rows of numbers that are stored as bytes, all of one length."""
    data = column.to_pylist()
    return np.frombuffer(b"".join(data), kind).reshape(len(data), -1) if data else np.zeros((0, 1), kind)


def in_place(rows: DataFrame, queries: DataFrame, search: Search, schema: str, *, row_bytes: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """search(block of queries, the batches of one task's rows) for every block and every task.

    queries are written once and cut into blocks by a hash of their place. A block is all that the driver holds at a
    time, and with more than one each one's results are written before the next is read; nothing of the rows is
    shuffled. row_bytes: about the size of a query.
    """
    spark = rows.sparkSession
    cell = unused(queries.columns, "_block")
    queries = stored(queries.withColumn(cell, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 20)).cast("int")))
    blocks = max(1, -(-queries.count() * row_bytes // block_bytes))
    rows = rows.coalesce(max(1, TASKS_A_CORE * spark.sparkContext.defaultParallelism))
    found = []
    for b in range(blocks):
        block = spark.sparkContext.broadcast(queries.where(F.col(cell) % blocks == b).drop(cell).toArrow().combine_chunks())
        part = rows.mapInArrow(lambda batches, block=block: search(block, batches), schema)
        found.append(part if blocks == 1 else stored(part))
        if blocks > 1:
            block.destroy()
    out = found[0]
    for part in found[1:]:
        out = out.union(part)
    return out
