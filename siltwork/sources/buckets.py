"""Tables in hash buckets of their keys, of which a run writes only the buckets that its changes reach.

Version n of a table is a folder ``v=n`` with the buckets that its run wrote, and a layout beside it (``<path>_layout``)
that says which version's folder holds each bucket. What a run does not reach stays where it is and is only referred
to, so the bytes that it reads and writes follow its changes. The layout is written last: without it a version does not count.

A bucket is told by a hash of the keys, NULL keys too. Their number follows the rows of the first load; when a table
has grown to four times the rows a bucket should hold, the run that finds this lays it out anew. The driver holds one
number a bucket (at most ``MOST``), never keys. Large buckets are written by several tasks.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltwork.sources import tables

BUCKET = "_bucket"
#: Rows that a bucket should hold, and the most buckets of a table.
ROWS, MOST = 1 << 20, 16384


@dataclass(frozen=True)
class Layout:
    """keys and number of buckets, the rows' schema, and for each bucket with rows its version and their number."""

    keys: tuple[str, ...]
    n: int
    rows: int
    schema: T.StructType
    held: Mapping[int, tuple[int, int]]

    def bucket(self) -> Column:
        """The bucket of a row that has the keys, by their types in the table."""
        if not self.keys or self.n == 1:
            return F.lit(0)
        return F.pmod(F.xxhash64(*[F.col(k).cast(self.schema[k].dataType) for k in self.keys]), F.lit(self.n)).cast("int")

    @property
    def outgrown(self) -> bool:
        return bool(self.keys) and self.n < MOST and sum(c for _, c in self.held.values()) > 4 * self.n * self.rows


@dataclass(frozen=True)
class Reach:
    """What changes reach of a table at a version: the buckets and their rows."""

    layout: Layout
    buckets: tuple[int, ...]
    rows: DataFrame


def _at(path: str) -> str:
    return f"{path}_layout"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Finished versions of a table in buckets."""
    return tables.versions(spark, _at(path))


def layout(spark: SparkSession, path: str, version: int) -> Layout:
    held = json.loads(tables.read_snapshot(spark, _at(path), version)[0].first()[0])
    return Layout(tuple(held["keys"]), held["n"], held["rows"], T.StructType.fromJson(held["schema"]), {int(b): tuple(v) for b, v in held["held"].items()})


def _rows(spark: SparkSession, path: str, of: Layout, buckets: Iterable[int], extra: T.StructType | None = None) -> DataFrame:
    folders = [f"{path}/v={of.held[b][0]}/{BUCKET}={b}" for b in buckets if b in of.held]
    schema = T.StructType([*of.schema.fields, *(extra.fields if extra else [])])
    if not folders:
        return spark.createDataFrame([], schema)
    if not extra:
        return spark.read.schema(schema).parquet(*folders)
    # Folders below the buckets are found from the root only, and the versions' and buckets' own with them.
    over = [T.StructField("v", T.IntegerType()), T.StructField(BUCKET, T.IntegerType())]
    return spark.read.schema(T.StructType([*of.schema.fields, *over, *extra.fields])).option("basePath", path).parquet(*folders).select(*schema.names)


def read(spark: SparkSession, path: str, version: int | None = None, extra: T.StructType | None = None) -> DataFrame:
    """The table at a version. extra: columns of folders below the buckets that are wanted too."""
    of = layout(spark, path, max(versions(spark, path)) if version is None else version)
    return _rows(spark, path, of, of.held, extra)


def _write(rows: DataFrame, path: str, of: Layout, buckets: Sequence[int], version: int, below: Sequence[str], counted: Column | None, redo: bool) -> int:
    """The buckets as a version, and the layout with them in place of what it had of them."""
    spark = rows.sparkSession
    spread = rows.withColumn(BUCKET, of.bucket()).hint("rebalance", BUCKET)
    n = tables.write_version(spread, path, version, partition_by=[BUCKET, *below], redo=redo)
    there = spark.read.schema(T.StructType([*of.schema.fields, T.StructField(BUCKET, T.IntegerType()), *[T.StructField(c, T.StringType()) for c in below]])).parquet(f"{path}/v={n}")
    counts = {r[0]: r[1] for r in (there if counted is None else there.where(counted)).groupBy(BUCKET).count().collect()}
    held = {b: v for b, v in of.held.items() if b not in set(buckets)} | {b: (n, c) for b, c in counts.items()}
    text = json.dumps({"keys": of.keys, "n": of.n, "rows": of.rows, "schema": of.schema.jsonValue(), "held": held})
    tables.write_version(spark.range(1, numPartitions=1).select(F.lit(text).alias("layout")), _at(path), n, redo=redo)
    return n


def _free(spark: SparkSession, path: str) -> int:
    """A version above all folders, also those that a crash left."""
    return max(tables.numbered(spark, path), default=-1) + 1


def create(rows: DataFrame, path: str, keys: Sequence[str] = (), version: int | None = None, *, per_bucket: int = ROWS, below: Sequence[str] = (), counted: Column | None = None, redo: bool = False, count: int | None = None) -> int:
    """A whole table as a version. below: columns that are folders within a bucket; counted: which rows a reader of the version sees.

    Without keys it is one bucket. rows are counted first unless their number is given: give rows that have been written.
    """
    n = 1 if not keys else min(MOST, max(1, -(-(rows.count() if count is None else count) // per_bucket)))
    fields = [f for f in rows.schema.fields if f.name not in below]
    of = Layout(tuple(keys), n, per_bucket, T.StructType([T.StructField(f.name, f.dataType) for f in fields]), {})
    return _write(rows, path, of, (), _free(rows.sparkSession, path) if version is None else version, below, counted, redo)


def reach(spark: SparkSession, path: str, changes: DataFrame, version: int, extra: T.StructType | None = None) -> Reach:
    """The buckets that rows with the keys reach, and what the table has in them; all of them if it is to be laid out anew."""
    of = layout(spark, path, version)
    if of.outgrown:
        fresh = Layout(of.keys, min(MOST, -(-sum(c for _, c in of.held.values()) // of.rows)), of.rows, of.schema, {})
        return Reach(fresh, tuple(range(fresh.n)), _rows(spark, path, of, of.held, extra))
    found = tuple(sorted(r[0] for r in changes.select(of.bucket().alias(BUCKET)).distinct().collect()))
    return Reach(of, found, _rows(spark, path, of, found, extra))


def everything(spark: SparkSession, path: str, version: int) -> Reach:
    """All buckets of a version."""
    of = layout(spark, path, version)
    return Reach(of, tuple(range(of.n)), _rows(spark, path, of, of.held))


def replace(into: Reach, rows: DataFrame, path: str, version: int | None = None, *, below: Sequence[str] = (), counted: Column | None = None, redo: bool = False) -> int:
    """A version in which the reached buckets hold these rows and all others what they held."""
    rows = rows.select(*into.layout.schema.names, *below)
    return _write(rows, path, into.layout, into.buckets, _free(rows.sparkSession, path) if version is None else version, below, counted, redo)
