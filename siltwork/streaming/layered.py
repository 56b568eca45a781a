"""The change feed as a stream through every layer and its gate."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltwork.operators import changes
from siltwork.operators.gate import Rule
from siltwork.plans.layers import Layers
from siltwork.sources.scratch import written


def stream_layers(spark: SparkSession, feed_path: str, schema: T.StructType, job: Layers, checkpoint: str, ts: str, rules: Sequence[Rule] = ()) -> None:
    """All changes that have come to ``feed_path`` since the checkpoint through Bronze, Silver and Gold of a job that has had its first load.

    Each batch goes through the layers as a bounded run does, so tables, quarantines and logs equal the batch job's. Its
    number stands in the marker of Bronze's run: a batch that a crash cut short is taken up by the layers that have not
    had it, and applied once. Changes are ordered by commit version; those up to Bronze's watermark are late: they are not
    applied, as a bounded run would not read them, and are kept in the log ``late_changes`` with their batch.
    """
    stream = f"{zlib.crc32(checkpoint.encode()):08x}"

    def apply(batch: DataFrame, number: int) -> None:
        spark, name = batch.sparkSession, f"{stream}-{number}"
        if not any(r.layer == "bronze" and r.notes.get("batch") == name for r in job.commits.all(spark)):
            rows, mark = written(batch, "batch"), job.watermark(spark, "bronze")
            top, late = rows.agg(F.max(changes.VERSION), F.count_if(F.col(changes.VERSION) <= mark)).first()
            if late:
                job.log_late(spark, rows.where(F.col(changes.VERSION) <= mark), name, ts)
            if top is not None and top > mark:
                job.run_feed(spark, changes.read_changes(rows, mark, top), top, ts, batch=name)
        job.run_silver(spark, ts, rules)
        job.run_gold(spark, ts)

    source = spark.readStream.schema(schema).parquet(feed_path)
    query = source.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(apply).start()
    query.awaitTermination()
