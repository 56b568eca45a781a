"""The change feed as a stream: each new version once, applied to a history that keeps what is closed as it is."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltwork.operators import changes
from siltwork.plans.layers import Entity
from siltwork.sources import history, tables


def incremental_apply(spark: SparkSession, feed_path: str, schema: T.StructType, history_path: str, checkpoint: str, entity: Entity, ts: str) -> DataFrame:
    """The history after all changes that have come to ``feed_path`` since the checkpoint; it equals the batch result.

    The stream's checkpoint tells what has been read. A batch's number names the version that it writes, so a batch
    that fails, also with a version half-written, is applied again to the same one. Changes are ordered by their commit
    version, never by arrival: one with a version up to that of the batches before is late and is not applied, as a
    bounded run would not read it. Each batch's last version is held beside the history.
    """
    marks = f"{history_path}_marks"

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        done = history.versions(spark, history_path)
        if number + 1 in done:  # written before the checkpoint was
            return
        held = [v for v in tables.versions(spark, marks) if v <= number]
        last = tables.read_snapshot(spark, marks, max(held))[0].first()[0] if held else None
        fresh = batch if last is None else batch.where(F.col(changes.VERSION) > last)
        if number + 1 not in tables.versions(spark, marks):
            top = fresh.agg(F.coalesce(F.max(changes.VERSION), F.lit(last)).cast("long").alias("version"))
            tables.write_version(top, marks, number + 1)
        history.run(spark, history_path, fresh, entity.keys, entity.business, ts, max(v for v in done if v <= number), number + 1, redo=True)

    stream = spark.readStream.schema(schema).parquet(feed_path)
    query = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(apply).start()
    query.awaitTermination()
    return history.read(spark, history_path)
