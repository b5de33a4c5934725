"""Subscribers of a stream: each micro-batch is handed over once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def deliver_once(target: str, handler: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes each micro-batch under ``target`` and hands the written rows to ``handler``.

    A batch id that was handed over before is not handed over again, and rows written before a failure are handed over
    as they were written. A handler that fails is called again with the same rows when the batch is run again, so only
    one that fails midway sees rows twice, under the same batch id.
    """

    def deliver(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = f"{target}/rows/batch_id={batch_id}"
        done, store = _path(spark, f"{target}/delivered/{batch_id}")
        if store.exists(done):
            return
        if not store.exists(_path(spark, f"{rows}/_SUCCESS")[0]):
            batch.write.mode("overwrite").parquet(rows)
        handler(spark.read.schema(batch.schema).parquet(rows), batch_id)
        store.create(done, True).close()

    return deliver


def subscribe(changes: DataFrame, target: str, checkpoint: str, handler: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    """Hand the rows of a stream, such as ``entitlement_changes_stream``, to ``handler``. Call ``start`` on the result."""
    return changes.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(deliver_once(target, handler))
