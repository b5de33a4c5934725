"""Run a stream over what is there now, into files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import checkpoint_dir


def run_available(stream: DataFrame) -> DataFrame:
    """Process all available input in append mode and return the written result."""
    spark = stream.sparkSession
    base = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    query = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")
