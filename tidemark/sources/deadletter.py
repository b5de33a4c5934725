"""The reject sink: what can never be delivered, with its error, out of the way of newer rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_dead_letter(df: DataFrame, error: Column) -> tuple[DataFrame, DataFrame]:
    """Rows to go on with (null ``error``) and rows for the reject sink (``error`` added)."""
    marked = df.withColumn("dead_letter_error", error)
    good = marked.filter(F.col("dead_letter_error").isNull()).drop("dead_letter_error")
    return good, marked.filter(F.col("dead_letter_error").isNotNull())


def undeliverable(outcomes: DataFrame) -> Column:
    """Error of a batch outcome that ended without delivery, else null."""
    return F.when(F.col("state").isin("dropped_permanent", "retry_exhausted"), F.col("state"))


def write_with_rejects(good: str, rejects: str, error: Column, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes both sinks of one micro-batch.

    The batch id names the folder and the write replaces it, so a batch that is run
    again after a lost executor or a restart leaves one copy.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            kept, dead = to_dead_letter(batch, error)
            kept.write.mode("overwrite").format(fmt).save(f"{good}/batch_id={batch_id}")
            dead.write.mode("overwrite").format(fmt).save(f"{rejects}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write
