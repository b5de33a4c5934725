"""Streaming ingest: envelopes to clean events, with rejects kept apart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.privacy import flag_sensitive_keys, scrub_pii_json
from ..functions.values import sanitize_json
from ..operators.gates import ingest_gate
from ..sources.events import CUSTOMER_FIELD, parse_event_batches
from .signals import event_signals, observed

DEFAULT_INTERVAL_MS = 2_000
MIN_INTERVAL_MS = 250
# Files of one micro-batch, so that the first one is not the whole history.
MAX_FILES = 1000


def clean_events(rows: DataFrame, public_key: Column) -> tuple[DataFrame, DataFrame]:
    """Gate, sanitise and scrub event rows whose ``properties`` are JSON text.

    Returns accepted rows (with the sanitiser's ``warnings`` and ``sensitive_keys``) and rejects, among them
    rows whose properties cannot be read, as they came.
    """
    gate = ingest_gate(public_key, F.col("environment"), F.col("app_id"), F.col("name"))
    gated = rows.withColumn("reject_code", gate)
    keys = flag_sensitive_keys(F.json_object_keys("properties"))
    read = gated.filter("reject_code is null").drop("reject_code").withColumn("__s", sanitize_json("properties"))
    scrubbed = read.filter("__s.error is null").withColumns(
        {"sensitive_keys": keys, "properties": scrub_pii_json()("__s.properties"), "warnings": F.col("__s.warnings")}
    )
    unreadable = read.filter("__s.error is not null").withColumn("reject_code", F.concat(F.lit("properties_"), "__s.error"))
    return scrubbed.drop("__s"), gated.filter("reject_code is not null").unionByName(unreadable.drop("__s"))


def ingest_stream(
    spark: SparkSession,
    source: str,
    target: str,
    rejects: str,
    checkpoint: str,
    public_key: str,
    interval_ms: int = DEFAULT_INTERVAL_MS,
    available_now: bool = False,
    customer_field: str = CUSTOMER_FIELD,
    max_files: int = MAX_FILES,
    on_signals: Callable[[int, dict], None] | None = None,
) -> DataStreamWriter:
    """Envelope files to an event table and a reject table. Call ``start`` on the result.

    ``on_signals`` gets each micro-batch's id and debug signal counts.

    The checkpoint takes the place of a device's saved buffer. Each micro-batch replaces the folder of
    its own id, so one that is run again leaves a single copy.
    """
    reader = spark.readStream.format("text").option("maxFilesPerTrigger", max_files)
    docs = reader.load(source).withColumn("received_ms", F.unix_millis(F.current_timestamp()))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            rows, broken = parse_event_batches(batch, "value", F.col("received_ms"), customer_field)
            clean, refused = clean_events(rows, F.lit(public_key))
            counts = Observation(f"signals-{batch_id}")
            observed(clean, counts, event_signals()).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")
            if on_signals is not None:
                on_signals(batch_id, counts.get)
            dead = broken.select("document", "reject_code").unionByName(
                refused.select(F.to_json(F.struct(*rows.columns)).alias("document"), "reject_code")
            )
            dead.write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{max(interval_ms, MIN_INTERVAL_MS)} milliseconds")


# A stream's first watermark is the epoch, and what is stamped then or earlier counts as late. So event time is
# moved on before it is watched; times in the results are those of the rows.
_AHEAD = "INTERVAL 500 YEARS"


def dedup_stream(events: DataFrame, key: str = "event_id", time: str = "ts", within: str = "24 hours") -> DataFrame:
    """Drop redelivered events; state is kept for ``within`` of event time."""
    watched = events.withColumn("__at", F.col(time) + F.expr(_AHEAD)).withWatermark("__at", within)
    return watched.dropDuplicatesWithinWatermark([key]).drop("__at")


def session_stream(events: DataFrame, key: str = "dev", time: str = "ts", idle: str = "1799999999 microseconds", late: str = "10 minutes") -> DataFrame:
    """Closed sessions of a stream. A gap of one microsecond under 30 minutes makes a pause of exactly 30 split.

    A session comes out when the watermark has passed its end. Where a stream ends, one more row of any device, later
    than all others by more than the pause and ``late``, closes the rest; its own session stays open.
    """
    return (
        events.withColumn("__at", F.col(time) + F.expr(_AHEAD))
        .withWatermark("__at", late)
        .groupBy(F.col(key), F.session_window("__at", idle).alias("__w"))
        .agg(
            F.min(F.unix_micros(time)).alias("start_us"),
            F.max(F.unix_micros(time)).alias("end_us"),
            F.count(F.lit(1)).alias("events"),
        )
        .drop("__w")
    )
