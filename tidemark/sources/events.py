"""Event batches: JSON envelopes to event rows and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordered import HOT_ROWS, Ordered, total
from .parse import whole_number, with_json

BATCH_SIZE = 20
# The wire name of the canonical customer id is set by the deployment.
CUSTOMER_FIELD = "customerId"


ENVELOPE = "appId string, environment string, sdk string, events array<string>, _corrupt_record string"
# Why a document yields no events, or an item of it is none.
MALFORMED = "malformed_batch"
NO_EVENTS = "no_events"
MISSING_ID = "missing_event_id"
MISSING_NAME = "missing_event_name"
MISSING_DEVICE = "missing_anonymous_id"


def event_schema(customer_field: str = CUSTOMER_FIELD) -> str:
    """Everything as text: numbers are read leniently, properties stay JSON as an object's shape is free."""
    fields = ("eventId", "name", "timestamp", "anonymousId", "developerUserId", customer_field, "properties")
    return ", ".join(f"{f} string" for f in fields)


def parse_event_batches(
    docs: DataFrame,
    body: str = "value",
    received_ms: Column | None = None,
    customer_field: str = CUSTOMER_FIELD,
) -> tuple[DataFrame, DataFrame]:
    """Envelopes (one JSON text per row) to event rows, and what is none of them.

    A text that cannot be parsed is a reject, and so is an envelope that holds no events, so that every document
    leaves rows or rejects. Items are read one by one: a timestamp may be
    text or have a fraction, and one that is missing or cannot be read takes the receive time; empty user and
    customer ids are null. An item without event id, name or anonymous id is a reject by itself. Works on batch and
    streaming input.
    """
    received = F.lit(None).cast("bigint") if received_ms is None else received_ms
    options = {"columnNameOfCorruptRecord": "_corrupt_record"}
    read = docs.select(F.col(body).alias("__body"), received.alias("__received"))
    parsed = with_json(read, "__body", ENVELOPE, options)
    blank = F.col("__body").isNull() | ~F.col("__body").rlike(r"\S")
    failed = F.when(F.col("_corrupt_record").isNotNull() | blank, MALFORMED).when(F.coalesce(F.size("events"), F.lit(0)) < 1, NO_EVENTS)
    whole = parsed.filter(failed.isNotNull()).select(F.col("__body").alias("document"), F.col("__received").alias("received_ms"), failed.alias("reject_code"))
    items = parsed.filter(failed.isNull()).select("__received", "appId", "environment", "sdk", F.explode("events").alias("__item"))
    item = F.struct(F.from_json("__item", event_schema(customer_field)).alias("e"), F.from_json("sdk", "name string, version string").alias("sdk"))
    items = items.select("__received", "appId", "environment", "__item", F.inline(F.array(item)))

    def given(name: str) -> Column:
        return F.nullif(F.col(f"e.{name}"), F.lit(""))

    missing = (
        F.when(given("eventId").isNull(), MISSING_ID).when(given("name").isNull(), MISSING_NAME).when(given("anonymousId").isNull(), MISSING_DEVICE)
    )
    bag = F.col("e.properties")
    rows = items.filter(missing.isNull()).select(
        F.col("appId").alias("app_id"),
        "environment",
        F.col("sdk.name").alias("sdk_name"),
        F.col("sdk.version").alias("sdk_version"),
        given("eventId").alias("event_id"),
        given("name").alias("name"),
        whole_number(F.col("e.timestamp"), F.col("__received")).alias("timestamp_ms"),
        given("anonymousId").alias("anonymous_id"),
        given("developerUserId").alias("developer_user_id"),
        given(customer_field).alias("customer_id"),
        F.when(bag.startswith("{"), bag).otherwise("{}").alias("properties"),
    )
    incomplete = items.filter(missing.isNotNull()).select(
        F.col("__item").alias("document"), F.col("__received").alias("received_ms"), missing.alias("reject_code")
    )
    return rows, whole.unionByName(incomplete)


def read_event_batches(
    spark: SparkSession, path: str, customer_field: str = CUSTOMER_FIELD, **options: str
) -> tuple[DataFrame, DataFrame]:
    """Read envelope files, one JSON document per line; the file time stands in for a missing timestamp."""
    docs = spark.read.options(**options).text(path).select("value", "_metadata.file_modification_time")
    return parse_event_batches(docs, "value", F.unix_millis("file_modification_time"), customer_field)


def encode_value(col: Column, dtype: T.DataType) -> Column:
    """A value as the wire takes it: non-finite numbers null, other types as text, nulls kept."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~(F.isnan(col) | (F.abs(col) == float("inf"))), col)
    if isinstance(dtype, T.MapType):
        return F.transform_values(col, lambda _, v: encode_value(v, dtype.valueType))
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda v: encode_value(v, dtype.elementType))
    if isinstance(dtype, T.StructType):
        fields = [encode_value(col[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(dtype, (T.StringType, T.BooleanType, T.NumericType)):
        return col
    return col.cast("string")


def pack_event_batches(
    events: DataFrame,
    sdk_name: str,
    sdk_version: str,
    size: int = BATCH_SIZE,
    customer_field: str = CUSTOMER_FIELD,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Events as envelopes of at most ``size``, oldest first, per app and environment (null is one of its own).

    Batch numbers come from a chunked count, so one app may hold any share of the
    rows; only a batch's own ``size`` events meet in one place. Properties keep their nulls and write numbers that
    are not finite as null; user and customer ids that are null are left out.
    """
    scope = ["app_id", "environment"]
    # Ordered rules take rows with a null key one by one; here they are one scope.
    keyed = events.withColumns({f"__{c}": F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in scope})
    keys = [f"__{c}" for c in scope]
    numbered = (
        Ordered(keyed, keys, ["timestamp_ms", "event_id"], hot_rows)
        .running(__nth=total(F.lit(1)))
        .frame()
        .withColumn("batch_no", F.expr(f"(__nth - 1) div {int(size)}"))
    )
    properties = F.to_json(encode_value(F.col("properties"), events.schema["properties"].dataType), {"ignoreNullFields": "false"})
    head = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("eventId"),
            "name",
            F.col("timestamp_ms").alias("timestamp"),
            F.col("anonymous_id").alias("anonymousId"),
            F.col("developer_user_id").alias("developerUserId"),
            F.col("customer_id").alias(customer_field),
        )
    )
    # The properties' nulls stay and the ids' do not, so the two are encoded apart.
    lead = F.regexp_replace(head, r"\}$", F.when(head == "{}", F.lit('"properties":')).otherwise(F.lit(',"properties":')))
    event = F.struct(F.col("__nth").alias("nth"), F.concat(lead, F.coalesce(properties, F.lit("{}")), F.lit("}")).alias("event"))
    packed = numbered.groupBy(*keys, "batch_no").agg(*[F.first(c).alias(c) for c in scope], F.collect_list(event).alias("__events"))
    in_order = F.array_sort("__events")
    sdk = F.struct(F.lit(sdk_name).alias("name"), F.lit(sdk_version).alias("version"))
    envelope = F.to_json(F.struct(F.col("app_id").alias("appId"), "environment", sdk.alias("sdk")))
    value = F.concat(
        F.substring(envelope, F.lit(1), F.length(envelope) - 1),
        F.lit(',"events":['),
        F.array_join(F.transform(in_order, lambda e: e["event"]), ","),
        F.lit("]}"),
    )
    return packed.select(*scope, "batch_no", F.size("__events").cast("bigint").alias("events"), value.alias("value"))


def write_event_batches(batches: DataFrame, path: str, mode: str = "append") -> None:
    """Write packed envelopes as JSON lines. Each names its app and environment, so no folder has to."""
    batches.select("value").write.mode(mode).text(path)
