"""Response bodies as rows. Each function takes one body per row and returns rows and rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .events import CUSTOMER_FIELD
from .parse import truth, whole_number

# Payment rails and environments.
RAILS = ("stripe", "apple", "google", "manual")
ENVIRONMENTS = ("production", "sandbox")

# Items are read one by one and their fields as text, so that a field of the wrong type costs no more than itself.
_ENTITLEMENT = "key string, isActive string, validUntil string, updatedAt string, source string"
_SOURCE = "rail string, productId string, subscriptionId string"


def _env(default: str) -> Column:
    return F.when(F.col("__r.env").isin(*ENVIRONMENTS), F.col("__r.env")).otherwise(default).alias("env")


def _parsed(df: DataFrame, body: str, schema: str) -> DataFrame:
    """The body's fields as the struct column ``__r``, parsed once: a generator's input is not copied into filters."""
    return df.select("*", F.explode(F.array(F.from_json(F.col(body), schema))).alias("__r"))


def _split(df: DataFrame, body: str, schema: str, customer_field: str, code: str) -> tuple[DataFrame, DataFrame]:
    customer = F.nullif(F.col(f"__r.{customer_field}"), F.lit(""))
    marked = _parsed(df, body, schema).withColumn("customer_id", customer)
    rejects = marked.filter("customer_id is null").drop("__r", "customer_id").withColumn("reject_code", F.lit(code))
    return marked.filter("customer_id is not null"), rejects


def flatten_entitlement_responses(
    responses: DataFrame,
    body: str = "body",
    purchases: bool = False,
    default_env: str = "production",
    received_ms: Column | None = None,
    customer_field: str = CUSTOMER_FIELD,
) -> tuple[DataFrame, DataFrame]:
    """Entitlement rows of ``/entitlements`` bodies, or with ``purchases`` of ``/purchases/sync`` bodies.

    A body without customer id is rejected; items without key or source, or of an unknown rail, are dropped.
    Numbers may be text or have a fraction. An end date that is missing or null means no end, one that cannot be
    read is 0 and so long past; an unreadable update time is the receive time.
    """
    field, code = ("entitlements", "purchase_response_invalid") if purchases else ("data", "entitlements_response_invalid")
    schema = f"{customer_field} string, env string, {field} array<string>"
    good, rejects = _split(responses, body, schema, customer_field, code)
    keep = [c for c in responses.columns if c != body]
    received = F.lit(None).cast("bigint") if received_ms is None else received_ms
    items = good.withColumn("__received", received).select(*keep, "customer_id", "__received", _env(default_env), F.explode(f"__r.{field}").alias("__item"))
    items = items.select("*", F.inline(F.array(F.struct(F.from_json("__item", _ENTITLEMENT).alias("e")))))
    items = items.select("*", F.inline(F.array(F.struct(F.from_json("e.source", _SOURCE).alias("__source")))))
    rows = items.filter((F.coalesce("e.key", F.lit("")) != "") & F.col("__source.rail").isin(*RAILS)).select(
        *keep,
        "customer_id",
        "env",
        F.col("e.key").alias("key"),
        truth(F.col("e.isActive")).alias("is_active"),
        F.when(F.col("e.validUntil").isNotNull(), whole_number(F.col("e.validUntil"), F.lit(0))).alias("valid_until_ms"),
        F.col("__source.rail").alias("rail"),
        F.coalesce("__source.productId", F.lit("")).alias("product_id"),
        F.coalesce("__source.subscriptionId", F.lit("")).alias("subscription_id"),
        whole_number(F.col("e.updatedAt"), F.col("__received")).alias("updated_at_ms"),
    )
    return rows, rejects


def flatten_alias_links(
    responses: DataFrame, body: str = "body", default_env: str = "production", customer_field: str = CUSTOMER_FIELD
) -> tuple[DataFrame, DataFrame]:
    """One row per linked identity (type and id null for a response that links none)."""
    schema = f"{customer_field} string, env string, mergePending string, linked array<string>"
    good, rejects = _split(responses, body, schema, customer_field, "alias_response_invalid")
    keep = [c for c in responses.columns if c != body]
    links = F.transform("__r.linked", lambda x: F.from_json(x, "type string, id string"))
    named = F.filter(
        links, lambda x: (F.coalesce(x["type"], F.lit("")) != "") & (F.coalesce(x["id"], F.lit("")) != "")
    )
    rows = good.select(
        *keep,
        "customer_id",
        _env(default_env),
        truth(F.col("__r.mergePending")).alias("merge_pending"),
        F.explode_outer(named).alias("l"),
    ).select(*keep, "customer_id", "env", "merge_pending", F.col("l.type").alias("link_type"), F.col("l.id").alias("link_id"))
    return rows, rejects


def split_heartbeats(
    responses: DataFrame, body: str = "body", received_ms: str = "received_ms", default_env: str = "production"
) -> tuple[DataFrame, DataFrame]:
    """Heartbeat bodies as rows, and the responses whose body is no object.

    ok is false and the server time the receive time when absent or unreadable. White space around a body does not count.
    """
    schema = "ok string, projectId string, appId string, env string, serverTime string, _corrupt_record string"
    keep = [c for c in responses.columns if c != body]
    record = F.from_json(F.col(body), schema, {"columnNameOfCorruptRecord": "_corrupt_record"})
    parsed = responses.select("*", F.explode(F.array(record)).alias("__r"))
    readable = F.coalesce(F.col(body).rlike(r"^\s*\{") & F.col("__r._corrupt_record").isNull(), F.lit(False))
    rows = parsed.filter(readable).select(
        *keep,
        truth(F.col("__r.ok")).alias("ok"),
        F.coalesce("__r.projectId", F.lit("")).alias("project_id"),
        F.coalesce("__r.appId", F.lit("")).alias("app_id"),
        _env(default_env),
        whole_number(F.col("__r.serverTime"), F.col(received_ms)).alias("server_time_ms"),
    )
    rejects = parsed.filter(~readable).drop("__r").withColumn("reject_code", F.lit("heartbeat_response_invalid"))
    return rows, rejects


def flatten_heartbeats(
    responses: DataFrame, body: str = "body", received_ms: str = "received_ms", default_env: str = "production"
) -> DataFrame:
    """The rows of ``split_heartbeats``."""
    return split_heartbeats(responses, body, received_ms, default_env)[0]
