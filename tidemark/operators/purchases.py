"""Billing results, purchase syncs and their reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.wire import classify_outcome, idempotency_key

GOOGLE = "google"
_CARRIED = ("event_id", "dev", "user_id", "ts_us")


def _carried(df: DataFrame) -> list[str]:
    return [c for c in _CARRIED if c in df.columns]


def billing_to_events(results: DataFrame) -> DataFrame:
    """Billing callbacks (``response_code``, ``purchases`` array) as funnel events.

    A code other than 0 is one ``purchase.failed``; 0 is one ``purchase.completed`` or, if revoked,
    ``purchase.refunded`` per purchase, and nothing for an empty list.
    """
    keep = _carried(results)
    failed = results.filter("response_code <> 0").select(
        *keep, F.lit("purchase.failed").alias("name"), F.col("response_code").alias("billing_response_code")
    )
    done = (
        results.filter("response_code = 0")
        .select(*keep, F.explode("purchases").alias("p"))
        .select(
            *keep,
            F.when(F.col("p.is_revoked"), "purchase.refunded").otherwise("purchase.completed").alias("name"),
            "p.product_id",
            "p.order_id",
            "p.purchase_token",
            "p.purchase_time_ms",
            "p.is_acknowledged",
        )
    )
    return done.unionByName(failed, allowMissingColumns=True)


def purchases_to_sync(results: DataFrame, namespace: str) -> tuple[DataFrame, DataFrame]:
    """Signed purchases to send with their idempotency key, and those refused for lack of a token."""
    keep = [*_carried(results), *[c for c in ("status", "error") if c in results.columns]]
    signed = (
        results.filter("response_code = 0")
        .select(*keep, F.explode("purchases").alias("p"))
        .select(*keep, "p.*")
        .filter(F.coalesce("signature", F.lit("")) != "")
    )
    key = idempotency_key(F.lit(GOOGLE), F.lit(None).cast("string"), F.col("purchase_token"), namespace)
    keyed = signed.withColumn("idempotency_key", key)
    refused = keyed.filter("idempotency_key is null").drop("idempotency_key")
    return keyed.filter("idempotency_key is not null"), refused.withColumn("reject_code", F.lit("missing_identifier"))


def billing_sync_result(syncs: DataFrame) -> DataFrame:
    """Add ``sync_error``: null on success, else the carried error or a generic typed one.

    ``status`` is the response status (null for none); ``error`` is a struct of type, code,
    message, request_id, status.
    """
    generic = F.struct(
        F.lit("internal_error").alias("type"),
        F.lit("auto_billing_sync_failed").alias("code"),
        F.lit("/purchases/sync did not succeed.").alias("message"),
        F.lit(None).cast("string").alias("request_id"),
        F.col("status").alias("status"),
    )
    ok = classify_outcome(F.col("status")) == "success"
    return syncs.withColumn("sync_error", F.when(~ok, F.coalesce("error", generic)))


def sync_failed_events(synced: DataFrame) -> DataFrame:
    """One ``purchase.sync_failed`` per failed sync."""
    return synced.filter(F.col("sync_error").isNotNull()).select(
        *_carried(synced),
        F.lit("purchase.sync_failed").alias("name"),
        F.lit(GOOGLE).alias("rail"),
        "product_id",
        "purchase_token",
        "order_id",
        F.col("sync_error.type").alias("error_type"),
        F.col("sync_error.code").alias("error_code"),
        F.col("sync_error.status").alias("status_code"),
        F.col("sync_error.request_id").alias("request_id"),
    )


def sync_completed_events(syncs: DataFrame) -> DataFrame:
    """One ``purchase.completed`` per successful manual sync.

    ``entitlements`` is the response's array; its first entry names product and subscription.
    ``outcome`` (from ``resolve_replays``), when present, marks answers that were replays.
    """
    replay = F.col("outcome") == "replayed" if "outcome" in syncs.columns else F.lit(False)
    first = F.when(F.size("entitlements") > 0, F.element_at("entitlements", 1))
    return syncs.filter(classify_outcome(F.col("status")) == "success").select(
        *_carried(syncs),
        F.lit("purchase.completed").alias("name"),
        "rail",
        first["source"]["productId"].alias("product_id"),
        first["source"]["subscriptionId"].alias("subscription_id"),
        replay.alias("idempotent_replay"),
    )


def reconcile_purchases(completed: DataFrame, synced: DataFrame, token: str = "purchase_token") -> DataFrame:
    """Per purchase token: synced, failed, never_synced or sync_only.

    Both sides are reduced to one row per token first, so a token on many rows
    neither multiplies rows nor makes a skewed join.
    """
    bought = completed.groupBy(token).agg(F.count(F.lit(1)).alias("purchases"))
    ok = F.col("sync_error").isNull()
    sent = synced.groupBy(token).agg(F.count(F.lit(1)).alias("syncs"), F.bool_or(ok).alias("__ok"))
    state = (
        F.when(F.col("purchases").isNull(), "sync_only")
        .when(F.col("syncs").isNull(), "never_synced")
        .when(F.col("__ok"), "synced")
        .otherwise("failed")
    )
    return bought.join(sent, token, "full_outer").select(
        token,
        F.coalesce("purchases", F.lit(0)).alias("purchases"),
        F.coalesce("syncs", F.lit(0)).alias("syncs"),
        state.alias("state"),
    )


def union_purchase_paths(automatic: DataFrame, manual: DataFrame) -> DataFrame:
    """Both kinds of purchase event as one stream, told apart by ``path``."""
    return automatic.withColumn("path", F.lit("automatic")).unionByName(
        manual.withColumn("path", F.lit("manual")), allowMissingColumns=True
    )


def purchase_funnel(events: DataFrame, user: str = "user_id") -> DataFrame:
    """Counts and users per product and outcome.

    Counted in two steps, per (product, user) and then per product, so a product with
    a third of the rows is spread by user.
    """
    names = ("completed", "refunded", "failed", "sync_failed")
    flags = {n: F.count_if(F.col("name") == f"purchase.{n}").alias(n) for n in names}
    per_user = events.groupBy("product_id", user).agg(*flags.values())
    sums = [F.sum(n).alias(n) for n in names]
    users = [F.count(F.when((F.col(n) > 0) & F.col(user).isNotNull(), 1)).alias(f"{n}_users") for n in names]
    return per_user.groupBy("product_id").agg(*sums, *users)
