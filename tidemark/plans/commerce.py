"""Purchases, syncs and entitlements."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..fixtures import sql
from ..functions.wire import decode_error_envelope
from ..operators import entitlements as ent
from ..operators import purchases as pur
from ..operators.delivery import resolve_replays
from .registry import query

_BILLING = """
    done AS (SELECT * FROM v_purchases WHERE response_code = 0 AND NOT no_purchases),
    billed AS (SELECT event_id, user_id, CASE WHEN is_revoked THEN 'purchase.refunded' ELSE 'purchase.completed' END AS name, product_id, order_id,
                      purchase_token, NULL::INT AS billing_response_code FROM done
               UNION ALL SELECT event_id, user_id, 'purchase.failed', NULL, NULL, NULL, response_code FROM v_purchases WHERE response_code <> 0)"""

_SYNCS = """
    synced AS (SELECT *, CASE WHEN status BETWEEN 200 AND 299 THEN NULL
                 WHEN event_id % 2 = 0 AND status = 400 THEN {'type': 'invalid_request_error', 'code': 'bad_request', 'rid': 'r' || event_id}
                 WHEN event_id % 2 = 0 AND status = 429 THEN {'type': 'rate_limit_error', 'code': 'rate_limited', 'rid': 'r' || event_id}
                 WHEN event_id % 2 = 0 AND status = 503 THEN {'type': 'internal_error', 'code': 'server_error', 'rid': 'r' || event_id}
                 WHEN event_id % 2 = 0 AND status IS NOT NULL THEN {'type': 'internal_error', 'code': 'http_' || status, 'rid': 'r' || event_id}
                 ELSE {'type': 'internal_error', 'code': 'auto_billing_sync_failed', 'rid': NULL::VARCHAR} END AS err
               FROM done WHERE signature IS NOT NULL AND purchase_token <> '')"""


def _syncs(spark, sf):
    to_send, _ = pur.purchases_to_sync(fx.billing_results(spark, sf), "acme")
    error = decode_error_envelope(F.col("status"), F.lit(None).cast("string"), F.concat(F.lit("r"), F.col("event_id")))
    carried = F.when((F.col("event_id") % 2 == 0) & F.col("status").isNotNull(), error)
    return pur.billing_sync_result(to_send.withColumn("error", carried))


@query("billing_to_events", sql(f"WITH {_BILLING} SELECT * FROM billed", "v_purchases"))
def _billing(spark, sf):
    events = pur.billing_to_events(fx.billing_results(spark, sf))
    return events.select("event_id", "user_id", "name", "product_id", "order_id", "purchase_token", "billing_response_code")


@query(
    "purchases_to_sync",
    sql(
        f"""WITH {_BILLING}, s AS (SELECT *, sha256('acme:purchases/sync:google:' || nullif(purchase_token, '')) AS h FROM done WHERE signature IS NOT NULL)
        SELECT event_id, h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] AS idempotency_key,
               CASE WHEN h IS NULL THEN 'missing_identifier' END AS reject_code FROM s""",
        "v_purchases",
    ),
)
def _to_sync(spark, sf):
    send, refused = pur.purchases_to_sync(fx.billing_results(spark, sf), "acme")
    both = send.select("event_id", "idempotency_key").unionByName(
        refused.select("event_id", "reject_code"), allowMissingColumns=True
    )
    return both


@query(
    "billing_sync_result",
    sql(
        f"""WITH {_BILLING}, {_SYNCS} SELECT event_id, err IS NULL AS ok, err.type AS error_type, err.code AS error_code,
        CASE WHEN err IS NOT NULL THEN status END AS error_status FROM synced""",
        "v_purchases",
    ),
)
def _sync_result(spark, sf):
    return _syncs(spark, sf).select(
        "event_id",
        F.col("sync_error").isNull().alias("ok"),
        F.col("sync_error.type").alias("error_type"),
        F.col("sync_error.code").alias("error_code"),
        F.col("sync_error.status").alias("error_status"),
    )


@query(
    "sync_failed_events",
    sql(
        f"""WITH {_BILLING}, {_SYNCS} SELECT event_id, 'purchase.sync_failed' AS name, 'google' AS rail, product_id, purchase_token, order_id,
        err.type AS error_type, err.code AS error_code, status AS status_code, err.rid AS request_id FROM synced WHERE err IS NOT NULL""",
        "v_purchases",
    ),
)
def _sync_failed(spark, sf):
    return pur.sync_failed_events(_syncs(spark, sf)).drop("dev", "user_id", "ts_us")


_REPLAYS = """
    numbered AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts_ms, event_id) AS n FROM v_requests),
    replayed AS (
      WITH RECURSIVE r AS (
        SELECT key, n, event_id, 'executed' AS outcome, CASE WHEN status BETWEEN 200 AND 299 THEN ts_ms END AS at,
               CASE WHEN status BETWEEN 200 AND 299 THEN body_hash END AS body FROM numbered WHERE n = 1
        UNION ALL
        SELECT x.key, x.n, x.event_id,
               CASE WHEN r.at IS NOT NULL AND x.ts_ms - r.at < 86400000 THEN CASE WHEN x.body_hash = r.body THEN 'replayed' ELSE 'conflict' END ELSE 'executed' END,
               CASE WHEN r.at IS NOT NULL AND x.ts_ms - r.at < 86400000 THEN r.at WHEN x.status BETWEEN 200 AND 299 THEN x.ts_ms ELSE r.at END,
               CASE WHEN r.at IS NOT NULL AND x.ts_ms - r.at < 86400000 THEN r.body WHEN x.status BETWEEN 200 AND 299 THEN x.body_hash ELSE r.body END
        FROM r JOIN numbered x ON x.key = r.key AND x.n = r.n + 1)
      SELECT * FROM r)"""


@query(
    "resolve_replays",
    sql(
        f"""WITH {_REPLAYS} SELECT key, event_id, outcome,
        CASE outcome WHEN 'replayed' THEN 'idempotent_replay' WHEN 'conflict' THEN 'idempotency_key_in_use' END AS code FROM replayed""",
        "v_requests",
    ),
)
def _replays(spark, sf):
    return resolve_replays(fx.requests(spark, sf)).select("key", "event_id", "outcome", "code")


@query(
    "sync_completed_events",
    sql(
        f"""WITH {_REPLAYS} SELECT e.event_id, 'purchase.completed' AS name, 'apple' AS rail, CASE WHEN e.k % 4 <> 0 THEN 'p_' || (e.k % 4) END AS product_id,
        CASE WHEN e.k % 4 <> 0 THEN 'sub' END AS subscription_id, r.outcome = 'replayed' AS idempotent_replay
        FROM replayed r JOIN v_events e USING (event_id) JOIN v_requests q USING (event_id) WHERE q.status BETWEEN 200 AND 299""",
        "v_requests",
    ),
)
def _sync_completed(spark, sf):
    return pur.sync_completed_events(_manual_syncs(spark, sf)).drop("user_id")


def _manual_syncs(spark, sf):
    """Manual syncs: a request, its response status and the entitlements it returned."""
    found = fx.events(spark, sf).filter("name = 'purchase.completed'").selectExpr(
        "event_id",
        "user_id",
        "ts_us div 1000 as ts_ms",
        "concat('key_', event_id % 200) as key",
        "concat('h', k % 3) as body_hash",
        f"{fx._STATUS} as status",
        "'apple' as rail",
        "case when k % 4 = 0 then cast(array() as array<struct<source:struct<productId:string,subscriptionId:string>>>) "
        "else transform(sequence(k % 4, 3), i -> named_struct('source', named_struct('productId', concat('p_', i), 'subscriptionId', 'sub'))) end as entitlements",
    )
    return resolve_replays(found)


@query(
    "reconcile_purchases",
    sql(
        f"""WITH {_BILLING}, {_SYNCS},
        b AS (SELECT purchase_token, count(*) AS purchases FROM billed WHERE name = 'purchase.completed' GROUP BY ALL),
        s AS (SELECT purchase_token, count(*) AS syncs, bool_or(err IS NULL) AS ok FROM synced GROUP BY ALL)
        SELECT purchase_token, coalesce(purchases, 0) AS purchases, coalesce(syncs, 0) AS syncs, CASE WHEN purchases IS NULL THEN 'sync_only'
               WHEN syncs IS NULL THEN 'never_synced' WHEN ok THEN 'synced' ELSE 'failed' END AS state FROM b FULL JOIN s USING (purchase_token)""",
        "v_purchases",
    ),
)
def _reconcile(spark, sf):
    completed = pur.billing_to_events(fx.billing_results(spark, sf)).filter("name = 'purchase.completed'")
    return pur.reconcile_purchases(completed, _syncs(spark, sf))


@query(
    "union_purchase_paths",
    sql(
        f"""WITH {_BILLING}, {_REPLAYS} SELECT path, name, count(*) AS n, count(product_id) AS with_product FROM (
          SELECT 'automatic' AS path, name, product_id FROM billed UNION ALL
          SELECT 'manual', 'purchase.completed', CASE WHEN e.k % 4 <> 0 THEN 'p' END FROM v_requests q JOIN v_events e USING (event_id) WHERE q.status BETWEEN 200 AND 299)
        GROUP BY ALL""",
        "v_purchases",
        "v_requests",
    ),
)
def _union(spark, sf):
    automatic = pur.billing_to_events(fx.billing_results(spark, sf))
    both = pur.union_purchase_paths(automatic, pur.sync_completed_events(_manual_syncs(spark, sf)))
    return both.groupBy("path", "name").agg(F.count(F.lit(1)).alias("n"), F.count("product_id").alias("with_product"))


@query(
    "purchase_funnel",
    sql(
        f"""WITH {_BILLING}, {_SYNCS}, f AS (SELECT product_id, user_id, name FROM billed UNION ALL
          SELECT product_id, user_id, 'purchase.sync_failed' FROM synced WHERE err IS NOT NULL)
        SELECT product_id, """
        + ", ".join(
            f"count(*) FILTER (WHERE name = 'purchase.{n}') AS {n}, count(DISTINCT user_id) FILTER (WHERE name = 'purchase.{n}') AS {n}_users"
            for n in ("completed", "refunded", "failed", "sync_failed")
        )
        + " FROM f GROUP BY product_id",
        "v_purchases",
    ),
)
def _funnel(spark, sf):
    events = pur.billing_to_events(fx.billing_results(spark, sf))
    failed = pur.sync_failed_events(_syncs(spark, sf))
    return pur.purchase_funnel(events.unionByName(failed, allowMissingColumns=True))


_AT = fx.AT_US
_VALID = 'active AND (valid_until_us IS NULL OR valid_until_us > {at})'
_LATEST = f"""
    newest AS (SELECT "user", max(ts_us) AS ts_us FROM v_snapshots WHERE ts_us <= {_AT} GROUP BY ALL),
    held AS (SELECT s.* FROM v_snapshots s JOIN newest n USING ("user", ts_us))"""


def _entitlement_requests(spark, sf):
    users = fx.table(spark, sf, "customer").selectExpr("c_custkey as user")
    keys = F.array(*[F.lit(k) for k in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")])
    return users.select("user", F.explode(keys).alias("key"))


@query("latest_snapshot", sql(f"WITH {_LATEST} SELECT * FROM held", "v_snapshots"))
def _latest_snapshot(spark, sf):
    return ent.latest_snapshot(fx.snapshots(spark, sf), _AT)


@query(
    "is_entitled",
    sql(
        f"""WITH {_LATEST} SELECT c.c_custkey AS "user", k.key, coalesce(bool_or({_VALID.format(at=_AT)}), false) AS entitled
        FROM customer c CROSS JOIN (SELECT unnest(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW']) AS key) k
        LEFT JOIN held h ON h."user" = c.c_custkey AND h.key = k.key GROUP BY ALL""",
        "v_snapshots",
    ),
)
def _is_entitled(spark, sf):
    return ent.is_entitled(_entitlement_requests(spark, sf), fx.snapshots(spark, sf), _AT)


@query(
    "is_entitled_as_of",
    sql(
        f"""WITH req AS (SELECT o_orderkey AS request_id, o_custkey AS "user", epoch_us(o_orderdate) + 30 * 86400000000 AS at, '2-HIGH' AS key FROM orders),
        times AS (SELECT DISTINCT "user", ts_us FROM v_snapshots),
        timed AS (SELECT r.*, t.ts_us AS snap FROM req r ASOF LEFT JOIN times t ON r."user" = t."user" AND r.at >= t.ts_us)
        SELECT a.request_id, coalesce({_VALID.format(at='a.at')}, false) AS entitled
        FROM timed a LEFT JOIN v_snapshots s ON s."user" = a."user" AND s.ts_us = a.snap AND s.key = a.key""",
        "v_snapshots",
    ),
)
def _is_entitled_as_of(spark, sf):
    requests = fx.table(spark, sf, "orders").selectExpr(
        "o_orderkey as request_id",
        "o_custkey as user",
        "unix_micros(cast(o_orderdate as timestamp)) + 30 * 86400000000L as ts_us",
        "'2-HIGH' as key",
    )
    return ent.is_entitled_as_of(requests, fx.snapshots(spark, sf)).select("request_id", "entitled")


@query(
    "is_entitled_as_of_every_key",
    sql(
        f"""WITH req AS (SELECT o_orderkey AS request_id, o_custkey AS "user", epoch_us(o_orderdate) + 30 * 86400000000 AS at,
             unnest(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW', 'unknown']) AS key FROM orders),
        times AS (SELECT DISTINCT "user", ts_us FROM v_snapshots),
        timed AS (SELECT r.*, t.ts_us AS snap FROM req r ASOF LEFT JOIN times t ON r."user" = t."user" AND r.at >= t.ts_us)
        SELECT a.request_id, a.key, coalesce({_VALID.format(at='a.at')}, false) AS entitled
        FROM timed a LEFT JOIN v_snapshots s ON s."user" = a."user" AND s.ts_us = a.snap AND s.key = a.key""",
        "v_snapshots",
    ),
)
def _is_entitled_as_of_every_key(spark, sf):
    keys = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "unknown"]
    requests = fx.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order"),
        F.col("o_custkey").alias("user"),
        (F.unix_micros(F.col("o_orderdate").cast("timestamp")) + 30 * 86_400_000_000).alias("ts_us"),
        F.posexplode(F.array(*map(F.lit, keys))).alias("nth", "key"),
    )
    asked = requests.withColumn("request_id", F.col("order") * len(keys) + F.col("nth")).drop("nth")
    return ent.is_entitled_as_of(asked, fx.snapshots(spark, sf)).select(F.col("order").alias("request_id"), "key", "entitled")


@query(
    "active_keys",
    sql(
        f"""WITH {_LATEST} SELECT c.c_custkey AS "user", array_to_string(k.keys, ',') AS keys FROM customer c LEFT JOIN
        (SELECT "user", coalesce(list_sort(list(DISTINCT key) FILTER (WHERE {_VALID.format(at=_AT)})), []) AS keys FROM held GROUP BY ALL) k
        ON k."user" = c.c_custkey""",
        "v_snapshots",
    ),
)
def _active_keys(spark, sf):
    users = fx.table(spark, sf, "customer").selectExpr("c_custkey as user")
    found = ent.active_keys(users, fx.snapshots(spark, sf), _AT)
    return found.select("user", F.array_join("active_keys", ",").alias("keys"))


@query(
    "entitlement_freshness",
    sql(
        f"""WITH t AS (SELECT "user", max(ts_us) AS taken FROM v_snapshots WHERE ts_us <= {_AT} GROUP BY ALL),
        f AS (SELECT "user", max(ts_us) AS failed FROM v_refresh_failures WHERE ts_us <= {_AT} GROUP BY ALL)
        SELECT "user", taken AS last_updated_us, {_AT} - taken > 60000000 AS is_stale, CASE WHEN failed > taken THEN failed END AS last_refresh_failed_us
        FROM t LEFT JOIN f USING ("user")""",
        "v_snapshots",
        "v_refresh_failures",
    ),
)
def _freshness(spark, sf):
    return ent.freshness(fx.snapshots(spark, sf), fx.refresh_failures(spark, sf), _AT)


_DOCS = """docs AS (SELECT "user", ts_us, list({'k': key, 'a': active, 'v': valid_until_us} ORDER BY key) AS items FROM v_snapshots GROUP BY ALL)"""


@query("entitlement_changes", sql(f'WITH {_DOCS} SELECT "user", ts_us, len(items) AS n FROM docs', "v_snapshots"))
def _changes(spark, sf):
    return ent.entitlement_changes(fx.snapshots(spark, sf)).select("user", "ts_us", F.size("entitlements").cast("bigint").alias("n"))


@query(
    "entitlement_changes_only",
    sql(
        f"""WITH {_DOCS.replace('v_snapshots', "(SELECT * REPLACE (NULL AS valid_until_us) FROM v_snapshots)")}
        SELECT "user", ts_us, n FROM (SELECT "user", ts_us, len(items) AS n, items IS DISTINCT FROM
        lag(items) OVER (PARTITION BY "user" ORDER BY ts_us) AS changed FROM docs) WHERE changed""",
        "v_snapshots",
    ),
)
def _changes_only(spark, sf):
    snapshots = fx.snapshots(spark, sf).withColumn("valid_until_us", F.lit(None).cast("bigint"))
    changes = ent.entitlement_changes(snapshots, entitlements_only=True)
    return changes.select("user", "ts_us", F.size("entitlements").cast("bigint").alias("n"))
