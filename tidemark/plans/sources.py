"""Event batches, response bodies, the registry and the reject sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..fixtures import sql
from ..functions.wire import classify_outcome, parse_retry_after
from ..operators.contracts import contract_failure_breakdown, contract_failures_by_contract
from ..operators.delivery import delivery_outcomes
from ..sources.deadletter import to_dead_letter, undeliverable
from ..sources.events import pack_event_batches, parse_event_batches
from ..sources.registry import contract_test_refs, parse_contract_registry
from ..sources.responses import flatten_alias_links, flatten_entitlement_responses, flatten_heartbeats, split_heartbeats
from .registry import query


def _wire_events(spark, sf):
    return fx.events(spark, sf).selectExpr(
        "concat('app_', k % 3) as app_id",
        "case when k % 2 = 0 then 'production' else 'sandbox' end as environment",
        "concat('evt_', event_id) as event_id",
        "name",
        "ts_us div 1000 as timestamp_ms",
        "dev as anonymous_id",
        "case when k % 4 = 0 then '' when k % 4 = 1 then concat('user_', user_id) end as developer_user_id",
        "cast(null as string) as customer_id",
        "map('value', case when k % 7 = 0 then double('NaN') else value end, 'none', cast(null as double)) as properties",
    )


@query(
    "pack_event_batches",
    sql(
        """WITH n AS (SELECT 'app_' || (k % 3) AS app_id, CASE WHEN k % 2 = 0 THEN 'production' ELSE 'sandbox' END AS environment, event_id,
             (row_number() OVER (PARTITION BY k % 3, k % 2 ORDER BY ts_us // 1000, 'evt_' || event_id) - 1) // 20 AS batch_no FROM v_events)
           SELECT app_id, environment, batch_no, count(*) AS events, sum(event_id)::BIGINT AS ids FROM n GROUP BY ALL""",
        "v_events",
    ),
)
def _pack(spark, sf):
    packed = pack_event_batches(_wire_events(spark, sf), "sdk", "1.0")
    ids = F.from_json("value", "events array<struct<eventId:string>>")["events"]
    number = F.aggregate(ids, F.lit(0).cast("bigint"), lambda a, e: a + F.replace(e["eventId"], F.lit("evt_"), F.lit("")).cast("bigint"))
    return packed.select("app_id", "environment", "batch_no", "events", number.alias("ids"))


@query(
    "read_event_batches",
    sql(
        """SELECT 'app_' || (k % 3) AS app_id, CASE WHEN k % 2 = 0 THEN 'production' ELSE 'sandbox' END AS environment, 'evt_' || event_id AS event_id,
           name, ts_us // 1000 AS timestamp_ms, dev AS anonymous_id, CASE WHEN k % 4 = 1 THEN 'user_' || user_id END AS developer_user_id,
           CASE WHEN k % 7 <> 0 THEN value END AS value FROM v_events""",
        "v_events",
    ),
)
def _read_batches(spark, sf):
    rows, _ = parse_event_batches(pack_event_batches(_wire_events(spark, sf), "sdk", "1.0"))
    value = F.get_json_object("properties", "$.value").cast("double").alias("value")
    return rows.select("app_id", "environment", "event_id", "name", "timestamp_ms", "anonymous_id", "developer_user_id", value)


@query(
    "read_event_batches_incomplete",
    sql(
        """SELECT 'evt_' || event_id AS event_id, CASE WHEN k % 5 = 0 THEN 0 ELSE ts_us // 1000 END AS timestamp_ms FROM v_events
           WHERE k % 11 <> 0 AND k % 13 <> 0 AND k % 17 <> 0 AND k % 19 <> 0""",
        "v_events",
    ),
)
def _read_incomplete(spark, sf):
    docs = fx.events(spark, sf).selectExpr(
        "case when k % 11 = 0 then concat('{\"events\": [', event_id) else to_json(named_struct('appId', 'a', 'events', array(named_struct("
        "'eventId', case when k % 13 <> 0 then concat('evt_', event_id) end, 'name', case when k % 17 <> 0 then name else '' end, "
        "'timestamp', case when k % 5 <> 0 then ts_us div 1000 end, 'anonymousId', case when k % 19 <> 0 then dev end)))) end as value"
    )
    rows, _ = parse_event_batches(docs, received_ms=F.lit(0).cast("bigint"))
    return rows.select("event_id", "timestamp_ms")


@query(
    "account_for_event_batches",
    sql(
        """WITH d AS (SELECT event_id, k, CASE k % 10 WHEN 0 THEN 'no_events' WHEN 1 THEN 'no_events' WHEN 2 THEN 'no_events' WHEN 3 THEN 'malformed_batch'
             WHEN 4 THEN 'malformed_batch' WHEN 5 THEN 'malformed_batch' WHEN 6 THEN 'missing_event_name' ELSE 'event' END AS outcome FROM v_events)
           SELECT outcome, event_id, count(*) AS n FROM d GROUP BY ALL UNION ALL SELECT 'event', event_id, 1 FROM d WHERE k % 10 = 6""",
        "v_events",
    ),
)
def _accounted(spark, sf):
    """Every document, by its number, leaves a row or a reject: without events, empty, blank, cut off, and with one item that is no event."""
    good = "'{\"eventId\": \"', event_id, '\", \"name\": \"n\", \"anonymousId\": \"a\"}'"
    docs = fx.events(spark, sf).selectExpr(
        "case k % 10 when 0 then concat('{\"appId\": \"', event_id, '\"}') when 1 then concat('{\"events\": null, \"sdk\": \"', event_id, '\"}') "
        "when 2 then concat('{\"events\": [], \"sdk\": ', event_id, '}') when 3 then concat('{\"events\": [', event_id) when 4 then concat('oops ', event_id) "
        "when 5 then concat(event_id, '\u0000') "
        f"when 6 then concat('\\n {{\"events\": [', {good}, ', {{\"eventId\": \"', event_id, '\", \"name\": \"\"}}]}}') else concat('{{\"events\": [', {good}, ']}}') end as value"
    )
    rows, rejects = parse_event_batches(docs)
    number = F.regexp_extract("document", "([0-9]+)", 1).cast("bigint").alias("event_id")
    told = rejects.select(F.col("reject_code").alias("outcome"), number)
    both = rows.select(F.lit("event").alias("outcome"), F.col("event_id").cast("bigint")).unionByName(told)
    return both.groupBy("outcome", "event_id").agg(F.count(F.lit(1)).alias("n"))


def _bodies(spark, sf, kind):
    item = (
        "named_struct('key', case when k % 8 = 0 then '' else concat('key_', k % 5) end, 'isActive', case when k % 3 = 0 then null else k % 3 = 1 end, "
        "'validUntil', case when k % 2 = 0 then ts_us div 1000 end, 'updatedAt', ts_us div 1000, "
        "'source', case when k % 9 <> 0 then named_struct('rail', case when k % 4 = 0 then 'barter' else 'google' end, 'productId', concat('p_', k), 'subscriptionId', 's') end)"
    )
    other = "named_struct('key', 'extra', 'isActive', true, 'validUntil', bigint(null), 'updatedAt', bigint(0), 'source', named_struct('rail', 'manual', 'productId', '', 'subscriptionId', ''))"
    field = "entitlements" if kind == "purchases" else "data"
    return fx.events(spark, sf).selectExpr(
        "event_id",
        "case when k % 10 = 7 then 'not json' else to_json(named_struct('customerId', case when k % 10 <> 3 then concat('cust_', user_id) end, "
        f"'env', 'sandbox', '{field}', array({item}, {other}))) end as body",
    )


_ENTITLEMENT_SQL = """
    ok AS (SELECT * FROM v_events WHERE k % 10 NOT IN (3, 7))
    SELECT event_id, 'cust_' || user_id AS customer_id, 'key_' || (k % 5) AS key, k % 3 = 1 AS is_active,
           CASE WHEN k % 2 = 0 THEN ts_us // 1000 END AS valid_until_ms, 'google' AS rail, 'p_' || k AS product_id
    FROM ok WHERE k % 8 <> 0 AND k % 9 <> 0 AND k % 4 <> 0
    UNION ALL SELECT event_id, 'cust_' || user_id, 'extra', true, NULL, 'manual', '' FROM ok"""


def _entitlement_rows(spark, sf, kind):
    rows, _ = flatten_entitlement_responses(_bodies(spark, sf, kind), purchases=kind == "purchases")
    return rows.select("event_id", "customer_id", "key", "is_active", "valid_until_ms", "rail", "product_id")


@query("flatten_entitlement_responses", sql(f"WITH {_ENTITLEMENT_SQL}", "v_events"))
def _entitlements(spark, sf):
    return _entitlement_rows(spark, sf, "entitlements")


@query("flatten_purchase_responses", sql(f"WITH {_ENTITLEMENT_SQL}", "v_events"))
def _purchase_responses(spark, sf):
    return _entitlement_rows(spark, sf, "purchases")


@query(
    "reject_entitlement_responses",
    sql("SELECT event_id, 'entitlements_response_invalid' AS reject_code FROM v_events WHERE k % 10 IN (3, 7)", "v_events"),
)
def _entitlement_rejects(spark, sf):
    return flatten_entitlement_responses(_bodies(spark, sf, "entitlements"))[1].select("event_id", "reject_code")


@query(
    "flatten_alias_links",
    sql(
        """WITH ok AS (SELECT *, k % 3 <> 0 AS has_user, k % 5 <> 0 AS has_mail FROM v_events WHERE k % 10 <> 3)
           SELECT event_id, 'cust_' || user_id AS customer_id, k % 4 = 0 AS merge_pending, 'user' AS link_type, 'user_' || user_id AS link_id FROM ok WHERE has_user
           UNION ALL SELECT event_id, 'cust_' || user_id, k % 4 = 0, 'mail', 'm' || k FROM ok WHERE has_mail
           UNION ALL SELECT event_id, 'cust_' || user_id, k % 4 = 0, NULL, NULL FROM ok WHERE NOT has_user AND NOT has_mail""",
        "v_events",
    ),
)
def _alias_links(spark, sf):
    bodies = fx.events(spark, sf).selectExpr(
        "event_id",
        "to_json(named_struct('customerId', case when k % 10 <> 3 then concat('cust_', user_id) end, 'mergePending', case when k % 4 = 0 then true end, "
        "'linked', array(named_struct('type', 'user', 'id', case when k % 3 <> 0 then concat('user_', user_id) end), "
        "named_struct('type', case when k % 5 <> 0 then 'mail' else '' end, 'id', concat('m', k))))) as body",
    )
    return flatten_alias_links(bodies)[0].select("event_id", "customer_id", "merge_pending", "link_type", "link_id")


def _heartbeats(spark, sf):
    bodies = fx.events(spark, sf).selectExpr(
        "event_id",
        "ts_us div 1000 as received_ms",
        "case when k % 10 = 7 then '<html>' else to_json(named_struct('ok', case when k % 3 <> 0 then true end, 'projectId', 'prj', 'appId', "
        "concat('app_', user_id % 40), 'env', case when k % 2 = 0 then 'sandbox' else 'moon' end, "
        "'serverTime', case when k % 4 <> 0 then ts_us div 1000 - k end)) end as body",
    )
    return flatten_heartbeats(bodies)


_HEARTBEAT_SQL = """beats AS (SELECT event_id, ts_us // 1000 AS received_ms, k % 3 <> 0 AS ok, 'app_' || (user_id % 40) AS app_id,
    CASE WHEN k % 2 = 0 THEN 'sandbox' ELSE 'production' END AS env, CASE WHEN k % 4 <> 0 THEN ts_us // 1000 - k ELSE ts_us // 1000 END AS server_time_ms
    FROM v_events WHERE k % 10 <> 7)"""


@query("flatten_heartbeats", sql(f"WITH {_HEARTBEAT_SQL} SELECT * FROM beats", "v_events"))
def _flatten_heartbeats(spark, sf):
    return _heartbeats(spark, sf).drop("project_id")


@query(
    "account_for_heartbeats",
    sql(
        """SELECT event_id, CASE k % 8 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true END AS ok,
             CASE WHEN k % 8 > 2 THEN 'heartbeat_response_invalid' END AS reject_code FROM v_events""",
        "v_events",
    ),
)
def _account_for_heartbeats(spark, sf):
    """Bodies behind white space, empty objects, and six kinds of what is none: each leaves a row or a reject."""
    bodies = fx.events(spark, sf).selectExpr(
        "event_id",
        "bigint(0) as received_ms",
        "case k % 8 when 0 then ' \\n\\t{\"ok\": true}' when 1 then '{}' when 2 then '{\"ok\": \"TRUE\"} ' when 3 then '{\"ok\": tr' when 4 then '[]' when 5 then ' ' when 6 then 'null' end as body",
    )
    rows, rejects = split_heartbeats(bodies)
    return rows.select("event_id", "ok").unionByName(rejects.select("event_id", "reject_code"), allowMissingColumns=True)


@query(
    "latest_heartbeat",
    sql(
        f"""WITH {_HEARTBEAT_SQL} SELECT app_id, b.received_ms, b.event_id, b.received_ms - b.server_time_ms AS clock_skew_ms FROM
        (SELECT app_id, arg_max(beats, (received_ms, event_id)) AS b FROM beats GROUP BY app_id)""",
        "v_events",
    ),
)
def _latest_heartbeat(spark, sf):
    from ..operators.vitals import latest_heartbeat

    beats = _heartbeats(spark, sf).select("app_id", "received_ms", "event_id", "server_time_ms")
    return latest_heartbeat(beats).select("app_id", "received_ms", "event_id", "clock_skew_ms")


def _registry(spark, sf):
    """Registry documents of one contract each, from the parts."""
    contract = (
        "named_struct('id', concat('contract_', p_partkey), 'pillar', element_at(array('revenue', 'errors', 'identity', 'analytics', 'lifecycle'), "
        "cast(p_partkey % 5 as int) + 1), 'status', case when p_partkey % 4 = 0 then 'proposed' else 'enforced' end, 'claim', p_name, "
        "'appliesTo', array('android'), 'codeRef', array('a.kt'), 'testRef', transform(sequence(0, cast(p_partkey % 3 as int)), "
        "i -> named_struct('file', 't.kt', 'name', concat('case ', i))), 'registeredAt', '2024-01-01', 'firstRegisteredIn', '1', 'bundledIn', '1')"
    )
    docs = fx.table(spark, sf, "part").selectExpr(
        f"to_json(named_struct('sdkVersion', '1.0', 'bundledIn', '1', 'contracts', array({contract}))) as value"
    )
    return parse_contract_registry(docs)


_REGISTRY_SQL = """registry AS (SELECT 'contract_' || p_partkey AS id, ['revenue', 'errors', 'identity', 'analytics', 'lifecycle'][CAST(p_partkey % 5 AS INT) + 1] AS pillar,
    CASE WHEN p_partkey % 4 = 0 THEN 'proposed' ELSE 'enforced' END AS status, p_name AS claim, p_partkey % 3 + 1 AS tests FROM part)"""


@query("read_contract_registry", f"WITH {_REGISTRY_SQL} SELECT id, pillar, status, claim FROM registry")
def _read_registry(spark, sf):
    return _registry(spark, sf).select("id", "pillar", "status", "claim")


@query(
    "contract_test_refs",
    f"WITH {_REGISTRY_SQL} SELECT id AS contract_id, 'case ' || i AS test_name FROM (SELECT id, unnest(range(tests)) AS i FROM registry)",
)
def _test_refs(spark, sf):
    return contract_test_refs(_registry(spark, sf)).select("contract_id", "test_name")


def _failures(spark, sf):
    return fx.errors(spark, sf).selectExpr(
        "concat('contract_', k * 3) as contract_id",
        "concat('run_', user_id) as run_id",
        "case when k % 2 = 0 then 'android' else 'web' end as sdk_platform",
        "element_at(array('ci', 'dogfood', 'customer-app'), k % 3 + 1) as run_context",
    )


@query(
    "contract_failures_by_contract",
    sql(
        f"""WITH {_REGISTRY_SQL} SELECT 'contract_' || (e.k * 3) AS contract_id, any_value(r.pillar) AS pillar, any_value(r.status) AS contract_status,
        count(*) AS failures, count(DISTINCT e.user_id) AS runs, any_value(r.id) IS NOT NULL AS known
        FROM v_errors e LEFT JOIN registry r ON r.id = 'contract_' || (e.k * 3) GROUP BY e.k""",
        "v_errors",
    ),
)
def _by_contract(spark, sf):
    return contract_failures_by_contract(_failures(spark, sf), _registry(spark, sf))


@query(
    "contract_failure_breakdown",
    sql(
        """SELECT 'contract_' || (k * 3) AS contract_id, CASE WHEN k % 2 = 0 THEN 'android' ELSE 'web' END AS sdk_platform,
           ['ci', 'dogfood', 'customer-app'][k % 3 + 1] AS run_context, count(*) AS failures FROM v_errors GROUP BY ALL""",
        "v_errors",
    ),
)
def _breakdown(spark, sf):
    return contract_failure_breakdown(_failures(spark, sf))


_OUTCOME_SQL = """CASE WHEN status BETWEEN 200 AND 299 THEN 'success' WHEN status BETWEEN 400 AND 499 AND status NOT IN (408, 429) THEN 'permanent' ELSE 'retryable' END"""


@query(
    "dead_letter_split",
    sql(
        f"""SELECT CASE WHEN {_OUTCOME_SQL} = 'permanent' THEN 'rejected' ELSE 'kept' END AS side, coalesce(status, 0) AS status, count(*) AS n
        FROM v_attempts GROUP BY ALL""",
        "v_attempts",
    ),
)
def _dead_letter(spark, sf):
    error = F.when(classify_outcome(F.col("status")) == "permanent", F.lit("permanent_failure"))
    good, dead = to_dead_letter(fx.attempts(spark, sf), error)
    both = good.select(F.lit("kept").alias("side"), "status").unionByName(dead.select(F.lit("rejected").alias("side"), "status"))
    return both.groupBy("side", F.coalesce("status", F.lit(0)).alias("status")).agg(F.count(F.lit(1)).alias("n"))


def timed_attempts(spark, sf):
    wait = parse_retry_after(F.col("retry_after"), F.col("ts_ms"))
    return fx.attempts(spark, sf).withColumn("retry_after_ms", wait).drop("retry_after")


_OUTCOMES_SQL = f"""
    tries AS (SELECT *, {_OUTCOME_SQL} AS kind, row_number() OVER w AS n, count(*) FILTER (WHERE {_OUTCOME_SQL} = 'retryable') OVER w AS failures
              FROM v_attempts WINDOW w AS (PARTITION BY key ORDER BY ts_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    stated AS (SELECT *, CASE WHEN kind = 'success' THEN 'delivered' WHEN kind = 'permanent' THEN 'dropped_permanent'
                     WHEN failures >= 6 THEN 'retry_exhausted' END AS state FROM tries),
    ends AS (SELECT key, min(n) FILTER (WHERE state IS NOT NULL) AS ended, max(n) AS newest FROM stated GROUP BY key),
    outcomes AS (SELECT s.key, s.n AS attempts, coalesce(s.state, 'pending') AS state, CASE WHEN s.state IS NULL THEN s.ts_ms +
        CASE WHEN s.retry_after_s > 0 THEN least(s.retry_after_s * 1000, 86400000) ELSE CAST(least(1000 * pow(2, s.failures - 1), 30000) AS BIGINT) END END AS next_retry_ms
      FROM stated s JOIN ends e ON s.key = e.key AND s.n = coalesce(e.ended, e.newest))"""


@query("delivery_outcomes", sql(f"WITH {_OUTCOMES_SQL} SELECT * FROM outcomes", "v_attempts"))
def _outcomes(spark, sf):
    return delivery_outcomes(timed_attempts(spark, sf))


@query(
    "dead_letter_batches",
    sql(f"WITH {_OUTCOMES_SQL} SELECT key, attempts, state AS dead_letter_error FROM outcomes WHERE state IN ('dropped_permanent', 'retry_exhausted')", "v_attempts"),
)
def _dead_batches(spark, sf):
    outcomes = delivery_outcomes(timed_attempts(spark, sf))
    return to_dead_letter(outcomes, undeliverable(outcomes))[1].select("key", "attempts", "dead_letter_error")
