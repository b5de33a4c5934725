"""Identity, consent, super-properties, enrichment and erasure."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..fixtures import sql
from ..operators.gates import consent_gate
from ..operators.identity import (
    attach_consent,
    attach_identity,
    enrich_events,
    fold_error_context,
    fold_identity,
    fold_super_properties,
    forget,
    group_operations,
    resolve_customer,
)
from ..operators.sessions import lifecycle_sessions, session_log
from ..session import checkpoint_dir, cut_lineage
from ..sources import stored
from .registry import query
from .sessions import _LIFECYCLE

_IDENTITY = """
    ids AS (SELECT dev, ts_us, event_id, epoch, CASE WHEN epoch = 0 THEN dev ELSE 'anon_' || md5(dev || '#' || epoch) END AS anonymous_id,
                   u.v AS developer_user_id, c.v AS customer_id
            FROM (SELECT *, CAST(count(*) FILTER (WHERE op = 'reset') OVER w AS BIGINT) AS epoch,
                    last_value(CASE op WHEN 'identify' THEN {'v': nullif(trim("user"), '')} WHEN 'reset' THEN {'v': NULL::VARCHAR} END IGNORE NULLS) OVER w AS u,
                    last_value(CASE op WHEN 'alias' THEN {'v': nullif(trim(customer), '')} WHEN 'reset' THEN {'v': NULL::VARCHAR} END IGNORE NULLS) OVER w AS c
                  FROM v_identity_log WINDOW w AS (PARTITION BY dev ORDER BY ts_us, event_id)))"""


@query("fold_identity", sql(f"WITH {_IDENTITY} SELECT * FROM ids", "v_identity_log"))
def _fold_identity(spark, sf):
    return fold_identity(fx.identity_log(spark, sf))


@query(
    "attach_identity",
    sql(
        f"""WITH {_IDENTITY} SELECT e.event_id, coalesce(i.anonymous_id, e.dev) AS anonymous_id, i.developer_user_id, i.customer_id
        FROM v_events e ASOF LEFT JOIN ids i ON e.dev = i.dev AND e.ts_us >= i.ts_us""",
        "v_identity_log",
    ),
)
def _attach_identity(spark, sf):
    events = fx.events(spark, sf).select("event_id", "dev", "ts_us")
    state = cut_lineage(fold_identity(fx.identity_log(spark, sf)))
    return attach_identity(events, state).drop("dev", "ts_us")


_CONSENTED = """
    held AS (SELECT e.*, coalesce(c.analytics, true) AS consent_analytics, coalesce(c.errors, true) AS consent_errors
             FROM v_events e ASOF LEFT JOIN v_consent_log c ON e.dev = c.dev AND e.ts_us >= c.ts_us)"""


@query(
    "attach_consent",
    sql(f"WITH {_CONSENTED} SELECT event_id, consent_analytics, consent_errors FROM held", "v_consent_log"),
)
def _attach_consent(spark, sf):
    events = fx.events(spark, sf).select("event_id", "dev", "ts_us")
    return attach_consent(events, fx.consent_log(spark, sf)).drop("dev", "ts_us")


@query(
    "consent_gate",
    sql(
        f"""WITH {_CONSENTED} SELECT event_id, name FROM held
        WHERE CASE WHEN name = '$error' THEN consent_errors ELSE consent_analytics END AND user_id % 23 <> 0""",
        "v_consent_log",
    ),
)
def _consent_gate(spark, sf):
    events = fx.events(spark, sf)
    opted_out = events.filter("user_id % 23 = 0").select("dev").distinct()
    kept = consent_gate(events.select("event_id", "dev", "ts_us", "name"), fx.consent_log(spark, sf), opted_out)
    return kept.select("event_id", "name")


def _super_sql(name: str) -> str:
    return f"""
    {name}_epochs AS (SELECT *, count(*) FILTER (WHERE op = 'clear' OR (op = 'unregister' AND key = '{name}'))
                      OVER (PARTITION BY dev ORDER BY ts_us, event_id) AS epoch FROM v_super_log),
    {name}_state AS (SELECT dev, ts_us, event_id, coalesce(
                       last_value(CASE WHEN op = 'register' AND key = '{name}' THEN value END IGNORE NULLS) OVER w,
                       first_value(CASE WHEN op = 'registerOnce' AND key = '{name}' THEN value END IGNORE NULLS) OVER w) AS {name}
                     FROM {name}_epochs WINDOW w AS (PARTITION BY dev, epoch ORDER BY ts_us, event_id
                                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


_SUPER = f"""{_super_sql('plan')}, {_super_sql('tier')},
    supers AS (SELECT dev, ts_us, event_id, plan, tier FROM plan_state JOIN tier_state USING (dev, ts_us, event_id))"""


@query("fold_super_properties", sql(f"WITH {_SUPER} SELECT * FROM supers", "v_super_log"))
def _fold_super(spark, sf):
    log = fx.super_log(spark, sf)
    state = fold_super_properties(log)
    value = [F.try_element_at("props", F.lit(n)).alias(n) for n in ("plan", "tier")]
    return state.select("dev", "ts_us", "event_id", *value)


@query(
    "fold_many_super_properties",
    sql(
        """WITH ops AS (SELECT dev, ts_us, event_id, 'p' || (event_id % 331) AS name, CASE WHEN k % 10 < 5 THEN 'register' WHEN k % 10 < 8 THEN 'registerOnce'
             WHEN k % 10 = 8 THEN 'unregister' WHEN k = 99 THEN 'clear' ELSE 'register' END AS op, CAST(k AS VARCHAR) AS value FROM v_events),
        cleared AS (SELECT *, count(*) FILTER (WHERE op = 'clear') OVER (PARTITION BY dev ORDER BY ts_us, event_id) AS c FROM ops),
        gone AS (SELECT *, count(*) FILTER (WHERE op = 'unregister') OVER (PARTITION BY dev, c, name ORDER BY ts_us, event_id) AS g FROM cleared),
        vals AS (SELECT *, coalesce(last_value(CASE WHEN op = 'register' THEN value END IGNORE NULLS) OVER w, first_value(CASE WHEN op = 'registerOnce' THEN value END IGNORE NULLS) OVER w) AS v,
                   lead({'t': ts_us, 'e': event_id}) OVER (PARTITION BY dev, c, name ORDER BY ts_us, event_id) AS nxt FROM gone WHERE op <> 'clear'
                 WINDOW w AS (PARTITION BY dev, c, name, g ORDER BY ts_us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
        SELECT o.event_id, count(v.name) AS n, coalesce(string_agg(v.name || '=' || v.v, ',' ORDER BY v.name), '') AS props FROM cleared o
          LEFT JOIN vals v ON v.dev = o.dev AND v.c = o.c AND v.v IS NOT NULL AND (v.ts_us, v.event_id) <= (o.ts_us, o.event_id)
            AND (v.nxt IS NULL OR (o.ts_us, o.event_id) < (v.nxt.t, v.nxt.e)) GROUP BY o.event_id""",
        "v_events",
    ),
)
def _fold_many(spark, sf):
    ops = fx.events(spark, sf).selectExpr(
        "dev",
        "ts_us",
        "event_id",
        "concat('p', event_id % 331) as key",
        "case when k % 10 < 5 then 'register' when k % 10 < 8 then 'registerOnce' when k % 10 = 8 then 'unregister' when k = 99 then 'clear' else 'register' end as op",
        "cast(k as string) as value",
    )
    pairs = F.transform(F.array_sort(F.map_entries("props")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    state = fold_super_properties(ops)
    return state.select("event_id", F.size("props").cast("bigint").alias("n"), F.array_join(pairs, ",").alias("props"))


@query(
    "group_operations",
    sql(
        """SELECT dev, ts_us, event_id, last_value(CASE WHEN k % 4 = 0 THEN {'v': NULL::VARCHAR} ELSE {'v': 'org_' || (k % 6)} END IGNORE NULLS)
           OVER (PARTITION BY dev ORDER BY ts_us, event_id).v AS group_org FROM v_events WHERE name = 'group.set'""",
        "v_events",
    ),
)
def _groups(spark, sf):
    calls = (
        fx.events(spark, sf)
        .filter("name = 'group.set'")
        .selectExpr(
            "dev", "ts_us", "event_id", "'org' as group_type", "case when k % 4 <> 0 then concat('org_', k % 6) end as group_key"
        )
    )
    state = fold_super_properties(group_operations(calls))
    return state.select("dev", "ts_us", "event_id", F.try_element_at("props", F.lit("group_org")).alias("group_org"))


@query(
    "fold_error_context",
    sql(
        """SELECT dev, ts_us, event_id, t.v AS plan_tag, b.v AS cart_total FROM (SELECT *,
             last_value(CASE WHEN k % 3 = 0 THEN {'v': 'p' || k} WHEN k % 3 = 1 THEN {'v': CASE WHEN k % 2 = 0 THEN 'bulk' END} END IGNORE NULLS) OVER w AS t,
             last_value(CASE WHEN k % 3 = 2 THEN {'v': CASE WHEN k % 4 <> 0 THEN CAST(k AS VARCHAR) END} END IGNORE NULLS) OVER w AS b
           FROM v_events WHERE name = 'element.clicked' WINDOW w AS (PARTITION BY dev ORDER BY ts_us, event_id))""",
        "v_events",
    ),
)
def _error_context(spark, sf):
    ops = (
        fx.events(spark, sf)
        .filter("name = 'element.clicked'")
        .selectExpr(
            "dev",
            "ts_us",
            "event_id",
            "case k % 3 when 0 then 'set_tag' when 1 then 'set_tags' else 'set_context' end as op",
            "case k % 3 when 0 then 'plan' when 2 then 'cart' end as name",
            "concat('p', k) as value",
            "case when k % 3 = 1 and k % 2 = 0 then map('plan', 'bulk') when k % 3 = 2 and k % 4 <> 0 "
            "then map('total', cast(k as string)) else cast(map() as map<string,string>) end as data",
        )
    )
    state = fold_error_context(ops)
    cart = F.try_element_at("context", F.lit("cart"))
    return state.select(
        "dev",
        "ts_us",
        "event_id",
        F.try_element_at("tags", F.lit("plan")).alias("plan_tag"),
        F.try_element_at(cart, F.lit("total")).alias("cart_total"),
    )


BAG = (
    "map_filter(map('plan', case when k % 5 = 0 then 'caller' end, 'note', concat('mail u', user_id, '@example.com'), "
    "'sessionId', 'given'), (k, v) -> v is not null) as properties"
)

_ENRICHED = f"""WITH {_SUPER}, {_IDENTITY}, {_LIFECYCLE},
        log AS (SELECT dev, ts_us, event_id, max(session_id) FILTER (WHERE name = 'session.started') AS session_id FROM emitted GROUP BY ALL),
        e1 AS (SELECT e.*, s.plan, s.tier FROM v_events e ASOF LEFT JOIN supers s ON e.dev = s.dev AND e.ts_us >= s.ts_us),
        e2 AS (SELECT e.*, l.session_id FROM e1 e ASOF LEFT JOIN log l ON e.dev = l.dev AND e.ts_us >= l.ts_us),
        e3 AS (SELECT e.*, d.version FROM e2 e ASOF LEFT JOIN v_launches d ON e.dev = d.dev AND e.ts_us >= d.ts_us),
        e4 AS (SELECT e.*, i.developer_user_id FROM e3 e ASOF LEFT JOIN ids i ON e.dev = i.dev AND e.ts_us >= i.ts_us),
        e5 AS (SELECT e.*, CASE WHEN e.name = '$error' THEN c.errors ELSE c.analytics END AS granted
               FROM e4 e ASOF LEFT JOIN v_consent_log c ON e.dev = c.dev AND e.ts_us >= c.ts_us)
        SELECT event_id, developer_user_id, CASE WHEN name = '$error' THEN CASE WHEN k % 5 = 0 THEN 'caller' END
               WHEN k % 5 = 0 THEN 'caller' ELSE plan END AS plan,
               CASE WHEN name <> '$error' THEN tier END AS tier, CASE WHEN name <> '$error' THEN version END AS app_version,
               CASE WHEN name = '$error' THEN 'mail u' || user_id || '@example.com' ELSE 'mail <email>' END AS note,
               CASE WHEN name = '$error' THEN 'given' ELSE coalesce(session_id, 'given') END AS session_id
        FROM e5 WHERE coalesce(granted, true)"""


@query(
    "enrich_events",
    sql(
        _ENRICHED,
        "v_super_log",
        "v_identity_log",
        "v_lifecycle",
        "v_launches",
        "v_consent_log",
    ),
)
def _enrich(spark, sf):
    events = fx.events(spark, sf).selectExpr("event_id", "dev", "ts_us", "name", BAG)
    device = fx.launches(spark, sf).selectExpr("dev", "ts_us", "event_id", "map('app_version', version) as payload")
    out = enrich_events(
        events,
        identity=cut_lineage(fold_identity(fx.identity_log(spark, sf))),
        consent=fx.consent_log(spark, sf),
        super_properties=cut_lineage(fold_super_properties(fx.super_log(spark, sf))),
        device=device,
        session=cut_lineage(session_log(lifecycle_sessions(fx.lifecycle(spark, sf)))),
        measure=fx.events(spark, sf).select("dev", "ts_us"),
    )
    props = [
        F.try_element_at("properties", F.lit(n)).alias(a)
        for n, a in (("plan", "plan"), ("tier", "tier"), ("app_version", "app_version"), ("note", "note"), ("sessionId", "session_id"))
    ]
    return out.select("event_id", "developer_user_id", *props)


@query(
    "resolve_customer",
    sql(
        """WITH a AS (SELECT dev, trim("user") AS u, customer, ts_us, event_id FROM v_identity_log WHERE op = 'alias')
        SELECT e.event_id, coalesce(x.customer, y.customer) AS customer_id FROM
          (SELECT *, CASE WHEN k % 2 = 0 THEN 'user_' || user_id || '_' || (k % 3) END AS u FROM v_events) e
          LEFT JOIN (SELECT u, arg_max(customer, (ts_us, event_id)) AS customer FROM a GROUP BY u) x USING (u)
          LEFT JOIN (SELECT dev, arg_max(customer, (ts_us, event_id)) AS customer FROM a GROUP BY dev) y USING (dev)""",
        "v_identity_log",
    ),
)
def _resolve_customer(spark, sf):
    aliases = (
        fx.identity_log(spark, sf)
        .filter("op = 'alias'")
        .selectExpr("dev", "trim(user) as developer_user_id", "customer as customer_id", "ts_us", "event_id")
    )
    events = fx.events(spark, sf).selectExpr(
        "event_id", "dev", "case when k % 2 = 0 then concat('user_', user_id, '_', k % 3) end as developer_user_id"
    )
    return resolve_customer(events, aliases).select("event_id", "customer_id")


@query(
    "forget",
    sql("SELECT event_id FROM v_events WHERE user_id % 17 <> 0", "v_events"),
)
def _forget(spark, sf):
    events = fx.events(spark, sf).selectExpr(
        "event_id", "dev", "cast(user_id as string) as user", "concat('cust_', user_id) as customer"
    )
    ids = {"user": "user", "dev": "dev", "customer": "customer"}
    return forget(events, fx.forget_requests(spark, sf), ids).select("event_id")


@query(
    "forget_in_stored_table",
    sql("SELECT event_id FROM v_events WHERE user_id % 17 <> 0", "v_events"),
)
def _forget_stored(spark, sf):
    """The same rule on a written table, of which only files with a hit are written anew."""
    path = f"{checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    rows = fx.events(spark, sf).selectExpr("event_id", "dev", "cast(user_id as string) as user", "concat('cust_', user_id) as customer")
    rows.repartitionByRange("user").write.parquet(path)
    stored.erase_stored(spark, path, fx.forget_requests(spark, sf), {"user": "user", "dev": "dev", "customer": "customer"}, "asked")
    return stored.read_stored(spark, path, rows.schema).select("event_id")
