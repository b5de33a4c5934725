"""The streaming forms, run over the tables as streams; their SQL is that of the batch forms."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..fixtures import Streams, sql
from ..session import checkpoint_dir, configure
from ..operators.delivery import delivery_outcomes, first_event_sent
from ..operators.gates import ingest_gate
from ..operators.identity import attach_consent
from ..streaming import ingest, signals, stateful
from ..streaming.deliver import subscribe
from ..streaming.run import run_available
from .commerce import _BILLING, _REPLAYS, _SYNCS, _syncs
from .health import _TAPS, _VIEWS, _greedy
from .identity import _CONSENTED, _ENRICHED, _IDENTITY, _SUPER, BAG
from .registry import QUERIES, query
from .sessions import _LIFECYCLE, _SESSIONS
from .sources import _OUTCOMES_SQL, timed_attempts


#: The log's rows come up to an hour late, and the streams allow for that.
DELAY_US = 3_600_000_000
LATE = "1 hour"


def _shuffled(spark) -> Streams:
    configure(spark)
    return Streams(spark, end=True, delay_us=DELAY_US - 1)


def _without_end(rows):
    return rows.filter(F.col("dev") != fx.END_DEVICE)


def _events(spark, sf, delay_us=0):
    configure(spark)
    return fx.events(Streams(spark, end=True, delay_us=delay_us), sf).withColumn("ts", F.timestamp_micros("ts_us"))


@query("stream_dedup", sql("SELECT event_id, dev, name FROM v_events", "v_events"))
def _dedup(spark, sf):
    twice = _events(spark, sf, DELAY_US).filter(F.col("dev") != fx.END_DEVICE).withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("event_id") % 7 == 0).cast("int"))))
    return run_available(ingest.dedup_stream(twice.select("event_id", "dev", "name", "ts"))).drop("ts")


@query(
    "stream_sessions",
    sql(
        f"""WITH {_SESSIONS.format(source='v_events')}
        SELECT dev, min(ts_us) AS start_us, max(ts_us) AS end_us, count(*) AS events FROM sessions GROUP BY dev, session_no""",
        "v_events",
    ),
)
def _sessions(spark, sf):
    closed = run_available(ingest.session_stream(_events(spark, sf, DELAY_US - 1).select("dev", "ts"), late=LATE))
    return closed.filter(F.col("dev") != fx.END_DEVICE)


@query("stream_lifecycle_sessions", sql(f"WITH {_LIFECYCLE} SELECT * FROM emitted", "v_lifecycle"))
def _lifecycle(spark, sf):
    return _without_end(run_available(stateful.lifecycle_stream(fx.lifecycle(_shuffled(spark), sf), late=LATE)))


@query("stream_fold_identity", sql(f"WITH {_IDENTITY} SELECT * FROM ids", "v_identity_log"))
def _identity(spark, sf):
    ops = fx.identity_log(_shuffled(spark), sf).select("dev", "ts_us", "event_id", "op", "user", "customer")
    return _without_end(run_available(stateful.identity_stream(ops, late=LATE)))


@query("stream_fold_super_properties", sql(f"WITH {_SUPER} SELECT * FROM supers", "v_super_log"))
def _super(spark, sf):
    state = _without_end(run_available(stateful.super_properties_stream(fx.super_log(_shuffled(spark), sf), late=LATE)))
    value = [F.try_element_at("props", F.lit(n)).alias(n) for n in ("plan", "tier")]
    return state.select("dev", "ts_us", "event_id", *value)


@query("stream_resolve_replays", sql(f"WITH {_REPLAYS} SELECT key, event_id, outcome FROM replayed", "v_requests"))
def _replays(spark, sf):
    return run_available(stateful.replays_stream(fx.requests(_shuffled(spark), sf), late=LATE)).filter("event_id >= 0").drop("ts_ms")


@query("stream_coalesce_screens", sql(f"WITH {_greedy(_VIEWS, 'screen', 250)} SELECT dev, event_id FROM walked WHERE kept", "v_fast"))
def _screens(spark, sf):
    views = fx.fast(_shuffled(spark), sf).selectExpr(
        "dev", "event_id", "c_ms div 8 as ts_ms", "case when k % 8 = 0 then 'b' else 'a' end as value"
    )
    return _without_end(run_available(stateful.coalesce_stream(views, 250, late="1 second"))).select("dev", "event_id")


@query("stream_coalesce_taps", sql(f"WITH {_greedy(_TAPS, 'element', 100)} SELECT dev, event_id FROM walked WHERE kept", "v_fast"))
def _taps(spark, sf):
    taps = (
        fx.fast(_shuffled(spark), sf)
        .filter("name = 'element.clicked'")
        .selectExpr("dev", "event_id", "c_ms as ts_ms", "concat('e', k % 2) as value")
    )
    return _without_end(run_available(stateful.coalesce_stream(taps, 100, late="1 second"))).select("dev", "event_id")


@query(
    "stream_frame_jank",
    sql(
        """WITH d AS (SELECT dev, ts_us, ts_us * 10 - lag(ts_us * 10) OVER (PARTITION BY dev ORDER BY ts_us, event_id) AS delta FROM v_events),
        w AS (SELECT dev, ts_us // 60000000 * 60000000 AS window_start_us, count(*) AS total_frames,
                count(*) FILTER (WHERE delta > 16000000 AND delta <= 700000000) AS slow_frames, count(*) FILTER (WHERE delta > 700000000) AS frozen_frames
              FROM d WHERE delta IS NOT NULL GROUP BY ALL)
        SELECT * FROM w""",
        "v_events",
    ),
)
def _jank(spark, sf):
    frames = fx.events(_shuffled(spark), sf).selectExpr("dev", "event_id", "ts_us * 10 as frame_ns")
    # Frame times run at a hundredth of the clock here: a minute is 600 ms, an hour 36 s.
    jank = stateful.frame_jank_stream(frames, window_ms=600, late="36 seconds")
    return _without_end(run_available(jank)).withColumn("window_start_us", F.expr("window_start_us * 100"))


@query("stream_enrich_events", sql(_ENRICHED, "v_super_log", "v_identity_log", "v_lifecycle", "v_launches", "v_consent_log"))
def _enrich(spark, sf):
    """Events and all changes to what is in force, in one stream out of order."""
    streams = _shuffled(spark)
    log = stateful.enriching_log(
        events=fx.events(streams, sf).selectExpr("event_id", "dev", "ts_us", "name", BAG),
        identity=fx.identity_log(streams, sf),
        consent=fx.consent_log(streams, sf),
        super_properties=fx.super_log(streams, sf),
        device=fx.launches(streams, sf).selectExpr("dev", "ts_us", "event_id", "map('app_version', version) as payload"),
        lifecycle=fx.lifecycle(streams, sf),
    )
    found = _without_end(run_available(stateful.enrich_stream(log, late=LATE)))
    names = (("plan", "plan"), ("tier", "tier"), ("app_version", "app_version"), ("note", "note"), ("sessionId", "session_id"))
    return found.select("event_id", "developer_user_id", *[F.try_element_at("properties", F.lit(n)).alias(a) for n, a in names])


_LATE_ROWS = "late AS (SELECT min(ts_us) + (max(ts_us) - min(ts_us)) // 3 AS until FROM v_events)"


@query(
    "stream_rejects_late_rows",
    sql(
        f"""WITH {_LATE_ROWS}, kept AS (SELECT l.* FROM v_identity_log l, late WHERE NOT (event_id % 50 = 0 AND ts_us < until)),
        {_IDENTITY.replace("v_identity_log", "kept")}
        SELECT event_id, epoch, anonymous_id, developer_user_id, customer_id, NULL AS reject_code FROM ids
        UNION ALL SELECT event_id, NULL, NULL, NULL, NULL, 'late_row' FROM v_identity_log, late WHERE event_id % 50 = 0 AND ts_us < until""",
        "v_events",
        "v_identity_log",
    ),
)
def _late(spark, sf):
    """One row in fifty of the first third of the log arrives with the last: it is refused, and all others fold as if it were not there."""
    configure(spark)
    arrival = "case when event_id % 50 = 0 and __at < {low} + ({high} - {low}) div 3 then {high} else __at end"
    ops = fx.identity_log(Streams(spark, end=True, arrival=arrival), sf).select("dev", "ts_us", "event_id", "op", "user", "customer")
    found = run_available(stateful.identity_stream(ops, late=LATE, rejects=True))
    known = F.coalesce("event_id", F.get_json_object("document", "$.event_id").cast("bigint")).alias("event_id")
    return found.select(known, "epoch", "anonymous_id", "developer_user_id", "customer_id", "reject_code").filter("event_id >= 0")


def _snapshot_rows(spark, sf):
    """Snapshot rows as files in which a row comes up to an hour late, and at the end one row later than all."""
    configure(spark)
    rows = fx.snapshots(spark, sf).withColumn("user", F.col("user").cast("string"))
    low, high = rows.agg(F.min("ts_us"), F.max("ts_us")).first()
    base = f"{checkpoint_dir(spark)}/snapshots-{uuid.uuid4().hex}"
    at = f"ts_us + pmod(xxhash64(user, key), {DELAY_US})"
    parts = rows.withColumn("__part", F.expr(f"cast(({at} - {low}) div {(high + DELAY_US - low) // 3 + 1} as int)"))
    for i in range(3):
        parts.filter(F.col("__part") == i).drop("__part").repartition(4).write.parquet(f"{base}/part={i}")
    last = spark.createDataFrame([(fx.END_DEVICE, high + 10 * DELAY_US, "end", True, None)], rows.schema)
    last.coalesce(1).write.parquet(f"{base}/part=3")
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(f"{base}/part=*")


_CHANGES = """SELECT CAST("user" AS VARCHAR) AS "user", ts_us, len(items) AS n, list_aggregate(list_transform(items, lambda i: i.key || ':' || i.active || ':' || coalesce(i.valid_until_us, -1)), 'string_agg', ',') AS items"""


@query(
    "stream_entitlement_changes",
    sql(
        f"""WITH docs AS (SELECT "user", ts_us, list(DISTINCT {{'key': key, 'active': active, 'valid_until_us': valid_until_us}} ORDER BY {{'key': key, 'active': active, 'valid_until_us': valid_until_us}}) AS items
              FROM v_snapshots GROUP BY ALL),
        seen AS (SELECT *, lag(items) OVER (PARTITION BY "user" ORDER BY ts_us) AS before FROM docs)
        {_CHANGES} FROM seen WHERE before IS NULL OR items <> before""",
        "v_snapshots",
    ),
)
def _changes(spark, sf):
    """The change feed, delivered to a subscriber that writes down what it is handed."""
    rows = _snapshot_rows(spark, sf)
    feed = stateful.entitlement_changes_stream(rows, entitlements_only=True, late=LATE)
    base = f"{checkpoint_dir(spark)}/changes-{uuid.uuid4().hex}"

    def handler(changes, batch_id):
        changes.write.mode("append").parquet(f"{base}/handed")

    subscribe(feed, f"{base}/target", f"{base}/checkpoint", handler).trigger(availableNow=True).start().awaitTermination()
    item = F.transform("entitlements", lambda i: F.concat_ws(":", i["key"], i["active"].cast("string"), F.coalesce(i["valid_until_us"], F.lit(-1)).cast("string")))
    handed = spark.read.schema(feed.schema).parquet(f"{base}/handed")
    return handed.select("user", "ts_us", F.size("entitlements").cast("bigint").alias("n"), F.array_join(item, ",").alias("items"))


_INGEST_ROWS = """ingested AS (SELECT event_id, k, CASE WHEN k % 19 = 0 THEN 'malformed_batch' WHEN k % 13 = 0 THEN 'missing_anonymous_id'
    WHEN k % 5 = 0 THEN 'env_mismatch' END AS reject_code FROM v_events)"""


@query(
    "ingest_stream",
    sql(
        f"""WITH {_INGEST_ROWS} SELECT event_id, reject_code, CASE WHEN reject_code IS NULL THEN CASE WHEN k % 17 = 0 THEN '�' ELSE '<email>' END END AS note,
          CASE WHEN reject_code IS NULL THEN CASE WHEN k % 3 = 0 THEN 0 ELSE event_id END END AS timestamp_ms FROM ingested""",
        "v_events",
    ),
)
def _ingest(spark, sf):
    """Envelopes of one event each, among them half surrogate pairs, cut-off texts, times that are none, and rows to refuse."""
    configure(spark)
    base = f"{checkpoint_dir(spark)}/ingest-{uuid.uuid4().hex}"
    event = (
        "concat('{\"eventId\": \"evt_', event_id, '\", \"name\": \"', name, '\", \"timestamp\": ', case when k % 3 = 0 then '\"oops\"' else concat('\"', event_id, '.5\"') end, "
        "case when k % 13 = 0 then '' else concat(', \"anonymousId\": \"', dev, '\"') end, ', \"properties\": {\"note\": \"', case when k % 17 = 0 then '\\\\ud800' else 'a@b.io' end, '\"}}')"
    )
    line = (
        f"concat('{{\"appId\": \"app\", \"environment\": \"', case when k % 5 = 0 then 'production' else 'sandbox' end, '\", \"events\": [', {event}, "
        "case when k % 19 = 0 then '' else ']}' end)"
    )
    fx.events(spark, sf).repartition(3, "event_id").selectExpr(line).write.text(f"{base}/in")
    stream = ingest.ingest_stream(
        spark, f"{base}/in", f"{base}/good", f"{base}/bad", f"{base}/checkpoint", "pub_test_1", available_now=True, max_files=1
    )
    stream.start().awaitTermination()
    good = spark.read.parquet(f"{base}/good").select(
        F.regexp_extract("event_id", "[0-9]+", 0).cast("bigint").alias("event_id"),
        F.lit(None).cast("string").alias("reject_code"),
        F.get_json_object("properties", "$.note").alias("note"),
        # An unreadable time is that of receipt, which no table knows.
        F.when(F.col("timestamp_ms") > 1_500_000_000_000, 0).otherwise(F.col("timestamp_ms")).alias("timestamp_ms"),
    )
    bad = spark.read.parquet(f"{base}/bad").select(F.regexp_extract("document", "evt_([0-9]+)", 1).cast("bigint").alias("event_id"), "reject_code")
    return good.unionByName(bad, allowMissingColumns=True)


@query(
    "debug_signals",
    sql(
        """SELECT count(*) FILTER (WHERE k % 11 = 0) AS invalid_key,
             count(*) FILTER (WHERE k % 11 <> 0 AND (k % 2 = 0) <> (k % 5 < 3)) AS environment_mismatch FROM v_events""",
        "v_events",
    ),
)
def _gate_signals(spark, sf):
    from .values import _claims

    code = ingest_gate(F.col("public_key"), F.col("environment"), F.col("app_id"), F.col("name"))
    return _claims(spark, sf).withColumn("reject_code", code).agg(*signals.gate_signals())


_STATE_SIGNALS = f"""
    WITH {_CONSENTED}, {_OUTCOMES_SQL}, {_BILLING}, {_SYNCS}, marks AS (SELECT event_id, k FROM v_events WHERE name = 'group.set')
    SELECT 'configured' AS signal, count(*) AS n FROM marks UNION ALL SELECT 'queue_restored', count(*) FROM marks WHERE k % 3 > 0
    UNION ALL SELECT 'consent_denied', count(*) FROM held WHERE NOT CASE WHEN name = '$error' THEN consent_errors ELSE consent_analytics END
    UNION ALL SELECT 'consent_changed', count(*) FROM marks WHERE k % 4 <> 0 UNION ALL SELECT 'consent_dnt_applied', count(*) FROM marks WHERE k % 4 = 0
    UNION ALL SELECT 'queue_persisted', count(*) FROM outcomes WHERE state = 'delivered'
    UNION ALL SELECT 'flush_retry_scheduled', count(*) FROM outcomes WHERE state = 'pending'
    UNION ALL SELECT 'flush_permanent_failure', count(*) FROM outcomes WHERE state IN ('dropped_permanent', 'retry_exhausted')
    UNION ALL SELECT 'first_event_sent', count(DISTINCT user_id % 40) FROM v_events WHERE k < 60
    UNION ALL SELECT 'entitlement_cache_used', count(*) FROM customer CROSS JOIN (SELECT unnest(range(5)))
    UNION ALL SELECT 'purchase_evidence_sent', count(*) FROM synced WHERE err IS NULL"""


@query("debug_signals_of_state", sql(_STATE_SIGNALS, "v_consent_log", "v_attempts", "v_purchases"))
def _state_signals(spark, sf):
    """The other eleven signals, each from the operator whose rows yield it."""
    configure(spark)
    events = fx.events(spark, sf)
    starts = events.filter("name = 'group.set'").selectExpr("k % 3 as restored_events", "k % 4 = 0 as do_not_track")
    held = attach_consent(events.select("event_id", "dev", "ts_us", "name"), fx.consent_log(spark, sf))
    sent = events.filter("k < 60").selectExpr("user_id % 40 as app", "ts_us div 1000 as ts_ms", "event_id")
    counted = [
        (starts, signals.session_signals()),
        (held, signals.consent_signals()),
        (starts, signals.consent_log_signals()),
        (delivery_outcomes(timed_attempts(spark, sf)), signals.delivery_signals()),
        (first_event_sent(sent), signals.first_sent_signals()),
        (QUERIES["is_entitled"](spark, sf), signals.entitlement_signals()),
        (_syncs(spark, sf), signals.purchase_signals()),
    ]
    parts = []
    for rows, wanted in counted:
        found = rows.agg(*wanted)
        parts.append(found.select(F.inline(F.array(*[F.struct(F.lit(c).alias("signal"), F.col(c).cast("bigint").alias("n")) for c in found.columns]))))
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(
    "debug_signals_of_events",
    sql(
        """SELECT count(*) FILTER (WHERE k % 7 = 0)::BIGINT AS property_coerced, count(*) FILTER (WHERE k % 3 = 0) AS sensitive_property_warning,
             count(*) FILTER (WHERE k % 4 = 0) AS no_identity, count(*) FILTER (WHERE k % 5 = 0) AS pii_scrubbed FROM v_events WHERE k % 2 = 0""",
        "v_events",
    ),
)
def _event_signals(spark, sf):
    configure(spark)
    rows = fx.events(spark, sf).selectExpr(
        "event_id",
        "name",
        "'app' as app_id",
        "case when k % 2 = 0 then 'sandbox' else 'production' end as environment",
        "case when k % 4 <> 0 then dev end as developer_user_id",
        "to_json(map(case when k % 3 = 0 then 'Password' else 'note' end, case when k % 5 = 0 then 'a@b.io' else 'x' end, "
        "'long', repeat('y', case when k % 7 = 0 then 1025 else 10 end))) as properties",
    )
    accepted, _ = ingest.clean_events(rows, F.lit("pub_test_1"))
    return accepted.agg(*signals.event_signals())
