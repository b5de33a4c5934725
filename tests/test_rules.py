"""State, purchase, entitlement, error and delivery rules on hand-built rows, mostly at their boundaries."""

from pyspark.sql import functions as F

from tidemark.operators import delivery, entitlements, errors, gates, identity, purchases, rollups, vitals

HEAD = "dev string, ts_us long, event_id long"
DAY_US = 86_400_000_000


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_identity(spark):
    ops = [
        ("d", 1, 1, "identify", " \t user_847 \n ", None),
        ("d", 2, 2, "alias", None, " cust_1 "),
        ("d", 3, 3, "identify", "   ", None),
        ("d", 4, 4, "identify", "u2", None),
        ("d", 5, 5, "reset", None, None),
        ("d", 6, 6, "identify", "", None),
    ]
    state = identity.fold_identity(spark.createDataFrame(ops, f"{HEAD}, op string, user string, customer string"), hot_rows=2)
    got = {r["event_id"]: r for r in state.collect()}
    assert [got[i]["developer_user_id"] for i in range(1, 7)] == ["user_847", "user_847", None, "u2", None, None]
    assert [got[i]["customer_id"] for i in range(1, 7)] == [None, "cust_1", "cust_1", "cust_1", None, None]
    assert got[4]["anonymous_id"] == "d" and got[5]["anonymous_id"].startswith("anon_") and len(got[5]["anonymous_id"]) == 37
    events = spark.createDataFrame([("d", 0, 10), ("d", 1, 11), ("d", 4, 12), ("e", 9, 13), (None, 9, 14)], HEAD)
    seen = rows(identity.attach_identity(events, state), "event_id", "anonymous_id", "developer_user_id")
    assert seen == [(10, "d", None), (11, "d", "user_847"), (12, "d", "u2"), (13, "e", None), (14, None, None)]


def test_super_properties(spark, monkeypatch):
    steps = [
        ("register", "plan", "free"),
        ("register", "plan", "pro"),
        ("registerOnce", "plan", "x"),
        ("registerOnce", "tier", "1"),
        ("registerOnce", "tier", "2"),
        ("register", "", "blank"),
        ("unregister", "plan", None),
        ("registerOnce", "plan", "again"),
        ("clear", None, None),
        ("registerOnce", "tier", "3"),
        ("register", "tier", "4"),
        ("registerOnce", "tier", "5"),
    ]
    ops = [("d", i, i, *s) for i, s in enumerate(steps)]
    df = spark.createDataFrame(ops, f"{HEAD}, op string, key string, value string")
    for hot_rows, block in ((1, 3), (5, 64), (100, 1)):
        monkeypatch.setattr(identity.fold_names, "__defaults__", (hot_rows, block))
        state = identity.fold_super_properties(df, hot_rows=hot_rows)
        got = [r["props"] for r in sorted(state.collect(), key=lambda r: r["event_id"])]
        assert got == [
            {"plan": "free"}, {"plan": "pro"}, {"plan": "pro"}, {"plan": "pro", "tier": "1"}, {"plan": "pro", "tier": "1"},
            {"plan": "pro", "tier": "1"}, {"tier": "1"}, {"plan": "again", "tier": "1"}, {}, {"tier": "3"}, {"tier": "4"}, {"tier": "4"},
        ]


def test_groups_register_and_unregister(spark):
    calls = spark.createDataFrame(
        [("d", 1, 1, "org", "a"), ("d", 2, 2, "", "b"), ("d", 3, 3, "org", None)], f"{HEAD}, group_type string, group_key string"
    )
    assert rows(identity.group_operations(calls), "event_id", "op", "key") == [(1, "register", "group_org"), (3, "unregister", "group_org")]


def test_error_context(spark):
    ops = [
        ("d", 1, 1, "set_tag", "plan", "pro", None),
        ("d", 2, 2, "set_tag", "", "x", None),
        ("d", 3, 3, "set_context", "cart", None, {"n": "2"}),
        ("d", 4, 4, "set_tags", None, None, {"env": "qa"}),
        ("d", 5, 5, "set_context", "cart", None, {}),
    ]
    df = spark.createDataFrame(ops, f"{HEAD}, op string, name string, value string, data map<string,string>")
    state = identity.fold_error_context(df, hot_rows=2)
    got = [(r["tags"], r["context"]) for r in sorted(state.collect(), key=lambda r: r["event_id"])]
    assert got == [
        ({"plan": "pro"}, {}), ({"plan": "pro"}, {}), ({"plan": "pro"}, {"cart": {"n": "2"}}), ({"env": "qa"}, {"cart": {"n": "2"}}), ({"env": "qa"}, {}),
    ]


def test_consent_gate(spark):
    events = spark.createDataFrame(
        [("d", 1, 1, "tap"), ("d", 5, 2, "tap"), ("d", 5, 3, "$error"), ("d", 5, 4, "$error.recovered"), ("x", 1, 5, "tap")], f"{HEAD}, name string"
    )
    log = spark.createDataFrame([("d", 5, 9, False, True)], f"{HEAD}, analytics boolean, errors boolean")
    out = spark.createDataFrame([("x",)], "dev string")
    assert rows(gates.consent_gate(events, log, out), "event_id") == [(1,), (3,)]
    seen = rows(identity.attach_consent(events, log), "event_id", "consent_analytics", "consent_errors")
    assert seen[:2] == [(1, True, True), (2, False, True)]


def test_enrichment_order_and_scrub(spark):
    events = spark.createDataFrame(
        [("d", 5, 1, "tap", {"a": "own", "mail": "x@y.io", "sessionId": "mine"}), ("d", 5, 2, "$error", {"k": "x@y.io"}), ("e", 1, 3, "tap", None)],
        f"{HEAD}, name string, properties map<string,string>",
    )
    supers = spark.createDataFrame([("d", 1, 7, {"a": "super", "b": "super", "c": "super"})], f"{HEAD}, props map<string,string>")
    device = spark.createDataFrame([("d", 2, 8, {"a": "device", "b": "device"})], f"{HEAD}, payload map<string,string>")
    session = spark.createDataFrame([("d", 3, 9, "s1")], f"{HEAD}, session_id string")
    out = identity.enrich_events(events, super_properties=supers, device=device, session=session)
    got = {r["event_id"]: r["properties"] for r in out.collect()}
    assert got[1] == {"a": "own", "b": "device", "c": "super", "mail": "<email>", "sessionId": "s1"}
    assert got[2] == {"k": "x@y.io"} and got[3] == {}


def test_resolve_and_forget(spark):
    alias = spark.createDataFrame(
        [("d", 1, 1, "u", "c1"), ("d", 2, 2, "u", "c2"), ("e", 1, 3, None, "c3")], f"{HEAD}, developer_user_id string, customer_id string"
    )
    events = spark.createDataFrame([(1, "x", "u"), (2, "e", None), (3, "z", "q")], "event_id long, dev string, developer_user_id string")
    assert rows(identity.resolve_customer(events, alias), "event_id", F.coalesce("customer_id", F.lit("-"))) == [(1, "c2"), (2, "c3"), (3, "-")]
    asked = spark.createDataFrame([("u", None), (None, "e")], "user string, device string")
    kept = identity.forget(events, asked, {"user": "developer_user_id", "device": "dev"})
    assert rows(kept, "event_id") == [(3,)]


SNAP = "user string, ts_us long, key string, active boolean, valid_until_us long"


def test_entitlements(spark):
    at = 100
    snaps = spark.createDataFrame(
        [
            ("alice", 10, "pro", True, None), ("alice", 90, "pro", True, 101), ("alice", 90, "old", True, 100), ("alice", 90, "off", False, None),
            ("alice", 200, "late", True, None), ("bob", 5, "trial", True, None), ("carol", 5, "gone", False, None),
        ],
        SNAP,
    )
    asked = [("alice", k) for k in ("pro", "old", "off", "late", "trial")] + [("bob", "trial"), ("bob", "pro"), ("dave", "pro")]
    requests = spark.createDataFrame(asked, "user string, key string")
    got = rows(entitlements.is_entitled(requests, snaps, at).filter("entitled"), "user", "key")
    assert got == [("alice", "pro"), ("bob", "trial")]
    users = spark.createDataFrame([("alice",), ("bob",), ("carol",), ("dave",)], "user string")
    keys = {r["user"]: r["active_keys"] for r in entitlements.active_keys(users, snaps, at).collect()}
    assert keys == {"alice": ["pro"], "bob": ["trial"], "carol": [], "dave": None}
    timed = spark.createDataFrame([("alice", 9, 1, "pro"), ("alice", 10, 2, "pro"), ("alice", 101, 3, "pro"), ("alice", 100, 4, "pro")], "user string, ts_us long, request_id long, key string")
    assert rows(entitlements.is_entitled_as_of(timed, snaps), "request_id", "entitled") == [(1, False), (2, True), (3, False), (4, True)]


def test_freshness_and_changes(spark):
    second = 1_000_000
    snaps = spark.createDataFrame([("a", 0, "p", True, None), ("a", 0, "p", True, None), ("b", second, "p", True, None)], SNAP)
    failed = spark.createDataFrame([("a", 5), ("a", 9), ("b", second - 1)], "user string, ts_us long")
    got = rows(entitlements.freshness(snaps, failed, 60 * second), "user", "is_stale", F.coalesce("last_refresh_failed_us", F.lit(-1)))
    assert got == [("a", False, 9), ("b", False, -1)]
    later = rows(entitlements.freshness(snaps, failed, 60 * second + 1), "user", "is_stale")
    assert later == [("a", True), ("b", False)]
    feed = spark.createDataFrame([("a", 1, "p", True, None), ("a", 2, "p", True, None), ("a", 3, "p", False, None), ("a", 3, "q", True, None)], SNAP)
    assert rows(entitlements.entitlement_changes(feed), "ts_us") == [(1,), (2,), (3,)]
    assert rows(entitlements.entitlement_changes(feed, entitlements_only=True), "ts_us") == [(1,), (3,)]


ITEM = "product_id:string,order_id:string,purchase_token:string,purchase_time_ms:long,signature:string,is_acknowledged:boolean,is_revoked:boolean"


def billing(spark):
    item = lambda p, token="t", sig="s", revoked=False: (p, None, token, 1, sig, True, revoked)
    data = [
        (1, "d", 7, 0, 0, 200, [item("a"), item("b", revoked=True)]),
        (2, "d", 7, 0, 1, 200, [item("a")]),
        (3, "d", 7, 0, 0, 200, []),
        (4, "d", 8, 0, 0, 418, [item("c", "t4"), item("d", "", "s"), item("e", "t5", "")]),
        (5, "d", 8, 0, 0, None, [item("c", "t6")]),
    ]
    return spark.createDataFrame(data, f"event_id long, dev string, user_id long, ts_us long, response_code int, status int, purchases array<struct<{ITEM}>>")


def test_billing(spark):
    results = billing(spark)
    events = purchases.billing_to_events(results)
    assert rows(events, "event_id", "name", F.coalesce("product_id", F.lit("-"))) == [
        (1, "purchase.completed", "a"), (1, "purchase.refunded", "b"), (2, "purchase.failed", "-"),
        (4, "purchase.completed", "c"), (4, "purchase.completed", "d"), (4, "purchase.completed", "e"), (5, "purchase.completed", "c"),
    ]
    send, refused = purchases.purchases_to_sync(results, "acme")
    assert rows(send, "event_id", "product_id") == [(1, "a"), (1, "b"), (4, "c"), (5, "c")]
    assert rows(refused, "event_id", "product_id", "reject_code") == [(4, "d", "missing_identifier")]
    network = F.struct(F.lit("network_error").alias("type"), F.lit("io_error").alias("code"), F.lit("m").alias("message"), F.lit(None).cast("string").alias("request_id"), F.lit(None).cast("int").alias("status"))
    synced = purchases.billing_sync_result(send.withColumn("error", F.when(F.col("status").isNull(), network)))
    got = {r["event_id"]: r["sync_error"] for r in synced.collect()}
    assert got[1] is None
    assert (got[4]["type"], got[4]["code"], got[4]["status"]) == ("internal_error", "auto_billing_sync_failed", 418)
    assert (got[5]["type"], got[5]["code"]) == ("network_error", "io_error")
    assert rows(purchases.sync_failed_events(synced), "event_id", "rail", "error_code") == [(4, "google", "auto_billing_sync_failed"), (5, "google", "io_error")]
    state = purchases.reconcile_purchases(events.filter("name = 'purchase.completed'"), synced)
    assert rows(state, "purchase_token", "purchases", "syncs", "state") == [
        ("", 1, 0, "never_synced"), ("t", 1, 2, "synced"), ("t4", 1, 1, "failed"), ("t5", 1, 0, "never_synced"), ("t6", 1, 1, "failed"),
    ]


def test_delivery_outcomes(spark):
    data = [
        ("ok", 1, 1, 503, None), ("ok", 2, 2, 202, None), ("ok", 3, 3, 400, None),
        ("bad", 1, 4, 400, None), ("wait", 1000, 5, 503, 5000), ("none", 1, 6, None, None),
    ] + [("spent", i, 10 + i, 503, None) for i in range(8)] + [("five", i, 30 + i, 503, None) for i in range(5)]
    df = spark.createDataFrame(data, "key string, ts_ms long, event_id long, status int, retry_after_ms long")
    got = {r["key"]: (r["attempts"], r["state"], r["next_retry_ms"]) for r in delivery.delivery_outcomes(df).collect()}
    assert got == {
        "ok": (2, "delivered", None), "bad": (1, "dropped_permanent", None), "wait": (1, "pending", 6000),
        "none": (1, "pending", 1001), "spent": (6, "retry_exhausted", None), "five": (5, "pending", 4 + 16_000),
    }
    audit = {r["event_id"]: r for r in delivery.retry_audit(df).collect()}
    assert [audit[10 + i]["ceiling_ms"] for i in range(6)] == [1000, 2000, 4000, 8000, 16000, None]
    assert audit[2]["ceiling_ms"] is None and not audit[10]["late"] and not audit[10]["early"]
    waits = spark.createDataFrame([("k", 0, 1, 429, 5000), ("k", 4999, 2, 429, 5000), ("k", 10_000, 3, 200, None)], df.schema)
    flags = {r["event_id"]: (r["late"], r["early"]) for r in delivery.retry_audit(waits).collect()}
    assert flags == {1: (False, True), 2: (True, False), 3: (False, False)}


def test_breadcrumbs(spark):
    crumb = "category string, level string, message string, data map<string,string>"
    given = [("d", i, i, "custom", "info", f"m{i}", None) for i in range(1, 8)] + [("d", 10, 8, "custom", "info", "after", {"k": "v"})]
    crumbs = spark.createDataFrame(given, f"{HEAD}, {crumb}")
    errs = spark.createDataFrame([("d", 0, 20, "e"), ("d", 2, 21, "e"), ("d", 7, 22, "e"), ("d", 9, 23, "e"), ("d", 11, 24, "e"), ("x", 9, 25, "e")], f"{HEAD}, type string")
    resets = spark.createDataFrame([("d", 8, 30)], HEAD)
    for hot_rows in (1, 4, 100):
        out = errors.attach_breadcrumbs(errs, crumbs, resets, n=3, hot_rows=hot_rows)
        got = {r["event_id"]: [c["message"] for c in r["breadcrumbs"]] for r in out.collect()}
        assert got == {20: [], 21: ["m1", "m2"], 22: ["m5", "m6", "m7"], 23: [], 24: ["after"], 25: []}


def test_recover_fatals(spark):
    frame = "array<struct<className:string,methodName:string,fileName:string,lineNumber:int>>"
    stack = [("c.C", f"m{i}", None, i) for i in range(60)]
    errs = spark.createDataFrame(
        [("d", 1, 1, "A", "m", stack, True), ("d", 2, 2, "B", "m", stack, True), ("d", 3, 3, "C", "m", stack, False), ("d", 7, 4, "D", "m", [], True)],
        f"{HEAD}, type string, message string, frames {frame}, fatal boolean",
    )
    launches = spark.createDataFrame([("d", 0, 10), ("d", 5, 11), ("d", 6, 12), ("d", 9, 13)], HEAD)
    out = errors.recover_fatals(errs, launches, hot_rows=2)
    assert rows(out, "event_id", "fatal_id", "type", F.size("stack")) == [(11, 2, "B", 50), (13, 4, "D", 0)]


def test_error_wire_form(spark):
    frame = "array<struct<className:string,methodName:string,fileName:string,lineNumber:int>>"
    df = spark.createDataFrame(
        [(1, 2000, "E", "to x@y.io", [("c.C", "m", None, 1)], True, {"t": "x@y.io"}, {}), (2, 2000, "E", "m", [], False, {}, {"c": {"k": "x@y.io"}})],
        f"event_id long, ts_us long, type string, message string, frames {frame}, handled boolean, tags map<string,string>, context map<string,map<string,string>>",
    )
    got = {r["event_id"]: r for r in errors.error_rows_to_events(df).collect()}
    assert got[1]["error_message"] == "to <email>" and got[1]["error_tags"] == {"t": "<email>"} and got[1]["error_context"] is None
    assert got[1]["error_timestamp_ms"] == 2 and got[1]["error_stack"] == ["c:C.m"]
    assert got[2]["error_fingerprint"] == "E:no_stack" and got[2]["error_stack"] is None and got[2]["error_tags"] is None
    raw = {r["event_id"]: r for r in errors.error_rows_to_events(df, scrub_context=False).collect()}
    assert raw[1]["error_tags"] == {"t": "x@y.io"} and raw[1]["error_message"] == "to <email>"


def test_vitals(spark):
    ms = 1_000_000
    frames = spark.createDataFrame([("d", t * ms, i) for i, t in enumerate([0, 16, 33, 733, 1434])], "dev string, frame_ns long, event_id long")
    got = vitals.frame_jank(frames, hot_rows=2).first()
    assert (got["total_frames"], got["slow_frames"], got["frozen_frames"], got["slow_pct"]) == (4, 2, 1, 50.0)
    states = spark.createDataFrame([("d", i, i, s) for i, s in enumerate([True, False, False, True, True])], f"{HEAD}, online boolean")
    assert rows(vitals.rising_edges(states, hot_rows=2), "event_id") == [(3,)]
    assert rows(vitals.rising_edges(states, seed=False, hot_rows=2), "event_id") == [(0,), (3,)]
    beats = spark.createDataFrame([("d", t, i) for i, t in enumerate([0, 5_000_000, 10_000_001, 11_000_000])], HEAD)
    assert rows(vitals.detect_stalls(beats), "event_id") == [(1,)]
    starts = spark.createDataFrame([("p", 1, 5), ("p", 2, 9), ("q", 1, 0), ("q", 2, 4)], "process_id string, ts_us long, elapsed_ms long")
    assert rows(vitals.cold_launches(starts), "process_id", "elapsed_ms") == [("p", 5)]


def test_package_lock(spark):
    apps = spark.createDataFrame([("a", "com.a"), ("b", "")], "app_id string, registered_package string")
    data = [(1, "a", "com.a"), (2, "a", "com.x"), (3, "a", ""), (4, "b", ""), (5, "z", "com.a"), (6, "a", None)]
    out = gates.package_lock_gate(spark.createDataFrame(data, "event_id long, app_id string, package_name string"), apps)
    assert rows(out.filter("reject_code is null"), "event_id") == [(1,)]


def test_group_rollup(spark):
    events = spark.createDataFrame([("d", 1, 1, 7), ("d", 5, 2, 7), ("d", 9, 3, 8)], f"{HEAD}, user_id long")
    groups = spark.createDataFrame([("d", 5, 4, "org", "a"), ("d", 8, 5, "org", None)], f"{HEAD}, group_type string, group_key string")
    got = rows(rollups.group_rollup(events, groups, "org"), F.coalesce("group_key", F.lit("-")), "events", "users")
    assert got == [("-", 2, 2), ("a", 1, 1)]
