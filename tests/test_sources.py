"""Envelopes, response bodies, the registry and the reject sink."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators.contracts import contract_failures_by_contract
from tidemark.sources.deadletter import to_dead_letter
from tidemark.sources.events import pack_event_batches, parse_event_batches, read_event_batches, write_event_batches
from tidemark.sources.registry import contract_test_refs, read_contract_registry
from tidemark.sources.responses import flatten_alias_links, flatten_entitlement_responses, flatten_heartbeats


def test_batches_round_trip(spark, tmp_path):
    data = [("app", "production", f"evt_{i:03d}", "n", 1000 + i // 2, "anon", None, None, {"v": None, "x": float("inf"), "y": 1.5}) for i in range(45)]
    schema = (
        "app_id string, environment string, event_id string, name string, timestamp_ms long, anonymous_id string, "
        "developer_user_id string, customer_id string, properties map<string,double>"
    )
    packed = pack_event_batches(spark.createDataFrame(data, schema), "sdk", "1.0", hot_rows=7)
    got = sorted((r["batch_no"], r["events"]) for r in packed.collect())
    assert got == [(0, 20), (1, 20), (2, 5)]
    first = json.loads(packed.filter("batch_no = 0").first()["value"])
    assert [e["eventId"] for e in first["events"]] == [f"evt_{i:03d}" for i in range(20)]
    assert first["sdk"] == {"name": "sdk", "version": "1.0"} and "developerUserId" not in first["events"][0]
    assert first["events"][0]["properties"] == {"v": None, "x": None, "y": 1.5}
    write_event_batches(packed, str(tmp_path / "out"))
    rows, rejects = read_event_batches(spark, str(tmp_path / "out"))
    assert rows.count() == 45 and rejects.count() == 0
    assert rows.agg(F.countDistinct("event_id")).first()[0] == 45


def test_batches_with_gaps(spark, tmp_path):
    events = [
        {"eventId": "e1", "name": "n", "timestamp": 5, "anonymousId": "a", "developerUserId": "", "customerId": "c", "properties": {"k": {"n": [1, None]}}},
        {"eventId": "", "name": "n", "anonymousId": "a"},
        {"eventId": "e3", "name": "", "anonymousId": "a"},
        {"eventId": "e4", "name": "n"},
        {"eventId": "e5", "name": "n", "anonymousId": "a", "properties": [1]},
    ]
    lines = [json.dumps({"appId": "p", "environment": "sandbox", "events": events}), "{broken", json.dumps({"appId": "p"})]
    (tmp_path / "in.jsonl").write_text("\n".join(lines))
    rows, rejects = read_event_batches(spark, str(tmp_path))
    got = {r["event_id"]: r for r in rows.collect()}
    assert set(got) == {"e1", "e5"}
    assert got["e1"]["developer_user_id"] is None and got["e1"]["customer_id"] == "c" and got["e1"]["timestamp_ms"] == 5
    assert json.loads(got["e1"]["properties"]) == {"k": {"n": [1, None]}}
    assert got["e5"]["properties"] == "{}" and got["e5"]["timestamp_ms"] > 0
    assert sorted((r["reject_code"], "{broken" in r["document"]) for r in rejects.collect()) == [
        ("malformed_batch", True), ("missing_anonymous_id", False), ("missing_event_id", False), ("missing_event_name", False),
        ("no_events", False),
    ]


def test_fields_of_the_wrong_type_cost_no_more_than_themselves(spark):
    good = {"name": "n", "anonymousId": "a"}
    times = ["oops", 2.0, "3", "4.9", None, {"t": 1}, True]
    events = [{**good, "eventId": f"e{i}", "timestamp": t} for i, t in enumerate(times)] + [{**good, "eventId": 77}, "no object", 5, None]
    docs = [{"appId": 5, "sdk": "none", "events": events}, {"appId": "p", "sdk": {"name": "s", "version": 2}, "events": []}, {"appId": "p", "events": [{**good, "eventId": "last"}]}]
    rows, rejects = parse_event_batches(spark.createDataFrame([(json.dumps(d),) for d in docs], "value string"), received_ms=F.lit(99).cast("bigint"))
    got = {r["event_id"]: (r["app_id"], r["timestamp_ms"]) for r in rows.collect()}
    assert got == {"e0": ("5", 99), "e1": ("5", 2), "e2": ("5", 3), "e3": ("5", 4), "e4": ("5", 99), "e5": ("5", 99), "e6": ("5", 99), "77": ("5", 99), "last": ("p", 99)}
    assert sorted(r["reject_code"] for r in rejects.collect()) == ["missing_event_id"] * 3 + ["no_events"]


def test_an_unreadable_end_date_is_not_for_ever(spark):
    item = {"key": "k", "isActive": "TRUE", "source": {"rail": "google"}}
    ends = [None, 5, 6.0, "7", "8.5", "soon", "", [1], True]
    data = [{**item, "key": f"k{i}", "validUntil": e, "updatedAt": "x"} for i, e in enumerate(ends)] + [item, "junk", 3, {**item, "source": "junk"}, {**item, "key": "z", "isActive": 1, "updatedAt": "12.5"}]
    df = spark.createDataFrame([(json.dumps({"customerId": 4, "data": data}),), (json.dumps({"customerId": "d", "data": "none"}),)], "body string")
    rows, rejects = flatten_entitlement_responses(df, received_ms=F.lit(70).cast("bigint"))
    got = {r["key"]: (r["is_active"], r["valid_until_ms"], r["updated_at_ms"]) for r in rows.collect()}
    want = {f"k{i}": (True, e, 70) for i, e in enumerate([None, 5, 6, 7, 8, 0, 0, 0, 0])}
    assert got == {**want, "k": (True, None, 70), "z": (False, None, 12)}
    assert rejects.count() == 0
    beats = spark.createDataFrame([('{"ok": "True", "serverTime": "5.9"}', 9), ('{"ok": 1, "serverTime": "x"}', 9)], "body string, received_ms long")
    assert [(r["ok"], r["server_time_ms"]) for r in flatten_heartbeats(beats).collect()] == [(True, 5), (False, 9)]


def test_packed_structs_keep_their_nulls(spark):
    schema = (
        "app_id string, environment string, event_id string, name string, timestamp_ms long, anonymous_id string, "
        "developer_user_id string, customer_id string, properties struct<p:struct<x:int>,z:string,f:double,l:array<double>>"
    )
    rows = [("a", None, f"e{i}", "n", i, "d", None, "c" if i else None, (None, None, float("nan"), [None, 1.5, float("inf")])) for i in range(3)]
    rows += [("a", None, "e9", "n", 9, None, None, None, None)]
    packed = pack_event_batches(spark.createDataFrame(rows, schema), "sdk", "1.0", hot_rows=2).collect()
    assert [(r["app_id"], r["environment"], r["batch_no"], r["events"]) for r in packed] == [("a", None, 0, 4)]
    batch = json.loads(packed[0]["value"])
    assert batch["appId"] == "a" and "environment" not in batch
    first, second, _, last = batch["events"]
    assert first["properties"] == {"p": None, "z": None, "f": None, "l": [None, 1.5, None]}
    assert "customerId" not in first and second["customerId"] == "c" and last["properties"] == {} and "anonymousId" not in last


def test_entitlement_responses(spark):
    item = {"key": "pro", "isActive": True, "validUntil": None, "source": {"rail": "apple", "productId": "p"}, "updatedAt": 3}
    bodies = [
        {"customerId": "c", "env": "sandbox", "data": [item, {**item, "key": ""}, {"key": "x"}, {**item, "source": {"rail": "barter"}}, {"key": "y", "source": {"rail": "manual"}, "validUntil": 9}]},
        {"customerId": "", "data": [item]},
        {"customerId": "d", "data": None},
    ]
    df = spark.createDataFrame([(i, json.dumps(b)) for i, b in enumerate(bodies)] + [(9, "<html>"), (10, None)], "id int, body string")
    rows, rejects = flatten_entitlement_responses(df, received_ms=F.lit(77).cast("bigint"))
    got = sorted((r["id"], r["key"], r["is_active"], r["valid_until_ms"], r["rail"], r["updated_at_ms"], r["env"]) for r in rows.collect())
    assert got == [(0, "pro", True, None, "apple", 3, "sandbox"), (0, "y", False, 9, "manual", 77, "sandbox")]
    assert sorted(r["id"] for r in rejects.collect()) == [1, 9, 10]
    assert flatten_entitlement_responses(df, purchases=True)[1].first()["reject_code"] == "purchase_response_invalid"


def test_alias_and_heartbeat(spark):
    body = {"customerId": "c", "linked": [{"type": "user", "id": "u"}, {"type": "", "id": "x"}, {"type": "mail"}]}
    df = spark.createDataFrame([(1, json.dumps(body)), (2, json.dumps({"customerId": "e", "mergePending": True})), (3, "{}")], "id int, body string")
    rows, rejects = flatten_alias_links(df)
    assert sorted((r["id"], r["merge_pending"], r["link_type"]) for r in rows.collect()) == [(1, False, "user"), (2, True, None)]
    assert [(r["id"], r["reject_code"]) for r in rejects.collect()] == [(3, "alias_response_invalid")]
    beats = spark.createDataFrame([('{"appId": "a", "serverTime": 5}', 9), ('{"ok": true}', 9), ("<html>", 9)], "body string, received_ms long")
    got = [(r["ok"], r["app_id"], r["server_time_ms"], r["env"]) for r in flatten_heartbeats(beats).collect()]
    assert got == [(False, "a", 5, "production"), (True, "", 9, "production")]


def registry(pillar="revenue"):
    contract = {"id": "c1", "pillar": pillar, "status": "enforced", "claim": "x", "appliesTo": ["android"], "codeRef": ["a"], "testRef": [{"file": "f", "name": "n1"}, {"file": "f", "name": "n2"}], "registeredAt": "2024-01-01", "firstRegisteredIn": "1", "bundledIn": "1"}
    return json.dumps({"sdkVersion": "1", "bundledIn": "1", "contracts": [contract]}, indent=2)


def test_registry(spark, tmp_path):
    (tmp_path / "r.json").write_text(registry())
    contracts = read_contract_registry(spark, str(tmp_path / "r.json"))
    assert contracts.first()["id"] == "c1" and contract_test_refs(contracts).count() == 2
    failures = spark.createDataFrame([("c1", "r1"), ("c1", "r1"), ("zz", "r2")], "contract_id string, run_id string")
    got = sorted((r["contract_id"], r["failures"], r["runs"], r["known"]) for r in contract_failures_by_contract(failures, contracts).collect())
    assert got == [("c1", 2, 1, True), ("zz", 1, 1, False)]
    (tmp_path / "bad.json").write_text(registry("nonsense"))
    with pytest.raises(Exception, match="unknown pillar"):
        read_contract_registry(spark, str(tmp_path / "bad.json")).collect()


def test_dead_letter(spark):
    df = spark.createDataFrame([(1, 400), (2, 200), (3, None)], "id int, status int")
    good, dead = to_dead_letter(df, F.when(F.col("status") == 400, F.lit("permanent")))
    assert sorted(r["id"] for r in good.collect()) == [2, 3] and good.columns == ["id", "status"]
    assert [(r["id"], r["dead_letter_error"]) for r in dead.collect()] == [(1, "permanent")]
