"""Streams over several micro-batches give what the batch rules give."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators.delivery import resolve_replays
from tidemark.operators.entitlements import entitlement_changes
from tidemark.operators.identity import fold_identity, fold_super_properties
from tidemark.operators.screens import coalesce_screens
from tidemark.operators.sessions import lifecycle_sessions
from tidemark.sources.deadletter import write_with_rejects
from tidemark.streaming import inorder, ingest, signals, stateful
from tidemark.streaming.deliver import deliver_once
from tidemark.streaming.run import run_available

BASE = 1_700_000_000_000_000


def in_batches(spark, tmp_path, rows, schema, parts=3):
    """Write rows as ordered files and open them as a stream of one file per micro-batch."""
    size = -(-len(rows) // parts)
    for i in range(parts):
        path = str(tmp_path / "in" / f"p{i}")
        spark.createDataFrame(rows[i * size : (i + 1) * size], schema).coalesce(1).write.parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))


def same(a, b, columns):
    def key(df):
        return sorted(str(tuple(r)) for r in df.select(*columns).collect())

    assert key(a) == key(b)


def test_lifecycle_identity_and_properties(spark, tmp_path):
    kinds = ["foreground", "background", "foreground", "foreground", "reset", "background"]
    rows = [(f"d{i % 3}", BASE + i * 700_000_000, i, kinds[(i * i + i // 4) % 6]) for i in range(60)]
    schema = "dev string, ts_us long, event_id long, op string"
    stream = in_batches(spark, tmp_path, rows, schema)
    out = run_available(stateful.lifecycle_stream(stream))
    same(out, lifecycle_sessions(spark.createDataFrame(rows, schema)), out.columns)


def test_identity(spark, tmp_path):
    ops = ["identify", "alias", "reset", "identify"]
    rows = [(f"d{i % 2}", BASE + i, i, ops[(i * 7) % 4], f" u{i} " if i % 5 else " ", f"c{i}") for i in range(30)]
    schema = "dev string, ts_us long, event_id long, op string, user string, customer string"
    out = run_available(stateful.identity_stream(in_batches(spark, tmp_path, rows, schema)))
    same(out, fold_identity(spark.createDataFrame(rows, schema)), out.columns)


def test_super_properties(spark, tmp_path):
    ops = ["register", "registerOnce", "unregister", "register", "clear"]
    rows = [(f"d{i % 2}", BASE + i, i, ops[(i * 3 + i // 7) % 5], ("plan", "tier", "")[i % 3], f"v{i}") for i in range(45)]
    schema = "dev string, ts_us long, event_id long, op string, key string, value string"
    out = run_available(stateful.super_properties_stream(in_batches(spark, tmp_path, rows, schema)))
    batch = fold_super_properties(spark.createDataFrame(rows, schema))
    shown = ["dev", "event_id", F.try_element_at("props", F.lit("plan")), F.try_element_at("props", F.lit("tier")), F.size("props")]
    same(out, batch, shown)


def test_coalesce(spark, tmp_path):
    rows = [("d", BASE + t, i, v) for i, (t, v) in enumerate([(0, "a"), (200, "a"), (400, "a"), (410, "a"), (700, "a"), (710, "b"), (711, "a"), (960, "a"), (961, "a")])]
    schema = "dev string, ts_ms long, event_id long, value string"
    out = run_available(stateful.coalesce_stream(in_batches(spark, tmp_path, rows, schema), 250))
    batch = coalesce_screens(spark.createDataFrame(rows, schema), screen="value")
    same(out, batch, out.columns)


def test_dedup_across_batches(spark, tmp_path):
    rows = [(i % 20, BASE + i * 1_000_000) for i in range(60)]
    stream = in_batches(spark, tmp_path, rows, "event_id long, ts_us long").withColumn("ts", F.timestamp_micros("ts_us"))
    out = run_available(ingest.dedup_stream(stream))
    assert sorted(r["event_id"] for r in out.collect()) == list(range(20))


def test_sessions_split_at_thirty_minutes(spark, tmp_path):
    minute = 60_000_000
    rows = [("d", BASE), ("d", BASE + 30 * minute), ("d", BASE + 60 * minute - 1), ("z", BASE + 600 * minute), ("z", BASE + 1200 * minute)]
    stream = in_batches(spark, tmp_path, rows, "dev string, ts_us long", 5).withColumn("ts", F.timestamp_micros("ts_us"))
    out = run_available(ingest.session_stream(stream))
    assert sorted((r["dev"], r["events"]) for r in out.collect()) == [("d", 1), ("d", 2), ("z", 1)]


def test_ingest_stream(spark, tmp_path):
    event = {"eventId": "e1", "name": "n", "timestamp": 5, "anonymousId": "a", "properties": {"mail": "x@y.io", "password": "p", "long": "z" * 2000}}
    source = tmp_path / "in"
    source.mkdir()
    lines = [json.dumps({"appId": "app", "environment": env, "events": [event]}) for env in ("sandbox", "production")]
    (source / "a.jsonl").write_text("\n".join([*lines, "{broken"]))
    counts = {}
    query = ingest.ingest_stream(
        spark, str(source), str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "cp"), "pub_test_1",
        available_now=True, on_signals=counts.__setitem__,
    ).start()
    query.awaitTermination()
    row = spark.read.parquet(str(tmp_path / "good")).first()
    bag = json.loads(row["properties"])
    assert bag["mail"] == "<email>" and len(bag["long"]) == 1024
    assert row["sensitive_keys"] == ["password"] and row["warnings"][0]["kind"] == "truncated_string"
    codes = sorted(r["reject_code"] for r in spark.read.parquet(str(tmp_path / "bad")).collect())
    assert codes == ["env_mismatch", "malformed_batch"]
    assert counts[0] == {"property_coerced": 1, "sensitive_property_warning": 1, "no_identity": 1, "pii_scrubbed": 1}


def test_reject_sink_can_run_again(spark, tmp_path):
    write = write_with_rejects(str(tmp_path / "g"), str(tmp_path / "r"), F.when(F.col("id") > 2, F.lit("big")))
    batch = spark.range(5)
    write(batch, 0)
    write(batch, 0)
    assert spark.read.parquet(str(tmp_path / "g")).count() == 3 and spark.read.parquet(str(tmp_path / "r")).count() == 2


def test_signals_are_observed(spark):
    from pyspark.sql import Observation

    rows = [("u", '{"m":"<email>"}', [("k", "not_finite")], []), (None, "{}", [], ["password"])]
    df = spark.createDataFrame(
        rows, "developer_user_id string, properties string, warnings array<struct<key:string,kind:string>>, sensitive_keys array<string>"
    )
    seen = Observation("signals")
    signals.observed(df, seen, signals.event_signals()).collect()
    assert seen.get == {"property_coerced": 1, "sensitive_property_warning": 1, "no_identity": 1, "pii_scrubbed": 1}


def test_signals_of_a_stream(spark, tmp_path):
    rows = [(i, BASE, "invalid_secret_key" if i % 3 == 0 else None) for i in range(30)]
    stream = in_batches(spark, tmp_path, rows, "event_id long, ts_us long, reject_code string")
    totals = signals.SignalTotals()
    spark.streams.addListener(totals)
    try:
        run_available(signals.observed(stream, "gate", signals.gate_signals()))
        for _ in range(50):
            if totals.totals.get("invalid_key") == 10:
                break
            time.sleep(0.1)
        assert totals.totals == {"invalid_key": 10, "environment_mismatch": 0}
    finally:
        spark.streams.removeListener(totals)


def shuffled(spark, tmp_path, rows, schema, late_rows, end):
    """Rows in random order within windows of ``late_rows`` as files of one micro-batch each, and one row later than all at the end."""
    rng = random.Random(11)
    order = sorted(range(len(rows)), key=lambda i: i + rng.uniform(0, late_rows))
    parts = [[rows[i] for i in order[k : k + 15]] for k in range(0, len(order), 15)]
    for i, part in enumerate([*parts, [end]]):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"p{i:03d}"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))


def test_rows_out_of_order_fold_as_in_batch(spark, tmp_path):
    kinds = ["foreground", "background", "foreground", "foreground", "reset", "background"]
    rows = [(f"d{i % 3}" if i % 17 else None, BASE + i * 60_000_000, i, kinds[(i * i + i // 4) % 6]) for i in range(90)]
    schema = "dev string, ts_us long, event_id long, op string"
    stream = shuffled(spark, tmp_path, rows, schema, 12, ("end", BASE + 10**12, 1000, "reset"))
    out = run_available(stateful.lifecycle_stream(stream, idle=240_000_000, late="12 minutes"))
    keyed = spark.createDataFrame([r for r in rows if r[0] is not None], schema)
    same(out.filter("dev is not null"), lifecycle_sessions(keyed, idle=240_000_000), out.columns)


def test_late_and_timeless_rows_are_refused(spark, tmp_path):
    rows = [("d", BASE + i * 60_000_000, i, "identify", f"u{i}", None) for i in range(45)]
    rows[40] = ("d", BASE + 60_000_001, 40, "identify", "late", None)
    rows[41] = ("d", None, 41, "identify", "timeless", None)
    schema = "dev string, ts_us long, event_id long, op string, user string, customer string"
    stream = shuffled(spark, tmp_path, rows, schema, 0, ("end", BASE + 10**12, 1000, "reset", None, None))
    found = run_available(stateful.identity_stream(stream, late="5 minutes", rejects=True)).collect()
    refused = {json.loads(r["document"])["user"]: r["reject_code"] for r in found if r["reject_code"]}
    assert refused == {"late": inorder.LATE, "timeless": inorder.TIMELESS}
    kept = sorted((r["event_id"], r["developer_user_id"]) for r in found if not r["reject_code"])
    assert kept == [(i, f"u{i}") for i in range(45) if i not in (40, 41)]


def test_hot_key_folds_chunk_by_chunk(spark, tmp_path):
    """Far more runs than are merged at a time, and chunks of a few rows; buffered and not."""
    rows = [("d", BASE + (i * 7919 % 3000) * 1_000, i, "identify", f"u{i}", None) for i in range(3000)]
    schema = "dev string, ts_us long, event_id long, op string, user string, customer string"
    batch = fold_identity(spark.createDataFrame(rows, schema))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        for late in (None, "1 minute"):
            path = str(tmp_path / str(late))
            spark.createDataFrame([*rows, ("end", BASE + 10**12, 9999, "reset", None, None)] if late is None else rows, schema).coalesce(1).write.parquet(f"{path}/a")
            if late:
                spark.createDataFrame([("end", BASE + 10**12, 9999, "reset", None, None)], schema).coalesce(1).write.parquet(f"{path}/b")
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")
            out = run_available(inorder.fold_in_order(stream, stateful.FoldIdentity(), "dev", late, chunk_rows=7, fan_in=4))
            same(out.filter("dev = 'd'"), batch, out.columns)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")


def test_answers_expire_by_the_watermark(spark, tmp_path):
    day = stateful.DAY_MS
    base = BASE // 1000
    rows = [("k", base, 0, "h", 200), ("k", base + day - 1, 1, "h", 200), ("j", base + day, 2, "h", 500), ("k", base + day, 3, "h", 200), ("k", base + day + 5, 4, "g", 200), ("j", base + 3 * day, 5, "h", 200)]
    schema = "key string, ts_ms long, event_id long, body_hash string, status int"
    stream = shuffled(spark, tmp_path, rows, schema, 0, ("end", base + 9 * day, 99, "h", 500))
    base_path = str(tmp_path / "run")
    done = stateful.replays_stream(stream, late="1 hour")
    query = done.writeStream.format("parquet").option("path", f"{base_path}/out").option("checkpointLocation", f"{base_path}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    out = spark.read.parquet(f"{base_path}/out")
    same(out, resolve_replays(spark.createDataFrame(rows, schema)), out.columns)
    state = spark.read.format("statestore").option("path", f"{base_path}/cp").option("stateVarName", "state").load()
    assert state.count() == 0


def test_entitlement_changes_as_in_batch(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"u{i % 4}", BASE + i // 8 * 60_000_000, f"k{rng.randint(0, 2)}", rng.random() < 0.5, rng.choice([None, 5, 9])) for i in range(240)]
    rows = sorted(set(rows), key=lambda r: r[1])
    schema = "user string, ts_us long, key string, active boolean, valid_until_us long"
    stream = shuffled(spark, tmp_path, rows, schema, 40, ("end", BASE + 10**12, "k", True, None))
    for only in (False, True):
        out = run_available(stateful.entitlement_changes_stream(stream, only, late="10 minutes"))
        same(out, entitlement_changes(spark.createDataFrame(rows, schema), only), ["user", "ts_us", "entitlements"])


def test_a_batch_is_handed_over_once(spark, tmp_path):
    seen, fails = [], [True]

    def handler(rows, batch_id):
        if fails and fails.pop():
            raise RuntimeError("subscriber failed")
        seen.append((batch_id, sorted(r["id"] for r in rows.collect())))

    send = deliver_once(str(tmp_path), handler)
    with pytest.raises(RuntimeError):
        send(spark.range(3), 0)
    # Run again with other rows, as a source that is not replayable might: what was written counts.
    send(spark.range(9), 0)
    send(spark.range(3), 0)
    send(spark.range(2), 1)
    assert seen == [(0, [0, 1, 2]), (1, [0, 1])]


def test_keys_share_buckets_and_pages(spark, tmp_path):
    """Calls and state entries are those of buckets, not of keys, and keys of one bucket do not see each other."""
    kinds = ["foreground", "background", "foreground", "reset", "background"]
    rows = [(f"d{i % 120}", BASE + i * 60_000_000, i, kinds[(i * i + i // 120) % 5]) for i in range(360)]
    schema = "dev string, ts_us long, event_id long, op string"
    stream = shuffled(spark, tmp_path, rows, schema, 8, ("end", BASE + 10**12, 1000, "reset"))
    base_path = str(tmp_path / "run")
    done = inorder.fold_in_order(stream, stateful.LifecycleSessions(240_000_000), "dev", "12 minutes", buckets=2)
    done.writeStream.format("parquet").option("path", f"{base_path}/out").option("checkpointLocation", f"{base_path}/cp").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(f"{base_path}/out")
    same(out, lifecycle_sessions(spark.createDataFrame(rows, schema), idle=240_000_000), out.columns)
    state = spark.read.format("statestore").option("path", f"{base_path}/cp").option("stateVarName", "state").load()
    assert 0 < state.count() <= 2 * inorder.PAGES
