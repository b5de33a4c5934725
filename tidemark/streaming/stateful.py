"""Per-key rules on streams, one small state per key.

Each is a rule of ``inorder``: give ``late`` and rows are folded in order of time
over the whole stream however they arrive; without it each micro-batch is folded
as it comes.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import reduce
from types import SimpleNamespace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.privacy import scrub_pii
from .inorder import Rule, fold_in_order

DAY_MS = 86_400_000


class LifecycleSessions(Rule):
    """Session starts and ends from foreground, background and reset rows."""

    reads = ("ts_us", "event_id", "op")
    state_schema = "is_open boolean, background long, started long, session_seq long"
    output = "dev string, ts_us long, event_id long, name string, session_id string, reason string, duration_ms long"

    def __init__(self, idle: int):
        self.idle = idle

    def start(self):
        return [False, None, None, None]

    def step(self, key, state, row):
        is_open, background, started, number = state
        now, seq = row.ts_us, row.event_id

        def ended(reason):
            return key, now, seq, "session.ended", f"ses_{key}_{number}", reason, (now - started) // 1000

        def begun(reason):
            state[:] = [True, background, now, seq]
            return key, now, seq, "session.started", f"ses_{key}_{seq}", reason, None

        if row.op == "background":
            if is_open:
                yield ended("background")
            state[:] = [False, now, started, number]
        elif row.op == "reset":
            if is_open:
                yield ended("manual_reset")
            yield begun("manual_reset")
        else:
            long_idle = background is None or now - background >= self.idle
            if not is_open or long_idle:
                yield begun("resume_idle" if long_idle else "resume")


class CoalesceRepeats(Rule):
    """Drops a row of the last kept row's value less than ``window`` after it."""

    reads = ("ts_ms", "event_id", "value")
    unit = 1
    state_schema = "value string, kept_at long"
    output = "dev string, ts_ms long, event_id long, value string"

    def __init__(self, window: int):
        self.window = window

    def start(self):
        return [None, None]

    def step(self, key, state, row):
        value, at = state
        if at is None or row.value != value or row.ts_ms - at >= self.window:
            state[:] = [row.value, row.ts_ms]
            yield key, row.ts_ms, row.event_id, row.value

    def deadline(self, state):
        # Nothing within the window can come any more.
        return None if state[1] is None else state[1] + self.window


class FoldIdentity(Rule):
    """Identity after each operation."""

    reads = ("ts_us", "event_id", "op", "user", "customer")
    state_schema = "epoch long, user string, customer string"
    output = (
        "dev string, ts_us long, event_id long, epoch long, anonymous_id string, "
        "developer_user_id string, customer_id string"
    )

    def start(self):
        return [0, None, None]

    def step(self, key, state, row):
        if row.op == "reset":
            state[:] = [state[0] + 1, None, None]
        elif row.op == "identify":
            state[1] = (row.user or "").strip() or None
        elif row.op == "alias":
            state[2] = (row.customer or "").strip() or None
        epoch, user, customer = state
        anonymous = key if epoch == 0 else "anon_" + hashlib.md5(f"{key}#{epoch}".encode()).hexdigest()
        yield key, row.ts_us, row.event_id, epoch, anonymous, user, customer


class ResolveReplays(Rule):
    """Replay, conflict or execution of requests with one key.

    An answer is forgotten when the watermark is ``ttl`` past it: no request to come can be answered from it.
    """

    reads = ("ts_ms", "event_id", "body_hash", "status")
    unit = 1
    state_schema = "stored_at long, body string"
    output = "key string, ts_ms long, event_id long, outcome string"

    def __init__(self, ttl: int = DAY_MS):
        self.ttl = ttl

    def start(self):
        return [None, None]

    def step(self, key, state, row):
        at, body = state
        if at is not None and row.ts_ms - at < self.ttl:
            outcome = "replayed" if row.body_hash == body else "conflict"
        else:
            outcome = "executed"
            if row.status is not None and 200 <= row.status <= 299:
                state[:] = [row.ts_ms, row.body_hash]
        yield key, row.ts_ms, row.event_id, outcome

    def deadline(self, state):
        return None if state[0] is None else state[0] + self.ttl


class SuperProperties(Rule):
    """Property map after each operation; any property names."""

    reads = ("ts_us", "event_id", "op", "key", "value")
    state_schema = "held string"
    output = "dev string, ts_us long, event_id long, props map<string,string>"

    def start(self):
        return ["{}"]

    def opened(self, state):
        return [json.loads(state[0])]

    def stored(self, state):
        return [json.dumps(state[0])]

    def step(self, key, state, row):
        held = state[0]
        if row.op == "clear":
            held.clear()
        elif row.key and row.op == "register":
            held[row.key] = row.value
        elif row.key and row.op == "registerOnce":
            held.setdefault(row.key, row.value)
        elif row.key and row.op == "unregister":
            held.pop(row.key, None)
        yield key, row.ts_us, row.event_id, dict(held)


class FrameJank(Rule):
    """Frames of each closed window by how long they took: the time since the device's frame before."""

    reads = ("frame_ns", "event_id")
    unit = 1_000_000
    state_schema = "frame_ns long, window long, total long, slow long, frozen long"
    output = "dev string, window_start_us long, total_frames long, slow_frames long, frozen_frames long"

    def __init__(self, window_ms: int):
        self.window = window_ms * self.unit

    def start(self):
        return [None, None, 0, 0, 0]

    def closed(self, key, state) -> Iterator[tuple]:
        _, window, total, slow, frozen = state
        if window is not None:
            yield key, window * (self.window // 1000), total, slow, frozen

    def step(self, key, state, row):
        before, window = state[:2]
        if before is not None:
            if row.frame_ns // self.window != window:
                yield from self.closed(key, state)
                state[1:] = [row.frame_ns // self.window, 0, 0, 0]
            took = row.frame_ns - before
            state[2] += 1
            state[3] += 16_000_000 < took <= 700_000_000
            state[4] += took > 700_000_000
        state[0] = row.frame_ns

    def deadline(self, state):
        return None if state[1] is None else (state[1] + 1) * self.window // self.unit

    def expire(self, key, state):
        return list(self.closed(key, state)), [state[0], None, 0, 0, 0]


class EntitlementChanges(Rule):
    """The snapshots of a user that differ from the one before, or all; a snapshot is all rows of one time.

    The last document is the state, as JSON: a list of [key, active, valid_until_us], sorted, without repetition.
    """

    reads = ("ts_us", "key", "active", "valid_until_us")
    state_schema = "at long, items string, before string"
    output = "user string, ts_us long, entitlements array<struct<key:string,active:boolean,valid_until_us:long>>"

    def __init__(self, entitlements_only: bool):
        self.entitlements_only = entitlements_only

    def start(self):
        return [None, "[]", None]

    def document(self, items: list) -> str:
        return json.dumps(sorted({tuple(i) for i in items}, key=lambda i: [x for v in i for x in (v is not None, v)]))

    def closed(self, key, state) -> Iterator[tuple]:
        """Output the open snapshot if it is a change, and make it the one before."""
        at, items, before = state
        if at is None:
            return
        held = self.document(json.loads(items))
        state[:] = [None, "[]", held]
        if not self.entitlements_only or held != before:
            yield key, at, [{"key": k, "active": a, "valid_until_us": v} for k, a, v in json.loads(held)]

    def step(self, key, state, row):
        if row.ts_us != state[0]:
            yield from self.closed(key, state)
        state[0] = row.ts_us
        state[1] = self.document([*json.loads(state[1]), [row.key, row.active, row.valid_until_us]])

    def deadline(self, state):
        return None if state[0] is None else state[0] // self.unit + 1

    def expire(self, key, state):
        return list(self.closed(key, state)), state


class EnrichEvents(Rule):
    """Everything in force when an event happened, from one log of events and of the changes to what is in force.

    ``kind`` says what a row is; a change at an event's time counts as earlier, so its ``seq`` is the lesser. ``a``,
    ``b`` and ``data`` are what the kind needs. The state is one JSON object: an identity, a property map, an open
    session, the last consent and the last device.
    """

    reads = ("ts_us", "seq", "event_id", "kind", "op", "a", "b", "data")
    state_schema = "held string"
    output = (
        "dev string, ts_us long, event_id long, name string, properties map<string,string>, anonymous_id string, "
        "developer_user_id string, customer_id string"
    )

    def __init__(self, idle: int):
        self.identity, self.supers, self.lifecycle = FoldIdentity(), SuperProperties(), LifecycleSessions(idle)

    def start(self):
        fresh = {"identity": self.identity.start(), "ids": None, "supers": {}, "lifecycle": self.lifecycle.start(), "session": None, "consent": None, "device": {}}
        return [json.dumps(fresh)]

    def opened(self, state):
        return [json.loads(state[0])]

    def stored(self, state):
        return [json.dumps(state[0])]

    def step(self, key, state, row):
        if key is None:
            # Rows without a device do not see each other.
            state = self.opened(self.start())
        held = state[0]
        if row.kind == "event":
            yield from self.event(key, held, row)
        elif row.kind == "identity":
            (made,) = self.identity.step(key, held["identity"], SimpleNamespace(ts_us=row.ts_us, event_id=row.event_id, op=row.op, user=row.a, customer=row.b))
            held["ids"] = made[-3:]
        elif row.kind == "super":
            list(self.supers.step(key, [held["supers"]], SimpleNamespace(ts_us=row.ts_us, event_id=row.event_id, op=row.op, key=row.a, value=row.b)))
        elif row.kind == "lifecycle":
            made = list(self.lifecycle.step(key, held["lifecycle"], row))
            if made:
                held["session"] = next((r[4] for r in made if r[3] == "session.started"), None)
        elif row.kind == "consent":
            held["consent"] = [row.a, row.b]
        elif row.kind == "device":
            held["device"] = json.loads(row.data or "{}")

    def event(self, key, held, row):
        is_error = row.op == "$error"
        if held["consent"] is not None and held["consent"][is_error] == "false":
            return
        own = json.loads(row.data) if row.data else None
        bag = own
        if not is_error:
            bag = {**held["supers"], **held["device"], **(own or {})}
            if held["session"] is not None:
                bag["sessionId"] = held["session"]
        yield key, row.ts_us, row.event_id, row.op, bag, *(held["ids"] or (key, None, None))


def enriching_log(events: DataFrame, identity: DataFrame, consent: DataFrame, super_properties: DataFrame, device: DataFrame, lifecycle: DataFrame, key: str = "dev") -> DataFrame:
    """The rows of all logs as ``EnrichEvents`` reads them."""
    text = F.lit(None).cast("string")

    def rows(df: DataFrame, kind: str, op=text, a=text, b=text, data=text) -> DataFrame:
        # Changes come before the events of their time.
        seq = F.col("event_id") + (1 << 62 if kind == "event" else 0)
        return df.select(key, "ts_us", seq.alias("seq"), "event_id", F.lit(kind).alias("kind"), op.alias("op"), a.alias("a"), b.alias("b"), data.alias("data"))

    def bag(column: str):
        return F.to_json(column, {"ignoreNullFields": "false"})

    parts = [
        rows(events, "event", F.col("name"), data=bag("properties")),
        rows(identity, "identity", F.col("op"), F.col("user"), F.col("customer")),
        rows(consent, "consent", a=F.col("analytics").cast("string"), b=F.col("errors").cast("string")),
        rows(super_properties, "super", F.col("op"), F.col("key"), F.col("value")),
        rows(device, "device", data=bag("payload")),
        rows(lifecycle, "lifecycle", F.col("op")),
    ]
    return reduce(DataFrame.unionByName, parts)


def enrich_stream(log: DataFrame, late: str, idle: int = 30 * 60 * 1_000_000, scrub: bool = True, key: str = "dev", rejects: bool = False) -> DataFrame:
    """``operators.identity.enrich_events`` on a stream of the rows of ``enriching_log``, whatever order they come in."""
    rows = fold_in_order(log, EnrichEvents(idle), key, late, rejects)
    if not scrub:
        return rows
    clean = F.when(F.col("name") == "$error", F.col("properties")).otherwise(F.transform_values("properties", lambda _, v: scrub_pii(v)))
    return rows.withColumn("properties", clean)


def lifecycle_stream(ops: DataFrame, idle: int = 30 * 60 * 1_000_000, key: str = "dev", late: str | None = None) -> DataFrame:
    return fold_in_order(ops, LifecycleSessions(idle), key, late)


def coalesce_stream(rows: DataFrame, window: int, key: str = "dev", late: str | None = None) -> DataFrame:
    """Screens (250 ms) or taps (100 ms); the screen or element is in ``value``."""
    return fold_in_order(rows, CoalesceRepeats(window), key, late)


def identity_stream(ops: DataFrame, key: str = "dev", late: str | None = None, rejects: bool = False) -> DataFrame:
    return fold_in_order(ops, FoldIdentity(), key, late, rejects)


def super_properties_stream(ops: DataFrame, key: str = "dev", late: str | None = None) -> DataFrame:
    return fold_in_order(ops, SuperProperties(), key, late)


def replays_stream(requests: DataFrame, key: str = "key", ttl: int = DAY_MS, late: str | None = None) -> DataFrame:
    """With ``late``, an answer leaves the state when the watermark is ``ttl`` past it."""
    return fold_in_order(requests, ResolveReplays(ttl), key, late)


def frame_jank_stream(frames: DataFrame, window_ms: int = 60_000, late: str = "10 seconds", key: str = "dev") -> DataFrame:
    """Jank per device and closed window, from frames with ``frame_ns``, nanoseconds since the epoch."""
    return fold_in_order(frames, FrameJank(window_ms), key, late)


def entitlement_changes_stream(snapshots: DataFrame, entitlements_only: bool = False, user: str = "user", late: str = "10 minutes") -> DataFrame:
    """The change feed of ``operators.entitlements.entitlement_changes`` from snapshot rows as they come.

    A snapshot comes out when the watermark has passed its time, after which no row of it can come.
    """
    return fold_in_order(snapshots, EntitlementChanges(entitlements_only), user, late)
