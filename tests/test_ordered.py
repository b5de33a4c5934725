"""Chunked scans against plain Python folds, with one key holding a third of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ordered
from tidemark.operators.delivery import dedup_events, keep_latest, resolve_replays
from tidemark.operators.screens import coalesce_screens
from tidemark.operators.sessions import lifecycle_sessions, session_funnel, sessionize


def skewed(n, seed, span, keys=9):
    """(key, time, seq, value) rows: key 0 has a third, times collide, values may be null."""
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        key = 0 if rng.random() < 1 / 3 else rng.randrange(1, keys)
        rows.append((f"k{key}", rng.randrange(span), seq, rng.choice([None, 1, 2, 3])))
    return rows


def by_key(rows):
    out = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        out.setdefault(row[0], []).append(row)
    return out


@pytest.mark.parametrize("hot_rows", [1, 7, 50, 10_000])
@pytest.mark.parametrize("reverse", [False, True])
def test_running_values(spark, hot_rows, reverse):
    rows = skewed(600, 1, 500)
    df = spark.createDataFrame(rows, "k string, t long, s long, v int")
    v = F.col("v")
    out = (
        ordered.Ordered(df, ["k"], ["t", "s"], hot_rows)
        .running(
            reverse,
            last=ordered.last(v),
            before=ordered.before(v),
            first=ordered.first(v),
            total=ordered.total(v),
            prev=ordered.previous(v),
            prev_t=ordered.previous(F.col("t")),
        )
        .frame()
    )
    got = {r["s"]: tuple(r[c] for c in ("last", "before", "first", "total", "prev", "prev_t")) for r in out.collect()}
    assert len(got) == len(rows)
    for series in by_key(rows).values():
        newest = earliest = prev = prev_t = None
        total = 0
        for _, t, s, value in reversed(series) if reverse else series:
            earlier = newest
            newest = value if value is not None else newest
            earliest = earliest if earliest is not None else value
            total += value or 0
            assert got[s] == (newest, earlier, earliest, total, prev, prev_t)
            prev, prev_t = value, t


def test_bursts_are_cut(spark):
    # A tenth of the hot key's rows spread over 40,000 ticks, the rest within 2,000 of them.
    rows = [("hot", 500 + i // 2 if i % 10 else i * 10, i) for i in range(4000)] + [("cold", i, i) for i in range(30)]
    df = spark.createDataFrame(rows, "k string, t long, s long")
    placed, cut = ordered.place(df, ["k"], "t", 100)
    sizes = placed.groupBy("k", "__chunk", "__hot").count().collect()
    assert cut and max(r["count"] for r in sizes) <= 400 and sum(r["count"] for r in sizes) == len(rows)
    assert [(r["count"], r["__hot"]) for r in sizes if r["k"] == "cold"] == [(30, False)]
    out = ordered.Ordered(df, ["k"], ["t", "s"], 100).running(n=ordered.total(F.lit(1))).frame()
    want = {r[2]: i + 1 for i, r in enumerate(sorted((r for r in rows if r[0] == "hot"), key=lambda r: r[1:]))}
    assert {r["s"]: r["n"] for r in out.filter("k = 'hot'").collect()} == want


def test_negative_times(spark):
    rows = [("k", t, i, i) for i, t in enumerate([-25, -11, -10, -1, 0, 3, 19])]
    df = spark.createDataFrame(rows, "k string, t long, s long, v int")
    out = ordered.Ordered(df, ["k"], ["t", "s"], 2).running(n=ordered.total(F.lit(1))).frame()
    assert sorted((r["t"], r["n"]) for r in out.collect()) == [(t, i + 1) for i, (_, t, _, _) in enumerate(rows)]


def test_as_of(spark):
    events, log_a, log_b = skewed(300, 2, 400), skewed(120, 3, 400), skewed(60, 4, 400)
    schema = "k string, t long, s long, v int"
    frames = [spark.createDataFrame(r, schema) for r in (events, log_a, log_b)]
    out = ordered.as_of(frames[0], {"a": frames[1], "b": frames[2]}, ["k"], "t", "s", 50).collect()
    assert len(out) == len(events)

    def latest(log, key, t):
        seen = [r for r in log if r[0] == key and r[1] <= t]
        return max(seen, key=lambda r: (r[1], r[2])) if seen else None

    for row in out:
        for name, log in (("a", log_a), ("b", log_b)):
            want = latest(log, row["k"], row["t"])
            assert (row[name] is None) == (want is None)
            if want is not None:
                assert row[name]["v"] == want[3]


def greedy(series, length, changed=lambda a, b: False):
    opened, at, what = set(), None, None
    for row in series:
        if at is None or changed(what, row) or row[1] - at >= length:
            opened.add(row[2])
            at = row[1]
            what = row
    return opened


@pytest.mark.parametrize("fold_rows", [0, 3, 4096])
@pytest.mark.parametrize("hot_rows", [5, 10_000])
def test_open_intervals(spark, fold_rows, hot_rows):
    rows = skewed(400, 5, 600)
    df = spark.createDataFrame(rows, "k string, t long, s long, v int")
    out = ordered.open_intervals(df, ["k"], "t", "s", 10, hot_rows=hot_rows, fold_rows=fold_rows)
    got = {r["s"] for r in out.filter("opens").collect()}
    assert out.count() == len(rows)
    assert got == set().union(*(greedy(series, 10) for series in by_key(rows).values()))


def test_coalesce_screens(spark):
    rows = [("d", t, i, "a") for i, t in enumerate([0, 200, 400, 410, 700])]
    rows += [("e", 0, 10, "a"), ("e", 100, 11, "b"), ("e", 200, 12, "a"), ("e", 449, 13, "a"), ("e", 450, 14, "a")]
    df = spark.createDataFrame(rows, "dev string, ts_ms long, event_id long, screen string")
    kept = {r["event_id"] for r in coalesce_screens(df).collect()}
    assert kept == {0, 2, 4, 10, 11, 12, 14}
    many = [(k, t, s, str(v)) for k, t, s, v in skewed(500, 6, 4000)]
    df = spark.createDataFrame(many, "dev string, ts_ms long, event_id long, screen string")
    kept = {r["event_id"] for r in coalesce_screens(df, hot_rows=20).collect()}
    assert kept == set().union(*(greedy(s, 250, lambda a, b: a[3] != b[3]) for s in by_key(many).values()))


def test_resolve_replays(spark):
    day = 86_400_000
    rows = [
        ("k", 0, 0, "x", 500),
        ("k", 5, 1, "x", 200),
        ("k", 6, 2, "x", None),
        ("k", 7, 3, "y", 200),
        ("k", 4 + day, 4, "x", 200),
        ("k", 5 + day, 5, "y", 200),
        ("k", 6 + day, 6, "y", 200),
        ("k", 9 + 2 * day, 7, "y", 400),
        ("k", 9 + 2 * day, 8, "z", 201),
        ("k", 10 + 2 * day, 9, "z", 201),
    ]
    df = spark.createDataFrame(rows, "key string, ts_ms long, event_id long, body_hash string, status int")
    got = {r["event_id"]: r["outcome"] for r in resolve_replays(df).collect()}
    assert [got[i] for i in range(10)] == [
        "executed", "executed", "replayed", "conflict", "replayed", "executed", "replayed", "executed", "executed", "replayed",
    ]


def test_sessions_split_at_the_limit(spark):
    minute = 60_000_000
    times = [0, 30 * minute - 1, 60 * minute - 1, 60 * minute, 89 * minute]
    rows = [("d", t, i) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "dev string, ts_us long, event_id long")
    for hot_rows in (1, 2, 100):
        got = {r["event_id"]: r["session_no"] for r in sessionize(df, hot_rows=hot_rows).collect()}
        assert got == {0: 1, 1: 1, 2: 2, 3: 2, 4: 2}


@pytest.mark.parametrize("hot_rows", [1, 40, 5000])
def test_sessions_random(spark, hot_rows):
    rows = skewed(700, 7, 3000)
    df = spark.createDataFrame(rows, "dev string, ts_us long, event_id long, v int")
    got = {r["event_id"]: r["session_no"] for r in sessionize(df, idle=11, hot_rows=hot_rows).collect()}
    for series in by_key(rows).values():
        number, before = 0, None
        for _, t, s, _ in series:
            number += before is None or t - before >= 11
            assert got[s] == number
            before = t


def test_lifecycle(spark):
    half = 30 * 60 * 1_000_000
    ops = [
        (0, "foreground"), (1, "background"), (2, "foreground"), (3, "reset"), (4, "background"), (5, "background"),
        (5 + half, "foreground"), (6 + half, "foreground"), (7 + half, "background"), (6 + 2 * half, "foreground"),
    ]
    df = spark.createDataFrame([("d", t, i, op) for i, (t, op) in enumerate(ops)], "dev string, ts_us long, event_id long, op string")
    for hot_rows in (1, 3, 100):
        got = sorted((r["event_id"], r["name"][8:], r["reason"]) for r in lifecycle_sessions(df, hot_rows=hot_rows).collect())
        assert got == [
            (0, "started", "resume_idle"), (1, "ended", "background"), (2, "started", "resume"), (3, "ended", "manual_reset"),
            (3, "started", "manual_reset"), (4, "ended", "background"), (6, "started", "resume_idle"), (7, "started", "resume_idle"),
            (8, "ended", "background"), (9, "started", "resume"),
        ]


def test_funnel_needs_order(spark):
    rows = [("s1", 1, 1, "b"), ("s1", 2, 2, "a"), ("s1", 2, 3, "b"), ("s1", 1, 0, "c"), ("s2", 1, 4, "b"), ("s3", 1, 5, "a")]
    df = spark.createDataFrame(rows, "session_id string, ts_us long, event_id long, name string")
    got = {r["session_id"]: r["steps_reached"] for r in session_funnel(df, ["a", "b", "c"]).collect()}
    assert got == {"s1": 2, "s2": 0, "s3": 1}


def test_funnel_is_one_shuffle_and_cuts_hot_sessions(spark):
    rng = random.Random(2)
    rows = [(f"s{i % 5}" if i % 9 else "hot", rng.randint(0, 300), i, rng.choice("abcdx")) for i in range(600)] + [(None, 1, 999, "a")]
    df = spark.createDataFrame(rows, "session_id string, ts_us long, event_id long, name string")
    for steps in (["a"], ["a", "b"], ["a", "b", "a", "d", "c"], ["zz", "a"]):
        want = {None: 0}
        for sid, _, _, name in sorted(rows[:-1], key=lambda r: r[1:3]):
            reached = want.get(sid, 0)
            want[sid] = reached + (reached < len(steps) and name == steps[reached])
        for hot in (4_000_000, 40):
            got = {r["session_id"]: r["steps_reached"] for r in session_funnel(df, steps, hot_rows=hot).collect()}
            assert got == want
    plan = session_funnel(df, ["a", "b", "c", "d"])._jdf.queryExecution().executedPlan().toString()
    # The rows' own shuffle, and that of the null session.
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(dealt) == 2 and sum("__alone" in line for line in dealt) == 1 and plan.count("Sort [") == 1


def test_keep_latest(spark):
    rows = [("d", i, i) for i in range(8)] + [("e", 1, 1)]
    df = spark.createDataFrame(rows, "dev string, ts_us long, event_id long")
    kept, dropped = keep_latest(df, 5, hot_rows=3)
    assert sorted(r["event_id"] for r in kept.filter("dev = 'd'").collect()) == [3, 4, 5, 6, 7]
    assert [tuple(r) for r in dropped.collect()] == [("d", 3)]


def test_dedup_keeps_the_first_received(spark):
    rows = [(1, 5, "b"), (1, 3, "a"), (2, 9, "c")] + [(7, i, "copy") for i in range(50, 500)]
    df = spark.createDataFrame(rows, "event_id long, received_us long, name string")
    got = sorted(tuple(r) for r in dedup_events(df).collect())
    assert got == [(1, 3, "a"), (2, 9, "c"), (7, 50, "copy")]
    bags = df.withColumn("bag", F.create_map(F.lit("n"), "name"))
    assert sorted(r["bag"]["n"] for r in dedup_events(bags).collect()) == ["a", "c", "copy"]
