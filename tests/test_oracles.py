"""Every registered query against its DuckDB SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from tidemark.operators import ordered, sessions

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return "~" if value is None else str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


# Queries that read rows in order, run once more with keys cut into many chunks.
ORDERED = (
    "session_summary lifecycle_sessions attach_session fold_identity consent_gate fold_super_properties enrich_events "
    "resolve_replays delivery_outcomes retry_audit keep_latest coalesce_screens pack_event_batches attach_breadcrumbs "
    "recover_fatals frame_jank rising_edges detect_stalls is_entitled_as_of entitlement_changes_only"
).split()


@pytest.mark.parametrize("name", sorted(entry_point.queries()))
def test_query_matches_sql(spark, duck, name):
    check(spark, duck, name)


@pytest.mark.parametrize("name", ORDERED)
def test_query_matches_sql_with_hot_keys(spark, duck, name, monkeypatch):
    real = ordered.place

    def cut_small(df, keys, tick, hot_rows=0, measure=None):
        return real(df, keys, tick, 3, measure)

    monkeypatch.setattr(ordered, "place", cut_small)
    monkeypatch.setattr(sessions, "place", cut_small)
    check(spark, duck, name)


def check(spark, duck, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    got = table(df.columns, df.collect())
    oracle = entry_point.oracle_sql().get(name)
    if oracle is None:
        assert got[0]
        return
    cursor = duck.execute(oracle)
    assert got == table([c[0] for c in cursor.description], cursor.fetchall())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
