"""Erasure in written tables, row hooks, and what becomes of documents that hold nothing."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import gates
from tidemark.sources import stored
from tidemark.sources.deadletter import to_dead_letter
from tidemark.sources.events import parse_event_batches
from tidemark.sources.responses import split_heartbeats

IDS = {"user": "user", "dev": "dev"}


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [(i, f"u{i // 10}", f"d{i % 7}" if i % 2 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, user string, dev string")
    df.repartitionByRange(10, "id").write.parquet(path)
    return path, rows


def asked(spark, *rows):
    return spark.createDataFrame(rows, "user string, dev string")


def test_only_files_with_a_hit_are_rewritten(spark, table):
    path, rows = table
    before = stored.live_files(spark, path)
    counts = stored.erase_stored(spark, path, asked(spark, ("u3", None), ("u99", None)), IDS, "a")
    after = stored.live_files(spark, path)
    assert counts["rewritten"] in (1, 2) and len(set(before) & set(after)) == len(before) - counts["rewritten"]
    assert sorted(r["id"] for r in stored.read_stored(spark, path).collect()) == [i for i, u, _ in rows if u != "u3"]
    # Nothing of the erased user is left in any file, listed or not.
    assert spark.read.option("recursiveFileLookup", True).parquet(path).filter("user = 'u3'").isEmpty()
    stored.erase_stored(spark, path, asked(spark, (None, "d1"), (None, None)), IDS, "b")
    assert sorted(r["id"] for r in stored.read_stored(spark, path).collect()) == [i for i, u, d in rows if u != "u3" and d != "d1"]


def test_nothing_to_erase_changes_no_file(spark, table, tmp_path):
    path, rows = table
    before = stored.live_files(spark, path)
    assert stored.erase_stored(spark, path, asked(spark, ("nobody", None)), IDS, "a") == {"files": len(before), "rewritten": 0}
    assert stored.live_files(spark, path) == before
    spark.createDataFrame([], "user string, dev string").write.parquet(str(tmp_path / "none"))
    assert stored.erase_stored(spark, str(tmp_path / "none"), asked(spark, ("u", None)), IDS, "a")["rewritten"] == 0


@pytest.mark.parametrize("step", ["_commit", "_clean"])
def test_an_erasure_goes_on_after_a_crash(spark, table, monkeypatch, step):
    path, rows = table
    requests = asked(spark, ("u3", None), (None, "d5"))
    want = [i for i, u, d in rows if u != "u3" and d != "d5"]

    real = getattr(stored, step)

    def crash(*given):
        if given[-1]["erasure"] == "a":
            raise RuntimeError("lost")
        real(*given)

    with monkeypatch.context() as m:
        m.setattr(stored, step, crash)
        with pytest.raises(RuntimeError):
            stored.erase_stored(spark, path, requests, IDS, "a")
    seen = sorted(r["id"] for r in stored.read_stored(spark, path).collect())
    assert seen == (sorted(i for i, _, _ in rows) if step == "_commit" else want)
    for _ in range(2):
        stored.erase_stored(spark, path, requests, IDS, "a")
        assert sorted(r["id"] for r in stored.read_stored(spark, path).collect()) == want
    assert spark.read.option("recursiveFileLookup", True).parquet(path).filter("user = 'u3' or dev = 'd5'").isEmpty()


def test_two_writers_cannot_commit_one_list(spark, table):
    path, _ = table
    stored._commit(spark, path, 1, {"erasure": "a", "files": [], "replaced": []})
    with pytest.raises(RuntimeError):
        stored._commit(spark, path, 1, {"erasure": "b", "files": [], "replaced": []})


def test_a_hook_costs_no_more_than_its_row(spark):
    rows = [(i, f"m{i}", [i]) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, message string, list array<int>").repartition(3)

    def hook(row):
        if row["id"] % 5 == 0:
            return None
        if row["id"] == 7:
            row["message"] = "half done"
            raise KeyError("x")
        if row["id"] == 8:
            return {"id": "text"}
        if row["id"] == 9:
            return "no row"
        if row["id"] == 11:
            return {"id": 11}
        row["list"].append(1)
        return row

    good, dead = to_dead_letter(gates.run_hook(df, hook), F.col("hook_error"))
    kept = {r["id"]: (r["message"], r["list"]) for r in good.collect()}
    refused = {r["id"]: (r["message"], r["list"], r["dead_letter_error"]) for r in dead.collect()}
    assert kept == {i: (f"m{i}", [i, 1]) for i in range(50) if i % 5 and i not in (7, 8, 9, 11)} | {11: (None, None)}
    assert sorted(refused) == [7, 8, 9] and refused[7] == ("m7", [7], "hook_failed: KeyError")
    assert refused[9][2] == "hook_failed: AttributeError"
    assert gates.run_hook(df.limit(0), hook).collect() == []


def test_every_document_leaves_a_row_or_a_reject(spark):
    event = {"eventId": "e", "name": "n", "anonymousId": "a"}
    docs = [None, "", " \n", "null", "[]", "5", "{}", '{"appId": "a"}', '{"events": null}', '{"events": []}', '{"events": [null]}', "{cut", ' \t{"events": [%s]}' % json.dumps(event)]
    rows, rejects = parse_event_batches(spark.createDataFrame([(d,) for d in docs], "value string"))
    assert [r["event_id"] for r in rows.collect()] == ["e"] and rejects.count() == len(docs) - 1
    codes = {r["document"]: r["reject_code"] for r in rejects.collect() if r["document"]}
    assert codes["{}"] == codes['{"appId": "a"}'] == codes['{"events": null}'] == "no_events" and codes[" \n"] == codes["{cut"] == "malformed_batch"


def test_heartbeats_behind_white_space(spark):
    bodies = [' {"ok":true}', '\n\t{"ok":true,"appId":"a"}', "{}", None, "", "<html>", "[1]", '"{"', '{"ok":']
    df = spark.createDataFrame([(i, b, 9) for i, b in enumerate(bodies)], "id int, body string, received_ms long")
    rows, rejects = split_heartbeats(df)
    assert sorted((r["id"], r["ok"]) for r in rows.collect()) == [(0, True), (1, True), (2, False)]
    assert sorted(r["id"] for r in rejects.collect()) == list(range(3, 9))
