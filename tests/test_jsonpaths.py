import json
import random
import re
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import jsonpaths, privacy, values
from tidemark.session import configure

ODD = [
    '{"n": NaN, "m": [Infinity, 3, -Infinity]}', '{"a":1,"a":{"b":"two"}}', "{broken", "[1]", '{"a": "\\ud83d x"}', '{"a": "\\\\ud83d \\udc00 \\ud83d\\ude00"}',
    None, "", "  ", "{} x", '{} ,"7"]', '"s"', "7", "null", "{'a':1}", "1,2", '{"a b.c":1,"\'":2,"":3,"x/y~z":[[]]}', "{}", '{"n":01}', '{"t":true,"u":null,"v":[null,{}]}',
    '{"d":' * 60 + "1" + "}" * 60, "[" * 3000 + "]" * 3000, '{"s":"' + "é" * 1025 + '","l":["' + "x" * 1024 + '","' + "\U0001f600" * 1030 + '"]}',
    '{"k":"mail a@b.cd or 4111 1111 1111 1111","n":4111111111111111}', '{"user":{"Email":"x","list":[{"my_password":1}]},"tokens":2,"token":null}',
]


def made(rng, depth=0):
    kind = rng.random()
    if depth < 6 and kind < 0.35:
        return {rng.choice(["a", "b", "email", "x~y", "/", "é", "creditCard"]) + str(i): made(rng, depth + 1) for i in range(rng.randint(0, 4))}
    if depth < 6 and kind < 0.6:
        return [made(rng, depth + 1) for _ in range(rng.randint(0, 4))]
    return rng.choice([None, True, False, 0, -7, 12345678901234567890, 1.5, float("nan"), "", "x@y.zz", "t" * 1030, "\n\"\\", "5500 0055 5555 5559"])


def texts():
    rng = random.Random(3)
    return ODD + [json.dumps({"r": made(rng), "s": made(rng)}, ensure_ascii=rng.random() < 0.5) for _ in range(300)]


def leaves(value, path=""):
    """The plain values of a parsed text by pointer."""
    if isinstance(value, dict):
        return {p: v for k, w in value.items() for p, v in leaves(w, path + "/" + k.replace("~", "~0").replace("/", "~1")).items()}
    if isinstance(value, list):
        return {p: v for i, w in enumerate(value) for p, v in leaves(w, f"{path}/{i}").items()}
    return {path: value}


@pytest.fixture(scope="module")
def frame(spark):
    return configure(spark).createDataFrame(list(enumerate(texts())), "i int, t string").repartition(8)


def test_warnings_and_errors_equal_the_arrow_form(frame):
    df = jsonpaths.with_json_nodes(frame.withColumn("s", values.sanitize_json("t")), "t")
    rows = df.select("t", "s", jsonpaths.json_warnings(F.col("nodes")).alias("w"), jsonpaths.json_error(F.col("t"), F.col("nodes")).alias("e")).collect()
    assert len(rows) == len(texts())
    for r in rows:
        if r["t"] == "[" * 3000 + "]" * 3000:
            # Python's reader goes deeper and finds a list.
            assert r["e"] == values.TOO_DEEP
            continue
        assert r["e"] == r["s"]["error"], r["t"]
        assert sorted(map(tuple, r["w"])) == sorted(map(tuple, r["s"]["warnings"])), r["t"]


def test_scrubbed_paths_equal_the_arrow_form(frame):
    whole = frame.withColumn("j", privacy.scrub_pii_json()("t"))
    df = jsonpaths.with_json_nodes(whole, "t", max_depth=privacy.SCRUB_MAX_DEPTH)
    for r in df.select("t", "j", "nodes", jsonpaths.scrub_json_nodes(F.col("nodes")).alias("c")).collect():
        if r["nodes"] is None:
            continue
        want = {p: v for p, v in leaves(json.loads(r["j"])).items()}
        got = {x["path"]: x for x in r["c"] if x["kind"] not in (jsonpaths.OBJECT, jsonpaths.LIST)}
        assert set(got) == set(want), r["t"]
        for path, value in want.items():
            x = got[path]
            if value is None:
                assert (x["kind"], x["value"]) == (jsonpaths.NULL, None)
            elif isinstance(value, bool):
                assert (x["kind"], x["value"]) == (jsonpaths.TRUTH, str(value).lower())
            elif isinstance(value, str):
                assert (x["kind"], x["value"]) == (jsonpaths.STRING, value)
            else:
                assert x["kind"] == jsonpaths.NUMBER and float(x["value"]) == float(value)


def test_depth_limit_and_marker(spark):
    df = configure(spark).createDataFrame([('{"a":{"b":{"c":{"d":1}}},"l":[["x@y.zz"]]}',)], "t string")
    row = jsonpaths.with_json_nodes(df, "t", max_depth=2).select(jsonpaths.scrub_json_nodes(F.col("nodes"), "<deep>").alias("c")).collect()[0]
    got = [(x["path"], x["value"]) for x in row["c"]]
    assert got == [("", None), ("/a", None), ("/l", None), ("/a/b", None), ("/l/0", None), ("/a/b/c", "<deep>"), ("/l/0/0", "<deep>")]


def test_sensitive_names_at_any_depth(frame):
    rows = jsonpaths.with_json_nodes(frame.filter(F.col("t").contains("my_password")), "t").select(jsonpaths.sensitive_json_paths(F.col("nodes")).alias("p")).collect()
    assert sorted(rows[0]["p"]) == ["/token", "/user/Email", "/user/list/0/my_password"]


def test_paths_need_no_python_and_no_shuffle(frame):
    plan = jsonpaths.json_paths(frame.select("i", F.col("t").alias("t")), "t")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan and plan.count("Exchange") == 1  # the fixture's repartition


def test_no_rows(spark):
    assert jsonpaths.json_paths(configure(spark).createDataFrame([], "i int, t string"), "t").collect() == []


def deepest(text):
    """The most brackets open at once outside of strings, one by one."""
    now = most = 0
    for m in re.sub(r"[^\[\]{}]+", "", re.sub(r'"(?:[^"\\]|\\.)*"', "", text)):
        now += 1 if m in "[{" else -1
        most = max(most, now)
    return most


def test_depth_is_that_of_counting_every_bracket(spark):
    rng = random.Random(5)
    runs = ["[" * 998, "{" * 1000, "]" * 997, '"' + "[" * 2000 + '"', '"\\"' + "[" * 1500, '"[\\', "[]" * 3000, "x" * 5000, "é\n1,", "}", "{", '"']
    odd = ["".join(rng.choice(runs) for _ in range(rng.randint(1, 9))) for _ in range(300)] + ["[" * 999 + "]" * 999 + "{" * 1000, "x" * 9000 + "[" * 1000]
    df = configure(spark).createDataFrame(list(enumerate(odd)), "i int, t string").repartition(4)
    got = {r["i"]: r["e"] for r in df.select("i", jsonpaths.json_error(F.col("t"), F.lit(None).cast("array<struct<kind:string>>")).alias("e")).collect()}
    assert got == {i: values.TOO_DEEP if deepest(t) >= jsonpaths.READER_DEPTH else values.INVALID_JSON for i, t in enumerate(odd)}
    assert len(set(got.values())) == 2


def test_long_texts_cost_no_step_a_bracket(spark):
    """2,000 texts of 400,000 brackets: one step each took minutes."""
    df = configure(spark).range(2000, numPartitions=8).select(F.expr("concat(repeat('[', 200000 + id), repeat(']', 200000 + id))").alias("t"))
    start = time.perf_counter()
    rows = jsonpaths.with_json_nodes(df, "t").select(jsonpaths.json_error(F.col("t"), F.col("nodes")).alias("e")).groupBy("e").count().collect()
    assert [tuple(r) for r in rows] == [(values.TOO_DEEP, 2000)] and time.perf_counter() - start < 60


def test_scrubbing_passes_over_texts_without_mail_or_digits(spark):
    """40 million brackets took 3 seconds; both patterns still hold beside them."""
    scrub = privacy.scrub_pii_json().func
    start = time.perf_counter()
    assert len(scrub(pd.Series(["[" * 40_000_000]))[0]) == 40_000_000 and time.perf_counter() - start < 1
    odd = ["[ a@b.io", "{ 4111 1111 1111 1111 ", "[ a@b.io 5500-0055-5555-5559 é", "[ 1 @"]
    assert list(scrub(pd.Series(odd))) == ["[ <email>", "{ <card> ", "[ <email> <card> é", "[ 1 @"]
