"""Exact vectors of the column rules."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import privacy, stacks, urls, values, wire
from tidemark.operators import gates


def ask(spark, schema, rows, **columns):
    df = spark.createDataFrame(rows, schema)
    return [r.asDict(recursive=True) for r in df.select(*[c.alias(n) for n, c in columns.items()]).collect()]


def test_scrub_pii(spark):
    cases = {
        "contact wes@example.com for details": "contact <email> for details",
        "paid via 4242 4242 4242 4242 last night": "paid via <card> last night",
        "4242-4242-4242-4242": "<card>",
        "123456789012": "123456789012",
        "1234567890123": "<card>",
        "1234567890123456789": "<card>",
        "a.b+c@x-y.co and d@e.fr": "<email> and <email>",
        "no at sign": "no at sign",
        "@ alone": "@ alone",
    }
    got = ask(spark, "t string", [(t,) for t in cases], s=privacy.scrub_pii(F.col("t")))
    assert [r["s"] for r in got] == list(cases.values())


def test_scrub_deep_typed(spark):
    schema = T.StructType.fromDDL(
        "bag struct<user:struct<contact:map<string,string>>,n:int,ok:boolean,z:string,tags:array<string>>"
    )
    rows = [(({"email": "user@example.com"},), 42, True, None, ["x@y.io", None])]
    df = spark.createDataFrame([(((rows[0][0]), *rows[0][1:]),)], schema)
    out = df.select(privacy.scrub_pii_deep(F.col("bag"), schema["bag"].dataType).alias("b")).first()["b"]
    assert out.asDict(recursive=True) == {
        "user": {"contact": {"email": "<email>"}},
        "n": 42,
        "ok": True,
        "z": None,
        "tags": ["<email>", None],
    }


def test_scrub_json_depth_and_keys(spark):
    deep = '{"a":' * 10 + '"x@y.io"' + "}" * 10
    scrub = privacy.scrub_pii_json(max_depth=3, marker="<deep>")
    rows = ask(spark, "t string", [(deep,), ('{"a@b.io": [1, "a@b.io", null, true]}',), ("not json",), (None,)], s=scrub("t"))
    assert "<deep>" in rows[0]["s"] and "x@y.io" not in rows[0]["s"]
    assert rows[1]["s"] == '{"a@b.io": [1, "<email>", null, true]}'
    assert rows[2]["s"] == "not json" and rows[3]["s"] is None


def test_free_json_never_fails(spark):
    odd = ['{"a":"\\ud800"}', "[" * 200_000 + "]" * 200_000, '{"a":NaN,"m":[Infinity]}', "{broken x@y.io", "[1]", '{"\\udc00":"' + "x" * 2000 + '"}', "\ud7ff"]
    rows = ask(spark, "t string", [(t,) for t in odd], s=values.sanitize_json("t"), p=privacy.scrub_pii_json()("t"))
    assert [r["s"]["error"] for r in rows] == [None, "too_deep", None, "invalid_json", "not_an_object", None, "invalid_json"]
    assert json.loads(rows[0]["s"]["properties"]) == {"a": "\ufffd"} == json.loads(rows[0]["p"])
    assert json.loads(rows[2]["s"]["properties"]) == {"m": [None]} and json.loads(rows[2]["p"]) == {"a": None, "m": [None]}
    assert rows[3]["p"] == "{broken <email>" and rows[5]["s"]["warnings"][0]["key"] == "\ufffd"


def test_both_scrubbers_agree_beside_letters_and_at_the_depth_limit(spark):
    texts = ["é4242424242424242", "4242424242424242é", "4242 4242 4242 4242", "-4242424242424242-", "_4242424242424242", "٤4242424242424242", "x@y.io4242424242424242"]
    rows = ask(spark, "t string", [(t,) for t in texts], c=privacy.scrub_pii(F.col("t")), j=privacy.scrub_pii_json()(F.to_json(F.struct("t"))))
    assert all(json.loads(r["j"])["t"] == r["c"] for r in rows)
    bag = F.struct(F.struct(F.col("t"), F.lit(5).alias("n"), F.array("t").alias("l")).alias("a"))
    deep = privacy.scrub_pii_deep(bag, T.StructType.fromDDL("a struct<t:string,n:int,l:array<string>>"), 1, "<deep>")
    assert ask(spark, "t string", [("x",)], d=deep)[0]["d"] == {"a": {"t": "<deep>", "n": None, "l": None}}
    free = ask(spark, "t string", [('{"a":{"t":"x","n":5,"l":["x"]}}',)], j=privacy.scrub_pii_json(1, "<deep>")("t"))[0]["j"]
    assert json.loads(free) == {"a": {"t": "<deep>", "n": "<deep>", "l": "<deep>"}}


def test_sensitive_keys(spark):
    keys = ["Email", "email_opt_in", "TOKEN", "tokens_remaining", "userPassword", "creditCard", "credit_card_no", "card", "discard", "phone"]
    got = ask(spark, "k array<string>", [(keys,), (None,)], h=privacy.flag_sensitive_keys(F.col("k")))
    assert got[0]["h"] == ["Email", "TOKEN", "userPassword", "creditCard", "credit_card_no", "card", "phone"]
    assert got[1]["h"] == []


def test_labels_and_marker(spark):
    labels = [("Enter PIN",), ("Shipping",), ("Buy",), (None,), ("",)]
    got = ask(spark, "d string", labels, p=privacy.has_pii_label(F.col("d")), o=privacy.is_opted_out(F.col("d"), "Shipp"))
    assert [r["p"] for r in got] == [True, True, False, False, False]
    assert [r["o"] for r in got] == [False, True, False, False, False]


def test_self_errors(spark):
    rows = [(["call API.Host.io"],), (["x"] * 7 + ["api.host.io"],), (["x"] * 8 + ["api.host.io"],), (None,)]
    got = ask(spark, "m array<string>", rows, s=privacy.is_self_error(F.col("m"), "api.host.IO"), n=privacy.is_self_error(F.col("m"), ""))
    assert [r["s"] for r in got] == [True, True, False, False]
    assert not any(r["n"] for r in got)


def test_sanitize_typed(spark):
    schema = T.StructType.fromDDL("b struct<s:string,d:double,f:float,t:timestamp,m:map<string,double>,l:array<double>,x:binary>")
    df = spark.sql(
        "select named_struct('s', repeat('x', 1074), 'd', double('NaN'), 'f', float('-Infinity'), 't', timestamp_millis(0), "
        "'m', map('a', 1.0D, 'b', double('Infinity')), 'l', array(1.0D, double('NaN')), 'x', binary('q')) as b"
    )
    kind = schema["b"].dataType
    out = df.select(values.sanitize(F.col("b"), kind).alias("b"), values.property_warnings(F.col("b"), kind).alias("w")).first()
    b = out["b"]
    assert len(b["s"]) == 1024 and b["s"].endswith("…")
    assert b["d"] is None and b["f"] is None
    assert b["t"] == "1970-01-01T00:00:00.000Z"
    assert b["m"] == {"a": 1.0} and b["l"] == [1.0, None] and b["x"] is None
    assert {(w["key"], w["kind"]) for w in out["w"]} == {
        ("s", "truncated_string"),
        ("d", "not_finite"),
        ("f", "not_finite"),
        ("b", "not_finite"),
        ("l[1]", "not_finite"),
        ("x", "non_serialisable"),
    }


def test_string_limit_is_exact(spark):
    got = ask(spark, "t string", [("x" * 1024,), ("x" * 1025,)], s=values.truncate_string(F.col("t")))
    assert got[0]["s"] == "x" * 1024 and got[1]["s"] == "x" * 1023 + "…"


def test_sanitize_json(spark):
    deep = '{"a":' * 37 + "1" + "}" * 37
    rows = [(deep,), ('{"d": NaN, "n": null, "l": [null, "' + "y" * 1100 + '"]}',), ("[1]",), (None,)]
    got = [r["s"] for r in ask(spark, "t string", rows, s=values.sanitize_json("t"))]
    assert "[depth-exceeded]" in got[0]["properties"] and got[0]["warnings"][0]["kind"] == "depth_exceeded"
    assert '"d"' not in got[1]["properties"] and '"n"' not in got[1]["properties"] and "[null, " in got[1]["properties"]
    assert [(w["key"], w["kind"]) for w in got[1]["warnings"]] == [("d", "not_finite"), ("l[1]", "truncated_string")]
    assert got[2]["properties"] == "{}" and got[3]["properties"] == "{}"


def test_wire_traits(spark):
    schema = "b map<string,double>"
    kind = T._parse_datatype_string("map<string,double>")
    got = ask(spark, schema, [({"a": 1.5, "b": None},), ({},), ({"a": float("nan")},), (None,)], t=values.wire_traits(F.col("b"), kind))
    assert [r["t"] for r in got] == [{"a": "1.5"}, None, None, None]


def test_device_label_page_cap(spark):
    got = ask(
        spark,
        "a string, b string",
        [("", "x"), (None, None)],
        d=values.device_payload(platform=F.lit("android"), sdk_int=F.lit(34), app_package=F.col("b")),
        l=values.resolve_label(F.col("a"), F.col("b"), F.lit("t"), F.lit(None), F.lit(None), F.lit(None)),
        p=values.page_key(F.col("a"), F.col("b"), F.lit("Home")),
        c=values.cap_text(F.lit("z" * 200)),
    )
    assert got[0]["d"] == {"platform": "android", "sdk_int": "34", "app_package": "x"} and got[1]["d"] == {"platform": "android", "sdk_int": "34"}
    assert [r["l"] for r in got] == ["x", "t"] and [r["p"] for r in got] == ["", "Home"] and len(got[0]["c"]) == 128


def test_outcomes(spark):
    cases = {200: "success", 299: "success", 300: "retryable", 400: "permanent", 408: "retryable", 429: "retryable", 499: "permanent", 500: "retryable", 199: "retryable", None: "retryable"}
    got = ask(spark, "s int", [(s,) for s in cases], o=wire.classify_outcome(F.col("s")))
    assert [r["o"] for r in got] == list(cases.values())


def test_error_envelope(spark):
    rows = [
        (400, '{"error":{"type":"invalid_request_error","code":"missing_event_name","message":"m","request_id":"req_abc"}}', "hdr"),
        (500, "<html>oops</html>", "req_header"),
        (418, "teapot", None),
        (400, '{"error":{"code":""}}', None),
        (503, '{"error":{"type":"api_error"}}', None),
        (500, '{"error":{"type":"unknown_error"}}', None),
        (401, '{"error":"text"}', None),
        (404, None, None),
        (429, '{"error":{"type":"martian"}}', None),
    ]
    got = [r["e"] for r in ask(spark, "s int, b string, h string", rows, e=wire.decode_error_envelope(F.col("s"), F.col("b"), F.col("h")))]
    assert [(e["type"], e["code"], e["request_id"]) for e in got] == [
        ("invalid_request_error", "missing_event_name", "req_abc"),
        ("internal_error", "server_error", "req_header"),
        ("internal_error", "http_418", None),
        ("internal_error", "bad_request", None),
        ("api_error", "server_error", None),
        ("unknown_error", "server_error", None),
        ("authentication_error", "unauthorized", None),
        ("internal_error", "not_found", None),
        ("internal_error", "rate_limited", None),
    ]
    assert got[2]["message"] == "Request failed with HTTP 418."


def test_retry_after(spark):
    rows = [("9223372036854775807",), ("30",), ("0",), ("-5",), ("garbage",), ("",), (None,), (" 7 ",), ("Thu, 01 Jan 1970 00:00:20 GMT",), ("Thu, 01 Jan 1970 00:00:01 GMT",)]
    got = ask(spark, "v string", rows, w=wire.parse_retry_after(F.col("v"), F.lit(5000)))
    assert [r["w"] for r in got] == [None, 30000, 0, None, None, None, None, 7000, 15000, 0]


def test_retry_ceiling(spark):
    def at(n, after=None, **policy):
        return wire.retry_ceiling(F.lit(n), F.lit(after).cast("bigint"), **policy)

    got = ask(
        spark,
        "x int",
        [(1,)],
        capped=at(15, base_ms=100, max_ms=5000, max_attempts=20),
        after=at(0, 60_000, max_ms=5000),
        ceiling=at(0, 2**63 - 1),
        first=at(0),
        fourth=at(4),
        spent=at(5),
        zero=at(1, 0),
    )[0]
    assert got == {"capped": 5000, "after": 60_000, "ceiling": 86_400_000, "first": 1000, "fourth": 16_000, "spent": None, "zero": 2000}


def test_idempotency_key(spark):
    rows = [("apple", "jws.1", None), ("google", None, "tok"), ("apple", "shared", "shared"), ("google", "shared", "shared"), ("stripe", "a", "b"), ("apple", None, "x"), ("google", "x", ""), ("apple", "", None)]
    got = [r["k"] for r in ask(spark, "r string, j string, t string", rows, k=wire.idempotency_key(F.col("r"), F.col("j"), F.col("t"), "acme"))]

    def expected(rail, identifier):
        h = hashlib.sha256(f"acme:purchases/sync:{rail}:{identifier}".encode()).hexdigest()
        return f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:32]}"

    assert got[:4] == [expected("apple", "jws.1"), expected("google", "tok"), expected("apple", "shared"), expected("google", "shared")]
    assert got[2] != got[3] and got[4:] == [None] * 4
    uuid = ask(spark, "h string", [("0123456789abcdef" * 3,)], u=wire.format_as_uuid(F.col("h")))[0]["u"]
    assert uuid == "01234567-89ab-cdef-0123-456789abcdef"


def test_user_slot(spark):
    got = ask(spark, "u string", [("abc",), ("",), (None,)], s=wire.user_slot(F.col("u")))
    assert [r["s"] for r in got] == ["ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad", "_anon", "_anon"]


def test_hosts(spark):
    rows = [("https://API.Example.COM/v1",), ("not a url",), (None,), ("mailto:x@y.io",)]
    got = ask(spark, "u string", rows, h=urls.host_of(F.col("u")), s=urls.is_self_request(F.col("u"), "api.EXAMPLE.com"), n=urls.is_self_request(F.col("u"), ""))
    assert [r["h"] for r in got] == ["api.example.com", None, None, None]
    assert [r["s"] for r in got] == [True, False, False, False] and not any(r["n"] for r in got)


def test_attribution(spark):
    rows = [
        ("app://open.me/a%20b+c?UTM_Source=x%26y&utm_medium=&utm_term=one+two&gclid=1&gclid=2&other=3&fbclid",),
        ("mailto:x@y.io?utm_source=z",),
        ("https://h.io",),
    ]
    got = [r["a"] for r in ask(spark, "u string", rows, a=urls.extract_attribution(F.col("u")))]
    first = {k: v for k, v in got[0].items() if v is not None}
    assert first == {"url": rows[0][0], "host": "open.me", "path": "/a b+c", "utm_source": "x&y", "utm_term": "one two", "gclid": "1"}
    assert {k for k, v in got[1].items() if v is not None} == {"url"}
    assert got[2]["path"] is None and got[2]["host"] == "h.io"


def test_deep_link_and_push(spark):
    got = ask(
        spark,
        "u string, a string, d map<string,string>",
        [("https://h.io/p?gclid=7", "", {"campaignId": "c", "type": "", "title": "t"}), (None, "view", {"trackId": "t"})],
        link=urls.deep_link_properties(F.col("u"), F.lit("mail"), F.col("a"), F.lit("com.x")),
        push=urls.project_push(F.col("d")),
        tap=urls.project_push(F.col("d"), F.lit("open")),
    )
    assert got[0]["link"] == {"url": "https://h.io/p?gclid=7", "host": "h.io", "path": "/p", "gclid": "7", "package": "com.x", "source": "mail"}
    assert got[1]["link"] is None
    assert got[0]["push"] == {"campaignId": "c"} and got[1]["tap"] == {"trackId": "t", "actionId": "open"}


FRAMES = "f array<struct<className:string,methodName:string,fileName:string,lineNumber:int>>"


def test_parse_stack_and_fingerprint(spark):
    rows = [
        ([("com.acme.Foo", "doIt", "Foo.kt", 12), ("Bar", "topLevel", None, -1), ("a.Outer$Inner", "m", None, 0)],),
        ([("", "m", None, 1), ("c.C", "", None, 1), ("c.C", "ok", None, 1)],),
        ([],),
        ([(f"p.C{i}", "m", None, i) for i in range(8)],),
    ]
    parsed = stacks.parse_stack(F.col("f"))
    got = ask(spark, FRAMES, rows, p=parsed, two=stacks.fingerprint(parsed, F.lit("T"), 2), five=stacks.fingerprint(parsed, F.lit("T")))
    assert [(f["module"], f["symbol"], f["frame_number"], f["line_number"]) for f in got[0]["p"]] == [
        ("com.acme", "Foo.doIt", 0, 12),
        ("<default>", "Bar.topLevel", 1, None),
        ("a", "Outer$Inner.m", 2, 0),
    ]
    assert [f["frame_number"] for f in got[1]["p"]] == [2]
    assert got[2]["five"] == "T:no_stack" and got[0]["two"] == "com.acme:Foo.doIt|<default>:Bar.topLevel"
    assert got[3]["five"].count("|") == 4 and "C5" not in got[3]["five"]


def test_parse_stack_text(spark):
    text = "java.lang.Error: x\n\tat com.acme.Foo.doIt(Foo.kt:12)\n\tat java.lang.Thread.run(Native Method)\n... 3 more"
    got = ask(spark, "t string", [(text,)], f=stacks.parse_stack_text(F.col("t")))[0]["f"]
    assert [(f["className"], f["methodName"], f["fileName"], f["lineNumber"]) for f in got] == [
        ("com.acme.Foo", "doIt", "Foo.kt", 12),
        ("java.lang.Thread", "run", "Native Method", None),
    ]


@pytest.mark.parametrize(
    ("key", "env", "app", "name", "code"),
    [
        ("pub_live_1", "production", "a", "n", None),
        ("pub_test_1", "sandbox", "a", "n", None),
        ("sk_1", "sandbox", "", "", "invalid_secret_key"),
        (None, "sandbox", "a", "n", "invalid_secret_key"),
        ("pub_live_1", "sandbox", "", "", "env_mismatch"),
        ("pub_1", "sandbox", "", "", "missing_app_id"),
        ("pub_1", "sandbox", "a", "", "missing_event_name"),
        ("pub_1", "sandbox", "a", None, "missing_event_name"),
    ],
)
def test_ingest_gate(spark, key, env, app, name, code):
    got = ask(spark, "k string, e string, a string, n string", [(key, env, app, name)], c=gates.ingest_gate(*map(F.col, "kean")))
    assert got[0]["c"] == code


def test_framework_screens(spark):
    rows = [("androidx.X",), ("android.X",), ("com.android.X",), ("a.ComposeActivity$Default",), ("a.ComposeActivity",), ("a.$Default",), (None,)]
    got = ask(spark, "s string", rows, f=gates.is_framework_screen(F.col("s")))
    assert [r["f"] for r in got] == [True, True, True, True, False, False, False]


def test_lock_schema(spark):
    assert not set(gates.FAILURE_REQUIRED) & set(gates.FAILURE_OPTIONAL)
    rows = [({**{k: "v" for k in gates.FAILURE_REQUIRED}, "ip": "1"},), ({"ip": "1"},), ({"run_id": "r"},)]
    got = [r["l"] for r in ask(spark, "p map<string,string>", rows, l=gates.lock_schema(F.col("p")))]
    assert set(got[0]["payload"]) == set(gates.FAILURE_REQUIRED) and got[0]["missing"] == [] and got[0]["refused"] == ["ip"]
    assert got[1]["payload"] is None and len(got[1]["missing"]) == 6
    assert "run_id" not in got[2]["missing"] and len(got[2]["missing"]) == 5
