import hashlib
import random
import re

import pytest
from pyspark.sql import types as T

from tidemark.llm import pii

SCHEMA = "doc_id long, text string, spans string, base int"
RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    values = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def brute(text):
    out = []
    for no, (kind, rule) in enumerate(RULES.items()):
        for m in re.finditer(rule, text, re.ASCII):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), no, m.end(), kind))
    return sorted(out)


def as_text(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)


def texts():
    rng = random.Random(5)
    parts = ["a@b.cd", "a@b.cd_e@f.g", "x@y@z.w", "..", ".", "@", "+", "+1 (222) 333-4444", "4111 1111 1111 1111", "4111-1111-1111-1111", " ", "  ", "-", "1.2.3.4", "256.1.1.1", "0001.2.3.255", ".5.6.7.8", "é", "\U0001f600", "12", "7", "()", "\n", "word", "_", "%", "+49.30.123456", "00000000000000"]
    made = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(400)]
    return [None, "", "é" * 50 + " 10.0.0.1", "1 " * 5000, "a." * 5000 + "@b.c", "x@" + "a." * 9000 + "z", "1.2.3.4 " * 700, *made]


def test_base_spans_match_the_rules(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    got = {r["doc_id"]: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        want = brute(t or "")
        r = got[i]
        assert r["base_sha256"] == hashlib.sha256(as_text(want).encode()).hexdigest(), t
        assert [r[f"n_{k}"] for k in RULES] == [sum(s[3] == k for s in want) for k in RULES]


def test_contexts_find_unseen_identifiers_only_where_they_are_confident(spark):
    seeds = [(i, f"word the card no. {4000000000000000 + 0} then") for i in range(1)]
    cards = ["4111111111111111", "5500005555555559", "340000000000009"]
    rows = [(i, f"pay with card-no: {c} today") for i, c in enumerate(cards)]
    rows += [(10, "pay with card-no: QX-77120934 today"), (11, "again QX-77120934 in the list"), (12, "the number 123456 of the list"), (13, "list of the 99999")]
    got = {r["doc_id"]: r["spans"] for r in pii.personal_data(spark.createDataFrame(seeds + [(i + 100, t) for i, t in rows], "doc_id long, text string")).collect()}
    assert got[110] == "identifier:18:29"
    assert got[111] == "identifier:6:17"
    assert got[112] == got[113] == ""


def contact_rows(tail):
    """A pattern that thirty known entities follow, and what else follows it."""
    return [(i, f"note {i}: please reach-at: u{i}@mail.example now") for i in range(30)] + [(100 + i, t) for i, t in enumerate(tail)]


def test_short_and_plain_identifiers_are_found_after_confident_patterns(spark):
    tail = ["please reach-at: @janedoe now", "please reach-at: jane123 now", "please reach-at: root@localhost now", "please reach-at: jane12345 now"]
    tail += ["please  reach-at:" + " " * 170 + "jane99999 now", "x" * 5000 + " reach-at: bob7", "reach-at: 2 times"]
    # A token that mostly stands elsewhere is found where the pattern is and nowhere else.
    tail += [f"in {i} parts of 2 things" for i in range(5)]
    got = {r["doc_id"]: r["spans"] for r in pii.personal_data(spark.createDataFrame(contact_rows(tail), "doc_id long, text string").repartition(4)).collect()}
    assert [got[100 + i] for i in range(4)] == ["identifier:17:25", "identifier:17:24", "identifier:17:31", "identifier:17:26"]
    assert got[104] == "identifier:187:196"
    assert got[105] == "identifier:5011:5015"
    assert got[106] == "identifier:10:11"
    assert all(got[107 + i] == "" for i in range(5))


def test_rounds_go_on_until_nothing_is_fresh(spark):
    # A step's tokens stand after its own pattern and the next one's, which they alone vouch for; seven in ten must be known.
    rows = [(i, f"reach-at: u{i}@mail.example end") for i in range(100)]
    for step, n in enumerate([40, 17, 7, 3]):
        here = "reach-at:" if step == 0 else f"tag{'abcd'[step]}:"
        rows += [(1000 + 100 * step + i, f"{here} id{step}x{i} end") for i in range(n)]
        if step < 3:
            rows += [(2000 + 100 * step + i, f"tag{'abcd'[step + 1]}: id{step}x{i} end") for i in range(n)]
    got = {r["doc_id"]: r["spans"] for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert all(got[i].startswith("identifier:") for i, _ in rows if i >= 1000)


def test_both_forms_of_counting_patterns_agree(spark, monkeypatch):
    df = spark.createDataFrame(contact_rows(["please reach-at: jane123 now"]), "doc_id long, text string").repartition(4)
    want = sorted(map(tuple, pii.personal_data(df).collect()))
    monkeypatch.setattr(pii, "BROADCAST_PATTERNS", 0)
    assert sorted(map(tuple, pii.personal_data(df).collect())) == want


def test_ties_repeated_rows_nulls_and_other_columns(spark):
    rows = [(1, "a@b.cd", 1), (1, "a@b.cd", 2), (None, None, 3), (None, "call +1 222 333 4444", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    got = sorted((r["doc_id"] or 0, r["spans"]) for r in pii.personal_data(df).collect())
    assert got == [(0, ""), (0, "phone:5:20"), (1, "email:0:6"), (1, "email:0:6")]


def test_no_rows(spark):
    assert pii.personal_data(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("text,want", [("", ""), (None, None), ("mail a@b.cd, 10.0.0.1!", "mail <email>, <ip>!"), ("é a@1.2.3.4 z", "é <email> z")])
def test_redact(spark, text, want):
    df = spark.createDataFrame([(1, text, 7)], T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("base", T.IntegerType())]))
    row = pii.redact(df).collect()[0]
    assert (row["text"], row["base"]) == (want, 7)


def test_many_spans_in_one_text(spark):
    import time

    n = 20_000
    addresses = [f"10.{i // 65536}.{i // 256 % 256}.{i % 256}" for i in range(n)]
    text = "host " + " x ".join(addresses) + " end"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    begun = time.time()
    row = pii.personal_data(df).first()
    assert row["n_ip"] == n and row["base_sha256"] == hashlib.sha256(as_text(brute(text)).encode()).hexdigest()
    assert pii.redact(df).first()["text"] == "host " + " x ".join(["<ip>"] * n) + " end"
    # Quadratic work took more than this for so many.
    assert time.time() - begun < 90


def test_redaction_of_overlapping_spans_in_blocks(spark):
    rows = [(i, t) for i, t in enumerate(texts())]

    def plain(text):
        out, at = [], 0
        for start, _, end, kind in brute(text):
            if start >= at:
                out += [text[at:start], f"<{kind}>"]
            at = max(at, end)
        return "".join(out) + text[at:]

    got = {r["doc_id"]: r["text"] for r in pii.redact(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()}
    assert got == {i: None if t is None else plain(t) for i, t in rows}
