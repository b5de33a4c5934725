import hashlib
import re
from collections import defaultdict

from tidemark.llm import exact

SCHEMA = "doc_id long, text string, kept string, digest int"


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[normal(t)].append(i)
    out = []
    for i, t, *_ in rows:
        ids = [x for x in groups[normal(t)] if x is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, len(groups[normal(t)]), hashlib.sha256(normal(t).encode()).hexdigest()))
    return out


def rows():
    texts = ["a  b", "a b", " a b", "a\tb\n", "", None, " ", "é b", "a\xa0b", "long " * 20000]
    made = [(k * 3 % 41, texts[k % len(texts)], "x", 1) for k in range(40)]
    # A third of all rows is one text; some ids and whole rows repeat, some ids are missing.
    return made + [(100 + k, "hot text", "x", 1) for k in range(25)] + [(7, "twice", "x", 1)] * 3 + [(None, "twice", "x", 1), (None, "alone", "x", 1), (None, "alone", "y", 2)]


def test_groups_match_brute_force_whatever_is_frequent(spark):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(4)
    want = sorted(brute(rows()), key=str)
    for counters in (1, 3, 1000):
        got = exact.exact_groups(df, counters=counters).collect()
        assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=str) == want
        kept = [r for r in got if r["kept"]]
        assert sorted(r["text_sha256"] for r in kept) == sorted({w[3] for w in want})
        assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_drop_copies_keeps_one_whole_row_of_each_text(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    for counters in (2, 1000):
        got = exact.drop_copies(df, counters=counters).collect()
        assert sorted(normal(r["text"]) for r in got) == sorted({normal(t) for _, t, *_ in rows()})
        best = {normal(t): k for _, t, k in ((i, t, k) for (i, t, *_), (_, k, *_) in zip(rows(), brute(rows()), strict=True))}
        assert all(r["doc_id"] == best[normal(r["text"])] for r in got)
        assert got[0].__fields__ == ["doc_id", "text", "kept", "digest"]


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact.exact_groups(empty).collect() == []
    assert exact.drop_copies(empty).collect() == []
