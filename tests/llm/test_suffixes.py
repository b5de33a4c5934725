import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import suffixes


def brute(rows):
    data = [(t or "").encode() for _, t, *_ in rows]
    seen = Counter(d[p : p + 200] for d in data for p in range(len(d) - 199))
    out = []
    for (i, *_), d in zip(rows, data, strict=True):
        covered = bytearray(len(d))
        for p in range(len(d) - 199):
            if seen[d[p : p + 200]] > 1:
                covered[p : p + 200] = b"\1" * 200
        edges = sum(a != b for a, b in zip(b"\0" + bytes(covered), bytes(covered) + b"\0", strict=True))
        kept = bytes(x for x, c in zip(d, covered, strict=True) if not c)
        out.append((i, len(d), sum(covered), edges // 2, hashlib.sha256(kept).hexdigest()))
    return out


def texts(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefé", k=rng.randint(2, 9)))
    base = [" ".join(word() for _ in range(rng.randint(40, 250))) for _ in range(14)]
    passage = base[0][:230]
    out = [None, "", "short", "a" * 700, "ab" * 150, base[0], base[0]]
    for k, b in enumerate(base):
        words = b.split(" ")
        for _ in range(k % 4):
            words[rng.randrange(len(words))] = word()
        out += [" ".join(words), b, b[:150] + passage + b[200:], b[7:206], b[7:207]]
    return out


def test_removed_bytes_match_brute_force(spark):
    rows = [(i, t, "clash") for i, t in enumerate(texts())] + [(None, texts()[5], "x"), (3, "a" * 700, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string").repartition(4)
    got = [tuple(r)[:5] for r in suffixes.remove_repeats(df, with_kept=True).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_windows_of_heavy_keys_and_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "KEY_CONTEXTS", 1)
    rows = [(i, t) for i, t in enumerate(texts(7))]
    got = [tuple(r) for r in suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == sorted(brute(rows))


def test_pieces_of_long_texts_have_the_same_windows(monkeypatch):
    data = np.random.default_rng(3).integers(0, 4, 5000).astype(np.uint8)
    with np.errstate(over="ignore"):
        whole = suffixes.anchors(data)
        monkeypatch.setattr(suffixes, "_PIECE", 777)
        pieces = suffixes.anchors(data)
    for found in (whole, pieces):
        assert np.array_equal(np.concatenate([np.arange(s, s + n) for s, n in zip(found[1], found[2], strict=True)]), np.arange(4801))
    owner = [np.repeat(found[0], found[2]) for found in (whole, pieces)]
    assert np.array_equal(*owner)


def test_merged_order_is_that_of_all_suffixes(monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 256, 900).astype(np.uint8).tobytes()
    texts = [base[a : a + 200 + n] for a, n in [(0, 60), (10, 0), (300, 90), (301, 140), (500, 199), (500, 150), (0, 20)]]
    many = np.array([0, 0, 0, 1, 0, 0, 0])
    seen = Counter()
    for t, m in zip(texts, many, strict=True):
        for p in range(len(t) - 199):
            seen[t[p : p + 200]] += 1 + m
    want = [seen[t[p : p + 200]] > 1 for t in texts for p in range(len(t) - 199)]
    for shards, size in [(2, 1 << 16), (3, 100), (7, 1), (8, 1)]:
        monkeypatch.setattr(suffixes, "SHARDS", shards)
        monkeypatch.setattr(suffixes, "SHARD_BYTES", size)
        with np.errstate(over="ignore"):
            assert suffixes.repeated_windows(texts, many).tolist() == want


def groups_of(spark, monkeypatch, number):
    """The sizes of what meets at one place when many documents share a passage in surroundings of their own."""
    monkeypatch.setattr(suffixes, "KEY_CONTEXTS", 20)
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    passage = " ".join(word() for _ in range(38))[:260]
    rows = [(i, " ".join(word() for _ in range(30)) + passage + " ".join(word() for _ in range(30))) for i in range(number)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).selectExpr("doc_id", "text _text", "xxhash64(text) _name")
    anchors = suffixes.packed_anchors(df, 8)
    marks = suffixes.marks_of(anchors)
    wanted = marks.filter("octet_length(sent) > 0").groupBy("name").agg(F.collect_list("sent").alias("sent"))
    dealt = suffixes.contexts_of(df.join(wanted, df["_name"] == wanted["name"]).select("name", "_text", "sent").coalesce(4), 1000)
    windows = dealt.filter("octet_length(context) = 200").groupBy(F.md5("context")).count().agg(F.max("count")).first()[0]
    # Each place of the passage is found all the same, with the letters beside it that others share by chance.
    found = [tuple(r) for r in suffixes.remove_repeats(df.selectExpr("doc_id", "_text text")).collect()]
    assert sorted(found) == sorted(brute(rows))
    return windows, dealt.filter("full is not null").count()


def test_what_meets_of_a_shared_passage_grows_with_tasks_and_not_with_documents(spark, monkeypatch):
    # At most one row of each of four tasks.
    for number in (150, 600):
        largest, decided = groups_of(spark, monkeypatch, number)
        assert largest <= 4 and decided >= number - 4


def test_equal_contexts_across_small_batches(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "COMBINED_ANCHORS", 5)
    monkeypatch.setattr(suffixes, "COMBINED_WINDOWS", 7)
    for most in (1, 4096):
        monkeypatch.setattr(suffixes, "KEY_CONTEXTS", most)
        rows = [(i, t) for i, t in enumerate(texts(11) + texts(12)[5:])]
        got = [tuple(r) for r in suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()]
        assert sorted(got) == sorted(brute(rows))


def test_many_empty_and_short_texts_and_null_ids(spark):
    rows = [(None, None), (None, ""), (None, "short"), (1, "short"), *[(i, "") for i in range(50)]]
    got = [tuple(r) for r in suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_no_rows(spark):
    assert suffixes.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_only_contexts_that_may_share_a_window_are_merged(monkeypatch):
    rng = random.Random(11)
    letters = lambda n: "".join(rng.choices("abcdefghij ", k=n))
    lines, passage = [letters(120) for _ in range(8)], letters(260)
    texts = ["".join(letters(150) + line for line in lines).encode() for _ in range(40)] + [(letters(90) + passage + letters(90)).encode() for _ in range(3)]
    rows, by_key = [], {}
    with np.errstate(over="ignore"):
        for i, text in enumerate(texts):
            for key, start, n in zip(*suffixes.anchors(np.frombuffer(text, dtype=np.uint8)), strict=True):
                by_key.setdefault(int(key), []).append((i, int(start), 0, text[start : start + n + 199], None))
    rows = [r for found in by_key.values() if len(found) > 1 for r in found]
    kinds = {"name": pa.int64(), "start": pa.int64(), "many": pa.int8(), "context": pa.binary(), "full": pa.binary()}
    given = []
    plain = suffixes.repeated_windows
    monkeypatch.setattr(suffixes, "repeated_windows", lambda texts, many: given.append(sum(map(len, texts))) or plain(texts, many))
    told = suffixes.merged(pa.table([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds.values())], names=list(kinds)))
    seen = Counter(r[3][p : p + 200] for r in rows for p in range(len(r[3]) - 199))
    want = {(r[0], r[1] + p) for r in rows for p in range(len(r[3]) - 199) if seen[r[3][p : p + 200]] > 1}
    pairs = [(name, np.frombuffer(runs, dtype="<u4").reshape(-1, 2)) for name, runs in zip(told["name"].to_pylist(), told["full"].to_pylist(), strict=True)]
    assert {(name, s + p) for name, runs in pairs for s, n in runs.tolist() for p in range(n)} == want and len(want) >= 3 * 61
    # The lines are too short to hold a window, so their contexts have nothing to be merged with.
    assert sum(given) < sum(len(r[3]) for r in rows) / 4


def test_anchors_of_many_texts_are_those_of_each(monkeypatch):
    rng = np.random.default_rng(8)
    texts = [rng.integers(0, 3, n).astype(np.uint8).tobytes() for n in (200, 201, 900, 200, 5000, 399, 20000, 250)] + [b"a" * 700, b"a" * 200]
    with np.errstate(over="ignore"):
        want = [suffixes.anchors(np.frombuffer(t, dtype=np.uint8)) for t in texts]
        for together, piece in [(1, 777), (6000, 8 << 20), (6000, 500), (1 << 20, 8 << 20)]:
            monkeypatch.setattr(suffixes, "_TOGETHER", together)
            monkeypatch.setattr(suffixes, "_PIECE", piece)
            for a, b, text in zip(want, suffixes.anchors_of([pa.py_buffer(t) for t in texts]), texts, strict=True):
                for found in (a, b):
                    assert int(found[2].sum()) == len(text) - 199
                assert np.array_equal(np.repeat(a[0], a[2]), np.repeat(b[0], b[2])) and np.array_equal(np.cumsum(b[2])[:-1], b[1][1:])


def test_rolling_hashes_of_equal_bytes_are_equal_across_blocks():
    data = np.random.default_rng(2).integers(0, 2, 40_000).astype(np.uint8)
    data[30_000:30_300] = data[100:400]
    with np.errstate(over="ignore"):
        for size in (1, 32, 200):
            h = suffixes.rolling(data, size)
            assert len(h) == len(data) - size + 1 and np.array_equal(h[30_000 : 30_301 - size], h[100 : 401 - size])
        assert len(suffixes.rolling(data[:10], 32)) == 0
