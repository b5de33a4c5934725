import hashlib
import random

from pyspark.sql import functions as F

from tidemark.llm import syncmers


def texts(n=60, seed=2):
    rng = random.Random(seed)
    words = ["the", "Thing", "é", "over", "and", "x" * 40, "\U0001f600"]
    made = [" ".join(rng.choices(words + [str(rng.random()) for _ in range(30)], k=rng.randint(0, 200))) for _ in range(n)]
    return [*made, None, "", " \n", "one", "one two three four", made[3], made[3], "same " * 3000]


def brute_next(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    return {r: order[(k + 1) % len(order)] for k, r in enumerate(order)}


def test_edited_texts_follow_the_order_of_ids(spark, monkeypatch):
    monkeypatch.setattr(syncmers, "RANGES", 7)
    monkeypatch.setattr(syncmers, "ROWS", 5)
    rows = [(k * 37 % 1009 + (0 if k % 3 else 10_000_000), t) for k, t in enumerate(texts())] + [(None, "no id")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, fingerprint string").repartition(5)
    got = {r["doc_id"]: r for r in syncmers.edited_neighbours(df).collect()}
    assert len(got) == len(rows)
    after = brute_next(rows)
    prints = {}
    for i, t in rows:
        t, other = t or "", after[(i, t)][1] or ""
        r = got[i]
        edited = t[: len(t) - len(t) // 2] + other[: len(t) // 2]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert prints.setdefault(t, r["fingerprint"]) == r["fingerprint"]
    assert len(set(prints.values())) >= len(prints) - 2


def test_single_row_follows_itself_and_no_rows(spark):
    df = spark.createDataFrame([(5, "a b c d e f g h")], "doc_id long, text string")
    assert [r["near_next"] for r in syncmers.edited_neighbours(df).collect()] == [1.0]
    assert syncmers.edited_neighbours(df.limit(0)).collect() == []


def test_anchors_depend_on_their_own_words_alone(spark):
    rng = random.Random(4)
    shared = " ".join(str(rng.random()) for _ in range(300))
    rows = [(1, "some words first " * 7 + shared), (2, shared + " others after"), (3, "nothing alike " * 100)]
    df = syncmers.with_anchors(spark.createDataFrame(rows, "doc_id long, text string"), "text", "anchors")
    sets = {r["doc_id"]: {(a["hash"]) for a in r["anchors"]} for r in df.collect()}
    places = {r["doc_id"]: {a["hash"]: a["position"] for a in r["anchors"]} for r in df.collect()}
    common = sets[1] & sets[2]
    # Half of the 296 five-word strings are chosen, about, and none is lost.
    assert len(common) >= 100 and sets[2] - sets[1] <= {h for h, p in places[2].items() if p >= 296}
    assert {places[1][h] - places[2][h] for h in common} == {21}
    assert not sets[3] & sets[1]


def test_likeness_is_near_the_jaccard_similarity_of_all_anchors(spark):
    rng = random.Random(6)
    base = [str(rng.random()) for _ in range(1200)]
    rows = [(k, " ".join(base), " ".join(base[: 1200 - 100 * k] + [str(rng.random()) for _ in range(100 * k)])) for k in range(12)]
    df = spark.createDataFrame(rows, "k long, a string, b string")
    for side in "ab":
        df = syncmers.with_anchors(df, side, f"x{side}").withColumn(f"s{side}", syncmers.sketch(f"x{side}"))
    got = df.select("k", syncmers.likeness("sa", "sb").alias("near"), (F.size(F.array_intersect("xa.hash", "xb.hash")) / F.size(F.array_union("xa.hash", "xb.hash"))).alias("true")).collect()
    assert all(abs(r["near"] - r["true"]) < 0.15 for r in got)
    assert got[0]["near"] == 1.0


def test_fingerprints_of_long_texts_hold_every_anchor_and_shared_passages_count(spark):
    rng = random.Random(7)
    passage = " ".join(str(rng.random()) for _ in range(40))
    far, near = (" ".join(str(rng.random()) for _ in range(n)) for n in (8000, 8000))
    rows = [(2, far + " " + passage), (1, passage + " " + near)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {r["doc_id"]: [f"{a['position']}:{a['hash']}" for a in r["anchors"]] for r in syncmers.with_anchors(df, "text", "anchors").collect()}
    assert all(len(x) > 3000 for x in want.values())
    assert {r["doc_id"]: r["fingerprint"].split(",") for r in syncmers.fingerprints(df).collect()} == want

    def parts(anchors):
        pairs = [tuple(map(int, a.split(":"))) for a in anchors]
        return {h for _, h in pairs} | {(h, g, q - p) for (p, h), (q, g) in zip(pairs, pairs[1:], strict=False)}

    two, one = parts(want[2]), parts(want[1])
    for r in syncmers.edited_neighbours(df).collect():
        assert r["fingerprint"].split(",") == want[r["doc_id"]]
        assert 0 < r["near_next"] == len(two & one) / len(two | one)
        mine = two if r["doc_id"] == 2 else one
        edited = parts(r["edited_fingerprint"].split(","))
        assert r["near_edited"] == len(mine & edited) / len(mine | edited)
