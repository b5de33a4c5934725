import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality

SUBJECTS = "the old man|a young dog|my neighbour|the tall tree|an honest clerk".split("|")
VERBS = "walks slowly along|looks out over|never forgets|often speaks of".split("|")
PLACES = "the quiet river bank|the market square|a house by the sea|the long winter road".split("|")


def prose(rng, n):
    return " ".join(f"{rng.choice(SUBJECTS)} {rng.choice(VERBS)} {rng.choice(PLACES)} ." for _ in range(n))


def junk(rng, n):
    return " ".join("".join(rng.choices("#$%&XQ9z", k=5)) for _ in range(n))


def brute(texts):
    """log P(word | two words before) by the recursion of interpolated modified Kneser-Ney, on words."""
    counts = {3: Counter()}
    for t in texts:
        w = ["<s>", "<s>", *t.split()]
        counts[3].update(zip(w, w[1:], w[2:]))
    for k in (2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    vocabulary = len(counts[1]) + 1
    off, total, mass = {}, {}, {}
    for k in (1, 2, 3):
        n = [sum(c == j for c in counts[k].values()) for j in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
        bound = lambda v, j: min(max(v, 0.1), j - 0.1)
        d = [bound(1 - 2 * y * n[1] / n[0], 1) if n[0] else 0.5, bound(2 - 3 * y * n[2] / n[1], 2) if n[1] else 1.0, bound(3 - 4 * y * n[3] / n[2], 3) if n[2] else 1.5]
        off[k] = {g: d[min(c, 3) - 1] for g, c in counts[k].items()}
        total[k], mass[k] = defaultdict(float), defaultdict(float)
        for g, c in counts[k].items():
            total[k][g[:-1]] += c
            mass[k][g[:-1]] += off[k][g]

    def p(gram):
        k = len(gram)
        if k == 0:
            return 1 / vocabulary
        below = p(gram[1:])
        context = gram[:-1]
        if context not in total[k]:
            return below
        return (counts[k].get(gram, 0) - off[k].get(gram, 0) + mass[k][context] * below) / total[k][context]

    return p


def brute_perplexity(p, text):
    w = ["<s>", "<s>", *text.split()]
    logs = [math.log(p(g)) for g in zip(w, w[1:], w[2:])]
    return math.exp(-sum(logs) / len(logs)) if logs else None


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randint(3, 12)), ["xx", "yy", None][i % 3]) for i in range(150)]
    rows += [(i, junk(rng, rng.randint(20, 300)), "xx") for i in range(500, 520)]
    rows += [(900, None, "xx"), (901, "", "zz"), (902, prose(rng, 3000), "zz"), (903, " \n\t", "xx"), (None, prose(rng, 30), "xx"), (7, rows[7][1], "xx"), (7, rows[7][1], "xx")]
    return rows, spark.createDataFrame([(*r, 0.5, "clash") for r in rows], "doc_id long, text string, lang string, perplexity double, _doc string").repartition(3)


def named(rows):
    return rows.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"), F.coalesce("text", F.lit("")).alias("_text")).withColumn("_doc", F.xxhash64("_id", "_text"))


def test_perplexity_matches_the_recursion(spark, docs, monkeypatch):
    rows, df = docs
    texts = [t for _, t, _ in rows[:60]]
    model = quality.fit(spark.createDataFrame([(t,) for t in texts], "t string").repartition(4))
    p = brute(texts)
    got = {r["_id"]: r["perplexity"] for r in quality.with_perplexity(named(df), model).collect()}
    model.discard()
    for i, t, _ in rows:
        want = brute_perplexity(p, t or "")
        assert got[i] == pytest.approx(want, rel=1e-4) if want else got[i] is None
    # Probabilities over all words and the unknown one sum to one, after seen, half seen and unseen contexts.
    words = sorted({w for t in texts for w in t.split()}) + ["never seen"]
    for context in (("the", "old"), ("river", "old"), ("no", "such"), ("<s>", "<s>")):
        assert sum(p((*context, w)) for w in words) == pytest.approx(1)


def test_long_texts_in_pieces_give_the_same(monkeypatch):
    text = prose(random.Random(1), 60)
    whole = list(quality.grams(text, quality.Names()))
    monkeypatch.setattr(quality, "PIECE", 7)
    parts = list(quality.grams(text, quality.Names()))
    assert len(whole) == 1 and len(parts) > 50
    for k in range(5):
        assert whole[0][k].tolist() == [x for part in parts for x in part[k].tolist()]


def test_word_order_counts(spark, docs):
    rows, df = docs
    rng = random.Random(5)
    model = quality.fit(spark.createDataFrame([(t,) for _, t, _ in rows[:60]], "t string"))
    pairs = []
    for i, t, lang in rows[60:150]:
        words = t.split()
        rng.shuffle(words)
        pairs += [(2 * i, t, lang), (2 * i + 1, " ".join(words), lang)]
    scored = quality.with_perplexity(named(spark.createDataFrame(pairs, "doc_id long, text string, lang string")), model)
    got = {r["_id"]: r["perplexity"] for r in scored.collect()}
    model.discard()
    assert all(got[2 * i + 1] > 3 * got[2 * i] for i, _, _ in rows[60:150])


def test_junk_goes_and_prose_stays(spark, docs):
    rows, df = docs
    trusted = spark.createDataFrame([(i,) for i in range(0, 150, 2)] + [(None,)], "doc_id long")
    got = quality.classify_quality(df, trusted).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    assert not any(by_id[i]["kept"] for i in [*range(500, 520), 900, 901, 903])
    assert by_id[902]["kept"] and by_id[None]["kept"] and by_id[900]["perplexity"] is None
    assert sum(by_id[i]["kept"] for i in range(150)) >= 140


def test_what_is_gathered_grows_with_the_trusted_text(spark):
    rng = random.Random(2)
    sizes = []
    for n in (20, 200):
        texts = [(" ".join(f"w{rng.randint(0, 10_000)}" for _ in range(50)),) for _ in range(n)]
        model = quality.fit(spark.createDataFrame(texts, "t string"))
        sizes.append(model.worth.count())
        model.discard()
    assert sizes[1] > 8 * sizes[0]


def test_without_trusted_documents_or_rows(spark, docs):
    _, df = docs
    nobody = spark.createDataFrame([], "doc_id long")
    assert all(r["kept"] for r in quality.classify_quality(df.filter("doc_id < 20"), nobody).collect())
    assert quality.classify_quality(df.limit(0), nobody).collect() == []


def folder_bytes(path):
    return sum(f.stat().st_size for f in path.rglob("*") if f.is_file())


def test_rounds_give_the_same_from_a_part_of_the_n_grams_each(spark, docs, monkeypatch):
    rows, df = docs
    texts = spark.createDataFrame([(t,) for _, t, _ in rows[:60]], "t string").repartition(4)
    whole = quality.fit(texts)
    monkeypatch.setattr(quality, "ROUND_BYTES", 8_000)
    model = quality.fit(texts)
    assert whole.rounds == 1 and model.rounds > 2
    parts = [model.part(k) for k in range(model.rounds)]
    sizes = [part.count() for part, _ in parts]
    assert sum(sizes) == whole.worth.count() and max(sizes) < sum(sizes) * 2 / 3
    p = brute([t for _, t, _ in rows[:60]])
    got = {r["_id"]: r["perplexity"] for r in quality.with_perplexity(named(df), model).collect()}
    for i, t, _ in rows:
        want = brute_perplexity(p, t or "")
        assert got[i] == pytest.approx(want, rel=1e-6) if want else got[i] is None
    assert spark.conf.get(quality._CLEANUP, None) in (None, "false")


def test_a_round_holds_a_part_of_the_disk(spark, monkeypatch, tmp_path):
    rng = random.Random(3)
    texts = [(i, " ".join(f"w{rng.randint(0, 50_000)}" for _ in range(300)), "xx") for i in range(600)]
    df = spark.createDataFrame(texts, "doc_id long, text string, lang string").repartition(4)
    kept = tmp_path / "kept"
    monkeypatch.setattr("tidemark.llm.common.checkpoint_dir", lambda _: str(kept))
    discard, most = quality.discard, {}
    for size in (1 << 30, 300_000):
        monkeypatch.setattr(quality, "ROUND_BYTES", size)
        model = quality.fit(df.select("text"))
        before, seen = folder_bytes(kept), []
        monkeypatch.setattr(quality, "discard", lambda one, b=before, s=seen: (s.append(folder_bytes(kept) - b), discard(one)))
        assert quality.with_perplexity(named(df), model).filter("perplexity > 0").count() == 600
        monkeypatch.setattr(quality, "discard", discard)
        most[model.rounds] = max(seen)
    (one, whole), (rounds, part) = sorted(most.items())
    assert one == 1 and rounds >= 4 and part < whole / 2


def test_words_are_named_alike_wherever_they_stand():
    names = quality.Names()
    found, start = names("\t\u00e9t\u00e9  a\x00 a \u00e9t\u00e9\n\u00a0 a\x00".encode())
    assert len(found) == 6 and start[0] == 1
    assert found[0] == found[3] and found[1] == found[5] and len(set(found.tolist())) == 4
    alone, _ = quality.Names()("\u00e9t\u00e9".encode())
    assert alone[0] == found[0] and len(names(b" \n")[0]) == 0
