import itertools
import random

import numpy as np

from tidemark.llm import toxicity

CLEAN = [a + b for a in ("tho", "an", "ere", "sti", "wha", "lor") for b in ("nd", "ing", "es", "ly", "tion")]
BAD = ["grubworm", "snarkle", "blightface"]


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = rng.choices(CLEAN, k=rng.randint(5, 80))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", "s", ",", "."]))
        out.append((i, " ".join(words), int(toxic)))
    return out


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    starts = np.array([0, 5, 5, 6, 13])
    e, trans, first = rng.normal(size=13), rng.normal(size=(2, 2)), 0.3
    got = toxicity.marginal_logits(e, starts, trans, first)
    pairs = toxicity.pair_marginals(e, starts, trans, first, np.array([3]))[0]
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        mass = np.zeros((b - a, 2))
        both = np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=int(b - a)):
            w = np.exp(sum(e[a + k] * v for k, v in enumerate(y)) + sum(trans[p, q] for p, q in zip(y, y[1:], strict=False)) + (first * y[0] if y else 0))
            for k, v in enumerate(y):
                mass[k, v] += w
            if a == 0 and len(y) == 5:
                both[y[2], y[3]] += w
        assert np.allclose(got[a:b], np.log(mass[:, 1] / mass[:, 0]) if b > a else [])
        if a == 0 and b == 5:
            assert np.allclose(pairs, both / both.sum())


def test_toxic_documents_and_offsets_in_unseen_rows(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "clash") for i, t, _ in rows] + [(900, None, "x"), (901, "", "x"), (902, "tho " * 40000 + "you grubworm", "x"), (None, "Grubworm!", "x")], "doc_id long, text string, spans string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None), (5, 0)], "doc_id long, toxic int")
    field = toxicity.fit(df, labels, labels.doc_id % 5 != 0)
    got = {r["doc_id"]: r for r in toxicity.score_texts(df, field, drop=()).collect()}
    assert len(got) == len(rows) + 4
    unseen = [r for r in rows if r[0] % 5 == 0]
    assert sum(got[i]["predicted"] == y for i, _, y in unseen) >= 0.95 * len(unseen)
    assert got[900]["predicted"] == got[901]["predicted"] == 0 and got[900]["spans"] == []
    assert got[902]["predicted"] == 1 and got[None]["predicted"] == 1
    span = got[902]["spans"][-1]
    assert got[902]["text"][span["start"] : span["end"]] == "grubworm"
    kept = toxicity.drop_toxic(df, labels)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if not r["predicted"]}


def test_long_labelled_texts_are_learned_from(spark):
    rng = random.Random(5)

    def long(bad):
        words = rng.choices(CLEAN, k=3000)
        for _ in range(4 if bad else 0):
            # Beyond the first 6,000 code points.
            words.insert(rng.randrange(2000, 3000), bad + rng.choice(["", "s", ","]))
        return " ".join(words)

    rows = [(i, long("grubworm"), 1) if i % 4 == 0 else (i, long("") if i % 4 == 1 else " ".join(rng.choices(CLEAN, k=50)), 0) for i in range(160)]
    df = spark.createDataFrame([r[:2] for r in rows] + [(900, None)], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(900, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score_texts(df, toxicity.fit(df, labels, labels.doc_id % 5 != 0)).collect()}
    unseen = [r for r in rows if r[0] % 5 == 0]
    assert sum(got[i] == y for i, _, y in unseen) >= 0.95 * len(unseen)
    assert {r["doc_id"] for r in toxicity.drop_toxic(df, labels).collect()} == {i for i, p in got.items() if not p}


def test_without_both_classes_or_rows(spark):
    df = spark.createDataFrame([(1, "grubworm")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert [r["score"] for r in toxicity.score_texts(df, toxicity.fit(df, labels)).collect()] == [0.0]
    assert toxicity.score_texts(df.limit(0), toxicity.fit(df.limit(0), labels)).collect() == []
