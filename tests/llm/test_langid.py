import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import langid

WORDS = {"aa": ["the", "thing", "other", "that"], "bb": ["que", "leau", "ouvre", "dès"], "cc": ["über", "schlich", "ung", "der"]}


def corpus(n, seed=1):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choices(WORDS[lang], k=rng.randint(3, 60))), lang) for i in range(n) for lang in [rng.choice(list(WORDS))]]


def test_learned_languages_are_found_in_unseen_rows(spark):
    rows = corpus(300) + [(1000, None, "aa"), (1001, "", None), (1002, "12 !? 34", "bb"), (1003, "the thing " * 60000, None), (None, "que leau", "bb"), (5, "the", "aa")]
    df = spark.createDataFrame([(*r, "clash", 1.5) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double").repartition(3)
    got = langid.identify_languages(df, F.col("doc_id") % 4 != 2).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None and r["doc_id"] >= 6}
    assert all(0 <= r["score"] <= 1 for r in got)
    unseen = [(i, lang) for i, _, lang in rows[:300] if i % 4 == 2 and i >= 6]
    assert sum(by_id[i]["lang_pred"] == lang for i, lang in unseen) >= 0.95 * len(unseen)
    assert [by_id[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3
    assert by_id[1000]["rejected"] and by_id[1003]["lang_pred"] == "aa"


def test_without_labels_or_rows(spark):
    df = spark.createDataFrame([(1, "the", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in langid.identify_languages(df, F.lit(True)).collect()] == ["und"]
    assert langid.identify_languages(df.limit(0), F.lit(True)).collect() == []


def test_frequencies_of_equal_texts_are_equal_wherever_they_stand():
    texts = ["", "Über den", "12", "x" * 5000, "über DEN", "que"]
    x = langid.frequencies(texts)
    assert np.array_equal(x[1], x[4]) and x[0].sum() == 0 and x[2].sum() == 0
    for i, t in enumerate(texts):
        assert np.allclose(langid.frequencies([t])[0], x[i])
