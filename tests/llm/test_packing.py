import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tidemark.llm import packing


def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def texts():
    rng = random.Random(9)
    words = ["the", "thing", " ", "  ", "\n", "é", "<|endoftext|>", "12345", "!!", "'ll", "你好", "a" * 30, "​"]
    return [None, "", "short", "short", "x" * 9000, "word " * 7000, *(" ".join(rng.choices(words, k=rng.randint(0, 900))) for _ in range(60))]


def test_every_id_lies_in_one_piece_and_sequences_have_no_gaps(spark):
    tokenizer = library()
    rows = [(i, t, "x", 0) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string, length int").repartition(3)
    got = packing.pack(df, with_ids=True).collect()
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        ids = np.array(r["ids"], dtype="<u4")
        assert r["length"] == len(ids) > 0 and r["ids_crc32"] == zlib.crc32(ids.tobytes())
    assert len(by_doc) == len(rows)
    for i, t, *_ in rows:
        want = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        pieces = sorted(by_doc[i], key=lambda r: r["start"])
        assert [x for r in pieces for x in r["ids"]] == want
        assert all(r["doc_tokens"] == len(want) for r in pieces)
        assert [r["start"] for r in pieces] == np.cumsum([0, *(r["length"] for r in pieces)])[:-1].tolist()
    padding = 0
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in pieces] == np.cumsum([0, *(r["length"] for r in pieces)])[:-1].tolist()
        total = sum(r["length"] for r in pieces)
        assert total <= packing.CAPACITY
        padding += 0 if total & (total - 1) == 0 else packing.CAPACITY - total
    assert padding <= 0.02 * sum(r["length"] for r in got)


def test_nulls_repeated_rows_and_no_rows(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None)], "doc_id long, text string")
    assert sorted(str(r["doc_id"]) for r in packing.pack(df).collect() if r["start"] == 0) == ["1", "None", "None"]
    assert packing.pack(df.limit(0)).collect() == []


def test_rank_file_gives_the_library_s_ids():
    tokenizer, encode = library(), packing.public_encoder()
    some = [t for t in texts() if t]
    assert encode(some) == [tokenizer.encode(t, add_special_tokens=False).ids for t in some]


def test_very_long_white_space_gives_the_library_s_ids(spark):
    tokenizer = library()
    long = ["a" + " " * 2_000_000 + "b", "\n" * 1_100_000, "x " * 60_000 + "\u2003 \t" * 400_000 + "<|endoftext|> y", " " * 100_000 + "z", "b " * 100_000]
    got = packing.pack(spark.createDataFrame(list(enumerate(long)), "doc_id long, text string"), with_ids=True).collect()
    for i, t in enumerate(long):
        pieces = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["start"])
        assert [x for r in pieces for x in r["ids"]] == [*tokenizer.encode(t, add_special_tokens=False).ids, 0]


def test_cuts():
    for n in range(1, 3000):
        pieces = packing.cuts(n)
        assert sum(pieces) == n and all(0 < p <= 1024 for p in pieces)
        assert all(packing.CAPACITY % p == 0 or p <= packing.TAIL for p in pieces)
