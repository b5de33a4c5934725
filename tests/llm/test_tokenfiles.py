import random
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidemark.llm import bpe, tokenfiles
from tidemark.llm.common import table

SF = "/root/testdata/sf0.01"


def library(texts):
    tokenizer = Tokenizer.from_file(bpe.public_path())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, tokenfiles.END_ID] for t in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_whole_table_against_the_library(spark):
    rows = sorted(tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect())
    want, start = [], 0
    for (doc_id, _), ids in zip(rows, library([t for _, t in rows]), strict=True):
        want.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    got = tokenfiles.op12_token_files(spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(tuple(r) for r in got.collect()) == want


@pytest.mark.parametrize(("file_ids", "file_docs", "width"), [(40, 1000, 2), (10**6, 7, 4)])
def test_odd_rows_many_files_and_ids_read_back(spark, tmp_path, file_ids, file_docs, width):
    rng = random.Random(5)
    texts = [None, "", " \n", "one", "one", "a b c", "é漢字 <|endoftext|>", "word " * 30_000, "x" * 4000]
    rows = [(rng.choice([None, -(2**63), 2**63 - 1, *range(-9, 30)]), rng.choice(texts), "c", 1) for _ in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, file string, part long").repartition(6)
    path = f"file://{tmp_path}/ids"
    files = tokenfiles.write_token_files(df, path, file_ids=file_ids, file_docs=file_docs, width=width)
    got = tokenfiles.read_token_files(files, path, with_ids=True).orderBy("start").collect()
    coded = library([r[1] for r in rows])
    def shown(rows):
        return sorted(rows, key=str)

    assert shown((r["doc_id"], r["ids"]) for r in got) == shown((r[0], ids) for r, ids in zip(rows, coded, strict=True))
    assert all(r["n_tokens"] == len(r["ids"]) and r["ids_crc32"] == crc(r["ids"]) for r in got)
    keys = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in got]
    assert keys == sorted(keys)
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1].tolist()]
    held = files.collect()
    assert len(held) > 10 and all(f["n_docs"] <= file_docs and (f["n_ids"] <= file_ids or f["n_docs"] == 1) for f in held)


def test_text_ids_and_no_rows(spark, tmp_path):
    rows = [(k, t) for k, t in (("b", "x y"), ("", "z"), (None, "q"), ("é", "w"), ("a" * 300, None), ("b", "x y"))]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    files = tokenfiles.write_token_files(df, f"{tmp_path}/a", file_docs=4)
    got = tokenfiles.read_token_files(files, f"{tmp_path}/a", id_type=T.StringType()).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, "", "a" * 300, "b", "b", "é"]
    none = tokenfiles.write_token_files(df.limit(0), f"{tmp_path}/b")
    assert none.collect() == [] and tokenfiles.read_token_files(none, f"{tmp_path}/b").collect() == []


def test_rows_that_are_alike_share_the_ranges_they_start(spark, tmp_path):
    rows = [(7, "same words")] * 400 + [(k, f"t{k}") for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    files = tokenfiles.write_token_files(df, f"{tmp_path}/a")
    got = tokenfiles.read_token_files(files, f"{tmp_path}/a").orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted(k for k, _ in rows)
    assert max(f["n_docs"] for f in files.collect()) < 300


def test_ids_beyond_the_width_are_refused(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    with pytest.raises(ValueError, match="more than 2 bytes"):
        tokenfiles.write_token_files(df, f"{tmp_path}/a", end_id=70_000)
    with pytest.raises(ValueError, match="more than 1 bytes"):
        tokenfiles.PackedEncoder(bpe.public_path(), 1)


def test_kept_words_are_bounded(monkeypatch):
    monkeypatch.setattr(tokenfiles.PackedEncoder, "KEPT", 5)
    encode = tokenfiles.PackedEncoder(bpe.public_path(), 4)
    texts = ["a b c d e f g a b", "", "a\tb\x0bc\x0cd\re\x1b\x00f", "x\x1cy\x85z\u2028w\xa0v", "it's 12 o'clock, isn't it?! " * 40, "Größe <|endoftext|>", "漢字"]
    assert [np.frombuffer(encode(t), "<u4").tolist() for t in texts] == [ids[:-1] for ids in library(texts)]
    assert len(encode.strings) <= 5 and len(encode.strings.older) <= 5


def test_select_and_size_of_coded_sequences():
    rng = np.random.default_rng(1)
    cases = [[0], [5], [2**64 - 1], [0, 0, 0], [0, 2**63], range(5000), [7] * 3000, np.cumsum(rng.integers(0, 3000, 40_000))]
    cases += [np.sort(rng.integers(0, 2**40, 700)), np.cumsum(rng.integers(0, 2, 9000))]
    for values in cases:
        values = np.array(list(values), dtype=np.uint64)
        data = b"head" + tokenfiles.EliasFano.of(values).to_bytes()
        held, end = tokenfiles.EliasFano.from_bytes(data, 4)
        assert end == len(data) and (held[np.arange(len(values))] == values).all()
        some = rng.integers(0, len(values), 50)
        assert (held[some] == values[some]).all()
        n, last = len(values), int(values[-1])
        assert 8 * len(data) <= n * (3 + max(0, np.log2((last + 1) / n))) + 2 * tokenfiles.BLOCK_BITS + 8 * 28
    assert len(tokenfiles.EliasFano.of(np.zeros(0))[np.zeros(0)]) == 0
