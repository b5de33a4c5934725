import math

import numpy as np
import pytest

from tidemark.llm import whitening

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>, key string, z int, many string"


def brute(vectors, weights="one"):
    """Whitened rows of equal-length vectors, signs as they come, and the facts of the contract."""
    x = np.floor(64 * np.array(vectors, dtype=float)).astype(np.int64) + 1_000_000
    held, counts = np.unique(x, axis=0, return_counts=True)
    w = np.ones(len(held), dtype=np.int64) if weights == "one" else counts
    n, s = int(w.sum()), (held * w[:, None]).sum(axis=0)
    centred = held - s / n
    cov = (centred * w[:, None]).T @ centred / n
    values, axes = np.linalg.eigh(cov)
    order = [i for i in np.argsort(values)[::-1] if values[i] > 1e-10 * values.max()][:16]
    z = (x - s / n) @ (axes[:, order] / np.sqrt(values[order]))
    away = [sum((n * int(v) - int(t)) ** 2 for v, t in zip(row, s, strict=True)) for row in x]
    return n, away, z, values[order] / np.trace(cov)


def compared(got, ids, want, zero=1e-6):
    n, away, z, explained = want
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], {})[r["component"]] = r
        assert r["n"] == n and r["identity_error"] <= 1e-4
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-6)
    assert sorted(by_id) == sorted(ids)
    signs = {}
    for place, key in enumerate(ids):
        assert sorted(by_id[key]) == list(range(1, z.shape[1] + 1))
        for c, r in by_id[key].items():
            assert r["deviation"] == away[place]
            value = z[place][c - 1]
            if abs(value) > 1e-3:
                sign = signs.setdefault(c, math.copysign(1, value * r["whitened"]))
                assert math.copysign(1, value * r["whitened"]) == sign
            assert abs(r["whitened"]) == pytest.approx(abs(value), abs=zero)


@pytest.mark.parametrize("weights", ["one", "count"])
def test_whole_table_against_numpy(spark, weights):
    df = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    rows = df.collect()
    again = df.withColumn("vec_id", df["vec_id"] + 100_000).filter("vec_id % 3 = 0 or vec_id = 100007")
    copies = again.collect()
    got = whitening.whiten(df.unionByName(again).repartition(5), weights=weights).collect()
    both = rows + copies
    compared(got, [r["vec_id"] for r in both], brute([r["embedding"] for r in both], weights))


def test_hot_vectors_and_cold_ones_meet_their_rows(spark, monkeypatch):
    rng = np.random.default_rng(3)
    some = rng.normal(size=(40, 5)).tolist()
    rows = [(i, some[0] if i % 3 == 0 else some[i % 40]) for i in range(300)]
    want = brute([v for _, v in rows])
    for hot in (1, 10, 10**9):
        monkeypatch.setattr(whitening, "HOT_ROWS", hot)
        got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4))
        compared(got.collect(), [i for i, _ in rows], want, 1e-5)


def test_odd_rows_are_dropped_or_defined(spark):
    nan, inf = float("nan"), float("inf")
    good = [[0.5, -1.25], [2.0, 0.03], [0.5, -1.25], [-7.7, 9.0]]
    odd = [None, [], [None, 1.0], [nan, 1.0], [1.0, inf], [-inf, 0.0], [1e300, 0.0], [1.0], [1.0, 2.0, 3.0]]
    rows = [(i, v, "k", 1, "m") for i, v in enumerate(good)] + [(100 + i, v, "k", 1, "m") for i, v in enumerate(odd)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    compared(got, [0, 1, 2, 3], brute(good))
    twice = spark.createDataFrame([(None, good[0]), (None, good[1]), (1, good[1])], "vec_id long, embedding array<double>")
    assert sorted(str(r["vec_id"]) for r in whitening.whiten(twice).collect()) == ["1", "None", "None"]


def test_no_rows_and_vectors_without_spread(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(empty).collect() == [] and whitening.whiten(empty).columns[:3] == ["vec_id", "component", "n"]
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert whitening.whiten(same).collect() == []
    # One direction only: one component.
    line = [[float(k), 2.0 * k] for k in range(10)]
    got = whitening.whiten(spark.createDataFrame(list(enumerate(line)), "vec_id long, embedding array<double>")).collect()
    compared(got, list(range(10)), brute(line))
    assert {r["component"] for r in got} == {1}


def test_large_entries_stay_exact(spark):
    rows = [[1e15, -3.0], [-2e15, 5.0], [7e15, 0.0]]
    got = whitening.whiten(spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")).collect()
    x = [[math.floor(64 * c) + 1_000_000 for c in r] for r in rows]
    s = [sum(c) for c in zip(*x, strict=True)]
    away = [sum((3 * c - t) ** 2 for c, t in zip(r, s, strict=True)) for r in x]
    assert all(r["deviation"] == (away[r["vec_id"]] if away[r["vec_id"]] < 1 << 63 else None) for r in got)
    assert got and {r["n"] for r in got} == {3}


def test_packed_rows_of_all_widths():
    import pyarrow as pa

    x = np.array([[0, -1], [32767, -32768], [32768, 0], [0, -32769], [1 << 40, -5], [-(1 << 31), (1 << 31) - 1], [1 << 31, 0]], dtype=np.int64)
    packed = whitening.pack(x)
    assert [p[0] for p in packed] == [2, 2, 4, 4, 8, 4, 8]
    assert (whitening.unpack(pa.array(packed, pa.binary())) == x).all()
