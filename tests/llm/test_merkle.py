import hashlib
import random
import zlib

import duckdb
import pytest

from tidemark.llm import merkle
from tidemark.llm.common import table

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, digest string, place int, proof string, root string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    """Levels of digests, from the leaves to the root."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def path(levels, place):
    """(digest beside or None, stands right) from a leaf up."""
    out = []
    for level in levels[:-1]:
        beside = place ^ 1
        out.append((level[beside] if beside < len(level) else None, place % 2 == 0))
        place //= 2
    return out


def folded(leaf, proof):
    for beside, right in proof:
        leaf = h(leaf) if beside is None else h(leaf, beside) if right else h(beside, leaf)
    return leaf


def brute(rows, tampered):
    """rows: (doc_id, source, lang, n_chars, text). A sorted list of (doc_id, leaf, subroot, root, proof hash, folded, verified)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf_of(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda t: t[:3])
    trees = {g: tree([t[2] for t in groups[g]]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    root = top[-1][0]
    out = []
    for at, g in enumerate(names):
        above = path(top, at)
        for place, (_, _, leaf, r) in enumerate(groups[g]):
            proof = path(trees[g], place) + above
            claim = leaf
            if tampered(r) and r[3] is not None:
                claim = leaf_of((*r[:3], r[3] + 1, r[4]))
            end = folded(claim, proof)
            out.append((r[0], leaf, trees[g][-1][0], root, h(*[d for d, _ in proof if d]), end, end == root))
    return out


def seven(r):
    return r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0


def key(t):
    return tuple(str(x) for x in t)


def compared(got, want):
    got = [tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in got]
    assert sorted(got, key=key) == sorted(want, key=key)


ONE_MORE = "n_chars + if(crc32(cast(string(doc_id) as binary)) % 7 = 0, 1, 0)"


def test_query_against_recursion(spark):
    want = brute([tuple(r) for r in table(spark, SF, "documents").select(*merkle.FIELDS).collect()], seven)
    compared(merkle.op11_merkle_manifest(spark, SF).collect(), want)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    found = con.execute(merkle.ORACLE)
    names = [c[0] for c in found.description]
    compared([dict(zip(names, r, strict=True)) for r in found.fetchall()], want)
    assert {w[6] for w in want} == {True, False}


@pytest.mark.parametrize("rises", [1, 3])
def test_any_block_size_gives_the_same(spark, rises):
    rows = [(k * 3, f"s{k}", "de" if k % 3 else None, k if k % 5 else None, f"text {k}") for k in range(45)]
    docs = spark.createDataFrame(rows, SCHEMA.split(", digest")[0]).repartition(4)
    compared(merkle.manifest(docs, claimed={"n_chars": merkle.F.expr(ONE_MORE)}, rises=rises).collect(), brute(rows, seven))


def test_odd_rows_and_clashing_columns(spark):
    rng = random.Random(4)
    texts = [None, "", "a", "é" * 40, "x" * 3_000_000, "1:a", "-"]
    rows = [(rng.choice([None, *range(12)]), rng.choice([None, "", "s"]), rng.choice([None, "", "+", "-", "en", "é"]), rng.choice([None, 0, 5]), rng.choice(texts)) for _ in range(90)]
    rows += [(3, "s", "en", 1, "same")] * 9
    docs = spark.createDataFrame([(*r, "d", 1, "p", "r") for r in rows], SCHEMA).repartition(5)
    got = merkle.manifest(docs, claimed={"n_chars": merkle.F.expr(ONE_MORE)}, rises=4).collect()
    compared(got, brute(rows, seven))


def test_proofs_lead_to_the_root(spark):
    rows = [(k, "s", f"l{k % 3}", 1, f"t{k}") for k in range(21)]
    docs = spark.createDataFrame(rows, SCHEMA.split(", digest")[0])
    got = merkle.manifest(docs, proofs=True).collect()
    assert len(got) == 21 and all(r["verified"] and folded(r["leaf"], [tuple(c) for c in r["proof"]]) == r["root"] for r in got)
    ids = merkle.manifest(docs.selectExpr("concat('d', doc_id) as doc_id", "source", "lang", "n_chars", "text")).collect()
    assert len({r["leaf"] for r in ids}) == 21 and ids[0]["doc_id"].startswith("d")


def test_small_trees_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "s", "en", 1, "t")], SCHEMA.split(", digest")[0])
    (only,) = merkle.manifest(docs).collect()
    assert only["leaf"] == only["subroot"] == only["root"] == only["folded_root"] == leaf_of((1, "s", "en", 1, "t"))
    assert only["proof_sha256"] == h("") and only["verified"]
    assert merkle.manifest(docs.limit(0)).collect() == []


def test_queue_delivers_children_before_parents():
    for n in range(1, 40):
        leaves = [hashlib.sha256(bytes([k])).digest() for k in range(n)]
        want = tree([d.hex() for d in leaves])
        up = merkle.height(n)
        done = merkle.forward(leaves, up)
        assert [done[len(want) - 1, 0].hex()] == want[-1] and len(done) == sum(map(len, want))
        for place, proof in enumerate(merkle.backward(done, n, up, None)):
            assert merkle.unpack_proof(merkle.pack_proof(proof)) == proof
            assert merkle.fold(leaves[place], proof).hex() == want[-1][0]
