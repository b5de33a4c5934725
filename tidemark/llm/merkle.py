"""Merkle manifest of a dataset: a tree of digests for each group, and a tree of their roots.

Time-forward processing. A node is labelled so that it comes after its children,
and a priority queue ordered by label delivers the digest of a child to its
parent. The queue is external: leaves and the roots of lower blocks are messages
in a table that Spark partitions by block and sorts, on disk where needed, and a
task reads them in the order of their labels, holding only the messages of one
block of 2^12 nodes besides. A round of blocks turns n nodes into n / 2^12, so a
tree of 2^36 leaves takes three. The reversed sweep goes through the same
rounds from the top: what a block's root owes to its leaves, the digests beside
the path above it, is one more message, which sorts before the block's nodes;
inside the block a queue by falling label hands the growing suffix down to each
leaf. A leaf there has all that proves it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_type, discard, table, written

#: Levels of a block of a tree.
LEVELS = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree of the groups' roots has no group; a group's name starts with "+", that of the null group is empty.
_TOP = "-"


def framed(values: list[Column]) -> Column:
    """Values one after another, each as its UTF-8 byte count, a colon and itself; null is a dash."""
    texts = [v.cast("string") for v in values]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def digest(values: list[Column]) -> Column:
    """SHA-256 of the framed values, as bytes."""
    return F.unhex(F.sha2(framed(values), 256))


def node(children: list[bytes]) -> bytes:
    """The digest above a run of children, whose digests go in as hexadecimal text."""
    return hashlib.sha256("".join([c.hex() for c in children]).encode()).digest()


def height(nodes: int) -> int:
    """Levels above the leaves of a tree of so many."""
    return max(nodes - 1, 0).bit_length()


def label(level: int, place: int, nodes: int) -> tuple[int, int]:
    """The last leaf below the node, then its level: after all that is below it."""
    return min((place + 1) << level, nodes) - 1, level


def forward(leaves: list[bytes], levels: int) -> dict[tuple[int, int], bytes]:
    """Digests of all nodes over a block's leaves up to ``levels``, by (level, place).

    The queue holds messages (label of the receiver, place of the sender, digest).
    """
    n = len(leaves)
    done = {(0, k): d for k, d in enumerate(leaves)}
    if levels == 0:
        return done
    queue = [(label(1, k >> 1, n), k, d) for k, d in enumerate(leaves)]
    heapify(queue)
    while queue:
        to, sender, first = heappop(queue)
        children = [first]
        while queue and queue[0][0] == to:
            children.append(heappop(queue)[2])
        level, place = to[1], sender >> 1
        made = done[level, place] = node(children)
        if level < levels:
            heappush(queue, (label(level + 1, place >> 1, n), place, made))
    return done


#: A proof is a chain of cells (digest beside, whether it stands to the right, the rest), from a leaf up. A node
#: alone in its run has nothing beside it, which is an empty digest.
Cell = tuple


def backward(done: dict[tuple[int, int], bytes], n: int, levels: int, above: Cell | None) -> list[Cell | None]:
    """The proof of each leaf, delivered from the block's root, whose own is ``above``, in falling order of labels."""
    found: list[Cell | None] = [None] * n
    queue = [((-(n - 1), -levels), 0, above)]
    while queue:
        (_, level), place, suffix = heappop(queue)
        level = -level
        if level == 0:
            found[place] = suffix
            continue
        for child in (2 * place, 2 * place + 1):
            if (level - 1, child) not in done:
                continue
            beside = done.get((level - 1, child ^ 1), b"")
            last, _ = label(level - 1, child, n)
            heappush(queue, ((-last, 1 - level), child, (beside, bool(beside) and child % 2 == 0, suffix)))
    return found


def cells(proof: Cell | None) -> Iterator[tuple[bytes, bool]]:
    while proof is not None:
        yield proof[0], proof[1]
        proof = proof[2]


def pack_proof(proof: Cell | None) -> bytes:
    """33 bytes a cell: 0 for left, 1 for right or 2 for nothing beside, and the digest."""
    return b"".join([(b"\1" if right else b"\0") + d if d else bytes([2]) + bytes(32) for d, right in cells(proof)])


def unpack_proof(packed: bytes) -> Cell | None:
    proof = None
    for at in range(len(packed) - 33, -1, -33):
        proof = (packed[at + 1 : at + 33] if packed[at] < 2 else b"", packed[at] == 1, proof)
    return proof


def fold(leaf: bytes, proof: Cell | None) -> bytes:
    """The root that a leaf and its proof lead to."""
    for beside, right in cells(proof):
        leaf = node([leaf] if not beside else [leaf, beside] if right else [beside, leaf])
    return leaf


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their place by ``order`` in their ``_tree`` and its total, from sorted ranges of all trees together.

    No range holds a whole tree but by size, and equal rows fall into several.
    """
    keys = ["_tree", *order, "_tie"]
    ranges = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    held = written(ranges.drop("_tie").withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)))
    # A row for each range and tree in it: at most the ranges and the trees together.
    counts = held.groupBy("_tree", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    tree = Window.partitionBy("_tree")
    before = F.coalesce(F.sum("_n").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_tree", "_part", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(tree).alias("total"))
    return held.join(offsets, ["_tree", "_part"]).withColumn("place", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def queued(messages: DataFrame, rises: int) -> DataFrame:
    """Messages of one block in one partition, by block, then what comes from above, then place."""
    block = F.shiftright("place", rises)
    return messages.repartition(F.col("_tree"), block).sortWithinPartitions("_tree", block, F.col("proof").isNull(), "place")


def blocks(batches: Iterator[pa.RecordBatch], rises: int) -> Iterator[list[dict]]:
    """The messages of each block, from a sorted stream of all."""
    held: list[dict] = []
    at = None
    for batch in batches:
        for row in batch.to_pylist():
            key = row["_tree"], row["place"] >> rises
            if key != at and held:
                yield held
                held = []
            at = key
            held.append(row)
    if held:
        yield held


def levels_of(total: int, rises: int) -> int:
    """Levels that a block of a tree of ``total`` nodes rises by in a round."""
    return min(rises, height(total))


def rise(nodes: DataFrame, rises: int) -> DataFrame:
    """One round up: the roots of all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches, rises):
            first, levels = rows[0], levels_of(rows[0]["total"], rises)
            root = forward([r["digest"] for r in rows], levels)[levels, 0]
            total = -(-first["total"] >> rises)
            yield pa.RecordBatch.from_pylist([{"_tree": first["_tree"], "place": first["place"] >> rises, "total": total, "digest": root}], schema=up)

    up = pa.schema([("_tree", pa.string()), ("place", pa.int64()), ("total", pa.int64()), ("digest", pa.binary())])
    sent = nodes.select("_tree", "place", "total", "digest", F.lit(None).cast("binary").alias("proof"))
    return queued(sent, rises).mapInArrow(run, "_tree string, place long, total long, digest binary")


def climb(leaves: DataFrame, rises: int) -> list[DataFrame]:
    """The nodes of all rounds, from the leaves to one root for each tree."""
    rounds = [leaves]
    while not rounds[-1].filter("total > 1").isEmpty():
        rounds.append(written(rise(rounds[-1], rises)))
    return rounds


_FROM_ABOVE = ("proof", "subroot", "root")


def descend(nodes: DataFrame, above: DataFrame, rises: int) -> DataFrame:
    """One round down: ``nodes`` with proof, subroot and root, from those of their blocks' roots in ``above``."""
    payload = [f for f in nodes.schema.fields if f.name not in ("_tree", "place", "total", "digest")]
    schema = T.StructType([*nodes.schema.fields, *[T.StructField(c, T.BinaryType()) for c in _FROM_ABOVE]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = None
        for batch_rows in blocks(seen(batches, found := []), rises):
            kinds = kinds or found[0]
            top, rows = batch_rows[0], batch_rows[1:]
            levels = levels_of(rows[0]["total"], rises)
            done = forward([r["digest"] for r in rows], levels)
            proofs = backward(done, len(rows), levels, unpack_proof(top["proof"]))
            for row, proof in zip(rows, proofs, strict=True):
                row |= {"proof": pack_proof(proof), "subroot": top["subroot"], "root": top["root"]}
            yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    def seen(batches: Iterator[pa.RecordBatch], found: list) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found.append(batch.schema)
            yield batch

    down = nodes.select("*", *[F.lit(None).cast("binary").alias(c) for c in _FROM_ABOVE])
    messages = above.select(
        "_tree",
        F.shiftleft("place", rises).alias("place"),
        *[F.lit(None).cast("long").alias("total"), F.lit(None).cast("binary").alias("digest")],
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in payload],
        *_FROM_ABOVE,
    )
    return queued(down.unionByName(messages), rises).select(schema.names).mapInArrow(run, schema)


def manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    fields: tuple[str, ...] = FIELDS,
    claimed: dict[str, Column] | None = None,
    proofs: bool = False,
    rises: int = LEVELS,
) -> DataFrame:
    """One row per row: ``id_col``, leaf, subroot, root, proof_sha256, folded_root, verified (and proof, if asked for).

    A leaf is the digest of ``fields``; a group's leaves ascend by id (null ids
    first, rows of one id by their leaf), groups by name (the null group first).
    ``claimed`` gives values of fields as someone else holds them; folded_root is
    what those rows and the stored proof lead to, and verified whether that is
    the root. A proof lists the digests beside the path from the leaf to the
    root, null where a node has none beside it, and the side they stand on.
    ``rises`` is the number of levels of a block; it changes no result.

    Repeated rows are leaves each for itself. Null and empty values differ, in
    fields and as groups. Texts are hashed whole where they are read, and only
    digests move. No rows give no rows. Other columns are ignored.
    """
    own = [F.col(f"`{c}`") for c in fields]
    other = [(claimed or {}).get(c, F.col(f"`{c}`")) for c in fields]
    same = F.lit(True)
    for a, b in zip(own, other, strict=True):
        same = same & a.eqNullSafe(b)
    group = F.col(f"`{group_col}`").cast("string")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("+"), group), F.lit("")).alias("_tree"),
        F.col(f"`{id_col}`").alias("_id"),
        digest(own).alias("digest"),
        F.when(~same, digest(other)).alias("claim") if claimed else F.lit(None).cast("binary").alias("claim"),
    )
    rounds = climb(placed(leaves, ["_id", "digest"]), rises)
    subroots = rounds[-1].select(F.lit(_TOP).alias("_tree"), F.col("_tree").alias("group"), "digest")
    tops = climb(placed(subroots, ["group"]), rises)
    above = tops[-1].select("_tree", "place", F.lit(b"").alias("proof"), F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root"))
    for nodes in reversed(tops):
        above = written(descend(nodes, above, rises))
    above = written(above.select(F.col("group").alias("_tree"), F.lit(0).cast("long").alias("place"), "proof", F.col("digest").alias("subroot"), "root"))
    for nodes in reversed(rounds[1:]):
        above = written(descend(nodes, above, rises).select("_tree", "place", *_FROM_ABOVE))
    for nodes in [*rounds[1:], *tops[1:]]:
        discard(nodes)
    return proved(descend(rounds[0], above, rises), id_col, docs.schema[id_col].dataType, proofs)


def proved(leaves: DataFrame, id_col: str, id_type: T.DataType, proofs: bool) -> DataFrame:
    """Fold each leaf's claim along its proof."""
    facts = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    schema = T.StructType([T.StructField(id_col, id_type), *T.StructType.fromDDL(facts).fields])
    if proofs:
        schema.add("proof", T.ArrayType(T.StructType.fromDDL("digest string, right boolean")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select(["claim", "digest", "subroot", "root", "proof"]).to_pylist()
            out: dict[str, list] = {n: [] for n in schema.names[1:]}
            for r in rows:
                proof = unpack_proof(r["proof"])
                folded = fold(r["claim"] or r["digest"], proof)
                beside = [(d.hex() or None, right) for d, right in cells(proof)]
                out["leaf"].append(r["digest"].hex())
                out["subroot"].append(r["subroot"].hex())
                out["root"].append(r["root"].hex())
                out["proof_sha256"].append(hashlib.sha256("".join([d for d, _ in beside if d]).encode()).hexdigest())
                out["folded_root"].append(folded.hex())
                out["verified"].append(folded == r["root"])
                if proofs:
                    out["proof"].append([{"digest": d, "right": right} for d, right in beside])
            arrays = [pa.array(v, arrow_type(schema[n].dataType)) for n, v in out.items()]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), *arrays], names=schema.names)

    return leaves.select("_id", "claim", "digest", "subroot", "root", "proof").mapInArrow(run, schema)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of documents, checked against rows of which one in seven ids claims one character more."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    docs = table(spark, sf_dir, "documents")
    return manifest(docs, claimed={"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})


#: Trees, proofs and folds level by level; CRC-32 from its table, as DuckDB has none.
ORACLE = r"""
WITH RECURSIVE steps(i, step, c) AS (
  SELECT i, 0, i::UBIGINT FROM range(256) t(i)
  UNION ALL SELECT i, step + 1, xor(c >> 1, (c & 1) * 3988292384::UBIGINT) FROM steps WHERE step < 8
), crcs AS (SELECT list(c ORDER BY i) AS byte_crc FROM steps WHERE step = 8),
claims AS (
  SELECT *, n_chars + CASE WHEN xor(list_reduce(
      list_concat([4294967295::UBIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::UBIGINT)),
      lambda c, b: xor(c >> 8, byte_crc[((xor(c, b) & 255) + 1)::BIGINT])), 4294967295::UBIGINT) % 7 = 0 THEN 1 ELSE 0 END AS claimed
  FROM documents, crcs
), leaves AS (
  SELECT doc_id, coalesce('+' || lang, '') AS tree, sha256(concat(head, coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-'), tail)) AS leaf,
         sha256(concat(head, coalesce(strlen(claimed::VARCHAR) || ':' || claimed, '-'), tail)) AS claim
  FROM (SELECT *, concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-')) AS head,
          coalesce(strlen(text) || ':' || text, '-') AS tail FROM claims)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves
), nodes(tree, level, place, digest, n) AS (
  SELECT tree, 0, place, leaf, count(*) OVER (PARTITION BY tree) FROM placed
  UNION ALL
  SELECT tree, level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (n + 1) // 2 FROM nodes WHERE n > 1 GROUP BY tree, level, place // 2, n
), subroots AS (
  SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place FROM nodes WHERE n = 1
), tops(level, place, digest, n) AS (
  SELECT 0, place, subroot, count(*) OVER () FROM subroots
  UNION ALL
  SELECT level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (n + 1) // 2 FROM tops WHERE n > 1 GROUP BY level, place // 2, n
), walks(row, tree, level, place, digest, proof) AS (
  SELECT row_number() OVER (), tree, 0, place, claim, '' FROM placed
  UNION ALL
  SELECT w.row, w.tree, w.level + 1, w.place // 2,
         sha256(CASE WHEN w.place % 2 = 0 THEN w.digest || coalesce(b.digest, '') ELSE b.digest || w.digest END), w.proof || coalesce(b.digest, '')
  FROM walks w JOIN nodes own ON own.tree = w.tree AND own.level = w.level AND own.place = w.place AND own.n > 1
  LEFT JOIN nodes b ON b.tree = w.tree AND b.level = w.level AND b.place = xor(w.place, 1)
), ends AS (SELECT row, tree, digest, proof FROM walks QUALIFY row_number() OVER (PARTITION BY row ORDER BY level DESC) = 1
), climbs(row, level, place, digest, proof) AS (
  SELECT row, 0, place, digest, proof FROM ends JOIN subroots USING (tree)
  UNION ALL
  SELECT w.row, w.level + 1, w.place // 2,
         sha256(CASE WHEN w.place % 2 = 0 THEN w.digest || coalesce(b.digest, '') ELSE b.digest || w.digest END), w.proof || coalesce(b.digest, '')
  FROM climbs w JOIN tops own ON own.level = w.level AND own.place = w.place AND own.n > 1
  LEFT JOIN tops b ON b.level = w.level AND b.place = xor(w.place, 1)
), folds AS (SELECT row, digest, proof FROM climbs QUALIFY row_number() OVER (PARTITION BY row ORDER BY level DESC) = 1
), numbered AS (SELECT row_number() OVER () AS row, * FROM placed)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folds.digest AS folded_root, folds.digest = root AS verified
FROM numbered JOIN subroots USING (tree) JOIN folds USING (row), (SELECT digest AS root FROM tops WHERE n = 1)
"""
