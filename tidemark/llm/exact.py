"""Exact deduplication with a heavy-hitter split.

Misra-Gries summaries find the digests that may be frequent; exact counts
verify them. The few winners are broadcast, so that the largest groups of
copies are resolved where their rows are and never meet in one task. All other
digests go through an ordinary shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_or_empty, written

#: Counters of a summary: at most this many digests, plus one, are broadcast.
COUNTERS = 1000


def normalised(text: str = "text"):
    return F.regexp_replace(text_or_empty(text), r"[\x20\x09-\x0D]+", " ")


def misra_gries(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Per-task Misra-Gries counts of the column ``digest``, summed over tasks.

    A task's count falls short of the truth by at most its rows / (counters + 1),
    so a digest of more than 2 n / (counters + 1) of n rows keeps a sum of at
    least n / (counters + 1), and at most ``counters`` + 1 digests can.
    """

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        for batch in batches:
            seen = batch.column(0).value_counts()
            for digest, n in zip(seen.field("values").to_pylist(), seen.field("counts").to_pylist(), strict=True):
                held[digest] = held.get(digest, 0) + n
            if len(held) > counters:
                # Taking off the (counters + 1)th largest count is that many decrements at once.
                cut = sorted(held.values(), reverse=True)[counters]
                held = {k: v - cut for k, v in held.items() if v > cut}
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["digest", "n"])

    return digests.select("digest").mapInArrow(summarise, "digest binary, n long").groupBy("digest").agg(F.sum("n").alias("n"))


def digest_groups(docs: DataFrame, id_col: str, text_col: str, counters: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The digest of every row, and the groups of equal digests: the few large ones, to be broadcast, and all others.

    A group has first (its smallest id, null ids last, and the number of that row) and group_size.
    """
    # A number for each row decides between rows of one id; it is fixed by writing it.
    rows = written(docs.select(F.col(f"`{id_col}`").alias("_id"), digest_of(text_col).alias("digest")).withColumn("_row", F.monotonically_increasing_id()))
    order = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    facts = [F.min(order).alias("first"), F.count(F.lit(1)).alias("group_size")]
    total = rows.count()
    frequent = misra_gries(rows, counters).filter(F.col("n") * (counters + 1) >= total).select("digest")
    # At most counters + 1 rows, by the bound above.
    winners = written(rows.join(F.broadcast(frequent), "digest", "left_semi").groupBy("digest").agg(*facts))
    others = rows.join(F.broadcast(winners), "digest", "left_anti").groupBy("digest").agg(*facts)
    return rows, winners, others


def digest_of(text_col: str):
    return F.unhex(F.sha2(normalised(text_col), 256))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per document: ``id_col``, keep_id, group_size, kept, text_sha256.

    Null texts count as empty. The row with the smallest id stays; rows without
    an id come after all others, and of rows with equal ids one stays, the first
    read. Other columns of ``docs`` are ignored. No rows give no rows.
    """
    rows, winners, others = digest_groups(docs, id_col, text_col, counters)
    marked = rows.join(F.broadcast(winners), "digest", "left")
    cold = marked.filter("first is null").select("_id", "digest", "_row").join(others, "digest")
    columns = ["_id", "digest", "_row", "first", "group_size"]
    out = marked.filter("first is not null").select(columns).unionByName(cold.select(columns))
    return out.select(
        F.col("_id").alias(id_col),
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("_row") == F.col("first.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """``docs`` without all but one row of each group of equal texts, as ``exact_groups`` chooses; of repeated rows with one id, any one stays.

    Copies of frequent texts are removed where they are read; only what is left is shuffled.
    """
    columns = docs.columns
    rows, winners, others = digest_groups(docs, id_col, text_col, counters)
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_doc"), F.col(f"`{id_col}`").alias("_id"), digest_of(text_col).alias("digest"))
    chosen = F.col("first").isNull() | F.col("_id").eqNullSafe(F.col("first.id"))
    one = held.join(F.broadcast(winners.select("digest", "first")), "digest", "left").filter(chosen).drop("first")
    one = one.join(others.filter("group_size > 1").select("digest", "first"), "digest", "left").filter(chosen).drop("first")
    again = rows.groupBy("digest", "_id").count().filter("count > 1").select("digest", F.lit(True).alias("_again")).distinct()
    if not again.isEmpty():
        flagged = one.join(again, "digest", "left")
        one = flagged.filter("_again is null").drop("_again").unionByName(flagged.filter("_again").drop("_again").dropDuplicates(["digest"]))
    return one.select(*[F.col(f"_doc.`{c}`").alias(c) for c in columns])


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256)
"""
