"""Document fingerprints from closed syncmers, in DataFrame expressions only.

Words are hashed in pairs; of each K words in a row, the K-mer is chosen when
the smallest of its pair hashes is the first or the last one. Whether a K-mer is
chosen depends on its own words alone, so a shared stretch of two texts has the
same anchors in both, whatever surrounds it, and at least one anchor in every
few words. A fingerprint holds all anchors with their positions, and likeness
compares all of them: the anchors, and each pair of neighbouring anchors with
their distance, which a shared stretch has at any offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, text_or_empty, written

#: Words of a K-mer; its inner substrings are pairs of words.
K = 5
#: Ranges of ids, at most; each range is sorted in one task. Beyond ROWS rows a range is cut into equal widths.
RANGES = 1024
ROWS = 20_000


def with_anchors(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``: array of (position, hash) of the closed syncmers of a text, in order.

    Words are what stands between ASCII white space, in lower case. A text of
    fewer than K words has one anchor, all its words; one without words none.
    """
    df = df.withColumn("_words", F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    n = F.size("_words")
    pairs = F.zip_with(F.slice("_words", 1, n - 1), F.slice("_words", 2, n - 1), lambda a, b: F.xxhash64(a, b))
    df = df.withColumn("_pairs", F.when(n >= K, pairs).otherwise(F.array().cast("array<bigint>")))

    def pair(i: Column, k: int) -> Column:
        return F.get("_pairs", i + k)

    def anchor(i: Column) -> Column:
        inner = F.least(*[pair(i, k) for k in range(1, K - 2)])
        whole = F.xxhash64(*[pair(i, k) for k in range(0, K - 1, 2)], pair(i, K - 2))
        return F.when(F.least(pair(i, 0), pair(i, K - 2)) <= inner, F.struct(i.alias("position"), whole.alias("hash")))

    long = F.filter(F.transform(F.sequence(F.lit(0), n - K), anchor), lambda x: x.isNotNull())
    short = F.array(F.struct(F.lit(0).alias("position"), F.xxhash64(F.array_join("_words", " ")).alias("hash")))
    none = F.array().cast("array<struct<position:int,hash:bigint>>")
    return df.withColumn(name, F.when(n >= K, long).when(n > 0, short).otherwise(none)).drop("_words", "_pairs")


def sketch(anchors: str) -> Column:
    """What is compared of all anchors, once each: their hashes, and hashes of neighbouring anchors with their distance."""
    following = F.greatest(F.size(anchors) - 1, F.lit(0))
    links = F.zip_with(F.slice(anchors, 1, following), F.slice(anchors, 2, following), lambda a, b: F.xxhash64(a["hash"], b["hash"], b["position"] - a["position"]))
    return F.array_distinct(F.concat(F.col(anchors)["hash"], links))


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two sketches, exactly. Two empty ones are alike, an empty and another are not."""
    both = F.size(F.array_intersect(a, b))
    shared = both / (F.size(a) + F.size(b) - both)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(shared)


def fingerprint_text(x: str) -> Column:
    """All anchors in order, as position:hash."""
    return F.array_join(F.transform(x, lambda a: F.concat_ws(":", a["position"].cast("string"), a["hash"].cast("string"))), ",")


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_id and _text of each row, with the text of the row that follows it by falling id, as _next.

    The first row follows the last. Rows of one id follow each other by their
    texts; rows without an id come last. Rows are dealt out by ranges of ids, and
    each range also gets the first row of the one after it, so that no row has to
    meet more than its range.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), text_or_empty(text_col).alias("_text"))
    ids = rows.select("_id")
    total, without = ids.agg(F.count(F.lit(1)), F.sum(F.col("_id").isNull().cast("long"))).first()
    ranges = max(1, min(RANGES, total // 50))
    cut = F.percentile_approx("_id", [q / ranges for q in range(1, ranges)], 10_000) if ranges > 1 else F.lit(None)
    bounds = sorted(set(ids.agg(cut).first()[0] or []))
    parts = max(1, total // (ranges * ROWS))
    lowest, highest = ids.agg(F.min("_id"), F.max("_id")).first()
    edges = F.array(*[F.lit(int(x)).cast("long") for x in [lowest or 0, *bounds, highest or 0]])
    # The range of an id, and the equal part of the range's width.
    no = F.size(F.filter(F.array(*[F.lit(int(x)).cast("long") for x in bounds]).cast("array<bigint>"), lambda b: b < F.col("_id")))
    low, high = F.get(edges, no).cast("double"), F.get(edges, no + 1).cast("double")
    part = F.least(F.lit(parts - 1), F.floor((F.col("_id").cast("double") - low) / (high - low + 1) * parts).cast("int"))
    idless = -1 - F.pmod(F.xxhash64("_text"), F.lit(max(1, (without or 0) // ROWS)))
    rows = rows.withColumn("_range", F.when(F.col("_id").isNull(), idless).otherwise(no * parts + F.greatest(part, F.lit(0))).cast("long"))

    # First rows of the ranges: at most one for each ROWS rows, and RANGES.
    first_ids = rows.groupBy("_range").agg(F.max("_id").alias("_first"))
    # In falling order of ranges, the one before gets it; the last range gets the first row of all.
    everywhere = Window.orderBy(F.desc("_range"))
    lowest_range = F.min("_range").over(Window.partitionBy())
    heirs = first_ids.select("_range", "_first", F.coalesce(F.lag("_range").over(everywhere), lowest_range).alias("_heir"))
    # Written, its size is known before the join, which then needs not move the texts while it is small.
    heirs = written(heirs)
    firsts = rows.join(heirs, "_range").filter(F.col("_id").eqNullSafe(F.col("_first"))).groupBy("_heir", "_id").agg(F.min("_text").alias("_text"))
    guests = firsts.select("_id", "_text", F.col("_heir").alias("_range"), F.lit(True).alias("_guest"))
    dealt = rows.withColumn("_guest", F.lit(False)).unionByName(guests).repartition(F.col("_range"))
    order = Window.partitionBy("_range").orderBy("_guest", F.desc_nulls_last("_id"), "_text")
    return dealt.withColumn("_next", F.lead("_text").over(order)).filter(~F.col("_guest")).drop("_range", "_guest")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col`` and fingerprint, all anchors as position:hash, in decimal, comma-joined.

    Null texts count as empty, with an empty fingerprint; other columns are
    ignored; equal texts have equal fingerprints; no rows give no rows.
    """
    rows = docs.select(F.col(id_col), text_or_empty(text_col).alias("_text"))
    return with_anchors(rows, "_text", "_anchors").select(id_col, fingerprint_text("_anchors").alias("fingerprint"))


def edited_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited form and of its neighbour compared.

    The edited form's last half (rounded down) is replaced by as many of the first
    code points of the row that follows by falling id, or all of them. A single
    row is followed by itself.
    """
    rows = with_next(docs, id_col, text_col).withColumn("n_chars", F.char_length("_text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("_text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("_next", F.lit(1), half))
    rows = rows.withColumn("_edited", edited)
    for side in ("_text", "_edited", "_next"):
        rows = with_anchors(rows, side, f"{side}_anchors").withColumn(f"{side}_sketch", sketch(f"{side}_anchors"))
    return rows.select(
        F.col("_id").alias(id_col),
        "n_chars",
        F.sha2("_edited", 256).alias("edited_sha256"),
        fingerprint_text("_text_anchors").alias("fingerprint"),
        fingerprint_text("_edited_anchors").alias("edited_fingerprint"),
        likeness("_text_sketch", "_edited_sketch").alias("near_edited"),
        likeness("_text_sketch", "_next_sketch").alias("near_next"),
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_neighbours(table(spark, sf_dir, "documents"))
