"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's documents. All but the last return
the columns of documents, whatever those are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact, jaccard, packing, pii, toxicity
from tidemark.llm.common import table, written


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the conditional random field rejects go; it learns from the labelled ones."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for white space, the one with the smallest id stays."""
    return exact.drop_copies(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of Jaccard similarity 0.75 on five words connect, the one with the smallest id stays."""
    return jaccard.drop_near_copies(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to the name of their kind; n_chars, where there is one, follows."""
    clean = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1,024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("exact_dedup", remove_copies),
    ("jaccard_join", remove_near_copies),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]
#: Models and tokenizers are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
