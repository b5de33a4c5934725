"""The contract registry: a JSON document of promises and the tests that hold them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .parse import with_json

# The registry's vocabularies.
PILLARS = ("revenue", "entitlements", "analytics", "webhooks", "errors", "lifecycle", "identity")
STATUSES = ("enforced", "proposed", "retired")

SCHEMA = (
    "sdkVersion string, bundledIn string, contracts array<struct<id:string,pillar:string,status:string,claim:string,"
    "appliesTo:array<string>,codeRef:array<string>,testRef:array<struct<file:string,name:string>>,"
    "registeredAt:string,firstRegisteredIn:string,bundledIn:string>>"
)


def contract_rows(registries: DataFrame) -> DataFrame:
    """One row per contract. A pillar or status outside the vocabulary is an error, not a row to drop."""
    rows = registries.select("sdkVersion", F.explode("contracts").alias("c")).select(
        F.col("sdkVersion").alias("sdk_version"),
        "c.id",
        "c.pillar",
        "c.status",
        "c.claim",
        F.col("c.appliesTo").alias("applies_to"),
        F.col("c.codeRef").alias("code_ref"),
        F.col("c.testRef").alias("test_ref"),
        F.col("c.registeredAt").alias("registered_at"),
        F.col("c.firstRegisteredIn").alias("first_registered_in"),
        F.col("c.bundledIn").alias("bundled_in"),
    )
    known = F.col("pillar").isin(*PILLARS) & F.col("status").isin(*STATUSES)
    unknown = F.raise_error(F.concat(F.lit("unknown pillar or status in contract "), F.col("id"))).cast("string")
    return rows.withColumn("pillar", F.when(known, F.col("pillar")).otherwise(unknown))


def contract_test_refs(contracts: DataFrame) -> DataFrame:
    """One row per contract and test reference."""
    return contracts.select("id", F.explode("test_ref").alias("t")).select(
        F.col("id").alias("contract_id"), F.col("t.file").alias("test_file"), F.col("t.name").alias("test_name")
    )


def parse_contract_registry(docs: DataFrame, body: str = "value") -> DataFrame:
    """Contracts from registry documents held as text, one per row."""
    return contract_rows(with_json(docs.select(F.col(body).alias("__body")), "__body", SCHEMA))


def read_contract_registry(spark: SparkSession, path: str) -> DataFrame:
    return contract_rows(spark.read.schema(SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(path))
