"""Contract failures against the contract registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def contract_failures_by_contract(failures: DataFrame, registry: DataFrame) -> DataFrame:
    """Failures per contract id with the contract's pillar and status; unknown ids are kept.

    Failures are counted first, so the join sees one row per id.
    """
    counted = failures.groupBy("contract_id").agg(
        F.count(F.lit(1)).alias("failures"), F.countDistinct("run_id").alias("runs")
    )
    known = registry.select(F.col("id").alias("contract_id"), "pillar", F.col("status").alias("contract_status"))
    joined = counted.join(known, "contract_id", "left")
    return joined.withColumn("known", F.col("contract_status").isNotNull())


def contract_failure_breakdown(failures: DataFrame) -> DataFrame:
    """Failures per contract, platform and run context."""
    return failures.groupBy("contract_id", "sdk_platform", "run_context").agg(F.count(F.lit(1)).alias("failures"))
