"""Sketches per day that are stored and merged, so that a week is seven rows a group and not seven days of events.

Distinct users are a HyperLogLog sketch, values a KLL sketch of their ranks. Both
merge without loss: the sketch of a week is as good as one made over the week.
With the default sizes an estimated number of users is within 3 % of the truth (three
standard errors of 0.8 %; exact up to some hundreds of users), and a quantile's rank within 1 %.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rollups import DAY_US

#: log2 of the registers, and the size of the rank sketch.
REGISTERS = 14
RANKS = 400
USERS_ERROR = 0.03
RANK_ERROR = 0.01


def daily_sketches(
    events: DataFrame, by: Sequence[str], time: str = "ts_us", user: str = "user_id", value: str | None = None, registers: int = REGISTERS, ranks: int = RANKS
) -> DataFrame:
    """One row per UTC day (days since the epoch) and group: rows, users (a sketch) and, with ``value``, a sketch of it.

    Null users and values are in no sketch. ``value`` is a whole number.
    """
    parts = [F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(F.col(user).cast("string"), F.lit(registers)).alias("users")]
    if value is not None:
        parts.append(F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), F.lit(ranks)).alias("ranks"))
    return events.withColumn("day", F.expr(f"{time} div {DAY_US}")).groupBy("day", *by).agg(*parts)


def merge_sketches(sketches: DataFrame, by: Sequence[str | Column], ranks: int = RANKS) -> DataFrame:
    """The sketches of the rows of each group as one: rows, users and, where there is one, ranks."""
    parts = [F.sum("rows").alias("rows"), F.hll_union_agg("users").alias("users")]
    if "ranks" in sketches.columns:
        parts.append(F.kll_merge_agg_bigint("ranks", F.lit(ranks)).alias("ranks"))
    return sketches.groupBy(*by).agg(*parts)


def read_sketches(sketches: DataFrame, quantiles: dict[str, float] | None = None) -> DataFrame:
    """The numbers in place of the sketches: users, and a column for each of ``quantiles`` (null where there was no value)."""
    kept = [c for c in sketches.columns if c not in ("users", "ranks")]
    empty = F.coalesce(F.kll_sketch_get_n_bigint("ranks"), F.lit(0)) == 0 if quantiles else None
    found = [F.when(~empty, F.kll_sketch_get_quantile_bigint("ranks", F.lit(q))).alias(n) for n, q in (quantiles or {}).items()]
    return sketches.select(*kept, F.hll_sketch_estimate("users").alias("users"), *found)
