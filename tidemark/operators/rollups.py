"""Counts over events: pages, names, days, tenants.

Distinct users are counted in two steps, per (group, user) and then per group, so that
a group with a third of all rows is spread over its users.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .identity import fold_super_properties, group_operations
from .ordered import HOT_ROWS, as_of

DAY_US = 86_400_000_000


def rows_and_users(events: DataFrame, by: Sequence[str], user: str = "user_id", rows: str = "events") -> DataFrame:
    per_user = events.groupBy(*by, user).agg(F.count(F.lit(1)).alias("__n"))
    return per_user.groupBy(*by).agg(F.sum("__n").alias(rows), F.count(user).alias("users"))


def page_views(views: DataFrame, page: str = "page", user: str = "user_id") -> DataFrame:
    return rows_and_users(views, [page], user, "views")


def event_counts(events: DataFrame, by: Sequence[str] = ("name", "platform", "day")) -> DataFrame:
    return events.groupBy(*by).agg(F.count(F.lit(1)).alias("events"))


def active_users(events: DataFrame, time: str = "ts_us", user: str = "user_id") -> DataFrame:
    """Users and events per UTC day (days since the epoch)."""
    return rows_and_users(events.withColumn("day", F.expr(f"{time} div {DAY_US}")), ["day"], user)


def group_rollup(
    events: DataFrame,
    groups: DataFrame,
    group_type: str,
    key: str = "dev",
    time: str = "ts_us",
    seq: str = "event_id",
    user: str = "user_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Events and users per tenant of one group type, by the tenant set when each event happened."""
    name = f"group_{group_type}"
    # Written once: the join below reads the state twice.
    state = cut_lineage(fold_super_properties(group_operations(groups, key, time, seq), [name], key, time, seq, hot_rows))
    held = as_of(events, {"__group": state}, [key], time, seq, hot_rows)
    tenant = F.try_element_at("__group.props", F.lit(name)).alias("group_key")
    return rows_and_users(held.select(user, tenant), ["group_key"], user)
