"""Who was entitled to what, and when.

Snapshots are in long form: one row per user, snapshot time and entitlement key, with
``active`` and ``valid_until_us``. The rows of one user and time are one snapshot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import HOT_ROWS, Ordered, as_of, previous

STALE_US = 60_000_000


def is_valid(active: Column, valid_until: Column, at: Column) -> Column:
    """Active, and not expired: the end must lie strictly after ``at``."""
    return active & (valid_until.isNull() | (valid_until > at))


def latest_snapshot(snapshots: DataFrame, at: int, user: str = "user", time: str = "ts_us") -> DataFrame:
    """The rows of each user's newest snapshot at or before ``at``.

    One maximum per user, pre-aggregated, then an equi-join; a user's history is never gathered.
    """
    seen = snapshots.filter(F.col(time) <= at)
    newest = seen.groupBy(user).agg(F.max(time).alias(time))
    return seen.join(newest, [user, time], "left_semi")


def is_entitled(
    requests: DataFrame, snapshots: DataFrame, at: int, user: str = "user", time: str = "ts_us"
) -> DataFrame:
    """Answer (user, key) requests as of one instant; no snapshot means false."""
    valid = latest_snapshot(snapshots, at, user, time).filter(
        is_valid(F.col("active"), F.col("valid_until_us"), F.lit(at))
    )
    held = valid.select(user, "key", F.lit(True).alias("__held")).distinct()
    joined = requests.join(held, [user, "key"], "left")
    return joined.withColumn("entitled", F.coalesce("__held", F.lit(False))).drop("__held")


def active_keys(users: DataFrame, snapshots: DataFrame, at: int, user: str = "user", time: str = "ts_us") -> DataFrame:
    """Sorted active keys per user; null, not empty, for a user without a snapshot.

    The set is gathered from one snapshot per user, the size of one response.
    """
    ok = is_valid(F.col("active"), F.col("valid_until_us"), F.lit(at))
    held = (
        latest_snapshot(snapshots, at, user, time)
        .groupBy(user)
        .agg(F.array_sort(F.collect_set(F.when(ok, F.col("key")))).alias("active_keys"))
    )
    return users.join(held, user, "left")


def as_documents(snapshots: DataFrame, user: str = "user", time: str = "ts_us") -> DataFrame:
    """One row per snapshot with its entitlements as a sorted array: one response's worth.

    Gathered as a set, so copies of a row collapse on the map side.
    """
    items = F.array_sort(F.collect_set(F.struct("key", "active", "valid_until_us")))
    return snapshots.groupBy(user, time).agg(items.alias("entitlements"))


def is_entitled_as_of(
    requests: DataFrame,
    snapshots: DataFrame,
    user: str = "user",
    time: str = "ts_us",
    seq: str = "request_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Answer (user, key) requests each at its own time."""
    documents = as_documents(snapshots, user, time).withColumn(seq, F.lit(0).cast("bigint"))
    out = as_of(requests, {"__snapshot": documents}, [user], time, seq, hot_rows)
    held = F.exists(
        F.col("__snapshot.entitlements"),
        lambda e: (e["key"] == F.col("key")) & is_valid(e["active"], e["valid_until_us"], F.col(time)),
    )
    return out.withColumn("entitled", F.coalesce(held, F.lit(False))).drop("__snapshot")


def freshness(
    snapshots: DataFrame,
    failures: DataFrame,
    at: int,
    stale_after: int = STALE_US,
    user: str = "user",
    time: str = "ts_us",
) -> DataFrame:
    """Per user with a snapshot: when it was taken, whether it is stale, and a failed refresh since.

    A failure is recorded but never invalidates; a newer snapshot clears it.
    """
    taken = snapshots.filter(F.col(time) <= at).groupBy(user).agg(F.max(time).alias("last_updated_us"))
    failed = failures.filter(F.col(time) <= at).groupBy(user).agg(F.max(time).alias("__failed"))
    since = F.when(F.col("__failed") > F.col("last_updated_us"), F.col("__failed"))
    return taken.join(failed, user, "left").select(
        user,
        "last_updated_us",
        (F.lit(at) - F.col("last_updated_us") > stale_after).alias("is_stale"),
        since.alias("last_refresh_failed_us"),
    )


def entitlement_changes(
    snapshots: DataFrame,
    entitlements_only: bool = False,
    user: str = "user",
    time: str = "ts_us",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Change feed: one row per snapshot that differs from the user's previous one.

    The time of the snapshot is part of it, so every refresh is a change unless
    ``entitlements_only``. The first snapshot is a change.
    """
    documents = as_documents(snapshots, user, time)
    if not entitlements_only:
        return documents
    scanned = Ordered(documents, [user], [time], hot_rows).running(__before=previous(F.col("entitlements"))).frame()
    return scanned.filter(~F.col("entitlements").eqNullSafe(F.col("__before"))).drop("__before")
