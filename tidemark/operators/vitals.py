"""Performance and health: frames, launches, connectivity, stalls, heartbeats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import HOT_ROWS, Ordered, previous

SLOW_NS = 16_000_000
FROZEN_NS = 700_000_000
MINUTE_NS = 60_000_000_000
STALL_US = 5_000_000


def frame_jank(
    frames: DataFrame,
    window_ns: int = MINUTE_NS,
    start_ns: int = 0,
    key: str = "dev",
    time: str = "frame_ns",
    seq: str = "event_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Per device and window: frames, slow (over 16 ms) and frozen (over 700 ms) ones, and their shares.

    A frame is timed against the one before it, across window edges; the first has no time.
    """
    timed = Ordered(frames, [key], [time, seq], hot_rows).running(__before=previous(F.col(time))).frame()
    delta = F.col(time) - F.col("__before")
    counted = (
        timed.filter(F.col("__before").isNotNull())
        .withColumn("window_start_ns", F.expr(f"(({time} - {start_ns}) div {window_ns}) * {window_ns} + {start_ns}"))
        .groupBy(key, "window_start_ns")
        .agg(
            F.count(F.lit(1)).alias("total_frames"),
            F.count_if((delta > SLOW_NS) & (delta <= FROZEN_NS)).alias("slow_frames"),
            F.count_if(delta > FROZEN_NS).alias("frozen_frames"),
        )
    )
    shares = {
        f"{n}_pct": F.round(F.col(f"{n}_frames") * 100.0 / F.col("total_frames"), 2) for n in ("slow", "frozen")
    }
    return counted.withColumns(shares)


def cold_launches(foregrounds: DataFrame, process: str = "process_id", time: str = "ts_us") -> DataFrame:
    """The first foreground of each process, if its elapsed time is above 0."""
    rest = [c for c in foregrounds.columns if c not in (process, time)]
    first = F.min(F.struct(time, *rest))
    firsts = foregrounds.groupBy(process).agg(first.alias("__f")).select(process, "__f.*")
    return firsts.filter("elapsed_ms > 0")


def cold_launch_summary(launches: DataFrame, by: str = "version") -> DataFrame:
    """Launches per version with the median and 90th percentile (exact nearest rank is not kept: a sketch is)."""
    quantiles = F.percentile_approx("elapsed_ms", [0.5, 0.9], 10_000)
    return (
        launches.groupBy(by)
        .agg(F.count(F.lit(1)).alias("launches"), quantiles.alias("__q"))
        .select(by, "launches", F.col("__q")[0].alias("p50_ms"), F.col("__q")[1].alias("p90_ms"))
    )


def rising_edges(
    states: DataFrame,
    state: str = "online",
    seed: bool = True,
    key: str = "dev",
    time: str = "ts_us",
    seq: str = "event_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows where the state turns true; ``seed`` is the state before a device's first row."""
    scanned = Ordered(states, [key], [time, seq], hot_rows).running(__before=previous(F.col(state))).frame()
    was = F.coalesce("__before", F.lit(seed))
    return scanned.filter(F.col(state) & ~was).drop("__before")


def detect_stalls(
    beats: DataFrame,
    threshold: int = STALL_US,
    key: str = "dev",
    time: str = "ts_us",
    seq: str = "event_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Acknowledged heartbeats followed by more than ``threshold`` of silence, once per stall.

    The next acknowledgement is the recovery, so each such pause is one stall.
    """
    scanned = Ordered(beats, [key], [time, seq], hot_rows).running(reverse=True, __next=previous(F.col(time))).frame()
    gap = F.col("__next") - F.col(time)
    return scanned.filter(gap > threshold).select(key, time, seq, gap.alias("stall"))


def latest_heartbeat(beats: DataFrame, app: str = "app_id") -> DataFrame:
    """The newest heartbeat per app and its clock skew (receive time minus server time)."""
    rest = [c for c in beats.columns if c not in (app, "received_ms")]
    newest = F.max(F.struct("received_ms", *rest))
    return (
        beats.groupBy(app)
        .agg(newest.alias("__b"))
        .select(app, "__b.*")
        .withColumn("clock_skew_ms", F.col("received_ms") - F.col("server_time_ms"))
    )
