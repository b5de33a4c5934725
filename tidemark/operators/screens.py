"""Coalescing of repeated screen views and taps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import HOT_ROWS, open_intervals, previous

SCREEN_MS = 250
TAP_MS = 100


def _coalesce(df: DataFrame, what: str, window: int, key: str, time: str, seq: str, hot_rows: int) -> DataFrame:
    changed = F.col("__prev").isNull() | ~F.col(what).eqNullSafe(F.col("__what"))
    marked = open_intervals(
        df, [key], time, seq, window, starts_run=changed, hot_rows=hot_rows, also={"__what": previous(F.col(what))}
    )
    return marked.filter("opens").select(*df.columns)


def coalesce_screens(
    views: DataFrame,
    screen: str = "screen",
    window: int = SCREEN_MS,
    key: str = "dev",
    time: str = "ts_ms",
    seq: str = "event_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Drop a view of the last kept view's screen less than ``window`` after it.

    Dropped views do not restart the clock; another screen does. A dropped view has the kept
    view's screen, so "another screen than the last kept" is "another than the previous row".
    """
    return _coalesce(views, screen, window, key, time, seq, hot_rows)


def coalesce_taps(
    taps: DataFrame,
    element: str = "element",
    window: int = TAP_MS,
    key: str = "dev",
    time: str = "ts_ms",
    seq: str = "event_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The same for taps on one element."""
    return _coalesce(taps, element, window, key, time, seq, hot_rows)
