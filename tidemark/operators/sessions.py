"""Sessions: idle-gap sessions, lifecycle sessions, summaries and funnels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import ALONE, HOT_ROWS, Ordered, as_of, before, last, place, previous

IDLE_US = 30 * 60 * 1_000_000


def sessionize(
    df: DataFrame,
    key: str = "dev",
    time: str = "ts_us",
    seq: str = "event_id",
    idle: int = IDLE_US,
    hot_rows: int = HOT_ROWS,
    measure: DataFrame | None = None,
) -> DataFrame:
    """Add ``session_no`` and ``session_id``: a pause of at least ``idle`` starts a session.

    One shuffle by key, or by (key, chunk) if a key is hot. Then sessions are counted inside chunks
    and a chunk's first row is compared with the end of the chunk before it in a summary. Rows
    without key or time are in no session and left out.
    """
    known = df.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
    placed, cut = place(known, [key], time, hot_rows, measure)
    group = [key, "__chunk"] if cut else [key]
    inside = Window.partitionBy(*group).orderBy(time, seq)
    is_new = (F.col(time) - F.lag(time).over(inside) >= idle).cast("int")
    so_far = F.sum(F.coalesce("__new", F.lit(0))).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    rows = placed.withColumn("__new", is_new).withColumn("__run", so_far)
    number = F.col("__run") + 1
    if cut:
        per_key = Window.partitionBy(key).orderBy("__chunk")
        upto = per_key.rowsBetween(Window.unboundedPreceding, 0)
        starts = (
            placed.filter("__hot")
            .withColumn("__new", is_new)
            .groupBy(*group)
            .agg(
                F.min(time).alias("__from"), F.max(time).alias("__to"), F.coalesce(F.sum("__new"), F.lit(0)).alias("__inner")
            )
            .withColumn("__edge", F.when(F.col("__from") - F.lag("__to").over(per_key) < idle, 0).otherwise(1))
            .withColumn("__first", F.sum(F.col("__edge") + F.col("__inner")).over(upto) - F.col("__inner"))
            .select(*group, "__first")
        )
        rows = rows.join(starts, group, "left")
        number = F.col("__run") + F.coalesce("__first", F.lit(1))
    return (
        rows.withColumn("session_no", number)
        .withColumn("session_id", F.concat_ws("_s", F.col(key), F.col("session_no").cast("string")))
        .drop("__chunk", "__hot", "__new", "__run", "__first")
    )


def session_summary(sessions: DataFrame, key: str = "dev", time: str = "ts_us") -> DataFrame:
    """Per session: start, end, length, event count and why it ended.

    The newest session of a device is still open; every other ended by idleness.
    """
    per_session = sessions.groupBy(key, "session_id", "session_no").agg(
        F.min(time).alias("start_us"), F.max(time).alias("end_us"), F.count(F.lit(1)).alias("events")
    )
    # Sessions of a key are at most time span / idle limit, so they may share a task.
    newest = F.max("session_no").over(Window.partitionBy(key))
    return per_session.withColumn("__newest", newest).select(
        key,
        "session_id",
        "start_us",
        "end_us",
        F.expr("(end_us - start_us) div 1000").alias("duration_ms"),
        "events",
        F.when(F.col("session_no") == F.col("__newest"), "open").otherwise("idle").alias("end_reason"),
    )


def lifecycle_sessions(
    ops: DataFrame,
    key: str = "dev",
    time: str = "ts_us",
    seq: str = "event_id",
    idle: int = IDLE_US,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Session starts and ends from foreground, background and reset rows (column ``op``).

    A session is open exactly when the previous row is a foreground or a reset,
    so the state needs only the previous row and the last background time. A
    foreground that finds an open session but an old background starts another.
    Output: one row per emitted ``session.started`` / ``session.ended``.
    """
    op = F.col("op")
    state = Ordered(ops, [key], [time, seq], hot_rows).running(
        __before=previous(op),
        __background=last(F.when(op == "background", F.col(time))),
    )
    is_open = F.coalesce(F.col("__before").isin("foreground", "reset"), F.lit(False))
    long_idle = F.col("__background").isNull() | (F.col(time) - F.col("__background") >= idle)
    starts = ((op == "foreground") & (~is_open | long_idle)) | (op == "reset")
    reason = F.when(op == "reset", "manual_reset").when(long_idle, "resume_idle").otherwise("resume")
    state = (
        state.with_columns(
            __ends=is_open & op.isin("background", "reset"), __starts=starts, __reason=F.when(starts, reason)
        )
        # The session that ends here began at the newest start before this row.
        .running(__began=before(F.when(F.col("__starts"), F.struct(F.col(time).alias("t"), F.col(seq).alias("s")))))
    )
    ended = F.when(
        F.col("__ends"),
        F.struct(
            F.lit("session.ended").alias("name"),
            F.when(op == "reset", "manual_reset").otherwise("background").alias("reason"),
            F.col("__began.t").alias("started_us"),
            F.col("__began.s").alias("session_seq"),
        ),
    )
    started = F.when(
        F.col("__starts"),
        F.struct(
            F.lit("session.started").alias("name"),
            F.col("__reason").alias("reason"),
            F.col(time).alias("started_us"),
            F.col(seq).alias("session_seq"),
        ),
    )
    emitted = F.filter(F.array(ended, started), lambda e: e.isNotNull())
    return (
        state.frame()
        .select(key, time, seq, F.explode(emitted).alias("e"))
        .select(
            key,
            time,
            seq,
            "e.name",
            F.concat_ws("_", F.lit("ses"), F.col(key), F.col("e.session_seq").cast("string")).alias("session_id"),
            "e.reason",
            F.when(F.col("e.name") == "session.ended", F.expr(f"({time} - e.started_us) div 1000")).alias("duration_ms"),
        )
    )


def session_log(emitted: DataFrame, key: str = "dev", time: str = "ts_us", seq: str = "event_id") -> DataFrame:
    """The open session per device over time, from ``lifecycle_sessions`` rows.

    One row per instant of change; a reset's end and start collapse to the start.
    """
    return emitted.groupBy(key, time, seq).agg(
        F.max(F.when(F.col("name") == "session.started", F.col("session_id"))).alias("session_id")
    )


def attach_session(
    events: DataFrame, log: DataFrame, key: str = "dev", time: str = "ts_us", seq: str = "event_id", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Stamp the session open when each event happened; null when none is.

    Replaces a ``session_id`` the caller supplied only where a session is open.
    """
    given = "session_id" in events.columns
    held = events.withColumnRenamed("session_id", "__given") if given else events
    joined = as_of(held, {"__session": log.select(key, time, seq, "session_id")}, [key], time, seq, hot_rows)
    now = F.col("__session.session_id")
    out = joined.withColumn("session_id", F.coalesce(now, F.col("__given")) if given else now)
    return out.drop("__session", "__given")


def session_funnel(
    sessions: DataFrame, steps: Sequence[str], time: str = "ts_us", seq: str = "event_id", by: str = "session_id", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Per session, how many of the ordered ``steps`` (event names) were reached.

    Each step is the earliest row of its name after the previous step's row, so a row reaches step n if it has the
    step's name and a row before it reached step n - 1. That is one running flag a step over one ordering of the rows:
    one shuffle by session whatever the number of steps, whose result the last aggregate groups in place. Rows without
    a session reach nothing. A session of
    over ``hot_rows`` rows is cut into chunks, and what a chunk starts with comes from a summary row for each.
    """
    known = F.col(by).isNotNull()
    scan = Ordered(sessions.filter(known).select(by, time, seq, "name"), [by], [time, seq], hot_rows)
    reached = F.col("name") == steps[0]
    depth = F.when(reached, 1).otherwise(0)
    for n, step in enumerate(steps[1:], start=2):
        scan = scan.with_columns(__reached=reached).running(__earlier=before(F.when(F.col("__reached"), F.lit(True)))).with_columns(__depth=depth)
        reached, depth = (F.col("name") == step) & F.col("__earlier").isNotNull(), F.col("__depth")
        scan = scan.with_columns(__hit=reached).with_columns(__best=F.when(F.col("__hit"), n).otherwise(depth))
        reached, depth = F.col("__hit"), F.col("__best")
    # Grouped by what the rows are dealt out by already.
    found = scan.with_columns(__deepest=depth).df.groupBy(by, ALONE).agg(F.max("__deepest").alias("steps_reached")).drop(ALONE)
    return found.unionByName(sessions.filter(~known).select(by, F.lit(0).alias("steps_reached")).distinct())
