"""Delivery rules: redelivery, replays, batch outcomes, buffer caps and retry audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.wire import classify_outcome, retry_ceiling
from .ordered import HOT_ROWS, Ordered, alone, before, open_intervals, place, previous, total

DAY_MS = 86_400_000
MAX_RETRYABLE = 6


def dedup_events(df: DataFrame, key: str = "event_id", received: str = "received_us") -> DataFrame:
    """Keep the earliest received copy of each event.

    An aggregate, not a window: copies collapse on the map side, so a third of the table
    being copies of one event moves one row per task. Copies received at once are told
    apart by their other columns, as far as these can be ordered.
    """
    rest = [c for c in df.columns if c not in (key, received)]
    sortable = [f.name for f in df.schema.fields if f.name in rest and _is_sortable(f.dataType)]
    if len(sortable) == len(rest):
        kept = F.min(F.struct(received, *rest))
    else:
        kept = F.min_by(F.struct(received, *rest), F.struct(received, *sortable))
    return df.groupBy(key).agg(kept.alias("__kept")).select(key, "__kept.*").select(*df.columns)


def _is_sortable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_is_sortable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _is_sortable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def resolve_replays(
    requests: DataFrame,
    key: str = "key",
    time: str = "ts_ms",
    seq: str = "event_id",
    body: str = "body_hash",
    ttl: int = DAY_MS,
) -> DataFrame:
    """Answer repeated requests from the first success of the last ``ttl``.

    ``executed`` runs the request, ``replayed`` (code ``idempotent_replay``) repeats the cached
    answer, ``conflict`` (``idempotency_key_in_use``) has the key but another body.
    Only a success is cached, and expiry starts over with the next success.
    """
    success = F.col("status").between(200, 299)
    stored = open_intervals(requests.filter(success), [key], time, seq, ttl).filter("opens")
    cached = stored.select(key, time, seq, F.struct(F.col(time).alias("t"), F.col(body).alias("b")).alias("__stored"))
    joined = requests.join(cached, [key, time, seq], "left")
    state = Ordered(joined, [key], [time, seq]).running(__answer=before(F.col("__stored"))).frame()
    live = F.col("__answer").isNotNull() & (F.col(time) - F.col("__answer.t") < ttl)
    same = F.col(body).eqNullSafe(F.col("__answer.b"))
    outcome = F.when(live & same, "replayed").when(live, "conflict").otherwise("executed")
    code = F.when(live & same, "idempotent_replay").when(live, "idempotency_key_in_use")
    return state.select(*requests.columns, outcome.alias("outcome"), code.alias("code"))


def delivery_outcomes(attempts: DataFrame, key: str = "key", time: str = "ts_ms", seq: str = "event_id") -> DataFrame:
    """Per batch: how many sends were made and how it ended.

    The first success, permanent failure or sixth retryable failure ends the batch; rows after
    it are ignored. ``next_retry_ms`` is the latest the next send may be when pending. A send without a key is a batch of its own.
    ``attempts`` has ``status`` and ``retry_after_ms`` columns.
    """
    kind = classify_outcome(F.col("status"))
    retryable = F.when(F.col("__kind") == "retryable", 1).otherwise(0)
    counted = (
        Ordered(attempts.withColumn("__kind", kind), [key], [time, seq])
        .running(__tries=total(F.lit(1)), __failures=total(retryable))
        .frame()
    )
    state = (
        F.when(F.col("__kind") == "success", "delivered")
        .when(F.col("__kind") == "permanent", "dropped_permanent")
        .when(F.col("__failures") >= MAX_RETRYABLE, "retry_exhausted")
    )
    counted = counted.withColumn("__state", state)
    at = F.struct(F.col(time), F.col(seq))
    row = F.struct(
        F.col("__tries").alias("attempts"),
        F.coalesce(F.col("__state"), F.lit("pending")).alias("state"),
        F.when(
            F.col("__state").isNull(),
            F.col(time) + retry_ceiling(F.col("__failures") - 1, F.col("retry_after_ms")),
        ).alias("next_retry_ms"),
    )
    ended = F.min_by(row, F.when(F.col("__state").isNotNull(), at))
    newest = F.max_by(row, at)
    per_batch = [F.col(key), alone([key], [time, seq]).alias("__alone")]
    picked = counted.groupBy(*per_batch).agg(ended.alias("__ended"), newest.alias("__newest"))
    return picked.select(key, F.coalesce("__ended", "__newest").alias("__r")).select(key, "__r.*")


def first_event_sent(delivered: DataFrame, scope: str = "app", time: str = "ts_ms", seq: str = "event_id") -> DataFrame:
    """The earliest delivered event per scope."""
    return (
        delivered.groupBy(scope)
        .agg(F.min(F.struct(time, seq)).alias("__first"))
        .select(scope, F.col(f"__first.{time}").alias(time), F.col(f"__first.{seq}").alias(seq))
    )


def keep_latest(
    df: DataFrame, n: int = 1000, key: str = "dev", time: str = "ts_us", seq: str = "event_id", hot_rows: int = HOT_ROWS
) -> tuple[DataFrame, DataFrame]:
    """The newest ``n`` rows per device, and how many each device lost.

    This buffer cap is the rule itself. Without a hot device it is a top-n that Spark cuts before its shuffle;
    with one, ranks come from a chunked count, newest first. Rows without a device are all kept.
    """
    placed, cut = place(df, [key], time, hot_rows)
    if cut:
        ranked = Ordered(df, [key], [time, seq], hot_rows).running(reverse=True, __rank=total(F.lit(1))).frame()
    else:
        newest = Window.partitionBy(key, "__alone").orderBy(F.desc(time), F.desc(seq))
        ranked = placed.withColumn("__alone", alone([key], [time, seq])).withColumn("__rank", F.row_number().over(newest)).drop("__alone")
    kept = ranked.filter(F.col("__rank") <= n).drop("__rank")
    dropped = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > n)
    return kept, dropped.select(key, (F.col("rows") - n).alias("dropped"))


def retry_audit(
    attempts: DataFrame,
    key: str = "key",
    time: str = "ts_ms",
    seq: str = "event_id",
    base_ms: int = 1000,
    max_ms: int = 30_000,
    max_attempts: int = 5,
) -> DataFrame:
    """For each send, the longest wait allowed after it and whether the next send kept to it.

    ``retry_no`` counts retryable failures before this row from 0; ``ceiling_ms`` is null for rows that are
    not retryable and once retries are used up. ``late`` marks a gap above the ceiling, ``early`` a send before
    the time a Retry-After named; below a backoff ceiling any gap is allowed, as jitter is random.
    """
    marked = attempts.withColumn("__kind", classify_outcome(F.col("status")))
    state = (
        Ordered(marked, [key], [time, seq])
        .running(__failures=total(F.when(F.col("__kind") == "retryable", 1).otherwise(0)))
        .running(reverse=True, __next=previous(F.col(time)))
        .frame()
    )
    retry_no = F.col("__failures") - 1
    ceiling = F.when(
        F.col("__kind") == "retryable",
        retry_ceiling(retry_no, F.col("retry_after_ms"), base_ms, max_ms, max_attempts),
    )
    gap = F.col("__next") - F.col(time)
    return state.select(
        key,
        time,
        seq,
        F.when(F.col("__kind") == "retryable", retry_no).alias("retry_no"),
        ceiling.alias("ceiling_ms"),
        gap.alias("gap_ms"),
        F.coalesce(gap > ceiling, F.lit(False)).alias("late"),
        F.coalesce((F.col("retry_after_ms") > 0) & (gap < ceiling), F.lit(False)).alias("early"),
    )
