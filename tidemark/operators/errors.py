"""Error rows: breadcrumbs, recovered fatals, the wire form and groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.privacy import scrub_pii
from ..functions.stacks import fingerprint, parse_stack
from ..functions.values import strip
from .ordered import HOT_ROWS, Ordered, before, last, total

BREADCRUMBS = 50
FATAL_FRAMES = 50

_CRUMB = ("category", "level", "message", "data")


def crumbs_from_events(events: DataFrame, key: str = "dev", time: str = "ts_us", seq: str = "event_id") -> DataFrame:
    """The breadcrumb each tracked event leaves."""
    return events.filter("name not in ('$error')").select(
        key,
        time,
        seq,
        F.lit("custom").alias("category"),
        F.lit("info").alias("level"),
        F.concat(F.lit("track "), "name").alias("message"),
        F.lit(None).cast("map<string,string>").alias("data"),
    )


def crumbs_from_identity(ops: DataFrame, key: str = "dev", time: str = "ts_us", seq: str = "event_id") -> DataFrame:
    """The breadcrumb each identify call leaves."""
    return ops.filter("op = 'identify'").select(
        key,
        time,
        seq,
        F.lit("identity").alias("category"),
        F.lit("info").alias("level"),
        F.concat(F.lit("identify "), strip(F.col("user"))).alias("message"),
        F.lit(None).cast("map<string,string>").alias("data"),
    )


def crumbs_from_messages(messages: DataFrame, key: str = "dev", time: str = "ts_us", seq: str = "event_id") -> DataFrame:
    """The breadcrumb each captured message (``message``, ``level``) leaves."""
    return messages.select(
        key,
        time,
        seq,
        F.lit("custom").alias("category"),
        "level",
        "message",
        F.lit(None).cast("map<string,string>").alias("data"),
    )


def attach_breadcrumbs(
    errors: DataFrame,
    crumbs: DataFrame,
    resets: DataFrame | None = None,
    n: int = BREADCRUMBS,
    key: str = "dev",
    time: str = "ts_us",
    seq: str = "event_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``breadcrumbs``: the last ``n`` crumbs before each error, oldest first, since the last reset.

    Crumbs are numbered per device and each goes to the block of its number and to the next, so
    the block of crumb c holds all of c-n+1..c. An error then finds its crumbs by one
    equi-join on (device, block): no list is copied per crumb, and a block never holds more
    than 2n whatever a device sends.
    """
    head = [key, time, seq]
    payload = [c for c in errors.columns if c not in head]
    kinds = [errors.select(*head, F.lit(2).alias("__kind"), F.struct(*payload).alias("__error"))]
    crumb = F.struct(*[F.col(c) for c in _CRUMB])
    kinds.append(crumbs.select(*head, F.lit(1).alias("__kind"), crumb.alias("__crumb")))
    if resets is not None:
        kinds.append(resets.select(*head, F.lit(0).alias("__kind")))
    union = kinds[0]
    for part in kinds[1:]:
        union = union.unionByName(part, allowMissingColumns=True)
    scan = (
        Ordered(union, [key], [time, "__kind", seq], hot_rows)
        .running(
            __count=total(F.when(F.col("__kind") == 1, 1).otherwise(0)),
            __reset=last(F.when(F.col("__kind") == 0, F.struct(F.col(time).alias("t"), F.col("__kind").alias("k"), F.col(seq).alias("s")))),
        )
        .frame()
    )
    block = F.expr(f"(__count - 1) div {int(n)}")
    asked = scan.filter("__kind = 2").select(
        *head, "__error", "__count", "__reset", F.when(F.col("__count") > 0, block).alias("__block")
    )
    # Errors are few beside crumbs: only the blocks that one asks for are gathered.
    wanted = asked.filter(F.col(key).isNotNull() & F.col("__block").isNotNull()).select(key, "__block").distinct()
    numbered = scan.filter("__kind = 1").filter(F.col(key).isNotNull()).select(
        key,
        F.explode(F.array(block, block + 1)).alias("__block"),
        F.struct(
            F.col("__count").alias("no"),
            F.struct(F.col(time).alias("t"), F.lit(1).alias("k"), F.col(seq).alias("s")).alias("at"),
            F.struct(F.col(time).alias("ts_us"), "__crumb.*").alias("crumb"),
        ).alias("__c"),
    )
    asked_for = numbered.join(wanted, [key, "__block"], "left_semi")
    blocks = asked_for.groupBy(key, "__block").agg(F.collect_list("__c").alias("__items"))
    found = asked.join(blocks, [key, "__block"], "left")
    none = F.array().cast(blocks.schema["__items"].dataType)
    recent = F.filter(
        F.coalesce("__items", none),
        lambda c: (c["no"] <= F.col("__count"))
        & (c["no"] > F.col("__count") - n)
        & (F.col("__reset").isNull() | (c["at"] > F.col("__reset"))),
    )
    ordered = F.array_sort(recent, lambda a, b: (a["no"] - b["no"]).cast("int"))
    return found.select(*head, "__error.*", F.transform(ordered, lambda c: c["crumb"]).alias("breadcrumbs"))


def recover_fatals(
    errors: DataFrame,
    launches: DataFrame,
    key: str = "dev",
    time: str = "ts_us",
    seq: str = "event_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Per launch, the newest fatal since the launch before it, as ``$error.recovered``.

    ``errors`` has ``fatal``, ``type``, ``message`` and ``frames``; older fatals of the same run are coalesced.
    """
    head = [key, time, seq]
    fatal = F.struct(F.col(time).alias("fatal_us"), F.col(seq).alias("fatal_id"), "type", "message", "frames")
    union = errors.filter("fatal").select(*head, F.lit(0).alias("__kind"), fatal.alias("__fatal"))
    union = union.unionByName(launches.select(*head, F.lit(1).alias("__kind")), allowMissingColumns=True)
    at = F.struct(F.col(time).alias("t"), F.col("__kind").alias("k"), F.col(seq).alias("s"))
    scan = (
        Ordered(union, [key], [time, "__kind", seq], hot_rows)
        .running(__last=last(F.col("__fatal")), __launch=before(F.when(F.col("__kind") == 1, at)))
        .frame()
        .filter("__kind = 1 and __last is not null")
    )
    fatal_at = F.struct(F.col("__last.fatal_us").alias("t"), F.lit(0).alias("k"), F.col("__last.fatal_id").alias("s"))
    return scan.filter(F.col("__launch").isNull() | (fatal_at > F.col("__launch"))).select(
        *head,
        F.lit("$error.recovered").alias("name"),
        F.lit(True).alias("recovered"),
        "__last.fatal_us",
        "__last.fatal_id",
        "__last.type",
        "__last.message",
        F.slice(parse_stack(F.col("__last.frames")), 1, FATAL_FRAMES).alias("stack"),
    )


def captured_messages(messages: DataFrame) -> DataFrame:
    """Captured messages as handled error rows without a stack."""
    frames = "array<struct<className:string,methodName:string,fileName:string,lineNumber:int>>"
    return messages.select(
        "*",
        F.lit("internal_error").alias("type"),
        F.lit(True).alias("handled"),
        F.array().cast(frames).alias("frames"),
    )


def error_rows_to_events(errors: DataFrame, scrub: bool = True, scrub_context: bool = True) -> DataFrame:
    """Error columns as the properties of a ``$error`` event; empty parts are null.

    Reads type, message, frames, handled, ts_us and, if present, breadcrumbs, tags, context.
    ``scrub_context=False`` leaves tags and context as given.
    """
    have = set(errors.columns)

    def clean(col: Column, on: bool = scrub) -> Column:
        return scrub_pii(col) if on else col

    parsed = parse_stack(F.col("frames"))
    stack = F.transform(parsed, lambda f: clean(F.concat_ws(":", f["module"], f["symbol"])))
    props = [
        F.col("type").alias("error_type"),
        clean(F.col("message")).alias("error_message"),
        fingerprint(parsed, F.col("type")).alias("error_fingerprint"),
        F.col("handled").alias("error_handled"),
        F.expr("ts_us div 1000").alias("error_timestamp_ms"),
        F.when(F.size(stack) > 0, stack).alias("error_stack"),
    ]
    if "tags" in have:
        tags = F.transform_values("tags", lambda _, v: clean(v, scrub and scrub_context))
        props.append(F.when(F.size("tags") > 0, tags).alias("error_tags"))
    if "context" in have:
        context = F.transform_values(
            "context", lambda _, b: F.transform_values(b, lambda _k, v: clean(v, scrub and scrub_context))
        )
        props.append(F.when(F.size("context") > 0, context).alias("error_context"))
    if "breadcrumbs" in have:
        crumbs = F.transform(
            "breadcrumbs",
            lambda c: F.struct(
                F.floor(c["ts_us"] / 1000).alias("timestamp_ms"),
                c["category"].alias("category"),
                c["level"].alias("level"),
                clean(c["message"]).alias("message"),
                F.when(F.size(c["data"]) > 0, F.transform_values(c["data"], lambda _, v: clean(v))).alias("data"),
            ),
        )
        props.append(F.when(F.size("breadcrumbs") > 0, crumbs).alias("error_breadcrumbs"))
    used = {"type", "message", "frames", "handled", "tags", "context", "breadcrumbs"}
    rest = [c for c in errors.columns if c not in used]
    return errors.select(*rest, F.lit("$error").alias("name"), *props)


def error_groups(
    errors: DataFrame, by: str = "error_fingerprint", user: str = "user_id", time: str = "ts_us", approximate: bool = False
) -> DataFrame:
    """Per fingerprint: count, users, first and last seen, handled share.

    Exact users are counted per (fingerprint, user) first, so one hot fingerprint is spread by user.
    """
    handled = F.sum(F.col("error_handled").cast("int"))
    if approximate:
        grouped = errors.groupBy(by).agg(
            F.count(F.lit(1)).alias("errors"),
            F.approx_count_distinct(user).alias("users"),
            F.min(time).alias("first_seen_us"),
            F.max(time).alias("last_seen_us"),
            handled.alias("__handled"),
        )
    else:
        per_user = errors.groupBy(by, user).agg(
            F.count(F.lit(1)).alias("__n"),
            F.min(time).alias("__from"),
            F.max(time).alias("__to"),
            handled.alias("__h"),
        )
        grouped = per_user.groupBy(by).agg(
            F.sum("__n").alias("errors"),
            F.count(user).alias("users"),
            F.min("__from").alias("first_seen_us"),
            F.max("__to").alias("last_seen_us"),
            F.sum("__h").alias("__handled"),
        )
    return grouped.withColumn("handled_share", F.round(F.col("__handled") / F.col("errors"), 4)).drop("__handled")
