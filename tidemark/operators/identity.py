"""Identity, consent and property state over time, and the joins that read it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.privacy import scrub_pii
from ..functions.values import strip
from ..session import cut_lineage
from .ordered import HOT_ROWS, Ordered, as_of, before, last, previous, total

def _set_to(value: Column) -> Column:
    """A wrapper that tells "set to null" from "not set"."""
    return F.struct(value.alias("v"))


def fold_identity(
    ops: DataFrame, key: str = "dev", time: str = "ts_us", seq: str = "event_id", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Identity after each operation (``op``: identify, alias, reset; ``user``, ``customer``).

    Ids are trimmed and blank is null. A reset clears both and starts an epoch with a new
    anonymous id, derived from device and epoch so that reruns agree.
    """
    op = F.col("op")
    nothing = F.when(op == "reset", _set_to(F.lit(None).cast("string")))
    user = F.when(op == "identify", _set_to(F.nullif(strip(F.col("user")), F.lit(""))))
    customer = F.when(op == "alias", _set_to(F.nullif(strip(F.col("customer")), F.lit(""))))
    state = (
        Ordered(ops, [key], [time, seq], hot_rows)
        .running(
            __epoch=total(F.when(op == "reset", 1).otherwise(0)),
            __user=last(F.coalesce(user, nothing)),
            __customer=last(F.coalesce(customer, nothing)),
        )
        .frame()
    )
    fresh = F.concat(F.lit("anon_"), F.md5(F.concat_ws("#", F.col(key), F.col("__epoch").cast("string"))))
    return state.select(
        key,
        time,
        seq,
        F.col("__epoch").alias("epoch"),
        F.when(F.col("__epoch") == 0, F.col(key)).otherwise(fresh).alias("anonymous_id"),
        F.col("__user.v").alias("developer_user_id"),
        F.col("__customer.v").alias("customer_id"),
    )


def attach_identity(
    events: DataFrame, identity: DataFrame, key: str = "dev", time: str = "ts_us", seq: str = "event_id", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Stamp each event with the identity in force; before any operation the device is anonymous."""
    out = as_of(events, {"__identity": identity}, [key], time, seq, hot_rows)
    return out.select(*events.columns, *_identity_columns(key))


def _identity_columns(key: str) -> list[Column]:
    return [
        F.coalesce("__identity.anonymous_id", key).alias("anonymous_id"),
        F.col("__identity.developer_user_id").alias("developer_user_id"),
        F.col("__identity.customer_id").alias("customer_id"),
    ]


def attach_consent(
    events: DataFrame, consent: DataFrame, key: str = "dev", time: str = "ts_us", seq: str = "event_id", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add the consent in force when each event happened; both channels are granted by default."""
    log = consent.select(key, time, seq, "analytics", "errors")
    out = as_of(events, {"__consent": log}, [key], time, seq, hot_rows)
    granted = [F.coalesce(f"__consent.{c}", F.lit(True)).alias(f"consent_{c}") for c in ("analytics", "errors")]
    return out.select(*events.columns, *granted)


def group_operations(groups: DataFrame, key: str = "dev", time: str = "ts_us", seq: str = "event_id") -> DataFrame:
    """Group calls (``group_type``, ``group_key``) as property operations: a null key unregisters."""
    return groups.filter(F.coalesce("group_type", F.lit("")) != "").select(
        key,
        time,
        seq,
        F.when(F.col("group_key").isNull(), "unregister").otherwise("register").alias("op"),
        F.concat(F.lit("group_"), "group_type").alias("key"),
        F.col("group_key").alias("value"),
    )


# Changes that a block of the log holds; see fold_names.
BLOCK = 64


def fold_names(
    ops: DataFrame, key: str, time: str, order: Sequence[str], hot_rows: int = HOT_ROWS, block: int = BLOCK
) -> DataFrame:
    """The map of names to values after each operation, whatever the number of names.

    ``ops`` has ``op`` (set, once, unset, clear or any other, which changes nothing), ``name`` and
    ``value``; ``order`` identifies rows of a key. Adds ``state``. An ``unset`` removes a name, a ``clear``
    all of them; a value is that of the newest ``set`` since the name was removed, else of the first
    ``once`` since then.

    Names are rows, not columns: each change is found by one ordered scan per (key, clear, name). Changes are
    numbered per key and a state is that at the last full block of them, plus the changes of the running block up to
    the row. A full state is so written once per block, not once per row.
    """
    head, op = list(dict.fromkeys([key, *order])), F.col("op")
    at = F.struct(*[F.col(c) for c in order])
    changes_it = op.isin("set", "once", "unset") & (F.coalesce("name", F.lit("")) != "")
    numbered = (
        Ordered(ops, [key], order, hot_rows)
        .running(__epoch=total(F.when(op == "clear", 1).otherwise(0)), __nth=total(F.when(changes_it, 1).otherwise(0)))
        .frame()
    )
    # Read by the changes, their last numbers and the rows.
    numbered = cut_lineage(numbered)
    scope = [key, "__epoch"]
    known = numbered.filter(F.col(key).isNotNull())
    changes = known.filter(changes_it).select(*head, "__epoch", "__nth", "op", "name", "value")

    def valued() -> Column:
        return F.struct(at.alias("at"), F.col("value").alias("v"))

    def since_removed(when: Column) -> Column:
        return when.isNotNull() & (F.col("__gone").isNull() | (when > F.col("__gone")))

    scan = Ordered(changes, [*scope, "name"], order, hot_rows).running(
        __gone=last(F.when(op == "unset", at)), __set=last(F.when(op == "set", valued())), __tried=before(F.when(op == "once", at))
    )
    # A once counts if no other one came since the name was last removed.
    scan = scan.running(__once=last(F.when((op == "once") & ~since_removed(F.col("__tried")), valued())))
    scan = scan.running(reverse=True, __next=previous(F.col("__nth")))
    now = F.when(since_removed(F.col("__set.at")), F.col("__set.v")).when(since_removed(F.col("__once.at")), F.col("__once.v"))
    valid = cut_lineage(scan.frame().select(*scope, "name", "__nth", "__next", now.alias("__now")))

    # What is in force at the start of a block: the changes up to it that no later one of their name replaced.
    ends = valid.groupBy(*scope).agg(F.max("__nth").alias("__last"))
    first = F.expr(f"(__nth + {block - 1}) div {block}")
    upto = F.expr(f"(coalesce(__next - 1, __last)) div {block}")
    held = valid.filter(F.col("__now").isNotNull()).join(ends, scope).withColumns({"__from": first, "__to": upto}).filter("__from <= __to")
    entry = F.struct("name", F.col("__now").alias("v"))
    bases = (
        held.select(*scope, F.explode(F.sequence("__from", "__to")).alias("__block"), entry.alias("__e"))
        .groupBy(*scope, "__block")
        .agg(F.map_from_entries(F.collect_list("__e")).alias("__base"))
    )
    recent = valid.groupBy(*scope, F.expr(f"(__nth - 1) div {block}").alias("__block")).agg(
        F.collect_list(F.struct(F.col("__nth").alias("n"), "name", F.col("__now").alias("v"))).alias("__recent")
    )
    rows = known.withColumn("__block", F.when(F.col("__nth") > 0, F.expr(f"(__nth - 1) div {block}")))
    joined = rows.join(bases, [*scope, "__block"], "left").join(recent, [*scope, "__block"], "left")
    # The block's changes up to the row, each name's newest.
    so_far = F.filter("__recent", lambda c: c["n"] <= F.col("__nth"))
    newest = F.array_sort(so_far, lambda x, y: (x["n"] - y["n"]).cast("int"))
    bag = F.transform(newest, lambda c: F.struct(c["name"].alias("name"), c["v"].alias("v")))
    value_type = ops.schema["value"].dataType.simpleString()
    empty = F.create_map().cast(f"map<string,{value_type}>")
    state = F.map_filter(F.map_concat(F.coalesce("__base", empty), F.coalesce(F.map_from_entries(bag), empty)), lambda _, v: v.isNotNull())
    # A row without a key has its own operation alone.
    own = F.when(changes_it & (op != "unset") & F.col("value").isNotNull(), F.create_map("name", "value")).otherwise(empty)
    out = joined.withColumn("state", state).unionByName(numbered.filter(F.col(key).isNull()).withColumn("state", own), allowMissingColumns=True)
    return out.select(*ops.columns, "state")


def fold_super_properties(
    ops: DataFrame,
    names: Sequence[str] | None = None,
    key: str = "dev",
    time: str = "ts_us",
    seq: str = "event_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Property map after each operation: register, registerOnce, unregister (``key``, ``value``), clear.

    For each name: the newest register since it was last removed, else the first
    registerOnce since then. Blank names are ignored; a null value is no value. With ``names``, only these are kept.
    """
    kind = (
        F.when(F.col("op") == "register", "set").when(F.col("op") == "registerOnce", "once").when(F.col("op") == "unregister", "unset")
    )
    wanted = F.lit(True) if names is None else F.col("key").isin(*names)
    ops = ops.select(
        *[F.col(c).alias(f"__{i}") for i, c in enumerate((key, time, seq))],
        F.when(F.col("op") == "clear", "clear").when(wanted, kind).alias("op"),
        F.col("key").alias("name"),
        "value",
    )
    state = fold_names(ops, "__0", "__1", ["__1", "__2"], hot_rows)
    return state.select(F.col("__0").alias(key), F.col("__1").alias(time), F.col("__2").alias(seq), F.col("state").alias("props"))


def fold_error_context(
    ops: DataFrame,
    tags: Sequence[str] | None = None,
    blocks: Sequence[str] | None = None,
    key: str = "dev",
    time: str = "ts_us",
    seq: str = "event_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Error tags and context blocks after each operation.

    ``op`` is set_tag (``name``, ``value``), set_tags (``data`` replaces all tags) or set_context
    (``name``, ``data``; an empty map removes the block). Blank names are ignored. With ``tags`` or ``blocks``, only
    these are kept.
    """
    op, data = F.col("op"), F.col("data")
    head = [F.col(c).alias(f"__{i}") for i, c in enumerate((key, time, seq))]

    def step(kind: str, name: Column, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("op"), name.alias("name"), value.alias("value"))

    nothing = F.lit(None).cast("string")
    # Replacing all tags is a clear and then one set for each new tag.
    bulk = F.transform(F.map_entries(F.coalesce(data, F.create_map().cast("map<string,string>"))), lambda e: step("set", e["key"], e["value"]))
    tag_steps = (
        F.when((op == "set_tag") & F.col("value").isNull(), F.array(step("unset", F.col("name"), nothing)))
        .when(op == "set_tag", F.array(step("set", F.col("name"), F.col("value"))))
        .when(op == "set_tags", F.concat(F.array(step("clear", nothing, nothing)), bulk))
        .otherwise(F.array(step("none", nothing, nothing)))
    )
    steps = ops.select(*head, F.posexplode(tag_steps).alias("__3", "s")).select("__0", "__1", "__2", "__3", "s.*")
    if tags is not None:
        steps = steps.withColumn("op", F.when((F.col("op") == "clear") | F.col("name").isin(*tags), F.col("op")).otherwise("none"))
    tagged = fold_names(steps, "__0", "__1", ["__1", "__2", "__3"], hot_rows)
    alone_of = F.col("__0").isNull()
    # The last step of an operation has its outcome; without a key its steps do not see each other.
    after = tagged.groupBy("__0", "__1", "__2").agg(F.max_by("state", "__3").alias("tags"))
    after = after.filter(~alone_of)

    has = (op == "set_context") & (F.size(data) > 0)
    contexts = ops.select(
        *head,
        F.when(has, "set").when(op == "set_context", "unset").otherwise("none").alias("op"),
        F.col("name"),
        F.when(has, data).alias("value"),
    )
    if blocks is not None:
        contexts = contexts.withColumn("op", F.when(F.col("name").isin(*blocks), F.col("op")).otherwise("none"))
    blocked = fold_names(contexts, "__0", "__1", ["__1", "__2"], hot_rows)
    known = blocked.filter(~alone_of).select("__0", "__1", "__2", F.col("state").alias("context")).join(after, ["__0", "__1", "__2"])
    empty = F.create_map().cast("map<string,string>")
    named = F.coalesce(F.col("name"), F.lit("")) != ""
    lone_tags = F.when((op == "set_tag") & named & F.col("value").isNotNull(), F.create_map("name", "value")).when(op == "set_tags", F.map_filter(F.coalesce(data, empty), lambda _, v: v.isNotNull()))
    lone_blocks = F.when(has & named, F.create_map("name", "data")).otherwise(F.create_map().cast("map<string,map<string,string>>"))
    lone = ops.filter(F.col(key).isNull()).select(*head, lone_blocks.alias("context"), F.coalesce(lone_tags, empty).alias("tags"))
    out = known.unionByName(lone)
    return out.select(F.col("__0").alias(key), F.col("__1").alias(time), F.col("__2").alias(seq), "tags", "context")


def enrich_events(
    events: DataFrame,
    identity: DataFrame | None = None,
    consent: DataFrame | None = None,
    super_properties: DataFrame | None = None,
    device: DataFrame | None = None,
    session: DataFrame | None = None,
    scrub: bool = True,
    key: str = "dev",
    time: str = "ts_us",
    seq: str = "event_id",
    hot_rows: int = HOT_ROWS,
    measure: DataFrame | None = None,
) -> DataFrame:
    """Everything in force when an event happened, in one pass.

    Events carry ``properties`` (a string map). Property bags merge in the order super-properties,
    device, the event's own, session id, and the later wins; scrubbing comes last. ``$error``
    rows get identity and consent but no merged bags. All state logs share one shuffle. ``measure`` may name a table
    of the same keys and times that is cheaper to count.
    """
    logs = {
        "__identity": identity,
        "__consent": None if consent is None else consent.select(key, time, seq, "analytics", "errors"),
        "__super": super_properties,
        "__device": device,
        "__session": session,
    }
    out = as_of(events, {n: log for n, log in logs.items() if log is not None}, [key], time, seq, hot_rows, measure)
    empty = F.create_map().cast("map<string,string>")
    columns: list[Column] = []
    if identity is not None:
        columns += _identity_columns(key)
    if consent is not None:
        asked = F.when(F.col("name") == "$error", F.col("__consent.errors")).otherwise(F.col("__consent.analytics"))
        out = out.filter(F.coalesce(asked, F.lit(True)))
    bags = []
    if super_properties is not None:
        bags.append(F.coalesce("__super.props", empty))
    if device is not None:
        bags.append(F.coalesce("__device.payload", empty))
    bags.append(F.coalesce("properties", empty))
    if session is not None:
        now = F.col("__session.session_id")
        bags.append(F.when(now.isNotNull(), F.create_map(F.lit("sessionId"), now)).otherwise(empty))
    merged = F.map_concat(*bags)
    if scrub:
        merged = F.transform_values(merged, lambda _, v: scrub_pii(v))
    merged = F.when(F.col("name") == "$error", F.col("properties")).otherwise(merged)
    rest = [c for c in events.columns if c != "properties"]
    return out.select(*rest, merged.alias("properties"), *columns)


def latest_alias(aliases: DataFrame, by: str, time: str = "ts_us", seq: str = "event_id") -> DataFrame:
    """The newest customer id per value of ``by`` (pre-aggregated, one row each)."""
    newest = F.max_by("customer_id", F.struct(time, seq))
    return aliases.filter(F.col(by).isNotNull()).groupBy(by).agg(newest.alias("customer_id"))


def resolve_customer(
    events: DataFrame, aliases: DataFrame, user: str = "developer_user_id", anonymous: str = "dev"
) -> DataFrame:
    """Fill ``customer_id`` from alias rows by developer id, else by anonymous id.

    The alias side has one row per id, so a hot id never multiplies rows. It grows with the
    number of users, so it is not hinted: Spark broadcasts it only while small.
    """
    by_user = latest_alias(aliases, user).withColumnRenamed("customer_id", "__by_user")
    by_device = latest_alias(aliases, anonymous).withColumnRenamed("customer_id", "__by_device")
    given = F.col("customer_id") if "customer_id" in events.columns else F.lit(None).cast("string")
    # Events without a developer id have nothing to look up and would all meet in one task.
    named = events.filter(F.col(user).isNotNull()).join(by_user, user, "left")
    joined = named.unionByName(events.filter(F.col(user).isNull()), allowMissingColumns=True).join(by_device, anonymous, "left")
    rest = [c for c in events.columns if c != "customer_id"]
    return joined.select(*rest, F.coalesce(given, "__by_user", "__by_device").alias("customer_id"))


def forget(df: DataFrame, requests: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Remove rows matching a request on any id. ``columns`` maps request columns to columns of ``df``.

    One anti join per id, each on one column, instead of one join on an OR.
    """
    kept = df
    for asked, held in columns.items():
        ids = requests.filter(F.col(asked).isNotNull()).select(F.col(asked).alias(held)).distinct()
        kept = kept.join(ids, held, "left_anti")
    return kept.select(*df.columns)
