"""Stacks, breadcrumbs, fatals and error groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..fixtures import sql
from ..functions.stacks import fingerprint, parse_stack, parse_stack_text
from ..operators import errors as err
from .registry import query

_FRAMES = """
    stacks AS (SELECT event_id, type, k, list_transform(range(n_frames), lambda i: 'com.app.m' || (i % 3) || ':C' || (k % 5) || '.f' || i) AS frames FROM v_errors)"""
_PRINT = "CASE WHEN len(frames) = 0 THEN type || ':no_stack' ELSE array_to_string(frames[1:5], '|') END"


@query(
    "parse_stack",
    sql(
        f"""WITH {_FRAMES} SELECT event_id, i::INT AS frame_number, split_part(f, ':', 1) AS module, split_part(f, ':', 2) AS symbol, 'C' || (k % 5) || '.kt' AS file_name,
        CASE WHEN i * 10 - 10 >= 0 THEN (i * 10 - 10)::INT END AS line_number
        FROM (SELECT event_id, k, unnest(frames) AS f, unnest(range(len(frames))) AS i FROM stacks)""",
        "v_errors",
    ),
)
def _parse(spark, sf):
    e = fx.errors(spark, sf).select("event_id", F.explode(parse_stack(F.col("frames"))).alias("f"))
    return e.select("event_id", "f.*")


@query(
    "parse_stack_text",
    sql(
        f"""WITH {_FRAMES} SELECT event_id, array_to_string(frames, '|') AS stack FROM stacks""",
        "v_errors",
    ),
)
def _parse_text(spark, sf):
    printed = F.concat(
        F.lit("java.lang.Error: x\n"),
        F.array_join(
            F.transform(
                "frames",
                lambda f: F.concat(F.lit("\tat "), f["className"], F.lit("."), f["methodName"], F.lit("("), f["fileName"], F.lit(":"), f["lineNumber"].cast("string"), F.lit(")")),
            ),
            "\n",
        ),
    )
    parsed = parse_stack(parse_stack_text(printed))
    named = F.transform(parsed, lambda f: F.concat_ws(":", f["module"], f["symbol"]))
    return fx.errors(spark, sf).select("event_id", F.array_join(named, "|").alias("stack"))


@query("fingerprint", sql(f"WITH {_FRAMES} SELECT event_id, {_PRINT} AS fingerprint FROM stacks", "v_errors"))
def _fingerprint(spark, sf):
    e = fx.errors(spark, sf)
    return e.select("event_id", fingerprint(parse_stack(F.col("frames")), F.col("type")).alias("fingerprint"))


_CRUMBS = """
    crumbs AS (SELECT dev, ts_us, event_id, 'track ' || name AS message FROM v_events WHERE name <> '$error'
               UNION ALL SELECT dev, ts_us, event_id, 'identify ' || trim("user") FROM v_identity_log WHERE op = 'identify'),
    resets AS (SELECT dev, ts_us, event_id FROM v_identity_log WHERE op = 'reset'),
    since AS (SELECT e.event_id, e.dev, e.ts_us, max(r.ts_us) AS reset_us FROM v_errors e LEFT JOIN resets r ON r.dev = e.dev AND r.ts_us <= e.ts_us GROUP BY ALL),
    picked AS (SELECT s.event_id, list(c.message ORDER BY c.ts_us, c.event_id, c.message DESC) AS messages, list(c.ts_us ORDER BY c.ts_us, c.event_id, c.message DESC) AS times
               FROM since s JOIN crumbs c ON c.dev = s.dev AND c.ts_us <= s.ts_us AND (s.reset_us IS NULL OR c.ts_us >= s.reset_us) GROUP BY s.event_id)"""


def _with_crumbs(spark, sf, n=5):
    events, ids = fx.events(spark, sf), fx.identity_log(spark, sf)
    # An identify and the event it rides on share a time and id: tell them apart.
    tracked = err.crumbs_from_events(events).withColumn("event_id", F.col("event_id") * 2)
    named = err.crumbs_from_identity(ids).withColumn("event_id", F.col("event_id") * 2 + 1)
    crumbs = tracked.unionByName(named)
    resets = ids.filter("op = 'reset'").select("dev", "ts_us", "event_id")
    return err.attach_breadcrumbs(fx.errors(spark, sf), crumbs, resets, n)


@query(
    "attach_breadcrumbs",
    sql(
        f"""WITH {_CRUMBS} SELECT e.event_id, coalesce(array_to_string(messages[-5:], '|'), '') AS crumbs, coalesce(times[-5:][1], 0) AS oldest_us
        FROM v_errors e LEFT JOIN picked USING (event_id)""",
        "v_errors",
        "v_identity_log",
    ),
)
def _breadcrumbs(spark, sf):
    out = _with_crumbs(spark, sf)
    crumbs = F.col("breadcrumbs")
    oldest = F.when(F.size(crumbs) > 0, F.element_at(crumbs, 1)["ts_us"]).otherwise(0)
    return out.select(
        "event_id", F.array_join(F.transform(crumbs, lambda c: c["message"]), "|").alias("crumbs"), oldest.alias("oldest_us")
    )


@query(
    "recover_fatals",
    sql(
        """WITH l AS (SELECT dev, ts_us, event_id, lag(ts_us) OVER (PARTITION BY dev ORDER BY ts_us, event_id) AS prior FROM v_launches)
        SELECT l.event_id, arg_max(e.event_id, (e.ts_us, e.event_id)) AS fatal_id, arg_max(e.type, (e.ts_us, e.event_id)) AS type,
               least(arg_max(e.n_frames, (e.ts_us, e.event_id)), 50)::INT AS n_frames
        FROM l JOIN v_errors e ON e.dev = l.dev AND e.fatal AND e.ts_us <= l.ts_us AND (l.prior IS NULL OR e.ts_us > l.prior) GROUP BY l.event_id""",
        "v_errors",
        "v_launches",
    ),
)
def _fatals(spark, sf):
    out = err.recover_fatals(fx.errors(spark, sf), fx.launches(spark, sf))
    return out.select("event_id", "fatal_id", "type", F.size("stack").alias("n_frames"))


def _wire_errors(spark, sf):
    rows = _with_crumbs(spark, sf).withColumns(
        {
            "handled": ~F.col("fatal"),
            "tags": F.expr("case when k % 2 = 0 then map('mail', concat('t', k, '@x.io')) else cast(map() as map<string,string>) end"),
            "context": F.expr("map('cart', map('card', '4242 4242 4242 4242'))"),
        }
    )
    return err.error_rows_to_events(rows.drop("k", "messages"))


@query(
    "error_rows_to_events",
    sql(
        f"""WITH {_FRAMES}, {_CRUMBS} SELECT e.event_id, e.type AS error_type, 'failed for <email> at ' || e.k AS error_message, {_PRINT} AS fingerprint, NOT e.fatal AS handled,
        e.ts_us // 1000 AS timestamp_ms, CASE WHEN len(frames) > 0 THEN array_to_string(frames, '|') END AS stack, CASE WHEN e.k % 2 = 0 THEN '<email>' END AS tag,
        '<card>' AS card, CASE WHEN messages IS NOT NULL THEN least(len(messages), 5)::INT END AS crumbs, messages[-1] AS newest
        FROM v_errors e JOIN stacks s USING (event_id) LEFT JOIN picked p USING (event_id)""".replace("{_PRINT}", _PRINT).replace(
            "THEN type ||", "THEN e.type ||"
        ),
        "v_errors",
        "v_identity_log",
    ),
)
def _to_events(spark, sf):
    out = _wire_errors(spark, sf)
    crumbs = F.col("error_breadcrumbs")
    return out.select(
        "event_id",
        "error_type",
        "error_message",
        F.col("error_fingerprint").alias("fingerprint"),
        F.col("error_handled").alias("handled"),
        F.col("error_timestamp_ms").alias("timestamp_ms"),
        F.array_join("error_stack", "|").alias("stack"),
        F.try_element_at("error_tags", F.lit("mail")).alias("tag"),
        F.try_element_at(F.try_element_at("error_context", F.lit("cart")), F.lit("card")).alias("card"),
        F.when(crumbs.isNotNull(), F.size(crumbs)).alias("crumbs"),
        F.when(crumbs.isNotNull(), F.element_at(crumbs, -1)["message"]).alias("newest"),
    )


@query(
    "captured_messages",
    sql("SELECT event_id, 'internal_error' AS error_type, 'failed for <email> at ' || k AS error_message, 'internal_error:no_stack' AS fingerprint, true AS handled FROM v_errors", "v_errors"),
)
def _captured(spark, sf):
    rows = err.captured_messages(fx.errors(spark, sf).select("event_id", "ts_us", "message"))
    out = err.error_rows_to_events(rows)
    return out.select(
        "event_id", "error_type", "error_message", F.col("error_fingerprint").alias("fingerprint"), F.col("error_handled").alias("handled")
    )


@query(
    "error_groups",
    sql(
        f"""WITH {_FRAMES} SELECT {_PRINT} AS error_fingerprint, count(*) AS errors, count(DISTINCT e.user_id) AS users, min(e.ts_us) AS first_seen_us,
        max(e.ts_us) AS last_seen_us, round(count(*) FILTER (WHERE NOT e.fatal) / count(*), 4) AS handled_share
        FROM v_errors e JOIN stacks s USING (event_id) GROUP BY ALL""".replace("THEN type ||", "THEN e.type ||"),
        "v_errors",
    ),
)
def _groups(spark, sf):
    rows = fx.errors(spark, sf).withColumn("handled", ~F.col("fatal"))
    return err.error_groups(err.error_rows_to_events(rows))
