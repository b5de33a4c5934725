"""Redelivery, sessions, lifecycle, funnels."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..fixtures import sql
from ..operators.delivery import dedup_events
from ..operators.sessions import (
    attach_session,
    lifecycle_sessions,
    session_funnel,
    session_log,
    session_summary,
    sessionize,
)
from ..session import cut_lineage
from .registry import query

_DEDUPED = """
    deduped AS (SELECT event_id, first(ts_us ORDER BY received_us) AS ts_us, first(dev ORDER BY received_us) AS dev,
                first(name ORDER BY received_us) AS name, min(received_us) AS received_us
                FROM v_redelivered GROUP BY event_id)"""

_SESSIONS = """
    flagged AS (SELECT *, CASE WHEN ts_us - lag(ts_us) OVER w < 1800000000 THEN 0 ELSE 1 END AS is_new
                FROM {source} WINDOW w AS (PARTITION BY dev ORDER BY ts_us, event_id)),
    sessions AS (SELECT *, CAST(sum(is_new) OVER (PARTITION BY dev ORDER BY ts_us, event_id) AS BIGINT) AS session_no
                 FROM flagged)"""

_LIFECYCLE = """
    folded AS (
      SELECT dev, list_reduce(list_prepend(
               {'bg': NULL::BIGINT, 'open': false, 'start': NULL::BIGINT, 'sid': NULL::BIGINT,
                'out': []::STRUCT(ts_us BIGINT, event_id BIGINT, name VARCHAR, sid BIGINT, reason VARCHAR, duration_ms BIGINT)[]},
               list({'bg': ts_us, 'open': false, 'start': event_id, 'sid': NULL::BIGINT,
                     'out': [{'ts_us': ts_us, 'event_id': event_id, 'name': op, 'sid': NULL::BIGINT, 'reason': '', 'duration_ms': NULL::BIGINT}]}
                    ORDER BY ts_us, event_id)),
             lambda s, x: {
               'bg': CASE WHEN x.out[1].name = 'background' THEN x.bg ELSE s.bg END,
               'open': x.out[1].name <> 'background',
               'start': CASE WHEN x.out[1].name = 'reset' OR (x.out[1].name = 'foreground'
                                  AND (NOT s.open OR s.bg IS NULL OR x.bg - s.bg >= 1800000000)) THEN x.bg ELSE s.start END,
               'sid': CASE WHEN x.out[1].name = 'reset' OR (x.out[1].name = 'foreground'
                                  AND (NOT s.open OR s.bg IS NULL OR x.bg - s.bg >= 1800000000)) THEN x.start ELSE s.sid END,
               'out': list_concat(list_concat(s.out,
                 CASE WHEN s.open AND x.out[1].name IN ('background', 'reset') THEN
                   [{'ts_us': x.bg, 'event_id': x.start, 'name': 'session.ended', 'sid': s.sid,
                     'reason': CASE WHEN x.out[1].name = 'reset' THEN 'manual_reset' ELSE 'background' END,
                     'duration_ms': (x.bg - s.start) // 1000}] ELSE [] END),
                 CASE WHEN x.out[1].name = 'reset' THEN
                   [{'ts_us': x.bg, 'event_id': x.start, 'name': 'session.started', 'sid': x.start,
                     'reason': 'manual_reset', 'duration_ms': NULL::BIGINT}]
                 WHEN x.out[1].name = 'foreground' AND (NOT s.open OR s.bg IS NULL OR x.bg - s.bg >= 1800000000) THEN
                   [{'ts_us': x.bg, 'event_id': x.start, 'name': 'session.started', 'sid': x.start,
                     'reason': CASE WHEN s.bg IS NULL OR x.bg - s.bg >= 1800000000 THEN 'resume_idle' ELSE 'resume' END,
                     'duration_ms': NULL::BIGINT}] ELSE [] END)}) AS s
      FROM v_lifecycle GROUP BY dev),
    emitted AS (SELECT dev, e.ts_us, e.event_id, e.name, 'ses_' || dev || '_' || e.sid AS session_id, e.reason, e.duration_ms
                FROM (SELECT dev, unnest(s.out) AS e FROM folded))"""


@query(
    "dedup_events",
    sql(f"WITH {_DEDUPED} SELECT event_id, ts_us, dev, name, received_us FROM deduped", "v_redelivered"),
)
def _dedup(spark, sf):
    return dedup_events(fx.redelivered(spark, sf).select("event_id", "ts_us", "dev", "name", "received_us"))


@query(
    "sessionize",
    sql(
        f"WITH {_SESSIONS.format(source='v_events')} "
        "SELECT event_id, dev, session_no, dev || '_s' || session_no AS session_id FROM sessions",
        "v_events",
    ),
)
def _sessionize(spark, sf):
    return sessionize(fx.events(spark, sf).select("event_id", "dev", "ts_us")).drop("ts_us")


@query(
    "session_summary",
    sql(
        f"""WITH {_DEDUPED}, {_SESSIONS.format(source='deduped')}
        SELECT dev, dev || '_s' || session_no AS session_id, min(ts_us) AS start_us, max(ts_us) AS end_us,
               (max(ts_us) - min(ts_us)) // 1000 AS duration_ms, count(*) AS events,
               CASE WHEN session_no = max(session_no) OVER (PARTITION BY dev) THEN 'open' ELSE 'idle' END AS end_reason
        FROM sessions GROUP BY dev, session_no""",
        "v_redelivered",
    ),
)
def _session_summary(spark, sf):
    log = fx.redelivered(spark, sf).select("event_id", "ts_us", "dev", "received_us")
    return session_summary(sessionize(dedup_events(log), measure=log))


@query("lifecycle_sessions", sql(f"WITH {_LIFECYCLE} SELECT * FROM emitted", "v_lifecycle"))
def _lifecycle(spark, sf):
    return lifecycle_sessions(fx.lifecycle(spark, sf))


@query(
    "attach_session",
    sql(
        f"""WITH {_LIFECYCLE},
        log AS (SELECT dev, ts_us, event_id, max(session_id) FILTER (WHERE name = 'session.started') AS session_id
                FROM emitted GROUP BY ALL)
        SELECT e.event_id, e.dev, l.session_id
        FROM v_events e ASOF LEFT JOIN log l ON e.dev = l.dev AND e.ts_us >= l.ts_us""",
        "v_lifecycle",
    ),
)
def _attach_session(spark, sf):
    log = cut_lineage(session_log(lifecycle_sessions(fx.lifecycle(spark, sf))))
    return attach_session(fx.events(spark, sf).select("event_id", "dev", "ts_us"), log).drop("ts_us")


@query(
    "session_funnel",
    sql(
        f"""WITH {_SESSIONS.format(source='v_events')},
        s1 AS (SELECT dev, session_no, min((ts_us, event_id)) AS at FROM sessions WHERE name = 'page.viewed' GROUP BY ALL),
        s2 AS (SELECT s.dev, s.session_no, min((s.ts_us, s.event_id)) AS at FROM sessions s JOIN s1 USING (dev, session_no)
               WHERE s.name = 'element.clicked' AND (s.ts_us, s.event_id) > s1.at GROUP BY ALL),
        s3 AS (SELECT s.dev, s.session_no, min((s.ts_us, s.event_id)) AS at FROM sessions s JOIN s2 USING (dev, session_no)
               WHERE s.name = 'purchase.completed' AND (s.ts_us, s.event_id) > s2.at GROUP BY ALL)
        SELECT a.dev || '_s' || a.session_no AS session_id,
               (s1.at IS NOT NULL)::INT + (s2.at IS NOT NULL)::INT + (s3.at IS NOT NULL)::INT AS steps_reached
        FROM (SELECT DISTINCT dev, session_no FROM sessions) a LEFT JOIN s1 USING (dev, session_no)
        LEFT JOIN s2 USING (dev, session_no) LEFT JOIN s3 USING (dev, session_no)""",
        "v_events",
    ),
)
def _session_funnel(spark, sf):
    s = cut_lineage(sessionize(fx.events(spark, sf).select("event_id", "dev", "ts_us", "name")))
    return session_funnel(s, ["page.viewed", "element.clicked", "purchase.completed"])
