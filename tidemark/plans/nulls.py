"""Rows without a device or key: each is treated alone, so the SQL gives each a key of its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..fixtures import sql
from ..operators import delivery, screens
from ..operators.sessions import lifecycle_sessions
from .commerce import _REPLAYS
from .health import _TAPS, _VIEWS, _greedy
from .registry import query
from .sessions import _LIFECYCLE
from .sources import _OUTCOMES_SQL, timed_attempts


def _lone(view: str, key: str) -> str:
    return f"lone AS (SELECT * REPLACE (CASE WHEN event_id % 5 = 0 THEN 'alone_' || event_id ELSE {key} END AS {key}) FROM {view})"


def _nulled(df, key):
    return df.withColumn(key, F.when(F.col("event_id") % 5 != 0, F.col(key)))


_LONE_VIEWS = _greedy(_VIEWS.replace("v_fast", "lone"), "screen", 250)
_LONE_TAPS = _greedy(_TAPS.replace("v_fast", "lone"), "element", 100)


@query("coalesce_screens_without_device", sql(f"WITH {_lone('v_fast', 'dev')}, {_LONE_VIEWS} SELECT event_id FROM walked WHERE kept", "v_fast"))
def _screens(spark, sf):
    views = fx.fast(spark, sf).selectExpr("dev", "event_id", "c_ms div 8 as ts_ms", "case when k % 8 = 0 then 'b' else 'a' end as screen")
    return screens.coalesce_screens(_nulled(views, "dev")).select("event_id")


@query("coalesce_taps_without_device", sql(f"WITH {_lone('v_fast', 'dev')}, {_LONE_TAPS} SELECT event_id FROM walked WHERE kept", "v_fast"))
def _taps(spark, sf):
    taps = fx.fast(spark, sf).filter("name = 'element.clicked'").selectExpr("dev", "event_id", "c_ms as ts_ms", "concat('e', k % 2) as element")
    return screens.coalesce_taps(_nulled(taps, "dev")).select("event_id")


@query(
    "resolve_replays_without_key",
    sql(f"WITH {_lone('v_requests', 'key')}, {_REPLAYS.replace('v_requests', 'lone')} SELECT event_id, outcome FROM replayed", "v_requests"),
)
def _replays(spark, sf):
    return delivery.resolve_replays(_nulled(fx.requests(spark, sf), "key")).select("event_id", "outcome")


@query(
    "delivery_outcomes_without_key",
    sql(
        f"""WITH {_lone('v_attempts', 'key')}, {_OUTCOMES_SQL.replace('v_attempts', 'lone')}
        SELECT CASE WHEN NOT starts_with(key, 'alone') THEN key END AS key, attempts, state, next_retry_ms FROM outcomes""",
        "v_attempts",
    ),
)
def _outcomes(spark, sf):
    return delivery.delivery_outcomes(_nulled(timed_attempts(spark, sf), "key"))


@query(
    "lifecycle_sessions_without_device",
    sql(f"WITH {_lone('v_lifecycle', 'dev')}, {_LIFECYCLE.replace('v_lifecycle', 'lone')} SELECT event_id, name, reason, duration_ms FROM emitted", "v_lifecycle"),
)
def _lifecycle(spark, sf):
    return lifecycle_sessions(_nulled(fx.lifecycle(spark, sf), "dev")).select("event_id", "name", "reason", "duration_ms")
