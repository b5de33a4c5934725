"""Outcomes, retries, buffers, screens, frames, launches, connectivity."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..fixtures import sql
from ..functions.wire import classify_outcome, decode_error_envelope, parse_retry_after
from ..operators import delivery, screens, vitals
from .registry import query
from .sources import _OUTCOME_SQL, timed_attempts


@query("classify_outcome", sql(f"SELECT event_id, status, {_OUTCOME_SQL} AS outcome FROM v_responses", "v_responses"))
def _classify(spark, sf):
    return fx.responses(spark, sf).select("event_id", "status", classify_outcome(F.col("status")).alias("outcome"))


@query(
    "decode_error_envelope",
    sql(
        """SELECT event_id, status,
          CASE WHEN k % 8 = 0 THEN 'invalid_request_error' WHEN k % 4 IN (0, 1) THEN 'internal_error'
               WHEN status = 400 THEN 'invalid_request_error' WHEN status = 429 THEN 'rate_limit_error' ELSE 'internal_error' END AS type,
          CASE WHEN k % 4 = 0 THEN 'c_' || k WHEN status = 400 THEN 'bad_request' WHEN status = 429 THEN 'rate_limited' WHEN status = 503 THEN 'server_error'
               ELSE 'http_' || status END AS code,
          CASE WHEN k % 4 = 0 THEN 'm ' || k WHEN k % 4 = 1 THEN 'only ' || k WHEN status = 400 THEN 'Request was malformed.'
               WHEN status = 429 THEN 'Rate limit exceeded — back off and retry.' WHEN status = 503 THEN 'Server error — the service will retry.'
               ELSE 'Request failed with HTTP ' || status || '.' END AS message,
          CASE WHEN k % 4 = 0 THEN 'req_b' || event_id ELSE 'req_h' || event_id END AS request_id
        FROM v_responses WHERE status >= 400""",
        "v_responses",
    ),
)
def _envelope(spark, sf):
    failed = fx.responses(spark, sf).filter("status >= 400")
    error = decode_error_envelope(F.col("status"), F.col("body"), F.col("header_request_id"))
    return failed.select("event_id", error.alias("e")).select("event_id", "e.*")


@query(
    "parse_retry_after",
    sql(
        """SELECT event_id, CASE k % 6 WHEN 0 THEN k * 1000 WHEN 2 THEN greatest(0, (received_ms // 1000 + k * 60) * 1000 - received_ms)
           WHEN 3 THEN 0 END AS wait_ms FROM v_responses""",
        "v_responses",
    ),
)
def _retry_after(spark, sf):
    header = F.expr(
        "case k % 6 when 0 then concat(' ', k, ' ') when 1 then '-5' "
        "when 2 then date_format(timestamp_seconds(received_ms div 1000 + k * 60), \"EEE, dd MMM yyyy HH:mm:ss 'GMT'\") "
        "when 3 then 'Mon, 01 Jan 2001 00:00:00 GMT' when 4 then 'soon' end"
    )
    return fx.responses(spark, sf).select("event_id", parse_retry_after(header, F.col("received_ms")).alias("wait_ms"))


@query(
    "retry_audit",
    sql(
        f"""WITH t AS (SELECT *, {_OUTCOME_SQL} AS kind, count(*) FILTER (WHERE {_OUTCOME_SQL} = 'retryable') OVER w - 1 AS n, lead(ts_ms) OVER (PARTITION BY key ORDER BY ts_ms, event_id) - ts_ms AS gap_ms
               FROM v_attempts WINDOW w AS (PARTITION BY key ORDER BY ts_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
        c AS (SELECT *, CASE WHEN kind = 'retryable' AND n < 5 THEN CASE WHEN retry_after_s > 0 THEN least(retry_after_s * 1000, 86400000)
               ELSE CAST(least(1000 * pow(2, n), 30000) AS BIGINT) END END AS ceiling_ms FROM t)
        SELECT key, ts_ms, event_id, CASE WHEN kind = 'retryable' THEN n END AS retry_no, ceiling_ms, gap_ms, coalesce(gap_ms > ceiling_ms, false) AS late,
          coalesce(retry_after_s > 0 AND gap_ms < ceiling_ms, false) AS early FROM c""",
        "v_attempts",
    ),
)
def _retry_audit(spark, sf):
    return delivery.retry_audit(timed_attempts(spark, sf))


@query(
    "first_event_sent",
    sql(
        "SELECT user_id % 40 AS app, r.ts_ms, r.event_id FROM (SELECT user_id % 40 AS user_id, min({'ts_ms': ts_us // 1000, 'event_id': event_id}) AS r FROM v_events WHERE k < 60 GROUP BY ALL)",
        "v_events",
    ),
)
def _first_sent(spark, sf):
    delivered = fx.events(spark, sf).filter("k < 60").selectExpr("user_id % 40 as app", "ts_us div 1000 as ts_ms", "event_id")
    return delivery.first_event_sent(delivered)


_RANKED = "ranked AS (SELECT *, row_number() OVER (PARTITION BY dev ORDER BY ts_us DESC, event_id DESC) AS n FROM v_events)"


@query("keep_latest", sql(f"WITH {_RANKED} SELECT event_id, dev FROM ranked WHERE n <= 40", "v_events"))
def _keep_latest(spark, sf):
    kept, _ = delivery.keep_latest(fx.events(spark, sf).select("event_id", "dev", "ts_us"), 40)
    return kept.select("event_id", "dev")


@query("keep_latest_dropped", sql("SELECT dev, count(*) - 40 AS dropped FROM v_events GROUP BY dev HAVING count(*) > 40", "v_events"))
def _dropped(spark, sf):
    return delivery.keep_latest(fx.events(spark, sf).select("event_id", "dev", "ts_us"), 40)[1]


def _greedy(source: str, what: str, window: int) -> str:
    return f"""
    rows_ AS ({source}), numbered AS (SELECT *, row_number() OVER (PARTITION BY dev ORDER BY c_ms, event_id) AS n FROM rows_),
    walked AS (
      WITH RECURSIVE w AS (
        SELECT dev, n, event_id, true AS kept, {what} AS at_what, c_ms AS at_ms FROM numbered WHERE n = 1
        UNION ALL
        SELECT x.dev, x.n, x.event_id, x.{what} <> w.at_what OR x.c_ms - w.at_ms >= {window},
               CASE WHEN x.{what} <> w.at_what OR x.c_ms - w.at_ms >= {window} THEN x.{what} ELSE w.at_what END,
               CASE WHEN x.{what} <> w.at_what OR x.c_ms - w.at_ms >= {window} THEN x.c_ms ELSE w.at_ms END
        FROM w JOIN numbered x ON x.dev = w.dev AND x.n = w.n + 1)
      SELECT * FROM w)"""


_VIEWS = "SELECT dev, event_id, c_ms // 8 AS c_ms, CASE WHEN k % 8 = 0 THEN 'b' ELSE 'a' END AS screen FROM v_fast"


@query("coalesce_screens", sql(f"WITH {_greedy(_VIEWS, 'screen', 250)} SELECT dev, event_id FROM walked WHERE kept", "v_fast"))
def _screens(spark, sf):
    views = fx.fast(spark, sf).selectExpr("dev", "event_id", "c_ms div 8 as ts_ms", "case when k % 8 = 0 then 'b' else 'a' end as screen")
    return screens.coalesce_screens(views).select("dev", "event_id")


_TAPS = "SELECT dev, event_id, c_ms, 'e' || (k % 2) AS element FROM v_fast WHERE name = 'element.clicked'"


@query("coalesce_taps", sql(f"WITH {_greedy(_TAPS, 'element', 100)} SELECT dev, event_id FROM walked WHERE kept", "v_fast"))
def _taps(spark, sf):
    taps = fx.fast(spark, sf).filter("name = 'element.clicked'").selectExpr("dev", "event_id", "c_ms as ts_ms", "concat('e', k % 2) as element")
    return screens.coalesce_taps(taps).select("dev", "event_id")


@query(
    "frame_jank",
    sql(
        """WITH d AS (SELECT dev, frame_ns, frame_ns - lag(frame_ns) OVER (PARTITION BY dev ORDER BY frame_ns, event_id) AS delta FROM v_frames)
        SELECT dev, frame_ns // 5000000000 * 5000000000 AS window_start_ns, count(*) AS total_frames, count(*) FILTER (WHERE delta > 16000000 AND delta <= 700000000) AS slow_frames,
               count(*) FILTER (WHERE delta > 700000000) AS frozen_frames, round(count(*) FILTER (WHERE delta > 16000000 AND delta <= 700000000) * 100.0 / count(*), 2) AS slow_pct,
               round(count(*) FILTER (WHERE delta > 700000000) * 100.0 / count(*), 2) AS frozen_pct
        FROM d WHERE delta IS NOT NULL GROUP BY ALL""",
        "v_frames",
    ),
)
def _jank(spark, sf):
    return vitals.frame_jank(fx.frames(spark, sf), window_ns=5_000_000_000)


@query(
    "cold_launches",
    sql(
        """SELECT process_id, f.ts_us, f.version, f.elapsed_ms FROM (SELECT dev || ':' || (event_id % 3) AS process_id,
             arg_min({'ts_us': ts_us, 'version': version, 'elapsed_ms': elapsed_ms}, (ts_us, event_id)) AS f FROM v_launches GROUP BY ALL) WHERE f.elapsed_ms > 0""",
        "v_launches",
    ),
)
def _cold_launches(spark, sf):
    return _first_foregrounds(spark, sf).select("process_id", "ts_us", "version", "elapsed_ms")


def _first_foregrounds(spark, sf):
    return vitals.cold_launches(
        fx.launches(spark, sf).select(
            F.concat("dev", F.lit(":"), (F.col("event_id") % 3).cast("string")).alias("process_id"),
            "ts_us",
            "event_id",
            "version",
            "elapsed_ms",
        )
    )


@query(
    "cold_launch_summary",
    sql(
        """SELECT version, count(*) AS launches, quantile_disc(elapsed_ms, 0.5) AS p50_ms, quantile_disc(elapsed_ms, 0.9) AS p90_ms FROM (
           SELECT f.version AS version, f.elapsed_ms AS elapsed_ms FROM (SELECT arg_min({'version': version, 'elapsed_ms': elapsed_ms}, (ts_us, event_id)) AS f
             FROM v_launches GROUP BY dev, event_id % 3) WHERE f.elapsed_ms > 0) GROUP BY version""",
        "v_launches",
    ),
)
def _launch_summary(spark, sf):
    return vitals.cold_launch_summary(_first_foregrounds(spark, sf))


@query(
    "rising_edges",
    sql(
        "SELECT dev, event_id FROM (SELECT *, coalesce(lag(online) OVER (PARTITION BY dev ORDER BY ts_us, event_id), true) AS was FROM v_connectivity) WHERE online AND NOT was",
        "v_connectivity",
    ),
)
def _edges(spark, sf):
    return vitals.rising_edges(fx.connectivity(spark, sf)).select("dev", "event_id")


@query(
    "detect_stalls",
    sql(
        "SELECT dev, event_id, stall FROM (SELECT dev, event_id, lead(c_ms) OVER (PARTITION BY dev ORDER BY c_ms, event_id) - c_ms AS stall FROM v_fast) WHERE stall > 5000",
        "v_fast",
    ),
)
def _stalls(spark, sf):
    beats = fx.fast(spark, sf).select("dev", "event_id", "c_ms")
    return vitals.detect_stalls(beats, threshold=5000, time="c_ms").select("dev", "event_id", "stall")
