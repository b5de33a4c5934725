"""Adapter views: the driver's tables in the shapes the rules read.

Every view exists twice, as a DataFrame here and as a DuckDB common table
expression in ``VIEWS``, so that a query and its SQL start from the same rows.
``k`` is the integer in ``props``; ``dev`` is the device; order is (time, event_id).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import checkpoint_dir, configure

EVENT_NAMES = {
    "view": "page.viewed",
    "click": "element.clicked",
    "purchase": "purchase.completed",
    "error": "$error",
    "signup": "group.set",
}


# The device of the row that ends a stream.
END_DEVICE = "anon_-1"


@dataclass(frozen=True)
class Streams:
    """Stands in for the session where a view is to be opened as a stream of files.

    The event log arrives in ``batches`` micro-batches of ``files`` files each, an event up to ``delay_us`` after its
    time, so rows come out of order within a micro-batch and across them. ``arrival`` is an SQL expression of the time
    of arrival instead; ``__at`` is the event's time, and {low} and {high} are the log's first and last. With ``end``, a
    last file holds a row of each kind of ``END_DEVICE``, with the id -1 and later than all others, so that what waits
    for the watermark comes out.
    """

    spark: SparkSession
    batches: int = 3
    end: bool = False
    files: int = 4
    delay_us: int = 0
    arrival: str = ""
    #: Folders of logs already written, so that views of one log read the same files.
    written: dict = field(default_factory=dict, compare=False)


def table(spark: SparkSession | Streams, sf_dir: str, name: str) -> DataFrame:
    if isinstance(spark, Streams):
        return _event_files(spark, sf_dir, name)
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _event_files(streams: Streams, sf_dir: str, name: str) -> DataFrame:
    """The log cut by time of arrival into parts written one after the other, opened as one part a micro-batch."""
    spark = streams.spark
    log = table(spark, sf_dir, name)
    if (sf_dir, name) not in streams.written:
        streams.written[sf_dir, name] = _write_event_files(streams, log)
    base = streams.written[sf_dir, name]
    return spark.readStream.schema(log.schema).option("maxFilesPerTrigger", streams.files).parquet(f"{base}/part=*")


def _write_event_files(streams: Streams, log: DataFrame) -> str:
    spark = streams.spark
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = log.agg(F.min(micros), F.max(micros)).first()
    step = (high + streams.delay_us - low) // streams.batches + 1
    base = f"{checkpoint_dir(spark)}/log-{uuid.uuid4().hex}"
    arrival = streams.arrival or f"__at + pmod(xxhash64(event_id), {streams.delay_us + 1})"
    part = F.expr(f"cast(({arrival.format(low=low, high=high)} - {low}) div {step} as int)")
    cut = log.withColumn("__at", micros).withColumn("__part", part).drop("__at")
    for i in range(streams.batches):
        cut.filter(F.col("__part") == i).drop("__part").repartition(streams.files).write.parquet(f"{base}/part={i}")
    if streams.end:
        last = {"event_id": "-1L", "ts": f"cast(timestamp_micros({high} + 172800000000) as timestamp_ntz)", "user_id": "-1L", "value": "0D", "props": "'{\"k\": 0}'"}
        kinds = spark.createDataFrame([(kind,) for kind in EVENT_NAMES], "event_type string")
        rows = kinds.select(*[F.expr(last.get(f.name, f.name)).cast(f.dataType).alias(f.name) for f in log.schema.fields])
        rows.coalesce(1).write.parquet(f"{base}/part={streams.batches}")
    return base


def events(spark: SparkSession | Streams, sf_dir: str) -> DataFrame:
    name = F.coalesce(*[F.when(F.col("event_type") == t, n) for t, n in EVENT_NAMES.items()])
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"),
        "user_id",
        F.concat(F.lit("anon_"), F.col("user_id")).alias("dev"),
        name.alias("name"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        "value",
    )


def _of(spark: SparkSession | Streams, sf_dir: str, *names: str) -> DataFrame:
    return events(spark, sf_dir).filter(F.col("name").isin(*names))


def redelivered(spark: SparkSession | Streams, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    copy = ev.filter("event_id % 7 = 0").withColumn("received_us", F.expr("ts_us + (k + 1) * 60000000L"))
    return ev.withColumn("received_us", F.col("ts_us")).unionByName(copy)


def fast(spark: SparkSession | Streams, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).withColumn("c_ms", F.expr("ts_us div 1000 div 20000"))


def frames(spark: SparkSession | Streams, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr("dev", "event_id", "ts_us div 100 as frame_ns")


def identity_log(spark: SparkSession | Streams, sf_dir: str) -> DataFrame:
    return _of(spark, sf_dir, "group.set").selectExpr(
        "dev",
        "ts_us",
        "event_id",
        "user_id",
        "case when k % 10 = 0 then 'reset' when k % 10 < 4 then 'alias' else 'identify' end as op",
        "case when k % 10 = 0 then null when k % 10 = 4 then '  ' "
        "else concat(' user_', user_id, '_', k % 3, ' ') end as user",
        "concat('cust_', user_id, '_', k % 2) as customer",
    )


def consent_log(spark: SparkSession | Streams, sf_dir: str) -> DataFrame:
    return _of(spark, sf_dir, "group.set").selectExpr(
        "dev", "ts_us", "event_id", "k % 5 <> 0 as analytics", "k % 7 <> 0 as errors"
    )


def super_log(spark: SparkSession | Streams, sf_dir: str) -> DataFrame:
    return _of(spark, sf_dir, "element.clicked").selectExpr(
        "dev",
        "ts_us",
        "event_id",
        "case k % 4 when 0 then 'register' when 1 then 'registerOnce' when 2 then 'unregister' else 'clear' end as op",
        "case when k % 4 = 3 then null when k % 19 = 0 then '' when event_id % 2 = 0 then 'plan' else 'tier' end as key",
        "cast(k as string) as value",
    )


def lifecycle(spark: SparkSession | Streams, sf_dir: str) -> DataFrame:
    return _of(spark, sf_dir, "page.viewed", "element.clicked", "group.set").selectExpr(
        "dev",
        "ts_us",
        "event_id",
        "case name when 'page.viewed' then 'foreground' when 'element.clicked' then 'background' else 'reset' end as op",
    )


def connectivity(spark: SparkSession | Streams, sf_dir: str) -> DataFrame:
    return _of(spark, sf_dir, "page.viewed").selectExpr("dev", "ts_us", "event_id", "k % 3 <> 0 as online")


def errors(spark: SparkSession | Streams, sf_dir: str) -> DataFrame:
    return _of(spark, sf_dir, "$error").selectExpr(
        "event_id",
        "dev",
        "ts_us",
        "user_id",
        "k",
        "concat('com.app.E', k % 4) as type",
        "concat('failed for u', user_id, '@example.com at ', k) as message",
        "case when k % 7 = 0 then array() else transform(sequence(0, k % 7 - 1), i -> named_struct("
        "'className', concat('com.app.m', i % 3, '.C', k % 5), 'methodName', concat('f', i), "
        "'fileName', concat('C', k % 5, '.kt'), 'lineNumber', i * 10 - 10)) end as frames",
        "array(concat('failed ', k), case when k % 9 = 0 then 'call to API.Ingest.Example failed' else 'other' end) as messages",
        "k % 2 = 0 as fatal",
    )


def launches(spark: SparkSession | Streams, sf_dir: str) -> DataFrame:
    return _of(spark, sf_dir, "group.set").selectExpr(
        "dev", "ts_us", "event_id", "cast(floor(value * 10) as bigint) - 50 as elapsed_ms", "concat('1.', k % 3) as version"
    )


_STATUS = (
    "case when k < 60 then 202 when k < 70 then 400 when k < 75 then 408 "
    "when k < 80 then 429 when k < 95 then 503 end"
)


def attempts(spark: SparkSession | Streams, sf_dir: str) -> DataFrame:
    return _of(spark, sf_dir, "purchase.completed").selectExpr(
        "concat('batch_', event_id % 300) as key",
        "ts_us div 1000 as ts_ms",
        "event_id",
        f"{_STATUS} as status",
        f"case when {_STATUS} = 429 then cast(k as string) end as retry_after",
    )


def responses(spark: SparkSession | Streams, sf_dir: str) -> DataFrame:
    return _of(spark, sf_dir, "purchase.completed").selectExpr(
        "event_id",
        "ts_us div 1000 as received_ms",
        "k",
        f"{_STATUS} as status",
        "concat('req_h', event_id) as header_request_id",
        "case k % 4 when 0 then concat('{\"error\":{\"type\":\"', "
        "case when k % 8 = 0 then 'invalid_request_error' else 'no_such_type' end, "
        "'\",\"code\":\"c_', k, '\",\"message\":\"m ', k, '\",\"request_id\":\"req_b', event_id, '\"}}') "
        "when 1 then concat('{\"error\":{\"code\":\"\",\"message\":\"only ', k, '\"}}') "
        "when 2 then '<html>bad gateway</html>' end as body",
    )


def requests(spark: SparkSession | Streams, sf_dir: str) -> DataFrame:
    return _of(spark, sf_dir, "purchase.completed").selectExpr(
        "concat('key_', event_id % 200) as key",
        "ts_us div 1000 as ts_ms",
        "event_id",
        "concat('h', k % 3) as body_hash",
        f"{_STATUS} as status",
    )


def purchases(spark: SparkSession | Streams, sf_dir: str) -> DataFrame:
    return _of(spark, sf_dir, "purchase.completed").selectExpr(
        "event_id",
        "dev",
        "user_id",
        "ts_us",
        "concat('p_', k % 10) as product_id",
        "case when k % 6 = 0 then null else concat('ord_', event_id) end as order_id",
        "case when k % 17 = 0 then '' else concat('tok_', event_id % 500) end as purchase_token",
        "ts_us div 1000 as purchase_time_ms",
        "case when k % 13 = 0 then null else concat('sig_', event_id) end as signature",
        "k % 3 <> 0 as is_acknowledged",
        "k % 11 = 0 as is_revoked",
        "case when k % 9 = 0 then 1 else 0 end as response_code",
        f"{_STATUS} as status",
    )


def billing_results(spark: SparkSession | Streams, sf_dir: str) -> DataFrame:
    """One billing callback per purchase row, its purchases as an array (empty for some)."""
    p = purchases(spark, sf_dir)
    item = F.struct(
        "product_id", "order_id", "purchase_token", "purchase_time_ms", "signature", "is_acknowledged", "is_revoked"
    )
    none = F.filter(F.array(item), lambda x: F.lit(False))
    return p.select(
        "event_id",
        "dev",
        "user_id",
        "ts_us",
        "status",
        "response_code",
        F.when(F.col("event_id") % 10 == 3, none).otherwise(F.array(item)).alias("purchases"),
    )


AT_US = 883_612_800_000_000  # 1998-01-01


def snapshots(spark: SparkSession | Streams, sf_dir: str) -> DataFrame:
    """Entitlement snapshots in long form: one row per user, snapshot time and key."""
    o = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey as user",
        "unix_micros(cast(o_orderdate as timestamp)) as ts_us",
        "o_orderpriority as key",
        "o_orderstatus <> 'F' as active",
        "case when o_orderstatus = 'O' then null "
        "else unix_micros(cast(o_orderdate as timestamp)) + 180 * 86400000000L end as valid_until_us",
    )
    newest = F.max(F.struct(F.col("active"), F.col("valid_until_us").isNull().alias("open"), "valid_until_us"))
    return (
        o.groupBy("user", "ts_us", "key")
        .agg(newest.alias("s"))
        .select("user", "ts_us", "key", "s.active", "s.valid_until_us")
    )


def refresh_failures(spark: SparkSession | Streams, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .filter("o_orderstatus = 'F'")
        .selectExpr("o_custkey as user", "unix_micros(cast(o_orderdate as timestamp)) + 1 as ts_us")
    )


def documents(spark: SparkSession | Streams, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")


def links(spark: SparkSession | Streams, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url")


def forget_requests(spark: SparkSession | Streams, sf_dir: str) -> DataFrame:
    users = events(spark, sf_dir).filter("user_id % 17 = 0").select("user_id").distinct()
    return users.selectExpr(
        "case when user_id % 3 = 0 then cast(user_id as string) end as user",
        "case when user_id % 3 = 1 then concat('anon_', user_id) end as dev",
        "case when user_id % 3 = 2 then concat('cust_', user_id) end as customer",
    )


_SQL_STATUS = _STATUS

VIEWS = {
    "v_events": """
        SELECT event_id, epoch_us(ts) AS ts_us, user_id, 'anon_' || user_id AS dev,
               CASE event_type WHEN 'view' THEN 'page.viewed' WHEN 'click' THEN 'element.clicked'
                    WHEN 'purchase' THEN 'purchase.completed' WHEN 'error' THEN '$error'
                    WHEN 'signup' THEN 'group.set' END AS name,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, value
        FROM events""",
    "v_redelivered": """
        SELECT *, ts_us AS received_us FROM v_events
        UNION ALL
        SELECT *, ts_us + (k + 1) * 60000000::BIGINT AS received_us FROM v_events WHERE event_id % 7 = 0""",
    "v_fast": "SELECT *, ts_us // 1000 // 20000 AS c_ms FROM v_events",
    "v_frames": "SELECT dev, event_id, ts_us // 100 AS frame_ns FROM v_events",
    "v_identity_log": """
        SELECT dev, user_id, ts_us, event_id, CASE WHEN k % 10 = 0 THEN 'reset' WHEN k % 10 < 4 THEN 'alias' ELSE 'identify' END AS op,
               CASE WHEN k % 10 = 0 THEN NULL WHEN k % 10 = 4 THEN '  '
                    ELSE ' user_' || user_id || '_' || (k % 3) || ' ' END AS "user",
               'cust_' || user_id || '_' || (k % 2) AS customer
        FROM v_events WHERE name = 'group.set'""",
    "v_consent_log": """
        SELECT dev, ts_us, event_id, k % 5 <> 0 AS analytics, k % 7 <> 0 AS errors
        FROM v_events WHERE name = 'group.set'""",
    "v_super_log": """
        SELECT dev, ts_us, event_id,
               CASE k % 4 WHEN 0 THEN 'register' WHEN 1 THEN 'registerOnce' WHEN 2 THEN 'unregister' ELSE 'clear' END AS op,
               CASE WHEN k % 4 = 3 THEN NULL WHEN k % 19 = 0 THEN '' WHEN event_id % 2 = 0 THEN 'plan' ELSE 'tier' END AS key,
               CAST(k AS VARCHAR) AS value
        FROM v_events WHERE name = 'element.clicked'""",
    "v_lifecycle": """
        SELECT dev, ts_us, event_id, CASE name WHEN 'page.viewed' THEN 'foreground'
               WHEN 'element.clicked' THEN 'background' ELSE 'reset' END AS op
        FROM v_events WHERE name IN ('page.viewed', 'element.clicked', 'group.set')""",
    "v_connectivity": "SELECT dev, ts_us, event_id, k % 3 <> 0 AS online FROM v_events WHERE name = 'page.viewed'",
    "v_errors": """
        SELECT event_id, dev, ts_us, user_id, k, 'com.app.E' || (k % 4) AS type,
               'failed for u' || user_id || '@example.com at ' || k AS message,
               k % 7 AS n_frames, k % 2 = 0 AS fatal
        FROM v_events WHERE name = '$error'""",
    "v_launches": """
        SELECT dev, ts_us, event_id, CAST(floor(value * 10) AS BIGINT) - 50 AS elapsed_ms, '1.' || (k % 3) AS version
        FROM v_events WHERE name = 'group.set'""",
    "v_attempts": f"""
        SELECT 'batch_' || (event_id % 300) AS key, ts_us // 1000 AS ts_ms, event_id, {_SQL_STATUS} AS status,
               CASE WHEN {_SQL_STATUS} = 429 THEN k END AS retry_after_s
        FROM v_events WHERE name = 'purchase.completed'""",
    "v_responses": f"""
        SELECT event_id, ts_us // 1000 AS received_ms, k, {_SQL_STATUS} AS status
        FROM v_events WHERE name = 'purchase.completed'""",
    "v_requests": f"""
        SELECT 'key_' || (event_id % 200) AS key, ts_us // 1000 AS ts_ms, event_id, 'h' || (k % 3) AS body_hash,
               {_SQL_STATUS} AS status
        FROM v_events WHERE name = 'purchase.completed'""",
    "v_purchases": f"""
        SELECT event_id, dev, user_id, ts_us, 'p_' || (k % 10) AS product_id,
               CASE WHEN k % 6 = 0 THEN NULL ELSE 'ord_' || event_id END AS order_id,
               CASE WHEN k % 17 = 0 THEN '' ELSE 'tok_' || (event_id % 500) END AS purchase_token,
               ts_us // 1000 AS purchase_time_ms,
               CASE WHEN k % 13 = 0 THEN NULL ELSE 'sig_' || event_id END AS signature,
               k % 3 <> 0 AS is_acknowledged, k % 11 = 0 AS is_revoked,
               CASE WHEN k % 9 = 0 THEN 1 ELSE 0 END AS response_code,
               event_id % 10 = 3 AS no_purchases, {_SQL_STATUS} AS status
        FROM v_events WHERE name = 'purchase.completed'""",
    "v_snapshots": """
        SELECT "user", ts_us, key, s.a AS active, s.v AS valid_until_us FROM (
          SELECT o_custkey AS "user", epoch_us(o_orderdate) AS ts_us, o_orderpriority AS key,
                 arg_max({'a': o_orderstatus <> 'F', 'v': CASE WHEN o_orderstatus = 'O' THEN NULL
                          ELSE epoch_us(o_orderdate) + 180 * 86400000000 END},
                         CASE o_orderstatus WHEN 'O' THEN 2 WHEN 'F' THEN 0 ELSE 1 END) AS s
          FROM orders GROUP BY ALL)""",
    "v_refresh_failures": """
        SELECT o_custkey AS "user", epoch_us(o_orderdate) + 1 AS ts_us FROM orders WHERE o_orderstatus = 'F'""",
    "v_forget": """
        SELECT DISTINCT CASE WHEN user_id % 3 = 0 THEN CAST(user_id AS VARCHAR) END AS "user",
               CASE WHEN user_id % 3 = 1 THEN 'anon_' || user_id END AS dev,
               CASE WHEN user_id % 3 = 2 THEN 'cust_' || user_id END AS customer
        FROM events WHERE user_id % 17 = 0""",
}

_NEEDS = {name: ["v_events"] for name in VIEWS if "v_events" in VIEWS[name]}


def sql(body: str, *views: str) -> str:
    """Prefix a DuckDB query with the adapter views it names."""
    wanted: list[str] = []
    for view in views:
        for name in [*_NEEDS.get(view, []), view]:
            if name not in wanted:
                wanted.append(name)
    body = body.strip()
    ctes = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in wanted)
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
