"""Counts over pages, names, days and tenants."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..fixtures import sql
from ..operators import rollups, sketches
from ..session import checkpoint_dir
from .registry import query

_PAGED = """paged AS (SELECT user_id, CASE WHEN k % 4 = 0 THEN 'https://x/' || (k % 8) WHEN k % 4 = 1 THEN '/p' || k ELSE 'Screen' || (k % 5) END AS page
    FROM v_events WHERE name = 'page.viewed')"""


@query("page_views", sql(f"WITH {_PAGED} SELECT page, count(*) AS views, count(DISTINCT user_id) AS users FROM paged GROUP BY page", "v_events"))
def _page_views(spark, sf):
    from ..functions.values import page_key

    key = page_key(
        F.expr("case when k % 4 = 0 then concat('https://x/', k % 8) end"),
        F.expr("case when k % 4 = 1 then concat('/p', k) end"),
        F.expr("concat('Screen', k % 5)"),
    )
    return rollups.page_views(fx.events(spark, sf).filter("name = 'page.viewed'").select("user_id", key.alias("page")))


@query(
    "event_counts",
    sql(
        "SELECT name, CASE WHEN k % 2 = 0 THEN 'android' ELSE 'ios' END AS platform, ts_us // 86400000000 AS day, count(*) AS events FROM v_events GROUP BY ALL",
        "v_events",
    ),
)
def _event_counts(spark, sf):
    return rollups.event_counts(
        fx.events(spark, sf).selectExpr("name", "case when k % 2 = 0 then 'android' else 'ios' end as platform", "ts_us div 86400000000 as day")
    )


@query("active_users", sql("SELECT ts_us // 86400000000 AS day, count(*) AS events, count(DISTINCT user_id) AS users FROM v_events GROUP BY day", "v_events"))
def _active_users(spark, sf):
    return rollups.active_users(fx.events(spark, sf).select("ts_us", "user_id"))


@query(
    "group_rollup",
    sql(
        """WITH g AS (SELECT dev, ts_us, event_id, CASE WHEN k % 4 <> 0 THEN 'org_' || (k % 6) END AS org FROM v_events WHERE name = 'group.set')
        SELECT g.org AS group_key, count(*) AS events, count(DISTINCT e.user_id) AS users
        FROM v_events e ASOF LEFT JOIN g ON e.dev = g.dev AND e.ts_us >= g.ts_us GROUP BY ALL""",
        "v_events",
    ),
)
def _group_rollup(spark, sf):
    events = fx.events(spark, sf)
    groups = events.filter("name = 'group.set'").selectExpr(
        "dev", "ts_us", "event_id", "'org' as group_type", "case when k % 4 <> 0 then concat('org_', k % 6) end as group_key"
    )
    return rollups.group_rollup(events.select("dev", "ts_us", "event_id", "user_id"), groups, "org")


@query(
    "weekly_sketches",
    sql("SELECT name, ts_us // 604800000000 AS week, count(*) AS rows, true AS users_near, true AS median_near, true AS p90_near FROM v_events GROUP BY ALL", "v_events"),
)
def _weekly_sketches(spark, sf):
    """Weeks from stored daily sketches; users and ranks are held against exact counts, within the stated bounds."""
    events = fx.events(spark, sf).selectExpr("name", "ts_us", "user_id", "cast(value * 100 as bigint) as value")
    path = f"{checkpoint_dir(spark)}/sketches-{uuid.uuid4().hex}"
    sketches.daily_sketches(events, ["name"], value="value").write.parquet(path)
    weeks = sketches.merge_sketches(spark.read.parquet(path), ["name", F.expr("day div 7").alias("week")])
    found = sketches.read_sketches(weeks, {"median": 0.5, "p90": 0.9})
    week = events.withColumn("week", F.expr("ts_us div 604800000000"))
    users = rollups.rows_and_users(week, ["name", "week"]).select("name", "week", F.col("users").alias("exact"))
    met = week.join(found.select("name", "week", "median", "p90"), ["name", "week"])
    bounds = {}
    for name, share in (("median", 0.5), ("p90", 0.9)):
        below, upto = F.avg((F.col("value") < F.col(name)).cast("double")), F.avg((F.col("value") <= F.col(name)).cast("double"))
        bounds[f"{name}_near"] = (below <= share + sketches.RANK_ERROR) & (upto >= share - sketches.RANK_ERROR)
    ranks = met.filter("value is not null").groupBy("name", "week").agg(*[c.alias(n) for n, c in bounds.items()])
    near = F.abs(F.col("users") - F.col("exact")) <= sketches.USERS_ERROR * F.col("exact")
    return found.join(users, ["name", "week"]).join(ranks, ["name", "week"]).select("name", "week", "rows", near.alias("users_near"), "median_near", "p90_near")
