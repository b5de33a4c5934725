"""Merged sketches against exact counts."""

from pyspark.sql import functions as F

from tidemark.operators import sketches

DAY = 86_400_000_000


def test_a_week_of_sketches_is_near_the_exact_counts(spark):
    rows = spark.range(300_000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('g', id % 5)) as name", f"(id % 7) * {DAY} + id as ts_us", "xxhash64(id) % 40000 as user_id", "pmod(xxhash64(id, 1), 1000000) as value"
    )
    days = sketches.daily_sketches(rows, ["name"], value="value")
    week = sketches.merge_sketches(days, ["name"])
    got = {r["name"]: r for r in sketches.read_sketches(week, {"p50": 0.5, "p99": 0.99}).collect()}
    exact = rows.groupBy("name").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("user_id").alias("users")).collect()
    assert len(got) == len(exact) == 6 and days.count() == 42
    for r in exact:
        found = got[r["name"]]
        assert found["rows"] == r["rows"] and abs(found["users"] - r["users"]) <= sketches.USERS_ERROR * r["users"]
        own = rows.filter(F.col("name") == r["name"])
        for column, share in (("p50", 0.5), ("p99", 0.99)):
            assert abs(own.filter(F.col("value") <= found[column]).count() / r["rows"] - share) <= sketches.RANK_ERROR


def test_nulls_and_no_rows(spark):
    rows = spark.createDataFrame([("a", 5, None, None), ("a", DAY + 5, 1, None), ("b", 5, 1, 7)], "name string, ts_us long, user_id long, value long")
    days = sketches.daily_sketches(rows, ["name"], value="value")
    got = {r["name"]: (r["rows"], r["users"], r["p50"]) for r in sketches.read_sketches(sketches.merge_sketches(days, ["name"]), {"p50": 0.5}).collect()}
    assert got == {"a": (2, 1, None), "b": (1, 1, 7)}
    assert sketches.merge_sketches(sketches.daily_sketches(rows.limit(0), ["name"]), ["name"]).collect() == []
