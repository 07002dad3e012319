"""Mergeable sketches: exact while small, within their bounds beyond, the same however the hours are united."""

from pyspark.sql import functions as F

from spanlight.operators import sketches


def _events(spark, n, users):
    return spark.range(n).select(
        F.lit("a").alias("app"), F.pmod(F.xxhash64("id"), F.lit(users)).cast("string").alias("user_id"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100_000)).cast("double").alias("latency_ms"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 37).cast("timestamp_ntz").alias("event_ts"))


def test_users_and_quantiles_within_bounds(spark):
    rows = _events(spark, 200_000, 60_000)
    hourly = sketches.hourly_sketches(rows, ["app"])
    assert hourly.count() > 1000
    for period in ("week", "quarter"):
        united = sketches.over_period(hourly, ["app"], period)
        found = united.select("period_start", "events", sketches.active_users(united).alias("users"), sketches.quantile("latency", 0.95).alias("p95")).collect()
        exact = {r.period_start: r for r in rows.groupBy(F.date_trunc(period, "event_ts").cast("date").alias("period_start")).agg(
            F.count_distinct("user_id").alias("users"), F.count(F.lit(1)).alias("events")).collect()}
        assert {r.period_start for r in found} == set(exact)
        for r in found:
            e = exact[r.period_start]
            assert r.events == e.events and abs(r.users - e.users) <= 0.04 * e.users  # five standard errors
            share = rows.where(F.date_trunc(period, "event_ts").cast("date") == F.lit(r.period_start)).agg(F.avg((F.col("latency_ms") <= r.p95).cast("int"))).first()[0]
            assert abs(share - 0.95) < 0.02


def test_small_sets_are_exact_and_nulls_do_not_count(spark):
    rows = _events(spark, 5000, 300).withColumn("user_id", F.when(F.col("user_id") != "7", F.col("user_id")))
    united = sketches.over_period(sketches.hourly_sketches(rows, ["app"]), ["app"], "year")
    access = spark.createDataFrame([("a", str(i)) for i in range(250, 400)] + [("b", "1")], "app string, user_id string")
    (r,) = sketches.adoption(united, sketches.user_set(access, ["app"]), ["app"]).collect()
    seen = {x.user_id for x in rows.collect() if x.user_id}
    assert (r.active_users, r.users_with_access, r.active_with_access) == (len(seen), 150, len(seen & {str(i) for i in range(250, 400)}))
    (r,) = sketches.adoption(united, sketches.user_set(access.where("app = 'b'"), ["app"]), ["app"]).collect()
    assert r.active_with_access is None and r.adoption_pct is None
    assert sketches.over_period(sketches.hourly_sketches(rows.where("false"), ["app"]), ["app"], "day").count() == 0
