"""Exact percentiles and running sums against brute force, with one key holding most rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from spanlight.operators import anomaly, budget, order_stats, slo, store


def _skewed(spark, n=4000):
    rnd = random.Random(5)
    rows = [("hot" if rnd.random() < 0.7 else f"k{rnd.randrange(6)}", rnd.choice([-1, 1]) * round(rnd.expovariate(0.01), 3) if rnd.random() > 0.05 else None) for _ in range(n)]
    rows += [("zero", 0.0), ("zero", 0.0), ("one", -3.5), ("empty", None)]
    return rows, spark.createDataFrame(rows, "k string, v double")


def test_continuous_percentiles(spark):
    rows, df = _skewed(spark)
    got = {r["k"]: r for r in order_stats.percentiles(df, ["k"], "v", {"a": 0.0, "b": 0.5, "c": 0.95, "d": 0.99, "e": 1.0}).collect()}
    for k in {k for k, _ in rows} - {"empty"}:
        values = [v for kk, v in rows if kk == k and v is not None]
        for name, q in (("a", 0), ("b", 0.5), ("c", 0.95), ("d", 0.99), ("e", 1)):
            assert abs(got[k][name] - np.quantile(values, q)) < 1e-9, (k, name)
    assert "empty" not in got


def test_index_percentiles_and_no_key(spark):
    rows, df = _skewed(spark)
    values = sorted(v for _, v in rows if v is not None)
    got = order_stats.percentiles(df, [], "v", {"p50": 0.5, "p99": 0.99}, method="index").collect()[0]
    assert got["p50"] == values[int(len(values) * 0.5)] and got["p99"] == values[int(len(values) * 0.99)]


def test_null_keys_keep_their_percentile(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "k string, v double")
    base = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = {r["k"]: r["p"] for r in order_stats.with_percentiles(base, df, ["k"], "v", {"p": 0.5}).collect()}
    assert got == {None: 2.0, "a": 5.0}


def test_running_sums(spark):
    rnd = random.Random(1)
    rows = [("hot" if rnd.random() < 0.8 else None, rnd.randrange(50), i, rnd.randrange(100)) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, bucket int, i int, x int")
    got = {r["i"]: r["run"] for r in order_stats.running_sums(df, ["k"], "bucket", ["i"], {"run": "x"}).collect()}
    totals = {}
    for k, _, i, x in sorted(rows, key=lambda r: (r[0] or "", r[1], r[2])):
        totals[k] = totals.get(k, 0) + x
        assert got[i] == totals[k]


def test_copies_of_one_event_keep_the_first(spark):
    rows = [("same", i) for i in range(5000)] + [(f"e{i}", i) for i in range(100)]
    df = spark.createDataFrame(rows, "event_id string, at int")
    got = {r["event_id"]: r["at"] for r in store.first_per_key(df, ["event_id"], ["at"]).collect()}
    assert got["same"] == 0 and len(got) == 101


def _request(i, ts, status="success", latency=10.0, app="app-1234"):
    return (f"e{i}", "REQUEST_COMPLETED" if status == "success" else "REQUEST_FAILED", ts, app, status, latency)


def _requests(spark, rows):
    return spark.createDataFrame(rows, "event_id string, event_type string, event_ts string, application_id string, status string, latency_ms double").withColumn(
        "event_ts", F.col("event_ts").cast("timestamp_ntz"))


def _slos(spark, sli="availability", latency=None, target="99.0"):
    return spark.createDataFrame([("s1", "app-1234", sli, target, latency, 30, True)],
                                 "slo_id string, application_id string, sli_type string, target string, latency_target_ms int, window_days int, enabled boolean"
                                 ).withColumn("target_pct", F.col("target").cast("decimal(6,3)")).drop("target")


def test_burn_two_percent_bad_is_two(spark):
    rows = [_request(i, "2026-01-01 10:00:00", "success" if i < 98 else "failed") for i in range(100)]
    rows.append(_request(100, "2026-01-01 12:00:00"))
    got = {r["event_id"]: r for r in slo.burn_rates(_requests(spark, rows), _slos(spark)).collect()}
    # Events of one instant are ordered by id; the last id sees all 100.
    worst = got["e99"]
    assert abs(worst["burn_rate_1h"] - 2.0) < 1e-9 and abs(worst["burn_rate_6h"] - 2.0) < 1e-9
    later = got["e100"]
    assert later["burn_rate_1h"] == 0.0 and later["burn_rate_6h"] > 0


def test_slow_success_burns_latency_objective(spark):
    got = slo.burn_rates(_requests(spark, [_request(1, "2026-01-01 10:00:00", latency=250.0)]), _slos(spark, "latency", 100)).collect()
    assert got[0]["good"] == 0 and abs(got[0]["burn_rate_1h"] - 100.0) < 1e-6


def test_failed_request_and_full_target(spark):
    failed = _requests(spark, [_request(1, "2026-01-01 10:00:00", "failed")])
    daily = slo.daily_compliance(slo.burn_rates(failed, _slos(spark))).collect()[0]
    assert (daily["good_events"], daily["total_events"], daily["breached"]) == (0, 1, True)
    full = slo.daily_compliance(slo.burn_rates(failed, _slos(spark, target="100.0"))).collect()[0]
    assert full["total_events"] == 1 and full["burn_rate_1h"] is None and full["breached"] is False


def test_daily_counts_equal_daily_compliance(spark):
    rnd = random.Random(11)
    rows = [_request(i, f"2026-01-0{1 + rnd.randrange(3)} {rnd.randrange(24):02d}:{rnd.randrange(60):02d}:00", rnd.choice(["success", "success", "failed"]),
                     rnd.choice([50.0, 150.0, None]), rnd.choice(["app-1234", "other"])) for i in range(300)]
    columns = ["slo_id", "application_id", "target_pct", "window_days", "day", "good_events", "total_events", "sli_pct"]
    for objectives in (_slos(spark), _slos(spark, "latency", 100)):
        events = _requests(spark, rows)
        counts = sorted(map(tuple, slo.daily_counts(events, objectives).select(columns).collect()))
        assert len(counts) == 3 and counts == sorted(map(tuple, slo.daily_compliance(slo.burn_rates(events, objectives)).select(columns).collect()))


def test_no_objective_no_rows(spark):
    assert slo.burn_rates(_requests(spark, [_request(1, "2026-01-01 10:00:00", app="other")]), _slos(spark)).count() == 0


def test_budget_crossed_once_even_inside_one_second(spark):
    rnd = random.Random(3)
    rows = [(f"e{i:05d}", "app-1", "m", f"2026-01-0{1 + i // 900} 10:00:{rnd.randrange(2):02d}", "0.10000000") for i in range(2700)]
    costed = spark.createDataFrame(rows, "event_id string, application_id string, model_name string, ts string, c string").select(
        "event_id", "application_id", "model_name", F.col("ts").cast("timestamp_ntz").alias("event_ts"), F.col("c").cast("decimal(20,8)").alias("cost_usd"))
    limits = spark.createDataFrame([("app-1", "*", "monthly", "100.00", 80)], "application_id string, model_name string, period string, m string, alert_at_pct int").withColumn(
        "max_spend_usd", F.col("m").cast("decimal(12,2)")).drop("m")
    got = {r["kind"]: r for r in budget.crossings(costed, limits).collect()}
    ordered = sorted(rows, key=lambda r: (r[3], r[0]))
    assert len(got) == 2
    assert got["alert"]["event_id"] == ordered[799][0] and float(got["alert"]["new_spend_usd"]) == 80.0
    assert got["cap"]["event_id"] == ordered[999][0]


def test_baseline_uses_only_earlier_days(spark):
    rows = [("a", f"2026-01-{d:02d} 00:00:00", float(d)) for d in range(1, 12)]
    df = spark.createDataFrame(rows, "k string, ts string, v double").withColumn("event_ts", F.col("ts").cast("timestamp_ntz"))
    got = {str(r["day"]): r["p50"] for r in anomaly.baselines(df, ["k"], "v").collect()}
    assert got["2026-01-02"] == 1.0 and got["2026-01-11"] == 7.0 and "2026-01-01" not in got


def test_trailing_percentiles_copy_histograms_not_values(spark):
    rnd = random.Random(9)
    rows = [("hot" if rnd.random() < 0.7 else rnd.choice(["b", None]), f"2026-01-{rnd.choice([1, 2, 3, 5, 14, 25]):02d}",
             rnd.choice([-1, 1]) * round(rnd.expovariate(0.01), 3) if rnd.random() > 0.05 else rnd.choice([None, float("nan"), 0.0])) for _ in range(4000)]
    df = spark.createDataFrame(rows, "k string, d string, v double").withColumn("d", F.col("d").cast("date"))
    probs = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99}
    out = order_stats.trailing_percentiles(df, ["k"], F.col("d"), "v", probs, 7)
    got = {(r["k"], r["day"].day + 31 * (r["day"].month - 1)): r for r in out.collect()}
    expected = {}
    for k, d, v in rows:
        if v is not None and v == v:
            for ahead in range(1, 8):
                expected.setdefault((k, int(d[-2:]) + ahead), []).append(v)
    assert set(got) == set(expected)
    for key, values in expected.items():
        for name, q in probs.items():
            assert abs(got[key][name] - np.quantile(values, q)) < 1e-9, (key, name)
    # The rows that are copied into later days carry bins, not values.
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert all("_v#" not in line.split("[")[1] for line in plan.splitlines() if "Generate explode" in line and "_dc#" in line)


def test_trailing_percentiles_of_nothing(spark):
    df = spark.createDataFrame([], "k string, d date, v double")
    assert order_stats.trailing_percentiles(df, ["k"], F.col("d"), "v", {"p50": 0.5}, 7).count() == 0
