"""Stores and streaming jobs: repeated batches, several batches, late rows, batch = stream."""

import json
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from spanlight import catalogs
from spanlight.operators import budget, enrich, metrics, store, validate
from spanlight.plans import pages
from spanlight.plans import load_all
from spanlight.plans.registry import Context, run
from spanlight.sources import logs, messages, tables
from spanlight.streaming import jobs

load_all()


def _event(i, ts, **more):
    return {"event_id": f"e{i}", "event_type": "REQUEST_COMPLETED", "service_name": "gssp-gs", "environment": "dev",
            "status": "success", "application_id": "app-1", "timestamp": ts, "latency_ms": float(i), "payload": {}, **more}


def _write(spark, path, events, name):
    spark.createDataFrame([(None, json.dumps(e)) for e in events], "key string, value string").withColumn(
        "headers", F.array().cast("array<struct<key:string,value:binary>>")).coalesce(1).write.mode("append").parquet(path)


def test_enrichment_stream_over_several_batches(spark, tmp_path):
    raw = str(tmp_path / "raw")
    dims = lambda s: enrich.Dimensions(None, catalogs.price_table(s), catalogs.error_rules())
    for n in range(3):
        events = [_event(10 * n + i, "2026-02-01T10:00:00Z", payload={"prompt": "p" * 3000}) for i in range(3)]
        events.append(_event(99, "2026-02-01T10:00:00Z", event_type="NOPE"))
        _write(spark, raw, events, n)
        jobs.enrichment(messages.read_files(spark, raw), dims, str(tmp_path / "done"), str(tmp_path / "dead"),
                        str(tmp_path / "ck"), archive=str(tmp_path / "archive"), available_now=True).awaitTermination()
    done = spark.read.parquet(str(tmp_path / "done"))
    assert done.count() == 9 and spark.read.parquet(str(tmp_path / "dead")).count() == 3
    assert json.loads(done.first()["value"])["payload"]["prompt_bytes"] == 3000
    assert spark.read.parquet(str(tmp_path / "archive")).count() == 9
    pointers = done.select(F.get_json_object("value", "$.payload.prompt").alias("pointer"))
    bodies = tables.read_archived(spark, str(tmp_path / "archive"), pointers).collect()
    assert len(bodies) == 9 and all(r["body"] == "p" * 3000 for r in bodies)
    again = jobs.replay_dead_letters(spark, str(tmp_path / "dead"), raw, reason="vocabulary")
    assert again.count() == 3 and messages.read_files(spark, raw, streaming=False).count() == 15


def test_storage_stream_ignores_copies_and_rebuilds_late_hours(spark, tmp_path):
    raw, store = str(tmp_path / "processed"), str(tmp_path / "events")

    def go():
        jobs.storage(messages.read_files(spark, raw), store, str(tmp_path / "domain"), str(tmp_path / "touched"), str(tmp_path / "ck"),
                     watermark="1 second", available_now=True).awaitTermination()
        return jobs.rebuild_rollup(spark, store, str(tmp_path / "touched"), str(tmp_path / "hourly"), rebuilt)

    _write(spark, raw, [_event(i, "2026-02-01T10:00:00Z") for i in range(4)] + [_event(1, "2026-02-01T10:00:00Z")], 0)
    rebuilt = -1
    rebuilt = go()
    _write(spark, raw, [_event(2, "2026-02-01T10:00:00Z"), _event(7, "2026-02-01T10:30:00Z"),
                        _event(9, "2026-01-03T04:00:00Z"), _event(8, "2026-02-02T01:00:00Z", event_type="LLM_CALL_COMPLETED", payload={"model_name": "m", "input_tokens": 5})], 1)
    go()
    assert spark.read.parquet(store).count() == 7
    hourly = {str(r["hour"]): r["request_count"] for r in tables.latest_rows(spark, str(tmp_path / "hourly"), ["application_id", "hour"]).collect()}
    assert hourly["2026-02-01 10:00:00"] == 5 and hourly["2026-01-03 04:00:00"] == 1
    tables.compact(spark, str(tmp_path / "hourly"), ["application_id", "hour"], str(tmp_path / "compacted"))
    assert spark.read.parquet(str(tmp_path / "compacted")).count() == len(hourly)
    calls = spark.read.parquet(str(tmp_path / "domain" / "llm_events")).collect()
    assert [(r["model_name"], r["input_tokens"]) for r in calls] == [("m", 5)]
    # Copies far beyond the watermark, one of an event that never had a time: neither store takes them again.
    timeless = {k: v for k, v in _event(20, None, event_type="LLM_CALL_COMPLETED").items() if k != "timestamp"}
    late_copy = _event(8, "2026-02-02T01:00:00Z", event_type="LLM_CALL_COMPLETED", payload={"model_name": "m", "input_tokens": 5})
    for n in (2, 3):
        time.sleep(1.1)
        _write(spark, raw, [timeless, late_copy], n)
        go()
    assert spark.read.parquet(store).where("event_id = 'e20'").count() == 1
    assert spark.read.parquet(store).count() == 8
    assert sorted(r["event_id"] for r in spark.read.parquet(str(tmp_path / "domain" / "llm_events")).collect()) == ["e20", "e8"]
    tables.backfill_domain_tables(spark, store, str(tmp_path / "again"))
    assert spark.read.parquet(str(tmp_path / "again" / "llm_events")).count() == 2


def test_append_is_idempotent_and_retention_archives(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a", "2026-01-05 00:00:00"), ("b", "2026-04-05 00:00:00"), ("a", "2026-01-05 00:00:00")], "event_id string, ts string").select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("event_ts"), F.col("ts").alias("emitted_at"), F.lit("x").alias("application_id")).withColumns({
            "event_date": F.col("event_ts").cast("date"), "event_month": F.date_format("event_ts", "yyyy-MM")})
    path, archive = str(tmp_path / "events"), str(tmp_path / "archive")
    for _ in range(2):
        tables.append_events(rows, path)
    assert spark.read.parquet(path).count() == 2
    assert tables.archive_and_drop(spark, path, archive, date(2026, 4, 30), 2) == ["event_month=2026-01"]
    assert [r["event_id"] for r in spark.read.parquet(path).collect()] == ["b"]
    assert spark.read.parquet(f"{archive}/event_month=2026-01").count() == 1


def test_layout_splits_only_large_days(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("event_id"), F.when(F.col("id") < 900, "hot").otherwise("cold").alias("d"))
    files = tables.files_per_value(rows, "d", 100)
    parts = tables.laid_out(rows, "d", files).withColumn("p", F.spark_partition_id()).groupBy("d").agg(F.count_distinct("p").alias("n")).collect()
    assert {r["d"]: r["n"] for r in parts}["hot"] > 1 and {r["d"]: r["n"] for r in parts}["cold"] == 1


def test_budget_stream_equals_batch(spark, tmp_path, data_dir):
    c = Context(spark, data_dir)
    spend = c.spend.select("event_id", "event_ts", "application_id", "model_name", "cost_usd")
    parts = str(tmp_path / "spend")
    ledger = str(tmp_path / "ledger")
    for low, high in ((0, 8), (8, 15), (15, 32)):
        days = F.dayofmonth("event_ts")
        spend.where((days > low) & (days <= high)).coalesce(1).write.mode("append").parquet(parts)
        stream = spark.readStream.schema(spend.schema).parquet(parts)
        jobs.budgets(stream, lambda _: c.budgets, ledger, str(tmp_path / "ck"), available_now=True).awaitTermination()
    # A copy counts once, a date far ahead is set aside and wipes nothing, and lost totals are an error.
    hot = spend.orderBy("event_ts").limit(3)
    wild = hot.withColumns({"event_id": F.concat("event_id", F.lit("-w")), "event_ts": F.lit("2099-01-01").cast("timestamp_ntz")})
    hot.unionByName(hot).unionByName(wild).coalesce(1).write.mode("append").parquet(parts)
    before = jobs._totals_before(spark, ledger, 3).count()
    jobs.budgets(spark.readStream.schema(spend.schema).parquet(parts), lambda _: c.budgets, ledger, str(tmp_path / "ck"), available_now=True).awaitTermination()
    assert spark.read.parquet(f"{ledger}/future").count() == 3 and jobs._totals_before(spark, ledger, 4).count() == before
    with pytest.raises(RuntimeError):
        jobs._totals_before(spark, ledger, 9)
    doubled = budget.totals(spend.unionByName(hot), c.budgets).agg(F.sum("spend_usd")).first()
    assert doubled == budget.totals(spend, c.budgets).agg(F.sum("spend_usd")).first()
    key = lambda r: (r["application_id"], r["limit_model"], r["period"], str(r["period_start"]), r["kind"], r["event_id"], r["new_spend_usd"])
    got = sorted(map(key, jobs.crossings(spark, ledger).collect()))
    assert got == sorted(map(key, budget.crossings(spend, c.budgets).collect())) and got


def test_bad_rule_rows_are_skipped(spark):
    table = spark.createDataFrame(
        [("B1", "x", "(unclosed", "error", False, 1, "active"), ("B2", "x", "ok", "error", False, 2, "active"), ("B3", "x", "no", "error", True, 0, "retired")],
        "error_code string, category string, pattern string, severity string, retryable boolean, priority int, status string")
    assert [r.error_code for r in catalogs.error_rules_from_table(table)] == ["B2"]


def test_log_lines(spark):
    lines = spark.createDataFrame([
        ('2026-01-01T00:00:00Z stdout F {"correlation_id":"c1","password":"p","n":3}',), ("2026-01-01T00:00:00Z stderr P plain",), ("odd line",)], "value string")
    got = logs.parse(lines).select("stream", "log", logs.field("correlation_id").alias("c"), F.map_keys("fields").alias("k")).orderBy("stream").collect()
    assert [(r["stream"], r["log"], r["c"]) for r in got] == [("stderr", "plain", None), ("stdout", None, "c1")]
    assert sorted(got[1]["k"]) == ["correlation_id", "n"]


def test_metric_catalog_refuses_other_dimensions(spark, data_dir):
    c = Context(spark, data_dir)
    with pytest.raises(ValueError):
        metrics.metric(c.obs, "llm_cost_usd", ["user_id"])
    with pytest.raises(KeyError):
        metrics.metric(c.obs, "nope")
    ids = {r["metric_id"] for r in metrics.lookup(metrics.catalog_table(spark), "why is the failure rate up").collect()}
    assert ids == {"error_rate_pct"}


def test_agent_trace_page(spark, data_dir):
    c = Context(spark, data_dir)
    rows = pages.get_agent_trace(c.spans, "trc-1").collect()
    assert len(rows) == 32 and {r["root_span_id"] for r in rows} == {"sp-32"}


def test_validation_vocabulary_is_a_parameter(spark):
    df = spark.createDataFrame([(json.dumps(_event(1, "2026-01-01T00:00:00Z", event_type="MEMORY_READ")),)], "value string")
    assert validate.good(validate.validate(df)).count() == 0
    assert validate.good(validate.validate(df, event_types=["MEMORY_READ"])).count() == 1


def test_incident_export_and_log_lines_from_files(spark, tmp_path):
    rows = spark.createDataFrame([("c1", 1), ("c2", 2)], "correlation_id string, n int")
    found = store.incident_rows({"events": rows, "calls": rows.where("n = 1")}, rows.where("n = 1"))
    tables.export_incident(found, str(tmp_path / "incident"))
    assert [spark.read.parquet(str(tmp_path / "incident" / t)).collect() for t in ("events", "calls")] == [[("c1", 1)], [("c1", 1)]]
    (tmp_path / "pod.log").write_text('2026-01-01T00:00:00Z stdout F {"correlation_id":"c1"}\nbroken\n')
    lines = logs.read_lines(spark, str(tmp_path / "pod.log"))
    assert logs.parse(lines).select(logs.field("correlation_id")).collect() == [("c1",)]
    raw = messages.from_lines(lines)
    assert raw.columns == ["key", "value", "headers"] and validate.validate(raw).where(F.size("violations") > 0).count() == 2


def test_enrichment_marks_budgets_and_notes_stage_errors(spark, tmp_path):
    raw = str(tmp_path / "raw")
    dims = lambda s: enrich.Dimensions(None, catalogs.price_table(s), [])
    limits = lambda s: catalogs.literal_table(
        s, [("app-1", "*", "daily", 0.02, 50)], "application_id string, model_name string, period string, max_spend_usd decimal(12,2), alert_at_pct int")
    sent = []
    for n in range(4):
        call = _event(n, f"2026-02-01T10:0{n}:00Z", event_type="LLM_CALL_COMPLETED", payload={"model_name": "claude-sonnet-4-5", "input_tokens": 2000, "output_tokens": 0 if n else "x"})
        _write(spark, raw, [call], n)
        jobs.enrichment(messages.read_files(spark, raw), dims, lambda rows, batch: sent.extend(rows.collect()), str(tmp_path / "dead"), str(tmp_path / "ck"),
                        limits=limits, ledger=str(tmp_path / "ledger"), errors=str(tmp_path / "errors"), available_now=True).awaitTermination()
    payloads = [json.loads(r["value"])["payload"] for r in sent]
    assert [p.get("budget_alert") for p in payloads] == [None, {"limit_usd": 0.02, "period": "daily", "spend_usd": 0.012}, None, None]
    assert [p.get("budget_cap_breached", False) for p in payloads] == [False, False, False, True]
    assert [(r["event_id"], r["stage"]) for r in spark.read.parquet(str(tmp_path / "errors")).collect()] == [("e0", "stage6-cost")]


def test_no_query_deals_its_table_out_anew(spark, data_dir):
    """Scans keep their own partitions: no plan has a round-robin exchange."""
    for name in ("processed_by_type", "enriched_messages", "document_metrics", "weekly_digest", "hourly_summary"):
        plan = run(name, spark, data_dir)._jdf.queryExecution().executedPlan().toString()
        assert "RoundRobin" not in plan, name


def test_weekly_digest_scans_the_events_twice(spark, data_dir):
    df = run("weekly_digest", spark, data_dir)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 2
