"""Streaming jobs run over the given tables to the end of the data, and their results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import catalogs
from ..operators import enrich, slo
from ..sources import tables
from ..streaming import jobs, state
from . import reliability
from .enrichment import _ENRICHED, _GOOD
from .registry import QUERIES, Context, query, run_folder

del reliability  # imported for its registered SQL


class StreamContext(Context):
    """The same views over a streaming read of one given table."""

    streamed = "events"

    def base(self, name: str) -> DataFrame:
        if name != self.streamed:
            return super().base(name)
        schema = super().base(name).schema
        return self.spark.readStream.schema(schema).parquet(f"{self.sf_dir}/{name}.parque[t]")


class DocumentStream(StreamContext):
    streamed = "documents"


def _finish(q) -> None:
    q.awaitTermination()


def _late(c: Context, events: DataFrame, run: str, job, rebuild) -> None:
    """Feed events out of order: the second half of the month first, then the days before, which are
    beyond every watermark. The event table holds them all; the hours of the late ones are rebuilt."""
    first, feed = F.col("event_date") >= F.lit("2024-01-15").cast("date"), f"{run}/feed"
    for part in (events.where(first), events.where(~first)):
        part.write.mode("append").parquet(feed)
        _finish(job(c.spark.readStream.schema(events.schema).parquet(feed)))
    payload = F.to_json(F.struct("model_name", "input_tokens", "output_tokens", "estimated_cost_usd"))
    stored = events.withColumns({"payload": payload, "emitted_at": F.col("event_ts"), "event_month": F.date_format("event_ts", "yyyy-MM")})
    tables.append_events(stored.drop("model_name", "input_tokens", "output_tokens", "estimated_cost_usd"), f"{run}/events")
    hours = events.where(~first).select(F.date_trunc("hour", "event_ts").cast("timestamp_ntz").alias("hour")).distinct()
    tables.write_batch(hours, f"{run}/touched", 0)
    rebuild(f"{run}/events", f"{run}/touched")


def _usage_events(c: Context) -> DataFrame:
    return c.costed.select("event_id", "event_ts", "event_date", "event_type", "status", "application_id", "service_name", "http_status",
                           "latency_ms", "model_name", F.col("input_tokens").cast("bigint").alias("input_tokens"),
                           F.col("output_tokens").cast("bigint").alias("output_tokens"), F.col("estimated_cost_usd").cast("decimal(20,8)").alias("estimated_cost_usd"))


@query("stream_hourly_usage", "R5 R9 S6", """
SELECT application_id, date_trunc('hour', event_ts) AS hour, n(count(*)) AS events, n(count(*) FILTER (status = 'failed')) AS failures,
  n(sum(input_tokens + output_tokens) FILTER (event_type LIKE 'LLM%')) AS tokens, dbl(sum(estimated_cost_usd)) AS cost_usd,
  r6(list_sort(list(latency_ms))[CAST(ceil(0.95 * count(*)) AS INT)]) AS p95_latency_ms FROM costed GROUP BY ALL""")
def _(c: Context):
    run, out = run_folder(c), "usage"
    _late(c, _usage_events(c), run,
          lambda stream: jobs.hourly_usage(stream, f"{run}/{out}", f"{run}/checkpoint", available_now=True),
          lambda events, touched: jobs.rebuild_usage(c.spark, events, touched, f"{run}/{out}"))
    return jobs.current_rows(c.spark, f"{run}/{out}", ["application_id", "hour"])


_SLIDING = QUERIES["sliding_slo_counts"].sql


@query("stream_sliding_slo", "R6 J6", f"""
SELECT 60 AS minutes, * FROM ({_SLIDING}) a UNION ALL
SELECT 360 AS minutes, * FROM ({_SLIDING.replace("range(0, 60)", "range(0, 360)").replace("INTERVAL 1 HOUR", "INTERVAL 6 HOUR")}) b""")
def _(c: Context):
    run = run_folder(c)
    _late(c, _usage_events(c), run,
          lambda stream: jobs.slo_minutes(stream, c.slos, f"{run}/out", f"{run}/checkpoint", available_now=True),
          lambda events, touched: jobs.rebuild_slo_minutes(c.spark, events, touched, c.slos, f"{run}/out"))
    minutes = jobs.current_rows(c.spark, f"{run}/out", ["slo_id", "minute"])
    windows = [slo.sliding_counts(minutes, n).withColumn("minutes", F.lit(n)) for n in (60, 360)]
    return windows[0].unionByName(windows[1])


@query("stream_budget_crossings", "R7 W2", QUERIES["budget_crossings"].sql)
def _(c: Context):
    """Every twentieth event comes twice and every fiftieth also with a date far ahead; neither changes the result."""
    run = run_folder(c)
    spend = StreamContext(c.spark, c.sf_dir).spend
    ahead = F.struct(F.lit("-ahead").alias("mark"), F.lit("2099-01-01").cast("timestamp_ntz").alias("ts"))
    plain = F.struct(F.lit("").alias("mark"), F.col("event_ts").alias("ts"))
    copies = F.concat(F.array(plain), F.when(F.col("seq") % 20 == 0, F.array(plain)).otherwise(F.slice(F.array(plain), 1, 0)),
                      F.when(F.col("seq") % 50 == 0, F.array(ahead)).otherwise(F.slice(F.array(ahead), 1, 0)))
    noisy = spend.withColumn("_c", F.explode(copies)).withColumns({
        "event_id": F.concat("event_id", "_c.mark"), "event_ts": F.col("_c.ts")}).drop("_c")
    _finish(jobs.budgets(noisy, lambda _: c.budgets, f"{run}/ledger", f"{run}/checkpoint", available_now=True))
    return jobs.crossings(c.spark, f"{run}/ledger")


def _in_parts(c: Context, rows: DataFrame, arrived: str, run: str, closing: DataFrame, job) -> DataFrame:
    """Feed rows in the order of arrival in two parts and a closing row that only lets time pass, with a restart
    from the checkpoint before each; returns what the job has told."""
    early, feed = F.col(arrived) < F.lit("2024-01-16").cast("timestamp"), f"{run}/feed"
    for part in (rows.where(early), rows.where(~early), closing):
        part.write.mode("append").parquet(feed)
        stream = c.spark.readStream.schema(rows.schema).parquet(feed)
        _finish(state.run_to(job(stream), f"{run}/out", f"{run}/checkpoint", available_now=True))
    return c.spark.read.parquet(f"{run}/out")


def _closing(rows: DataFrame) -> DataFrame:
    """One row of nulls but for its times, which lie 120 days behind the last arrival, wherever in time that is."""
    end = (F.coalesce(F.max("arrived"), F.lit("2024-01-31").cast("timestamp")) + F.make_dt_interval(days=F.lit(120))).alias("_end")
    return rows.agg(end).select(*[
        (F.col("_end") if f.name in ("event_ts", "arrived") else F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema.fields])


def spend_feed(spend: DataFrame) -> DataFrame:
    """Every twentieth event comes twice, the second time three minutes later, every seventh event eight minutes late,
    every fiftieth also with a date far ahead."""
    one = lambda mark, ts, minutes: F.struct(F.lit(mark).alias("mark"), ts.alias("ts"), F.lit(minutes).alias("minutes"))
    ts, late = F.col("event_ts"), F.when(F.col("seq") % 7 == 0, 8).otherwise(0)
    plain = F.struct(F.lit("").alias("mark"), ts.alias("ts"), late.alias("minutes"))
    none = F.slice(F.array(plain), 1, 0)
    copies = F.concat(F.array(plain), F.when(F.col("seq") % 20 == 0, F.array(one("", ts, 3))).otherwise(none),
                      F.when(F.col("seq") % 50 == 0, F.array(one("-ahead", F.lit("2099-01-01").cast("timestamp_ntz"), 0))).otherwise(none))
    arrival = (ts.cast("timestamp") + F.make_dt_interval(mins=F.col("_c.minutes"))).alias("arrived")
    return spend.select("event_id", "event_ts", "seq", "application_id", "model_name", "cost_usd", F.explode(copies).alias("_c")).select(
        F.concat("event_id", "_c.mark").alias("event_id"), F.col("_c.ts").alias("event_ts"), "application_id", "model_name", "cost_usd", arrival)


@query("stream_budget_state", "R7 W2", QUERIES["budget_crossings"].sql)
def _(c: Context):
    run, feed = run_folder(c), spend_feed(c.spend)
    told = _in_parts(c, feed, "arrived", run, _closing(feed),
                     lambda stream: state.spend_crossings(stream, c.budgets, F.col("arrived")))
    return told.where("kind IN ('alert', 'cap')")


@query("stream_alert_life", "R8 W11 K2", QUERIES["held_error_rate_alerts"].sql.split("SELECT service_name, TIMESTAMP")[0] + """
SELECT service_name, 'pending' AS state, TIMESTAMP '1970-01-01' + to_minutes(a) AS at, TIMESTAMP '1970-01-01' + to_minutes(a) AS since FROM s
UNION ALL SELECT service_name, 'firing', TIMESTAMP '1970-01-01' + to_minutes(a + 10), TIMESTAMP '1970-01-01' + to_minutes(a) FROM s WHERE z - a >= 10
UNION ALL SELECT service_name, CASE WHEN z - a >= 10 THEN 'resolved' ELSE 'cleared' END, TIMESTAMP '1970-01-01' + to_minutes(z + 1), TIMESTAMP '1970-01-01' + to_minutes(a) FROM s""")
def _(c: Context):
    run = run_folder(c)
    rows = c.obs.select("event_id", "event_ts", "service_name", "http_status", F.col("event_ts").cast("timestamp").alias("arrived"))
    return _in_parts(c, rows, "arrived", run, _closing(rows), state.alert_transitions)


@query("stream_held_alerts", "R8 W11", QUERIES["held_error_rate_alerts"].sql)
def _(c: Context):
    run = run_folder(c)
    _late(c, _usage_events(c), run,
          lambda stream: jobs.minute_rates(stream, f"{run}/out", f"{run}/checkpoint", available_now=True),
          lambda events, touched: jobs.rebuild_minute_rates(c.spark, events, touched, f"{run}/out"))
    return jobs.held_alerts(c.spark, f"{run}/out")


@query("stream_archive", "S9 C12 R1", """
WITH t AS (SELECT doc_id, regexp_replace(text, '[0-9@]', '', 'g') AS body FROM documents)
SELECT concat('doc-', CAST(doc_id AS VARCHAR)) AS event_id, sha256(body) AS body_hash, strlen(body) > 2048 AS archived,
  CASE WHEN strlen(body) > 2048 THEN concat('redacted-prompts/doc-', CAST(doc_id AS VARCHAR), '/prompt.txt') END AS archive_key,
  CASE WHEN strlen(body) > 2048 THEN n(strlen(body)) END AS bytes FROM t""")
def _(c: Context):
    """Texts of documents as prompts (without digits and @, so that nothing in them is redacted): what is left in
    the event and what its pointer leads to, together again."""
    run = run_folder(c)
    body = F.to_json(F.struct(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("event_id"), F.lit("REQUEST_RECEIVED").alias("event_type"),
        F.lit("gssp-gs").alias("service_name"), F.lit("dev").alias("environment"), F.lit("success").alias("status"),
        F.struct(F.regexp_replace("text", "[0-9@]", "").alias("prompt")).alias("payload")))
    messages = DocumentStream(c.spark, c.sf_dir).documents.select(F.lit("").alias("key"), body.alias("value"))
    archive = f"{run}/archive"
    _finish(jobs.enrichment(messages, lambda _: enrich.Dimensions(), f"{run}/processed", f"{run}/dead", f"{run}/checkpoint",
                            archive=archive, available_now=True))
    doc = F.try_parse_json("value")
    read = lambda path, kind="string": F.try_variant_get(doc, path, kind)
    done = c.spark.read.parquet(f"{run}/processed").select(
        read("$.event_id").alias("event_id"), read("$.payload.prompt").alias("pointer"), read("$.payload.prompt_bytes", "bigint").alias("bytes"))
    found = tables.read_archived(c.spark, archive, done)
    moved = F.col("body").isNotNull()
    return found.select("event_id", F.sha2(F.coalesce("body", "pointer"), 256).alias("body_hash"), moved.alias("archived"),
                        F.when(moved, F.substr("pointer", F.lit(len(archive) + 2))).alias("archive_key"), "bytes")


@query("stream_enrichment", "R1 R2 S1 S2 S3", f"""
WITH {_ENRICHED}
SELECT 'dead' AS kind, 'stage1-validate' AS label, n(count(*)) AS messages, CAST(NULL AS BIGINT) AS coded, CAST(NULL AS DOUBLE) AS cost_usd, CAST(NULL AS BIGINT) AS redacted
FROM raw_checked WHERE NOT coalesce({_GOOD}, FALSE)
UNION ALL SELECT 'processed', coalesce(application_id, ''), n(count(*)), n(count(error_code)), r6(sum(estimated_cost_usd)), n(count(note)) FROM e GROUP BY ALL""")
def _(c: Context):
    run = run_folder(c)
    messages = StreamContext(c.spark, c.sf_dir).raw_events.select(F.lit("").alias("key"), "value")
    dims = lambda _: enrich.Dimensions(c.app_registry, c.prices, catalogs.error_rules())
    _finish(jobs.enrichment(messages, dims, f"{run}/processed", f"{run}/dead", f"{run}/checkpoint", available_now=True))
    doc = F.try_parse_json("value")
    read = lambda path, kind="string": F.try_variant_get(doc, path, kind)
    done = c.spark.read.parquet(f"{run}/processed").select(
        F.coalesce(read("$.application_id"), F.lit("")).alias("label"), read("$.error_code").alias("error_code"),
        read("$.payload.estimated_cost_usd", "decimal(20,8)").alias("cost"), read("$.payload.note").alias("note"))
    processed = done.groupBy(F.lit("processed").alias("kind"), "label").agg(
        F.count(F.lit(1)).alias("messages"), F.count("error_code").alias("coded"), F.sum("cost").cast("double").alias("cost_usd"),
        F.count_if(F.col("note").contains("[REDACTED:email]") & ~F.col("note").contains("@")).alias("redacted"))
    dead = c.spark.read.parquet(f"{run}/dead").groupBy(
        F.lit("dead").alias("kind"), F.split_part(read("$.reason"), F.lit(":"), F.lit(1)).alias("label")).agg(F.count(F.lit(1)).alias("messages"))
    return processed.unionByName(dead, allowMissingColumns=True)


@query("stream_slo_compliance", "R1 A24", QUERIES["daily_slo_compliance"].sql)
def _(c: Context):
    """Every day noted as touched, one after the other half of the month, and rebuilt from the event table."""
    run = run_folder(c)
    stored = _usage_events(c).withColumns({"payload": F.lit("{}"), "emitted_at": F.col("event_ts"), "event_month": F.date_format("event_ts", "yyyy-MM")})
    covered = -1
    for batch, part in enumerate((F.col("event_date") < F.lit("2024-01-15").cast("date"), F.col("event_date") >= F.lit("2024-01-15").cast("date"))):
        rows = stored.where(part)
        tables.append_events(rows.drop("model_name", "input_tokens", "output_tokens", "estimated_cost_usd"), f"{run}/events")
        tables.write_batch(rows.select(F.date_trunc("hour", "event_ts").cast("timestamp_ntz").alias("hour")).distinct(), f"{run}/touched", batch)
        covered = jobs.rebuild_compliance(c.spark, f"{run}/events", f"{run}/touched", c.slos, f"{run}/compliance", covered)
    return tables.latest_rows(c.spark, f"{run}/compliance", ["slo_id", "application_id", "day"])


@query("stream_event_store", "R4 S5 S6 S8 S11", """
SELECT application_id, date_trunc('day', event_ts) AS day, n(count(*)) AS events, n(count(*) FILTER (event_type = 'REQUEST_COMPLETED')) AS completed FROM obs GROUP BY ALL""")
def _(c: Context):
    run = run_folder(c)
    stream = StreamContext(c.spark, c.sf_dir).obs
    body = F.to_json(F.struct(
        "event_id", "event_type", "service_name", F.lit("dev").alias("environment"), "status", "application_id", "latency_ms",
        F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.struct("model_name", "input_tokens", "output_tokens").alias("payload")))
    copies = F.when(F.col("seq") % 20 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    messages = stream.select(body.alias("value"), copies.alias("_c")).select("value", F.explode("_c")).drop("col")
    _finish(jobs.storage(messages, f"{run}/events", f"{run}/domain", f"{run}/touched", f"{run}/checkpoint", available_now=True))
    jobs.rebuild_rollup(c.spark, f"{run}/events", f"{run}/touched", f"{run}/hourly")
    stored = c.spark.read.parquet(f"{run}/events").groupBy("application_id", F.date_trunc("day", "event_ts").alias("day")).agg(F.count(F.lit(1)).alias("events"))
    hourly = tables.latest_rows(c.spark, f"{run}/hourly", ["application_id", "hour"]).groupBy("application_id", F.date_trunc("day", "hour").alias("day")).agg(F.sum("success_count").alias("completed"))
    return stored.join(hourly, ["application_id", "day"], "left").fillna(0, ["completed"])
