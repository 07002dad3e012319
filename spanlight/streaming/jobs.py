"""Enrichment, storage, rollups, sliding counters and budgets as streaming queries.

Delivery is at least once: a micro-batch is committed after its sinks were written, and every sink
either replaces its own batch directory or ignores keys it already has, so a repeated batch leaves
no trace. Windowed counts have a watermark on event time (10 minutes unless given). Rows later than that
still reach the event table, and the hours they touch are noted there: `rebuild_rollup`, `rebuild_usage`,
`rebuild_slo_minutes` and `rebuild_minute_rates` make the rows of these hours anew from all stored events.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions import money
from ..operators import alerts, budget, enrich, slo, store, validate
from ..operators.rollups import hourly_application
from ..session import small_side
from ..sources import lookup, tables

WATERMARK = "10 minutes"
FLUSH = "5 seconds"
REBUILT = "_rebuilt"
SNAPSHOT = 50


def _adaptive(work: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Run a batch's own queries adaptively (skew, partition sizes). Streaming plans keep their fixed
    partitions: the setting is put back before the next batch is planned."""
    def run(batch: DataFrame, batch_id: int) -> None:
        conf = batch.sparkSession.conf
        before = conf.get("spark.sql.adaptive.enabled")
        conf.set("spark.sql.adaptive.enabled", "true")
        try:
            work(batch, batch_id)
        finally:
            conf.set("spark.sql.adaptive.enabled", before)

    return run


def _start(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
           available_now: bool = False, interval: str = FLUSH) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(_adaptive(work)).option("checkpointLocation", checkpoint).outputMode(mode)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


Sink = str | Callable[[DataFrame, int], None]


def _send(rows: DataFrame, sink: Sink, batch_id: int) -> None:
    """Into a table of batches, or to what the caller passed, such as `messages.kafka_sink`."""
    if isinstance(sink, str):
        tables.write_batch(rows, sink, batch_id)
    else:
        sink(rows, batch_id)


def enrichment(messages: DataFrame, dims: Callable[[SparkSession], enrich.Dimensions], processed: Sink, dead: Sink,
               checkpoint: str, archive: str | None = None, settings: enrich.Settings | None = None,
               available_now: bool = False, limits: Callable[[SparkSession], DataFrame] | None = None,
               ledger: str | None = None, errors: str | None = None) -> StreamingQuery:
    """Raw messages to processed messages, dead letters and archived texts.

    The registries are read again for each batch, so a changed registry needs no restart. With an
    `archive` oversized texts move there and their pointers name it; without one they stay in the event.
    With `limits` and a `ledger` of spend the events that reach a budget line are marked; stages that found
    their input unusable are noted in the table `errors`.
    """
    settings = replace(settings or enrich.Settings(), archive_root=archive)

    def work(batch: DataFrame, batch_id: int) -> None:
        checked = validate.validate(batch).persist()
        try:
            valid = validate.good(checked)
            out = enrich.enrich(valid, dims(batch.sparkSession), settings, now=F.current_timestamp())
            if limits is not None and ledger is not None:
                known = limits(batch.sparkSession)
                opening = _charge(batch.sparkSession, enrich.charged(out), known, ledger, batch_id, unique=False)
                out = enrich.with_budget_flags(out, known, opening)
            _send(enrich.to_message(out), processed, batch_id)
            if errors:
                tables.write_batch(enrich.stage_error_rows(out), errors, batch_id)
            _send(validate.dead_letters(checked), dead, batch_id)
            if archive:
                clean = valid.withColumn("payload", enrich.redacted_payload(settings))
                tables.write_batch(enrich.oversized(clean, settings), archive, batch_id, ["prefix"])
        finally:
            checked.unpersist()

    return _start(messages, work, checkpoint, available_now=available_now)


def storage(processed: DataFrame, events_path: str, domain_root: str, touched_path: str, checkpoint: str,
            watermark: str = WATERMARK, available_now: bool = False, index_path: str | None = None) -> StreamingQuery:
    """Processed messages into the event table and the domain tables, noting the hours they touch.

    Copies that arrive within the watermark are dropped by the state store, older ones by the keys
    already stored. The watermark follows arrival, not event time, so a late event is stored all the same.
    A message without a time gets its arrival, and as that moves with every delivery its copies are told
    by their identifier alone. Domain tables are projected from what this batch left in the event table, so
    they never hold a copy that the event table refused, and a repeated batch finds the same rows. With an `index_path`
    the files of the batch's days are entered in the look-up index of correlation ids.
    """
    arrival = F.col("timestamp") if dict(processed.dtypes).get("timestamp") == "timestamp" else F.current_timestamp()
    arrived = processed.select("value", arrival.alias("_at")).withWatermark("_at", watermark)
    checked = validate.good(validate.validate(arrived, now=F.col("_at")))
    arrived_text = F.date_format("_at", validate.TIME_FORMAT)
    read = lambda c: (F.col(c) != arrived_text) & F.try_to_timestamp(c).isNotNull()
    given = read("timestamp") | (F.try_to_timestamp("timestamp").isNull() & read("emitted_at"))
    typed = store.typed(checked).withColumn("time_given", F.coalesce(given, F.lit(False)))
    unique = typed.dropDuplicatesWithinWatermark(["event_id"]).drop("_at")

    def work(batch: DataFrame, batch_id: int) -> None:
        rows = batch.drop("source_value", "value").withColumn("ingest_batch", F.lit(batch_id).cast("long")).persist()
        try:
            files = tables.files_per_value(rows, "event_date")
            tables.append_events(rows, events_path, files)
            if files:
                kept = tables.stored_batch(rows.sparkSession, events_path, batch_id, list(files))
                tables.write_domain_tables(kept, domain_root, batch_id, files)
                if index_path:
                    lookup.update(rows.sparkSession, events_path, index_path, days=list(files) if len(files) <= tables.MAX_LISTED_DAYS else None)
            hours = rows.select(F.date_trunc("hour", "event_ts").cast("timestamp_ntz").alias("hour")).distinct()
            tables.write_batch(hours, touched_path, batch_id)
        finally:
            rows.unpersist()

    return _start(unique, work, checkpoint, available_now=available_now)


def _rebuild(spark: SparkSession, events_path: str, touched_path: str, out: str, after_batch: int,
             make: Callable[[DataFrame], DataFrame]) -> int:
    """Rebuild the hours touched since a batch from all stored events, late ones included.

    Meant to run every few minutes, apart from the micro-batches; returns the last batch it covered. The
    new rows are a later version than any that the stream has written.
    """
    notes = spark.read.option("basePath", touched_path).parquet(touched_path).where(F.col("batch") > after_batch)
    last = notes.agg(F.max("batch")).first()[0]
    if last is None:
        return after_batch
    tables.recompute_hours(notes.select("hour").distinct(), spark.read.parquet(events_path), make, out, last)
    return last


def rebuild_rollup(spark: SparkSession, events_path: str, touched_path: str, rollup_path: str, after_batch: int = -1) -> int:
    """The hourly application rollup of the touched hours."""
    return _rebuild(spark, events_path, touched_path, rollup_path, after_batch, lambda rows: hourly_application(promoted(rows)))


def rebuild_usage(spark: SparkSession, events_path: str, touched_path: str, out: str, after_batch: int = -1) -> int:
    """The rows of `hourly_usage` of the touched hours; read both with `current_rows`."""
    return _rebuild(spark, events_path, touched_path, f"{out}{REBUILT}", after_batch,
                    lambda rows: _usage(promoted(rows).withColumn("_at", F.col("event_ts").cast("timestamp"))))


def rebuild_slo_minutes(spark: SparkSession, events_path: str, touched_path: str, definitions: DataFrame, out: str,
                        after_batch: int = -1) -> int:
    """The rows of `slo_minutes` of the touched hours; read both with `current_rows`."""
    return _rebuild(spark, events_path, touched_path, f"{out}{REBUILT}", after_batch,
                    lambda rows: slo.minute_counts(rows.withColumn("event_ts", F.col("event_ts").cast("timestamp")), definitions))


def rebuild_minute_rates(spark: SparkSession, events_path: str, touched_path: str, out: str, after_batch: int = -1) -> int:
    """The rows of `minute_rates` of the touched hours; read both with `current_rows`."""
    return _rebuild(spark, events_path, touched_path, f"{out}{REBUILT}", after_batch,
                    lambda rows: _rates(rows.withColumn("_at", F.col("event_ts").cast("timestamp"))))


def rebuild_compliance(spark: SparkSession, events_path: str, touched_path: str, definitions: DataFrame, out: str,
                       after_batch: int = -1) -> int:
    """Daily compliance of the days touched since a batch; read with `tables.latest_rows`.

    A burn rate looks back six hours, so the day before is read along, and the first hours of the day after a
    touched one are judged anew with it.
    """
    notes = spark.read.option("basePath", touched_path).parquet(touched_path).where(F.col("batch") > after_batch)
    last = notes.agg(F.max("batch")).first()[0]
    if last is None:
        return after_batch
    touched = notes.select(F.col("hour").cast("date").alias("day")).distinct()
    judged = touched.select(F.explode(F.array("day", F.date_add("day", 1))).alias("day")).distinct()
    needed = judged.select(F.explode(F.array("day", F.date_sub("day", 1))).alias("event_date")).distinct()
    rows = spark.read.parquet(events_path).join(small_side(needed), "event_date", "left_semi")
    daily = slo.daily_compliance(slo.burn_rates(rows, definitions))
    tables.write_batch(daily.join(small_side(judged), "day", "left_semi"), out, last)
    return last


def current_rows(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """Rows of a windowed table: a rebuilt row is made from all stored events and goes before a streamed one."""
    streamed = tables.latest_rows(spark, out, keys)
    if not tables.exists(spark, f"{out}{REBUILT}"):
        return streamed
    rebuilt = tables.latest_rows(spark, f"{out}{REBUILT}", keys)
    return rebuilt.unionByName(streamed.join(rebuilt.select(*keys), keys, "left_anti"))


def promoted(stored: DataFrame) -> DataFrame:
    """The payload columns the rollups use, typed, from stored events."""
    doc = F.try_parse_json("payload")
    wanted = {"model_name": "string", "input_tokens": "bigint", "output_tokens": "bigint", "estimated_cost_usd": "decimal(20,8)"}
    return stored.withColumns({k: F.try_variant_get(doc, f"$.{k}", t) for k, t in wanted.items()})


def _usage(rows: DataFrame) -> DataFrame:
    t = F.col("event_type")
    return rows.groupBy("application_id", F.window("_at", "1 hour").alias("w")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("status") == "failed").alias("failures"),
        F.sum(F.when(t.startswith("LLM_"), F.col("input_tokens") + F.col("output_tokens"))).alias("tokens"),
        F.sum("estimated_cost_usd").cast(money.TOTAL).alias("cost_usd"),
        F.percentile_approx("latency_ms", 0.95, 10_000).alias("p95_latency_ms"),
    ).select("application_id", F.col("w.start").cast("timestamp_ntz").alias("hour"), "events", "failures", "tokens", "cost_usd", "p95_latency_ms")


def hourly_usage(events: DataFrame, out: str, checkpoint: str, watermark: str = WATERMARK,
                 available_now: bool = False) -> StreamingQuery:
    """Hourly counts, tokens and cost per application in update mode; read with `current_rows`."""
    rows = events.withColumn("_at", F.col("event_ts").cast("timestamp")).withWatermark("_at", watermark)

    def work(batch: DataFrame, batch_id: int) -> None:
        tables.write_batch(batch, out, batch_id)

    return _start(_usage(rows), work, checkpoint, "update", available_now)


def slo_minutes(events: DataFrame, definitions: DataFrame, out: str, checkpoint: str,
                watermark: str = WATERMARK, available_now: bool = False) -> StreamingQuery:
    """Good and total per objective and minute. The state is minutes; the sliding windows of one and
    six hours are read off the minute table with `slo.sliding_counts`."""
    stamped = events.withColumn("event_ts", F.col("event_ts").cast("timestamp")).withWatermark("event_ts", watermark)
    counts = slo.minute_counts(stamped, definitions)

    def work(batch: DataFrame, batch_id: int) -> None:
        tables.write_batch(batch, out, batch_id)

    return _start(counts, work, checkpoint, "update", available_now)


def _rates(rows: DataFrame) -> DataFrame:
    counts = rows.groupBy("service_name", F.window("_at", "1 minute").alias("w")).agg(
        F.count_if(F.col("http_status") >= 500).alias("failed"), F.count("http_status").alias("total"))
    return counts.select("service_name", F.floor(F.unix_seconds("w.start") / 60).cast("long").alias("minute"), "failed", "total")


def minute_rates(events: DataFrame, out: str, checkpoint: str, watermark: str = WATERMARK,
                 available_now: bool = False) -> StreamingQuery:
    """Requests and server errors per service and minute; alert states are read off with `held_alerts`."""
    stamped = events.withColumn("_at", F.col("event_ts").cast("timestamp")).withWatermark("_at", watermark)

    def work(batch: DataFrame, batch_id: int) -> None:
        tables.write_batch(batch, out, batch_id)

    return _start(_rates(stamped), work, checkpoint, "update", available_now)


def held_alerts(spark: SparkSession, path: str, share: float = 0.05, rate_minutes: int = 5, hold_minutes: int = 10) -> DataFrame:
    """Services over the error share for the hold time, from the minute table."""
    minutes = current_rows(spark, path, ["service_name", "minute"])
    spread = minutes.withColumn("minute", F.explode(F.sequence(F.col("minute"), F.col("minute") + rate_minutes - 1)))
    rates = spread.groupBy("service_name", "minute").agg(F.sum("failed").alias("failed"), F.sum("total").alias("total"))
    over: Column = F.col("failed") / F.greatest(F.col("total").cast("double"), F.lit(0.001 * rate_minutes * 60)) > share
    return alerts.holding(rates, ["service_name"], over, hold_minutes)


def budgets(costed: DataFrame, limits: Callable[[SparkSession], DataFrame], root: str, checkpoint: str,
            watermark: str = "1 hour", available_now: bool = False) -> StreamingQuery:
    """Budget crossings as they happen, each reported once; every event counts once.

    Copies that arrive within the watermark of each other are dropped by the state store; a source that
    may redeliver later than that is read from the event table, which holds each event once. Totals per limit
    and period live in a table: a batch writes those it changed and, every SNAPSHOT batches, all of them.
    They never expire, so neither a late event nor one with a wild date starts a period anew; events
    dated beyond tomorrow are set aside in `{root}/future` until someone has looked at them.
    """
    arrived = costed.withColumn("_at", F.current_timestamp()).withWatermark("_at", watermark)
    unique = arrived.dropDuplicatesWithinWatermark(["event_id"]).drop("_at")

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = limits(spark)
        rows = batch.withColumn("_future", F.col("event_ts") > F.date_add(F.current_date(), 2)).persist()
        try:
            tables.write_batch(rows.where("_future").drop("_future"), f"{root}/future", batch_id)
            dated = rows.where("NOT _future").drop("_future")
            opening = _charge(spark, dated, known, root, batch_id, unique=True)
            tables.write_batch(budget.crossings(dated, known, opening, unique=True), f"{root}/crossings", batch_id)
        finally:
            rows.unpersist()

    return _start(unique, work, checkpoint, available_now=available_now)


def _charge(spark: SparkSession, spend: DataFrame, known: DataFrame, root: str, batch_id: int, unique: bool) -> DataFrame | None:
    """Add a batch's spend to the ledger; returns the totals that its limits opened with."""
    before = _totals_before(spark, root, batch_id)
    added = budget.totals(spend, known, unique=unique).select(*budget.KEYS, F.col("spend_usd").alias("opening_usd"))
    opening = None if before is None else before.join(added.select(*budget.KEYS), budget.KEYS, "left_semi")
    both = added if opening is None else opening.unionByName(added)
    changed = both.groupBy(*budget.KEYS).agg(F.sum("opening_usd").cast(money.TOTAL).alias("opening_usd"))
    tables.write_batch(changed, f"{root}/totals", batch_id)
    if batch_id % SNAPSHOT == SNAPSHOT - 1:
        tables.write_batch(_totals_before(spark, root, batch_id + 1), f"{root}/snapshots", batch_id)
    return opening


def _totals_before(spark: SparkSession, root: str, batch_id: int) -> DataFrame | None:
    """All totals before a batch: the last snapshot and the batches after it."""
    if batch_id == 0:
        return None
    if not tables.exists(spark, f"{root}/totals/batch={batch_id - 1}"):
        raise RuntimeError(f"the totals of batch {batch_id - 1} are missing under {root}; refusing to start from zero")
    last = (batch_id - 1) // SNAPSHOT * SNAPSHOT - 1  # the newest snapshot written before the previous batch ended
    totals = spark.read.option("basePath", f"{root}/totals").parquet(
        *[f"{root}/totals/batch={b}" for b in range(last + 1, batch_id)])
    if last >= 0:
        totals = totals.unionByName(spark.read.option("basePath", f"{root}/snapshots").parquet(f"{root}/snapshots/batch={last}"))
    return totals.groupBy(*budget.KEYS).agg(F.max_by("opening_usd", "batch").alias("opening_usd"))


def crossings(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/crossings").drop("batch")


def replay_dead_letters(spark: SparkSession, dead: str, raw: str, reason: str | None = None, limit: int | None = None,
                        dry_run: bool = False) -> DataFrame:
    """Put quarantined messages back on the raw files; returns what was (or would be) replayed."""
    letters = spark.read.parquet(dead).select("key", "value")
    again = validate.replay(letters, reason, limit)
    if not dry_run:
        again.drop("reason").write.mode("append").parquet(raw)
    return again
