"""Service-level objectives: burn rates, daily compliance, error budget, burn alerts.

A burn rate at an event covers the current minute up to that event and the 59 (359) minutes before
it. Whole minutes come from per-minute counts; only the current minute is ordered by event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..catalogs import BURN_LEVELS, DAILY_BREACH_BURN_1H
from ..contract import TERMINAL_REQUEST_EVENTS
from ..functions.times import bucket, day, epoch_minute
from ..session import small_side
from .lookups import match_slos
from .order_stats import ratio, running_sums


FILTER_COLUMNS = ["event_type", "service_name", "status", "lob", "agent_id", "tool_id", "model_name", "http_status"]


def slo_events(events: DataFrame, definitions: DataFrame) -> DataFrame:
    """Terminal request events per objective with their good flag. Other SLI kinds are computed elsewhere."""
    terminal = events.where(F.col("event_type").isin(TERMINAL_REQUEST_EVENTS))
    per_event = definitions.where(F.col("sli_type").isin("availability", "latency"))
    if "event_filter" not in per_event.columns:
        per_event = per_event.withColumn("event_filter", F.lit(None).cast("map<string,string>"))
    # Every entry of an objective's filter must equal the event's column of that name; an unknown name matches nothing.
    own = F.create_map(*[x for c in FILTER_COLUMNS if c in terminal.columns for x in (F.lit(c), F.col(c).cast("string"))])
    passes = F.forall(F.map_entries("event_filter"), lambda e: F.coalesce(F.element_at(own, e["key"]) == e["value"], F.lit(False)))
    good = F.when(F.col("sli_type") == "availability", F.col("status") == "success").otherwise(
        F.coalesce(F.col("latency_ms") <= F.col("latency_target_ms"), F.lit(False)))
    matched = match_slos(terminal, per_event).where(F.col("event_filter").isNull() | passes).drop("event_filter")
    return matched.withColumns({
        "good": good.cast("int"), "one": F.lit(1), "minute": epoch_minute("event_ts"),
        "second": bucket("event_ts", "second"),
    })


def _budget() -> Column:
    return F.lit(1.0) - F.col("target_pct").cast("double") / 100.0


def burn(good: Column, total: Column) -> Column:
    """Bad share over allowed share; null for a target of 100 %."""
    allowed = F.nullif(_budget(), F.lit(0.0))
    return (F.lit(1.0) - good / total) / allowed


def burn_rates(events: DataFrame, definitions: DataFrame, short_minutes: int = 60, long_minutes: int = 360) -> DataFrame:
    """burn_rate_1h and burn_rate_6h at every terminal request event."""
    rows = slo_events(events, definitions)
    per_minute = rows.groupBy("slo_id", "minute").agg(F.sum("good").alias("g"), F.sum("one").alias("t"))
    w = Window.partitionBy("slo_id").orderBy("minute")
    earlier = {}
    for name, minutes in (("s", short_minutes), ("l", long_minutes)):
        frame = w.rangeBetween(-(minutes - 1), -1)
        earlier[f"{name}_g"] = F.coalesce(F.sum("g").over(frame), F.lit(0))
        earlier[f"{name}_t"] = F.coalesce(F.sum("t").over(frame), F.lit(0))
    history = per_minute.withColumns(earlier).drop("g", "t")
    now = running_sums(rows, ["slo_id", "minute"], "second", ["event_ts", "event_id"], {"now_g": "good", "now_t": "one"})
    joined = now.join(history, ["slo_id", "minute"])
    return joined.withColumns({
        "burn_rate_1h": burn(F.col("s_g") + F.col("now_g"), F.col("s_t") + F.col("now_t")),
        "burn_rate_6h": burn(F.col("l_g") + F.col("now_g"), F.col("l_t") + F.col("now_t")),
    }).select("slo_id", "application_id", "event_id", "event_ts", "good", "target_pct", "window_days",
              "burn_rate_1h", "burn_rate_6h")


def daily_compliance(rates: DataFrame) -> DataFrame:
    """Per objective and day: good, total, sli_pct, worst burn rates, breach of the 1 h threshold."""
    return rates.groupBy("slo_id", "application_id", "target_pct", "window_days", day("event_ts").alias("day")).agg(
        F.sum("good").alias("good_events"), F.count(F.lit(1)).alias("total_events"),
        ratio(F.sum("good"), F.count(F.lit(1)), 100.0).alias("sli_pct"),
        F.max("burn_rate_1h").alias("burn_rate_1h"), F.max("burn_rate_6h").alias("burn_rate_6h"),
        F.coalesce(F.max(F.col("burn_rate_1h") > DAILY_BREACH_BURN_1H), F.lit(False)).alias("breached"),
    )


def daily_counts(events: DataFrame, definitions: DataFrame) -> DataFrame:
    """Good and total events and sli_pct per objective and day, as in `daily_compliance`, without its burn rates: one
    pass over the events and no order among them."""
    keys = ["slo_id", "application_id", "target_pct", "window_days", day("event_ts").alias("day")]
    return slo_events(events, definitions).groupBy(*keys).agg(
        F.sum("good").alias("good_events"), F.count(F.lit(1)).alias("total_events"),
        ratio(F.sum("good"), F.count(F.lit(1)), 100.0).alias("sli_pct"))


def error_budget(compliance: DataFrame) -> DataFrame:
    """Share of the error budget used over the rolling window of days, what is left, and when it runs out."""
    epoch_day = F.datediff("day", F.lit("1970-01-01").cast("date"))
    rows = compliance.withColumn("_d", epoch_day)
    # A day counts into the windows of the window_days days from it on: bounded fan-out of daily rows.
    days = F.sequence(F.col("_d"), F.col("_d") + F.col("window_days") - 1)
    spread = rows.select("slo_id", F.explode(days).alias("_d"), "good_events", "total_events")
    sums = spread.groupBy("slo_id", "_d").agg(F.sum("good_events").alias("wg"), F.sum("total_events").alias("wt"))
    joined = rows.join(sums, ["slo_id", "_d"])
    bad = F.col("wt") - F.col("wg")
    allowed = F.nullif(_budget() * F.col("wt"), F.lit(0.0))
    used = F.lit(100.0) * bad / allowed
    return joined.withColumns({
        "error_budget_consumed_pct": used,
        "error_budget_remaining_pct": F.when(used.isNotNull(), F.greatest(F.lit(100.0) - used, F.lit(0.0))),
    }).withColumn(
        "exhausted_on",
        F.when(F.col("error_budget_remaining_pct") <= 0, F.col("day")).when(
            F.col("burn_rate_6h") > 0,
            F.date_add("day", F.ceil(
                F.col("error_budget_remaining_pct") / 100.0 * F.col("window_days") / F.col("burn_rate_6h")).cast("int"))),
    ).drop("wg", "wt", "_d")


def burn_alerts(rates: DataFrame) -> DataFrame:
    """Events at which both windows exceed a level's thresholds; the strictest level wins."""
    level = F.coalesce(*[
        F.when((F.col("burn_rate_1h") > fast) & (F.col("burn_rate_6h") > slow), name) for name, fast, slow in BURN_LEVELS])
    return rates.withColumn("level", level).where("level IS NOT NULL")


def history_snapshot(compliance: DataFrame, apps: DataFrame) -> DataFrame:
    """Daily compliance with the application's line of business, for the long-term table."""
    dim = small_side(apps.select("application_id", "lob"))
    return compliance.join(dim, "application_id", "left").select(
        "slo_id", F.col("day").cast("timestamp_ntz").alias("event_ts"), "application_id", "lob",
        F.round("sli_pct", 3).alias("sli_pct"), F.round("burn_rate_1h", 4).alias("burn_rate_1h"),
        F.round("burn_rate_6h", 4).alias("burn_rate_6h"), "breached")


def minute_counts(events: DataFrame, definitions: DataFrame) -> DataFrame:
    """Good and total per objective and minute; also runs on a stream with a watermark."""
    rows = slo_events(events, definitions)
    return rows.groupBy("slo_id", F.window("event_ts", "1 minute").alias("w")).agg(
        F.sum("good").alias("good"), F.sum("one").alias("total")
    ).select("slo_id", F.floor(F.unix_seconds(F.col("w.start").cast("timestamp")) / 60).cast("long").alias("minute"), "good", "total")


def sliding_counts(minutes: DataFrame, length: int) -> DataFrame:
    """Counts in windows of `length` minutes that slide by one minute, from counts per minute.

    Swept by differences: a minute's counts come in with the first window that holds it and go out behind the last, two
    rows whatever the length. Running sums per objective (minutes, not events) hold between two changes, and only after
    the shuffle is each stretch spelled out minute by minute.
    """
    change = lambda at, sign: F.struct(at.alias("m"), (sign * F.col("good")).alias("good"), (sign * F.col("total")).alias("total"))
    changes = minutes.select("slo_id", F.explode(F.array(change(F.col("minute") - (length - 1), 1), change(F.col("minute") + 1, -1))).alias("c"))
    net = changes.groupBy("slo_id", F.col("c.m").alias("_m")).agg(F.sum("c.good").alias("g"), F.sum("c.total").alias("t"))
    order = Window.partitionBy("slo_id").orderBy("_m")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = net.select("slo_id", "_m", F.lead("_m").over(order).alias("_next"), F.sum("g").over(upto).alias("good"), F.sum("t").over(upto).alias("total"))
    each = runs.where("total > 0").select("slo_id", F.explode(F.sequence(F.col("_m"), F.col("_next") - 1)).alias("_m"), "good", "total")
    start = F.timestamp_seconds(F.col("_m") * 60).cast("timestamp_ntz")
    end = F.timestamp_seconds((F.col("_m") + length) * 60).cast("timestamp_ntz")
    return each.select("slo_id", start.alias("window_start"), end.alias("window_end"), "good", "total")
