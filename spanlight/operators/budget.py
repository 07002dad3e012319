"""Spend against budget limits: totals, crossings, utilisation, adherence.

A single hot (application, model, period) would put its whole history into one window. Crossings
are therefore found on totals per minute and only the minute of a crossing is looked at by event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import money
from ..functions.times import bucket, period_start
from ..session import cut_lineage
from .lookups import match_budgets
from .order_stats import ratio, running_sums

KEYS = ["application_id", "limit_model", "period", "period_start"]


def counted(costed: DataFrame, unique: bool) -> DataFrame:
    """Events that count: with cost and application, each identifier once. `unique` tells that no copies are there."""
    spend = costed.where("cost_usd > 0 AND application_id IS NOT NULL")
    return spend if unique else spend.dropDuplicates(["event_id"])


def matched_spend(spend: DataFrame, limits: DataFrame) -> DataFrame:
    """One row per event and limit, with the period it counts into."""
    return match_budgets(spend, limits).withColumn("period_start", period_start("event_ts", F.col("period")))


def totals(costed: DataFrame, limits: DataFrame, unique: bool = False) -> DataFrame:
    """Accumulated spend per limit and period: pre-aggregated per day and model before the limits join."""
    daily = (
        counted(costed, unique)
        .groupBy("application_id", "model_name", F.col("event_ts").cast("date").alias("event_ts"))
        .agg(F.sum("cost_usd").alias("cost_usd"))
    )
    return matched_spend(daily, limits).groupBy(*KEYS, "max_spend_usd", "alert_at_pct").agg(
        F.sum("cost_usd").cast(money.TOTAL).alias("spend_usd")
    ).withColumns({
        "alert_emitted": F.col("spend_usd") >= alert_line(),
        "cap_emitted": F.col("spend_usd") >= F.col("max_spend_usd"),
    })


def alert_line() -> Column:
    return F.col("max_spend_usd") * F.col("alert_at_pct") / F.lit(100)


def _refine(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Per key and bucket of `order`: the bucket in which the running total reaches the line."""
    sums = rows.groupBy(*keys, "line", "before", order).agg(F.sum("cost_usd").cast(money.TOTAL).alias("_s"))
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = sums.withColumn("_upto", (F.col("before") + F.sum("_s").over(upto).cast(money.TOTAL)).cast(money.TOTAL))
    return run.where((F.col("_upto") >= F.col("line")) & (F.col("_upto") - F.col("_s") < F.col("line"))).select(
        *keys, "line", (F.col("_upto") - F.col("_s")).cast(money.TOTAL).alias("before"), order)


def crossings(costed: DataFrame, limits: DataFrame, opening: DataFrame | None = None, unique: bool = False) -> DataFrame:
    """The events on which a limit's alert share or cap was reached, one row per crossing.

    Order is (event_ts, event_id). `opening` carries spend per KEYS accumulated earlier, as
    (KEYS, opening_usd); a line it already reached is not crossed again.
    """
    # Looked at twice, by minute and inside the minutes that matter: the few columns needed are made once.
    spend = cut_lineage(counted(costed, unique).select("event_id", "event_ts", "application_id", "model_name", "cost_usd"))
    rows = matched_spend(spend, limits).withColumns({
        "minute": bucket("event_ts", "minute"),
        "second": bucket("event_ts", "second"),
        "limit_usd": F.col("max_spend_usd"),
    })
    if opening is None:
        rows = rows.withColumn("before", F.lit(0).cast(money.TOTAL))
    else:
        rows = rows.join(opening, KEYS, "left").withColumn(
            "before", F.coalesce("opening_usd", F.lit(0)).cast(money.TOTAL)).drop("opening_usd")
    kinds = F.explode(F.array(
        F.struct(F.lit("alert").alias("kind"), alert_line().cast(money.TOTAL).alias("line")),
        F.struct(F.lit("cap").alias("kind"), F.col("max_spend_usd").cast(money.TOTAL).alias("line"))))
    per_minute = rows.groupBy(*KEYS, "max_spend_usd", "alert_at_pct", "before", "minute").agg(F.sum("cost_usd").cast(money.TOTAL).alias("cost_usd"))
    lined = per_minute.select("*", kinds.alias("k")).select("*", "k.kind", "k.line").where("before < line")
    keys = [*KEYS, "kind"]
    hit_minute = _refine(lined, keys, "minute")
    # A few rows per crossing are left; kept aside so that the events are not read again for them.
    in_minute = cut_lineage(rows.drop("before").join(hit_minute, [*KEYS, "minute"]))
    hit_second = _refine(in_minute, keys, "second")
    in_second = in_minute.drop("before", "line").join(hit_second, [*keys, "second"])
    upto = Window.partitionBy(*keys).orderBy("event_ts", "event_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spend = (F.col("before") + F.sum("cost_usd").over(upto).cast(money.TOTAL)).cast(money.TOTAL)
    return in_second.withColumn("new_spend_usd", spend).where(
        (F.col("new_spend_usd") >= F.col("line")) & (F.col("new_spend_usd") - F.col("cost_usd") < F.col("line"))
    ).select(*KEYS, "kind", "event_id", "event_ts", "new_spend_usd", "limit_usd")


def flags(costed: DataFrame, limits: DataFrame, opening: DataFrame | None = None, unique: bool = False) -> DataFrame:
    """Per event that reached a line: budget_alert (period, spend_usd, limit_usd) of the alert with the largest
    limit, ties by period, and budget_cap_breached. A handful of rows, to be joined to the events by id."""
    found = crossings(costed, limits, opening, unique)
    alert = F.struct(F.col("period"), F.col("new_spend_usd").cast("double").alias("spend_usd"), F.col("limit_usd").cast("double").alias("limit_usd"))
    is_alert = F.col("kind") == "alert"
    return found.groupBy("event_id").agg(
        F.max_by(F.when(is_alert, alert), F.when(is_alert, F.struct("limit_usd", "period"))).alias("budget_alert"),
        F.max(F.col("kind") == "cap").alias("budget_cap_breached"))


def utilisation(costed: DataFrame, limits: DataFrame, unique: bool = False) -> DataFrame:
    """Running spend and its share of the limit at every event."""
    rows = matched_spend(counted(costed, unique), limits).withColumn("minute", bucket("event_ts", "minute"))
    run = running_sums(rows, KEYS, "minute", ["event_ts", "event_id"], {"running_usd": "cost_usd"})
    return run.withColumn("utilisation_pct", ratio(F.col("running_usd").cast("double"), F.col("max_spend_usd").cast("double"), 100.0))


def adherence(accumulated: DataFrame) -> DataFrame:
    """Spend against cap with headroom, from `totals`."""
    return accumulated.withColumns({
        "utilisation_pct": ratio(F.col("spend_usd").cast("double"), F.col("max_spend_usd").cast("double"), 100.0),
        "headroom_usd": F.col("max_spend_usd") - F.col("spend_usd"),
        "state": F.when(F.col("cap_emitted"), "breached").when(F.col("alert_emitted"), "warning").otherwise("ok"),
    })


def daily_spend_trend(costed: DataFrame, keys: list[str], days: int = 7, factor: float = 2.0) -> DataFrame:
    """Daily spend, its trailing mean over the previous days with data, the previous day, and flags."""
    daily = costed.groupBy(*keys, F.col("event_ts").cast("date").alias("day")).agg(
        F.sum("cost_usd").cast(money.TOTAL).alias("spend_usd"))
    w = Window.partitionBy(*keys).orderBy("day")
    trailing = w.rowsBetween(-days, -1)
    mean = F.sum("spend_usd").over(trailing).cast("double") / F.nullif(F.count("spend_usd").over(trailing), F.lit(0))
    spend = F.col("spend_usd").cast("double")
    return daily.withColumns({
        "trailing_mean_usd": mean, "previous_usd": F.lag("spend_usd").over(w).cast("double"),
    }).withColumns({
        "above_trend": F.coalesce(spend >= F.lit(factor) * F.col("trailing_mean_usd"), F.lit(False)),
        "doubled": F.coalesce(spend >= F.lit(factor) * F.col("previous_usd"), F.lit(False)),
    })
