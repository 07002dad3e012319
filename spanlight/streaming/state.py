"""Streaming operators with keyed state and event-time timers: spend per budget, life of an alert.

State lives in a RocksDB state store, which `run_to` sets for these jobs whatever the session has; it is versioned with
the checkpoint and restored from it, so a restart neither repeats nor forgets a result; the file sink takes each batch
once. A batch costs what it brings and what is due, not what came before.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.times import NTZ
from ..operators import budget

# Processors are sent by value: the worker that Spark starts for them beside the driver may not find this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Money in state is a whole number of 10^-8 dollars.
_UNIT = 100_000_000
_DAY_MS = 86_400_000

# Several states under one key need column families, which Spark's default store does not have.
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SPEND_OUT = ("application_id string, limit_model string, period string, period_day int, kind string, event_id string, "
             "ts long, spend long, cap long")
ALERT_OUT = "service_name string, state string, minute long, since long"


def _frame(rows: list[tuple], schema: str) -> Iterator[pd.DataFrame]:
    if rows:
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])


class SpendPerLimit(StatefulProcessor):
    """Running spend of one (application, limit model, period), with once-only flags for the alert share and the cap.

    Events wait until the watermark has passed them and are then added in the order (time, identifier), so the event that
    reaches a line does not depend on how arrivals were cut into batches. A period is forgotten `grace` after its
    end; what still arrives for it is told as `expired` and starts nothing anew.
    """

    def __init__(self, grace_ms: int):
        self.grace_ms = grace_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.totals = handle.getMapState("totals", "period_day int", "spent long, alerted boolean, capped boolean, ends_ms long")
        self.waiting = handle.getListState("waiting", "ts long, event_id string, cost long, period_day int, ends_ms long, alert long, cap long")

    def _fold(self, key: tuple, waiting: list[tuple], watermark: int) -> list[tuple]:
        """Add the events that the watermark has passed; keep and plan the others."""
        due = sorted(w for w in waiting if w[0] < watermark * 1000)
        later = [w for w in waiting if w[0] >= watermark * 1000]
        out, held = [], {}
        for ts, event_id, cost, day, ends, alert, cap in due:
            if day not in held:
                known = self.totals.getValue((day,)) if self.totals.containsKey((day,)) else (0, False, False, ends)
                held[day] = list(known)
                self.handle.registerTimer(ends + self.grace_ms)
            state = held[day]
            before, state[0] = state[0], state[0] + cost
            for kind, at, line in (("alert", 1, alert), ("cap", 2, cap)):
                if not state[at] and before < line <= state[0]:
                    state[at] = True
                    out.append((*key, day, kind, event_id, ts, state[0], cap))
        for day, state in held.items():
            self.totals.updateValue((day,), tuple(state))
        if later:
            self.waiting.put(later)
            self.handle.registerTimer(min(w[0] for w in later) // 1000 + 1)
        else:
            self.waiting.clear()
        return out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark, out = timerValues.getCurrentWatermarkInMs(), []
        waiting = list(self.waiting.get()) if self.waiting.exists() else []
        for part in rows:
            for r in zip(*(part[c].tolist() for c in ("ts", "event_id", "cost", "period_day", "ends_ms", "alert", "cap"))):
                if r[4] + self.grace_ms <= watermark:
                    out.append((*key, r[3], "expired", r[1], r[0], r[2], r[6]))
                else:
                    waiting.append(r)
        yield from _frame(out + self._fold(key, [tuple(w) for w in waiting], watermark), SPEND_OUT)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        waiting = [tuple(w) for w in self.waiting.get()] if self.waiting.exists() else []
        out = self._fold(key, waiting, watermark)
        for (day,), state in list(self.totals.iterator()):
            if state[3] + self.grace_ms <= watermark:
                self.totals.removeKey((day,))
        yield from _frame(out, SPEND_OUT)

    def close(self) -> None:
        pass


def _interval(seconds: int) -> Column:
    return F.make_dt_interval(secs=F.lit(seconds))


def spend_crossings(costed: DataFrame, limits: DataFrame, arrived: Column | None = None, hold_s: int = 600, skew_s: int = 300,
                    grace_s: int = 172_800) -> DataFrame:
    """A stream of costed events to the events on which a limit's alert share or cap was reached, each line once.

    Columns as `budget.crossings`. Events count in the order of event time if they arrive within `hold_s` of it, and when
    they come if later; a crossing is told when event time has gone on by `hold_s` + `skew_s`. Copies within that
    time count once. An event dated more than `skew_s` after its arrival is told as `future` and does not count,
    so a wild date moves no watermark; one of a period that ended `grace_s` ago is told as `expired`.
    A row without application or cost counts for nothing but the passing of time. `arrived` is the arrival time, by
    default now; a source read again from long ago needs its own, such as the time its log keeps.
    """
    at = F.current_timestamp() if arrived is None else arrived
    stamped = costed.withColumns({"_ts": F.col("event_ts").cast("timestamp"), "_arrived": at})
    future = F.col("_ts") > F.col("_arrived") + _interval(skew_s)
    clocked = stamped.where(~future).withColumn("_clock", F.greatest("_ts", F.col("_arrived") - _interval(hold_s)))
    unique = clocked.withWatermark("_clock", f"{hold_s + skew_s} seconds").dropDuplicatesWithinWatermark(["event_id"])
    matched = budget.matched_spend(budget.counted(unique, unique=True), limits)
    months, days = F.when(F.col("period").isin("daily", "weekly"), 0).otherwise(1), F.when(F.col("period") == "daily", 1).when(F.col("period") == "weekly", 7).otherwise(0)
    ends = F.date_add(F.add_months("period_start", months), days)
    units = lambda c: F.round(c * _UNIT, 0).cast("long")
    rows = matched.select(
        "application_id", "limit_model", "period", F.unix_micros("_ts").alias("ts"), "event_id", units(F.col("cost_usd")).alias("cost"),
        F.unix_date("period_start").alias("period_day"), (F.unix_date(ends).cast("long") * _DAY_MS).alias("ends_ms"),
        units(budget.alert_line()).alias("alert"), units(F.col("max_spend_usd")).alias("cap"), "_clock")
    told = rows.groupBy("application_id", "limit_model", "period").transformWithStateInPandas(
        SpendPerLimit(grace_s * 1000), SPEND_OUT, "append", "eventTime")
    dollars = lambda c: (F.col(c).cast("decimal(28,8)") / F.lit(_UNIT)).cast("decimal(28,8)")
    crossed = told.select(
        "application_id", "limit_model", "period", F.date_from_unix_date("period_day").alias("period_start"), "kind", "event_id",
        F.timestamp_micros("ts").cast(NTZ).alias("event_ts"), dollars("spend").alias("new_spend_usd"), dollars("cap").cast("decimal(12,2)").alias("limit_usd"))
    ahead = stamped.where(future & (F.col("cost_usd") > 0)).select(
        "application_id", F.lit(None).cast("string").alias("limit_model"), F.lit(None).cast("string").alias("period"), F.lit(None).cast("date").alias("period_start"),
        F.lit("future").alias("kind"), "event_id", F.col("_ts").cast(NTZ).alias("event_ts"), F.col("cost_usd").cast("decimal(28,8)").alias("new_spend_usd"),
        F.lit(None).cast("decimal(12,2)").alias("limit_usd"))
    return crossed.unionByName(ahead)


class AlertLife(StatefulProcessor):
    """pending -> firing -> resolved of one service, or pending -> cleared if it never held long enough.

    The condition is judged once for every minute, when its count is final, over the last `rate_minutes`; timers judge
    the minutes in which nothing comes.
    """

    def __init__(self, share: float, rate_minutes: int, hold_minutes: int):
        self.share, self.rate, self.hold = share, rate_minutes, hold_minutes

    def init(self, handle) -> None:
        self.handle = handle
        self.now = handle.getValueState("now", "state string, since long, judged long, minutes array<long>, failed array<long>, total array<long>")

    def _advance(self, key: tuple, given: dict[int, tuple[int, int]], to: int) -> list[tuple]:
        """Judge all minutes up to `to`; `given` holds the counts of new minutes."""
        state, since, judged, recent = "ok", 0, None, {}
        if self.now.exists():
            state, since, judged, m, f, t = self.now.get()
            recent = {a: (b, c) for a, b, c in zip(m, f, t)}
        recent.update({m: c for m, c in given.items() if judged is None or m > judged})
        out = []
        if recent:
            minutes = sorted(recent)
            minute = minutes[0] if judged is None else judged + 1
            first = upto = failed = total = 0  # minutes[first:upto] are those of the last `rate`; their sums
            while minute <= to:
                while upto < len(minutes) and minutes[upto] <= minute:
                    f, t = recent[minutes[upto]]
                    failed, total, upto = failed + f, total + t, upto + 1
                while first < upto and minutes[first] <= minute - self.rate:
                    f, t = recent[minutes[first]]
                    failed, total, first = failed - f, total - t, first + 1
                inside = first < upto
                if not inside and state == "ok":
                    if upto == len(minutes) or minutes[upto] > to:
                        break
                    minute = minutes[upto]
                    continue
                # The floor on the total keeps an idle service from dividing by zero.
                over = inside and failed / max(float(total), 0.001 * self.rate * 60) > self.share
                if over and state == "ok":
                    state, since = "pending", minute
                    out.append((key[0], state, minute, since))
                if over and state == "pending" and minute - since >= self.hold:
                    state = "firing"
                    out.append((key[0], state, minute, since))
                if not over and state != "ok":
                    out.append((key[0], "resolved" if state == "firing" else "cleared", minute, since))
                    state = "ok"
                judged = minute
                minute += 1
            recent = {m: recent[m] for m in minutes[first:]}
        if state == "ok" and not any(m > to - self.rate + 1 for m in recent):
            # Nothing is open: only what has been judged is kept, so that no minute is judged twice.
            recent, judged = {}, max(to, judged if judged is not None else to)
        kept = sorted(recent)
        self.now.update((state, since, judged, kept, [recent[m][0] for m in kept], [recent[m][1] for m in kept]))
        if kept or state != "ok":
            self.handle.registerTimer((to + 2) * 60_000)
        return out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        given: dict[int, tuple[int, int]] = {}
        if key[0] is None:
            return
        for part in rows:
            for m, f, t in zip(part["minute"].tolist(), part["failed"].tolist(), part["total"].tolist()):
                given[m] = (f, t)
        yield from _frame(self._advance(key, given, max(given)), ALERT_OUT)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        final = timerValues.getCurrentWatermarkInMs() // 60_000 - 1
        judged = self.now.get()[2] if self.now.exists() else None
        if judged is None or judged < final:
            yield from _frame(self._advance(key, {}, final), ALERT_OUT)

    def close(self) -> None:
        pass


def alert_transitions(events: DataFrame, share: float = 0.05, rate_minutes: int = 5, hold_minutes: int = 10,
                      watermark: str = "10 minutes") -> DataFrame:
    """A stream of requests to (service_name, state, at, since): the life of each service's server-error alert.

    Counts per minute are made before the state, so a busy service brings one row per minute. A row without a status
    counts for nothing but the passing of time.
    """
    stamped = events.withColumn("_at", F.col("event_ts").cast("timestamp")).withWatermark("_at", watermark)
    counts = stamped.groupBy("service_name", F.window("_at", "1 minute").alias("w")).agg(
        F.count_if(F.col("http_status") >= 500).alias("failed"), F.count("http_status").alias("total"))
    # Rows without a service go along to the state, which passes over them: a filter would be moved below the watermark.
    minutes = counts.select(
        "service_name", F.floor(F.unix_seconds("w.start") / 60).cast("long").alias("minute"), "failed", "total", F.window_time("w").alias("ended"))
    told = minutes.groupBy("service_name").transformWithStateInPandas(AlertLife(share, rate_minutes, hold_minutes), ALERT_OUT, "append", "eventTime")
    time = lambda c: F.timestamp_seconds(F.col(c) * 60).cast(NTZ)
    return told.select("service_name", "state", time("minute").alias("at"), time("since").alias("since"))


def run_to(rows: DataFrame, out: str, checkpoint: str, available_now: bool = False, interval: str = "5 seconds") -> StreamingQuery:
    """Into a table of files; the sink's log takes each batch once, also after a restart."""
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    writer = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(**trigger)
    conf = rows.sparkSession.conf
    before = conf.get(_PROVIDER, None)
    conf.set(_PROVIDER, _ROCKSDB)
    try:
        return writer.start()  # the query takes a copy of the settings here
    finally:
        if before is None:
            conf.unset(_PROVIDER)
        else:
            conf.set(_PROVIDER, before)
