"""Keyed streaming state: spend per budget and the life of an alert, over restarts."""

import time
from datetime import datetime, timedelta
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F
from test_registry import rows as plain_rows

from spanlight.plans.registry import oracle, run
from spanlight.streaming import state

START = datetime(2026, 3, 2, 10)  # a Monday
EVENTS = "event_id string, event_ts timestamp_ntz, application_id string, model_name string, cost_usd decimal(20,8), arrived timestamp"


@pytest.fixture()
def limits(spark):
    return spark.createDataFrame([("app", "*", "daily", Decimal("10.00"), 50), ("app", "m", "monthly", Decimal("30.00"), 80)],
                                 "application_id string, model_name string, period string, max_spend_usd decimal(12,2), alert_at_pct int")


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _at(minutes):
    return START + timedelta(minutes=minutes)


def _run(spark, tmp_path, job, schema, batches):
    """Each batch is a run of its own from the checkpoint; returns what each has told."""
    feed, out, seen, told = str(tmp_path / "feed"), str(tmp_path / "out"), set(), []
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(feed)
        state.run_to(job(spark.readStream.schema(schema).parquet(feed)), out, str(tmp_path / "ck"), available_now=True).awaitTermination()
        now = sorted(map(tuple, spark.read.parquet(out).collect()), key=str)
        fresh = [r for r in now if r not in seen]
        assert len(now) == len(set(now)) == len(seen) + len(fresh)  # nothing twice, nothing gone
        seen |= set(fresh)
        told.append(fresh)
    return told


def test_spend_over_restarts(spark, tmp_path, limits):
    def event(i, minute, cost, late=0, model="m"):
        return (f"e{i}", _at(minute), "app", model, Decimal(cost), _at(minute + late))

    def passing(minute):
        return (None, _at(minute), None, None, None, _at(minute))

    day = 24 * 60
    told = _run(spark, tmp_path, lambda s: state.spend_crossings(s, limits, F.col("arrived"), hold_s=600, skew_s=300, grace_s=3600), EVENTS, [
        # e2 is a copy; e4 reaches the alert by arrival, but e3, which comes late in the next run, is before it
        [event(1, 0, "2"), event(2, 1, "2"), event(2, 1, "2"), event(4, 3, "1.5")],
        [event(3, 2, "1", late=6), event(2, 1, "2", late=5), ("wild", datetime(2099, 1, 1), "app", "m", Decimal("900"), _at(9))],
        [event(5, 40, "4.5", model="other"), event(5, 41, "4.5", model="other")],
        [passing(80)],
        # hours late, still its day: counts when it comes; the day is over in the run after
        [event(6, 5, "0.25", late=200), passing(300)],
        [event(7, day, "20", model="m"), passing(day + 30)],
        [passing(day * 2)],
        [event(8, 6, "50", late=2 * day), passing(day * 2 + 100)],
        [passing(day * 70)]])
    short = [[(r[2], str(r[3]), r[4], r[5], None if r[7] is None else float(r[7])) for r in part] for part in told]
    assert short[0] == []  # nothing before event time has passed
    assert short[1] == [(None, "None", "future", "wild", 900.0)]
    assert short[2] == [("daily", "2026-03-02", "alert", "e3", 5.0)]
    assert short[3] == [("daily", "2026-03-02", "cap", "e5", 11.0)]
    assert short[4] == []
    assert sorted(short[5]) == [("daily", "2026-03-03", "alert", "e7", 20.0), ("daily", "2026-03-03", "cap", "e7", 20.0),
                                ("monthly", "2026-03-01", "alert", "e7", 26.75)]
    assert short[6] == []
    # The day of e8 is forgotten, its month is not.
    assert sorted(short[7]) == [("daily", "2026-03-02", "expired", "e8", 50.0), ("monthly", "2026-03-01", "cap", "e8", 76.75)]
    assert short[8] == []
    held = spark.read.format("statestore").option("operatorId", 0).option("stateVarName", "totals").load(str(tmp_path / "ck"))
    assert held.count() == 0  # all periods have ended
    waiting = spark.read.format("statestore").option("operatorId", 0).option("stateVarName", "waiting").load(str(tmp_path / "ck"))
    assert waiting.count() == 0


REQUESTS = "event_ts timestamp_ntz, service_name string, http_status int"


def test_alert_life_over_restarts(spark, tmp_path):
    def minute(service, m, failed, ok=10):
        return [(_at(m) + timedelta(seconds=i), service, 500 if i < failed else 200) for i in range(failed + ok)]

    def passing(m):
        return [(_at(m), None, None)]

    def run(*minutes):
        return [r for part in minutes for r in part]

    told = _run(spark, tmp_path, lambda s: state.alert_transitions(s, watermark="2 minutes"), REQUESTS, [
        run(*[minute("a", m, 5) for m in range(4)], minute("b", 0, 1, ok=99)),
        run(*[minute("a", m, 5) for m in range(4, 14)], minute("c", 5, 3)),
        run(minute("b", 14, 0), minute("d", 1, 9)),  # d comes after the watermark and is not judged
        passing(40),  # no further event of a or c: timers end both
        run(minute("c", 60, 9), passing(63)),
        passing(200)])
    where = [sorted((r[0], r[1], int((r[2] - START).total_seconds()) // 60, int((r[3] - START).total_seconds()) // 60) for r in part) for part in told]
    assert where[0] == [("a", "pending", 0, 0)]
    assert where[1] == [("a", "firing", 10, 0), ("c", "cleared", 10, 5), ("c", "pending", 5, 5)]
    assert where[2] == []
    assert where[3] == [("a", "resolved", 18, 0)]
    assert where[4] == [("c", "pending", 60, 60)]
    assert where[5] == [("c", "cleared", 65, 60)]


class _Held:
    """The state and the timers of one key, outside a query."""

    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def registerTimer(self, at):
        self.timer = at


def test_alert_life_costs_as_many_steps_as_minutes():
    """A month of one busy service in one batch; each minute looked through all later ones, a minute or more in all."""
    life = state.AlertLife(0.05, 5, 10)
    life.now = life.handle = _Held()
    began = time.process_time()
    told = life._advance(("a",), {m: (m // 100 % 2, 10) for m in range(43_200)}, 43_199)
    assert time.process_time() - began < 10
    # Three failures among the fifty requests of five minutes are over the share, two are not.
    assert told[:3] == [("a", "pending", 102, 102), ("a", "firing", 112, 102), ("a", "resolved", 202, 102)]
    assert [t[1] for t in told].count("firing") == 216
    assert life.now.value[:3] == ("firing", 43_102, 43_199) and life.now.value[3] == list(range(43_195, 43_200))


@pytest.mark.parametrize("days", [0, 400])
def test_alert_life_wherever_the_events_lie_in_time(spark, data_dir, tmp_path, days):
    """The closing row ends the alerts of events of any year."""
    duckdb.sql(f"COPY (SELECT * REPLACE (ts + INTERVAL {days} DAY AS ts) FROM '{data_dir}/events.parquet') TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    got = run("stream_alert_life", spark, str(tmp_path))
    assert plain_rows(got.toPandas()) == plain_rows(con.sql(oracle("stream_alert_life")).df())
