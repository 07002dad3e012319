"""Look-up by correlation id, the rule index, reconciliation by digests, retention that survives a stop, swept windows."""

import json
import random
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from spanlight import catalogs
from spanlight.catalogs import error_rules
from spanlight.operators import enrich, governance, lookups, rule_index, slo, validate
from spanlight.sources import lookup, tables


def _stored(spark, rows):
    return spark.createDataFrame(rows, "event_id string, ts string, correlation_id string").select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("event_ts"), F.col("ts").alias("emitted_at"), F.lit("x").alias("application_id"), "correlation_id").withColumns({
            "event_date": F.col("event_ts").cast("date"), "event_month": F.date_format("event_ts", "yyyy-MM")})


def _found(df):
    return sorted((r.event_id, r.correlation_id) for r in df.collect())


def test_lookup_reads_few_files_and_finds_all(spark, tmp_path):
    path, index = str(tmp_path / "events"), str(tmp_path / "index")
    rows = [(f"e{d}-{i}", f"2026-01-{d:02d} {i % 24:02d}:00:00", f"c{d}-{i % 7}" if i % 9 else None) for d in range(1, 21) for i in range(40)]
    tables.append_events(_stored(spark, rows), path)
    assert lookup.update(spark, path, index) == 20 and lookup.update(spark, path, index) == 0
    for wanted in (["c3-2"], ["c3-2", "c19-5", "c19-6", "no such id"], ["no such id"], []):
        found = lookup.events_of(spark, path, index, wanted)
        assert _found(found) == sorted((e, c) for e, _, c in rows if c in wanted)
        assert len(found.inputFiles()) == len({c.split("-")[0] for _, _, c in rows if c in wanted}) or not wanted or wanted == ["no such id"]
    assert lookup.files_with(spark, path, index, spark.createDataFrame([("no such id",)], "c string")) == []
    # Late events of an old trace lie in new files: read before they are indexed, and named by the index after.
    late = [("late", "2026-02-03 00:00:00", "c3-2"), ("other", "2026-02-04 00:00:00", "c99-1")]
    tables.append_events(_stored(spark, late), path)
    both = sorted([(e, c) for e, _, c in rows if c == "c3-2"] + [("late", "c3-2")])
    found = lookup.events_of(spark, path, index, ["c3-2"])
    assert _found(found) == both and len(found.inputFiles()) == 3
    assert lookup.update(spark, path, index, days=["2026-02-03", "2026-02-04"]) == 2
    found = lookup.events_of(spark, path, index, ["c3-2"])
    assert _found(found) == both and len(found.inputFiles()) == 2
    # More identifiers than are listed as literals, and files that retention has taken.
    many = spark.createDataFrame([(c,) for c in {c for _, _, c in rows if c}] + [(f"x{i}",) for i in range(1200)], "id string")
    assert _found(lookup.events_of(spark, path, index, many)) == sorted((e, c) for e, _, c in rows + late[:1] if c)
    tables.archive_and_drop(spark, path, str(tmp_path / "archive"), date(2026, 3, 1), 1)
    assert _found(lookup.events_of(spark, path, index, ["c3-2"])) == [("late", "c3-2")]


class Stopped(Exception):
    pass


@pytest.mark.parametrize("at", ["take", "copy", "compare", "publish", "set aside", "delete"])
def test_retention_survives_a_stop_at_any_step(spark, tmp_path, at):
    path, archive = str(tmp_path / "events"), str(tmp_path / "archive")
    old = [(f"e{i}", f"2026-01-{i + 1:02d} 00:00:00", "c") for i in range(6)] + [("feb", "2026-02-01 00:00:00", "c")]
    tables.append_events(_stored(spark, old + [("new", "2026-04-01 00:00:00", "c")]), path)

    def stop(name):
        if name == at:
            raise Stopped

    with pytest.raises(Stopped):
        tables.archive_and_drop(spark, path, archive, date(2026, 4, 30), 1, stop)
    # Rows of an expired month come late, between the stop and the next run.
    tables.append_events(_stored(spark, [("late", "2026-01-09 00:00:00", "c")]), path)
    tables.archive_and_drop(spark, path, archive, date(2026, 4, 30), 1)
    assert tables.archive_and_drop(spark, path, archive, date(2026, 4, 30), 1) == []
    kept = [r.event_id for r in spark.read.parquet(path).collect()]
    moved = [r.event_id for m in ("01", "02") for r in spark.read.parquet(f"{archive}/event_month=2026-{m}").collect()]
    assert kept == ["new"] and sorted(moved) == sorted([e for e, _, _ in old] + ["late"])


def test_factors():
    known = {
        r"rate limit|too many": ["rate limit", "too many"], r"429|rate": ["429", "rate"], r"time(d)? ?out": ["time"], r"a\.b\d+cdef": ["cdef"],
        r"connection (reset|refused) by peer": ["connection "], r"ab?cdx*ef": [], r"quota{2}x exceeded": ["x exceeded"], r"[abc]|token": [],
        r"\x41bcd": [], r"(?i)abcd": [], r"(?:abc|def)": [], r"\Qa.b\E": [], r"xyz+abc": ["xyz"], r"\bnot found\b": ["not found"], r"naïve case": ["ve case"], r"": []}
    for pattern, want in known.items():
        assert rule_index.factors(pattern) == want, pattern


def test_rule_index_equals_the_folded_rules(spark):
    rnd = random.Random(8)
    words = ["timeout", "quota", "schema", "token", "socket", "denied", "index", "shard", "vector", "prompt", "limit", "abc"]
    shapes = ["{a} {b}", "{a}.*{b}", "{a}|{b} {c}", "({a}|{b}) {c}", "{a} ?{n}", r"{a}\s+{n}\b", "[{n}]{a}", "{n}", "({a})?{b}{n}", r"{a}\.{b}", "^{a}", "{a}+x"]
    rules = [(f"R{i:04d}", rnd.choice(["x", "y"]), rnd.choice(shapes).format(a=rnd.choice(words), b=rnd.choice(words), c=rnd.choice(words), n=rnd.randrange(3000)),
              rnd.randrange(1, 40), rnd.random() < 0.5, "active") for i in range(5000)]
    catalogue = spark.createDataFrame(rules + [("BAD", "x", "(unclosed", 0, True, "active"), ("OFF", "x", ".", 0, True, "inactive"), ("NONE", "x", None, 0, True, "active")],
                                      "error_code string, category string, pattern string, priority int, retryable boolean, status string")
    messages = [None, "", "Timeout  17", "K", "İndex shard", "x" * 3000 + " QUOTA 12"] + [
        " ".join(rnd.choice([rnd.choice(words), rnd.choice(words).upper(), str(rnd.randrange(3000))]) for _ in range(rnd.randrange(1, 9))) for _ in range(60)]
    events = spark.createDataFrame([(i, rnd.choice(["failed", "success"]), rnd.choice([None, "", "E1"]), m) for i, m in enumerate(messages + messages[:30])],
                                   "id int, status string, error_code string, error_message string")
    found = {r.id: (r.error_code, r.raw_error_code, r.error_category, r.error_retryable) for r in rule_index.with_error_code(events, catalogue).collect()}
    order = sorted((p, c, re.compile(f"(?ai){x}"), k, t) for c, k, x, p, t, _ in rules)
    for e in events.collect():
        body = None
        if e.status == "failed" or e.error_code:
            body = f"{e.error_code or ''}: {e.error_message or ''}"
        hit = next(((c, k, t) for _, c, x, k, t in order if body is not None and x.search(body)), (None, None, None))
        raw = e.error_code if hit[0] is not None and hit[0] != e.error_code else None
        assert found[e.id] == (hit[0] or e.error_code, raw, hit[1], hit[2]), body


def test_rule_index_equals_the_seed(spark):
    rules = error_rules()
    catalogue = spark.createDataFrame([(r.error_code, r.category, r.pattern, r.priority, r.retryable) for r in rules],
                                      "error_code string, category string, pattern string, priority int, retryable boolean")
    bodies = [("failed", None, m) for m in ("Rate limit exceeded", "connection timed out after 3s", "context length 9000", "schema validation", "?", "HTTP 503 from upstream")]
    events = spark.createDataFrame(bodies + [("failed", "X", None), ("success", None, "timeout")], "status string, error_code string, error_message string")
    cols = ["status", "error_message", "error_code", "raw_error_code", "error_category", "error_retryable"]
    rows = lambda df: sorted(map(str, df.select(*cols).collect()))
    assert rows(rule_index.with_error_code(events, catalogue)) == rows(lookups.with_error_code(events, rules))
    assert rows(rule_index.with_error_code(events, catalogue.where("false"))) == rows(lookups.with_error_code(events, []))


def test_large_catalogue_in_enrichment(spark):
    """A catalogue of more rules than are folded comes back as a table, and enrichment takes it as it takes a list."""
    rows = [(f"R{i}", "x", f"fault {i}[.!]?$", 5, "error", True, "active") for i in range(catalogs.FOLDED_RULES + 50)]
    table = spark.createDataFrame(rows, "error_code string, category string, pattern string, priority int, severity string, retryable boolean, status string")
    known = catalogs.error_rules_from_table(table)
    assert not isinstance(known, list) and isinstance(catalogs.error_rules_from_table(table.limit(20)), list)
    raw = [json.dumps({"event_type": "LLM_CALL_FAILED", "service_name": "gssp-gs", "environment": "dev", "status": "failed", "event_id": f"e{i}",
                       "payload": {"error_message": f"Fault {i * 40}!"}}) for i in range(8)]
    good = validate.good(validate.validate(spark.createDataFrame([(r,) for r in raw], "value string")))
    found = {r.event_id: r.error_code for r in enrich.enrich(good, enrich.Dimensions(rules=known)).collect()}
    assert found == {f"e{i}": f"R{i * 40}" if i * 40 < len(rows) else None for i in range(8)}


def test_reconcile_rows(spark):
    rnd = random.Random(2)
    rows = [(f"k{i}", rnd.choice([None, 1, 2]), "v") for i in range(2000)] + [(None, 1, "v"), ("twice", 1, "v"), ("twice", 1, "v"), ("pair", 1, "v"), ("pair", 2, "v")]
    other = [r for r in rows if r[0] not in ("k5", "twice", None)] + [("twice", 1, "v"), ("more", 3, "v"), ("k7", rows[7][1], "v")]
    other = [(k, 9 if k == "k11" else v, t) for k, v, t in other]
    make = lambda r: spark.createDataFrame(r, "k string, v int, t string")
    for buckets in (4, 4096):
        found = sorted(map(tuple, governance.reconcile_rows(make(rows), make(other), "k", ["v", "t"], buckets).collect()), key=str)
        assert found == sorted([("k5", "missing in target", 1, 0), ("more", "missing in source", 0, 1), ("twice", "repeated", 2, 1), ("k7", "repeated", 1, 2),
                                ("k11", "changed", 1, 1), (None, "missing in target", 1, 0)], key=str)
    same = governance._unequal(*[make(r).select(F.pmod(F.xxhash64("k"), F.lit(64)).alias("_b"), F.xxhash64("k", "v", "t").alias("_h")) for r in (rows, rows[::-1])], "_b")
    assert same.count() == 0  # no bucket is left, so no row would be shuffled
    assert governance.reconcile_rows(make(rows), make(rows), "k", ["v", "t"]).count() == 0


def test_swept_windows_equal_copied_ones(spark):
    rnd = random.Random(1)
    minutes = sorted({(rnd.choice("ab"), rnd.randrange(0, 300)) for _ in range(60)})
    rows = [(s, m, rnd.randrange(3), rnd.randrange(1, 5)) for s, m in minutes]
    want = {}
    for s, m, g, t in rows:
        for w in range(m - 19, m + 1):
            a = want.setdefault((s, w * 60), [0, 0])
            a[0] += g
            a[1] += t
    out = slo.sliding_counts(spark.createDataFrame(rows, "slo_id string, minute long, good long, total long"), 20)
    found = {(r.slo_id, r.at): [r.good, r.total] for r in out.withColumn("at", F.unix_seconds(F.col("window_start").cast("timestamp"))).collect()}
    assert found == want
