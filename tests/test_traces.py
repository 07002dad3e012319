from pyspark.sql import functions as F

from spanlight.operators import traces


def _spans(spark, edges):
    return spark.createDataFrame([("t", s, p, 1.0) for s, p in edges], "correlation_id string, span_id string, parent_span_id string, latency_ms double")


def test_deep_chain_orphan_and_cycle(spark):
    chain = [("s0", None)] + [(f"s{i}", f"s{i - 1}") for i in range(1, 300)]
    odd = [("o", "lost"), ("o2", "o"), ("x", "y"), ("y", "x"), ("self", "self"), ("z", "x")]
    got = {r["span_id"]: r for r in traces.tree(_spans(spark, chain + odd), with_path=True).collect()}
    assert got["s299"]["depth"] == 299 and got["s299"]["root_span_id"] == "s0" and got["s299"]["path"].startswith("s0/s1/s2/")
    assert got["o"]["root_span_id"] == "o" and got["o2"]["depth"] == 1
    assert all(got[s]["on_cycle"] and got[s]["root_span_id"] is None for s in ("x", "y", "self", "z"))
    assert all(got[s]["path"] is None and got[s]["depth"] is None for s in ("x", "y", "self", "z"))
    assert got["s0"]["child_count"] == 1 and got["s0"]["self_ms"] == 0.0


def test_few_traces_walk_to_the_same_trees(spark):
    def edges(t, pairs):
        return [(t, s, p, 2.0) for s, p in pairs]

    shallow = [("a", None), ("b", "a"), ("c", "a"), ("d", "c"), ("o", "lost"), ("x", "y"), ("y", "x"), ("z", "x"), ("self", "self")]
    deep = [("s0", None)] + [(f"s{i}", f"s{i - 1}") for i in range(1, 2 * traces.FEW_LEVELS)]
    at_limit = deep[:traces.FEW_LEVELS + 1]
    rows = edges("t1", shallow) + edges("t2", shallow[:4]) + edges("far", deep) + edges("edge", at_limit) + edges(None, shallow[:2])
    spans = spark.createDataFrame(rows, "correlation_id string, span_id string, parent_span_id string, latency_ms double")
    columns = ["correlation_id", "span_id", "depth", "root_span_id", "path", "on_cycle", "child_count", "self_ms"]
    for chosen in (["t1"], ["t1", "t2", "t2"], ["far"], ["edge", "t1"], ["none"]):
        ids = spark.createDataFrame([(c,) for c in chosen], "correlation_id string")
        got = sorted(map(tuple, traces.tree_of(spans, ids, with_path=True).select(columns).collect()))
        whole = traces.tree(spans.where(F.col("correlation_id").isin(chosen)), with_path=True)
        assert got == sorted(map(tuple, whole.select(columns).collect())) and len(got) == sum(r[0] in chosen for r in rows)


def test_started_and_terminal_share_a_span(spark):
    rows = [("t", "a", None, "e1", "STARTED", "2026-01-01 00:00:00", None), ("t", "a", None, "e2", "TERMINAL", "2026-01-01 00:00:02", "failed"),
            ("t", "b", "a", "e3", "STARTED", "2026-01-01 00:00:01", None)]
    df = spark.createDataFrame(rows, "correlation_id string, span_id string, parent_span_id string, event_id string, phase string, ts string, status string").withColumn(
        "event_ts", F.col("ts").cast("timestamp_ntz"))
    got = {r["span_id"]: r for r in traces.assemble(df).collect()}
    assert got["a"]["duration_ms"] == 2000.0 and got["a"]["status"] == "failed"
    assert got["b"]["status"] == "open" and got["b"]["end_ts"] is None
