"""Headline queries on the benchmark data: median of 3 runs after one warm-up, one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from spanlight.plans import load_all  # noqa: E402
from spanlight.plans.registry import run  # noqa: E402
from spanlight.session import build_session  # noqa: E402

HEADLINE = [
    "enriched_messages",
    "validate_messages",
    "model_call_cost",
    "error_normalisation",
    "redact_documents",
    "hourly_llm_metrics",
    "hourly_application_metrics",
    "hourly_summary",
    "metric_p95_latency_ms",
    "budget_crossings",
    "order_budget_crossings",
    "slo_burn_rates",
    "daily_slo_compliance",
    "latency_baselines",
    "span_trees",
    "waterfall",
    "feedback_attribution",
    "cause_hypotheses",
    "embedding_drift",
    "document_entropy",
    "weekly_digest",
    "document_metrics",
    "redact_nested_payloads",
    "stream_enrichment",
]


def main() -> None:
    data = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    load_all()
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.log.level": "ERROR"})
    only = sys.argv[1:] or HEADLINE
    seconds: dict[str, float] = {}
    for name in only:
        times = []
        for _ in range(4):
            started = time.perf_counter()
            run(name, spark, data, partitions=int(cpus)).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(data.rstrip("/")).removeprefix("sf"),
        "spark": spark.version, "cpus": int(cpus), "shuffle_partitions": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
