"""Time registered queries; prints one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all cores),
    BENCH_QUERIES=all or a comma separated list.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = (
    "validate_rows", "duplicate_users", "validate_summary", "stratified_split", "export_manifest", "clean_pairs",
    "parse_reply", "baseline_eval", "per_class_accuracy", "confusion_matrix", "gate", "majority_vote",
    "gate_summary", "gate_quality", "spearman", "pr_curve", "route_replay", "run_summary", "headline",
    "latency_percentiles", "rescued_broken", "outcome_examples", "micro_route", "threshold_sweep",
    "extract_mono", "extract_multi", "field_accuracy", "mode_disagreement", "micro_predict", "centroid_classify",
    "score_requests", "stream_gate",
)


def main() -> None:
    from replyloom.plans import QUERIES
    from replyloom.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else [n for n in wanted.split(",") if n] or list(HEADLINE)

    spark = local_session(cpus, "bench")
    # start-up of the engine is not a query's time
    QUERIES["class_support"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
