"""Headline queries, warm: one JSON line with seconds per query.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Every query is run once to warm up, then timed (median of 3, or one run when it takes
longer than 3 seconds).  Session queries start from the kept session table;
``sessions_build`` measures deriving it from the events.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from catalog import queries as Q
from clickscore.session import local_session
from clickscore.sources import clickstream as src

HEADLINE = (
    "threshold_sweep", "threshold_sweep_lineitem", "optimal_threshold_value", "metric_suite",
    "metric_suite_lineitem", "compare_models", "roc_points", "calibration_curve", "top_errors_false_positive",
    "decisions", "policy_labels", "batch_summary", "dedupe", "duplicate_stats", "segment", "align_renamed",
    "validate_sessions", "quality", "outliers", "correlation_matrix", "mutual_information",
    "histogram", "conversion_by_month", "segment_presets", "stratified_split", "stratified_folds",
    "runs_wide", "runs_comparison", "score", "attribute_linear", "sensitivity_span",
    "read_sessions", "score_trees", "attribute_trees", "global_contribution", "cross_validated_search",
    "save_load_model", "score_stream", "history_stream",
)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run) -> float:
    t0 = time.perf_counter()
    run()
    return time.perf_counter() - t0


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    every = Q.all_queries()
    tasks = {
        "sessions_build": lambda: drain(src.sessions_from_events(src.read_table(spark, folder, "events")))
    }
    for name in HEADLINE:
        tasks[name] = lambda q=every[name]: drain(q(spark, folder))
    seconds, cold = {}, {}
    for name, run in tasks.items():
        cold[name] = round(timed(run), 3)
        first = timed(run)
        runs = [first] if first > 3 else [first, timed(run), timed(run)]
        seconds[name] = round(statistics.median(runs), 3)
    sessions = every["sessions"](spark, folder).count()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "first_run_sec": cold,
                "rows_per_sec": {n: round(sessions / seconds[n]) for n in ("score", "score_trees", "attribute_linear", "score_stream")},
                # Twelve points and the defaults on five folds, and the refit.
                "search_fits": 13 * 5 + 1,
                "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
