"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the cores.
Every query runs once to warm up and is then timed; its result goes to the
``noop`` sink, so all rows are computed and none are collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidyspark.queries import QUERIES
from tidyspark.session import build_session

HEADLINE = (
    "quality_score", "quality_score_customer", "validate_report", "profile_table", "profile_columns",
    "profile_columns_numeric", "profile_top_values", "plan_steps", "clean_duplicates", "clean_coerce_numeric",
    "clean_fill_median", "clean_fill_mode", "clean_strings", "clean_strings_documents", "clean_dates", "clean_run",
    "feat_clip", "feat_scale_standard", "feat_scale_robust", "feat_encode_ordinal", "feat_encode_onehot",
    "lookup_exact", "lookup_contains", "group_total_top5", "extreme_rows_max", "tail_rows", "numeric_summary",
    "schema_report", "question_intents", "text_passages", "knowledge_rows", "tfidf_weights", "tfidf_topk",
    "metric_macro_f1", "metric_r2", "scan_csv_typed", "run_summary", "knn_vote",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "tidyspark-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        for attempt in ("warm up", "timed"):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
