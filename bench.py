"""Wall-clock seconds per registered query; prints one JSON line.

BENCH_SF_DIR names the folder (default sf0.1), BENCH_CPUS the number of local cores,
BENCH_RUNS the measured runs per query (the median counts, after one warm-up run), and
BENCH_QUERIES a comma-separated choice of queries, or "all".
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quillgrid.plans import QUERIES  # noqa: E402
from quillgrid.session import build_session  # noqa: E402


# At least one query per kind of work; BENCH_QUERIES=all measures every registered query.
HEADLINE = (
    "scan_table", "filter_month_prefix", "filter_conj", "row_search_any_column", "label_lookup",
    "join_inner_group", "join_three_way_distinct", "join_left_unknown", "join_left_two_dims", "anti_not_in",
    "semi_ordered_products", "identity_lookup_ci", "open_request_join", "fk_dependents",
    "agg_group_sum", "agg_group_avg", "agg_kpi_row", "agg_by_month", "agg_by_category",
    "table_inventory", "count_distinct_nonnull", "value_extract", "describe_table",
    "latest_per_key", "cooldown_gap", "row_enumerate", "top5_customers", "top10_products", "union_query",
    "tokenize", "clean_sql_text", "query_log_safety", "email_valid",
    "bm25_index", "bm25_score", "knn_vector", "vector_topk_populated", "hybrid_fusion", "value_retrieve",
    "abstain_calibration", "answer_cache_match", "bag_equal", "batch_result_match", "accuracy_rollup", "ablation_compare",
    "eval_log_write", "answers_refresh", "upsert_update", "delete_guarded", "repoint_fk", "recompute_amount",
    "constraint_check", "fill_core_rows", "fill_generic_rows", "respread_dates", "stream_refresh",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    chosen = list(QUERIES) if wanted == "all" else [name for name in wanted.split(",") if name] or list(HEADLINE)
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in chosen:
        measured = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            measured.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(measured[1:]), 3)
        print(f"{name} first {measured[0]:.2f} then {seconds[name]:.2f}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total wall-clock of the headline queries, warm" if not wanted else "total wall-clock of the chosen queries, warm",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
