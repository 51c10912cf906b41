"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (optional, comma-separated names, or `all`), BENCH_RUNS (default 3; the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfline.catalog import runnable  # noqa: E402
from shelfline.session import build_session, scratch_scope  # noqa: E402

HEADLINES = """
attribute_ranking pareto_head running_sum topn_per_group topn_per_two_keys filter_threshold
agg_describe agg_describe_rows agg_distinct_count agg_count_by_two agg_by_strategy agg_string_join
join_group_stat_back join_three_keys_left join_different_key_names join_per_group_option_list
join_normalised_key join_prefix_theta semi_join_frequent filter_min_group_size filter_stop_phrases
filter_stop_phrases_literal reset_row_ids sample_exact split_train_test union_distinct_master
extract_tags clean_literal_list split_explode taxonomy_rollup column_type_profile row_fingerprint
map_key_conform map_defaults_deep typed_values_from_text bucket_resample gap_fill forecast_trend
forecast_quantiles forecast_additive backtest_windows ensemble_blend target_encode min_max_scale
classification_report batch_infer dedupe_before_infer classify_root_then_leaf sink_partitioned_by_channel
""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    queries = runnable()
    names = list(queries) if wanted == "all" else (wanted.split(",") if wanted else HEADLINES)
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
           "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        with scratch_scope(spark):
            began = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - began

    run("project_columns")  # JVM and file system warm-up, not counted
    run("agg_mean")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    seconds = {name: round(statistics.median(run(name) for _ in range(runs)), 3) for name in names}
    print(json.dumps({
        "metric": "headline queries, total wall-clock", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
