"""Headline queries, timed one after the other; prints one JSON line.

`stage_order_frame` is the join that later queries read; it is written once and timed on its own.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "prof_missing", "prof_value_counts", "prof_describe_num_lines", "prof_describe_cat", "stat_corr_matrix", "stat_spearman",
    "stat_box", "fs_mutual_info", "fold_kfold", "imp_group_median", "imp_group_median_fold", "scale_standard_fold",
    "enc_onehot", "enc_label", "oof_predict", "met_comparison", "met_comparison_models", "tune_grid", "score_batch",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tabwright.plans import catalog
    from tabwright.session import local_session
    from tabwright.sources.tables import staged_order_frame

    spark = local_session("bench", cpus)
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()  # start-up is not part of any query
    queries = catalog.queries()
    seconds: dict[str, float] = {}
    start = time.time()
    staged_order_frame(spark, sf_dir)
    seconds["stage_order_frame"] = round(time.time() - start, 3)
    for name in HEADLINE:
        start = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
