"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default: all cores)
choose the tables and the local cores.
"""

from __future__ import annotations

import json
import os
import time

from reviewlake import build_session
from reviewlake.plans import QUERIES
from reviewlake.session import release_scratch

HEADLINE = [
    "p02_predicates", "j01_products_left_reviews", "a01_product_review_summary", "a02_user_engagement",
    "a03_daily_trends", "a05_user_stats", "a12_monthly_products", "a14_overview", "a20_price_boxes", "a29_describe",
    "a30_correlations", "w01_rolling_rows", "w02_percentile_rank", "w04_duplicate_flags", "w05_frequency_consistency",
    "o07_stratified_split", "u02_keep_first", "q09_quality_rules", "q13_column_profile", "c06_clean_dataset",
    "t02_lexicon_sentiment", "t05_keywords", "t07_analyze_table", "e01_text_features", "e07_product_features",
    "e07_product_features_on_rows", "e08_statistical_features", "a07_customer_features", "g02_user_segment_features",
    "k02_lake_parquet", "k06_upsert", "x11_window_aggregates", "n09_change_capture", "z01_transform_dataset",
    "t08_train_classifier", "x12_finished_windows", "s02_json_document", "m03_kmeans", "l04_compaction",
]


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["a14_overview"](spark, base).write.format("noop").mode("overwrite").save()  # start-up is not measured
    seconds = {}
    for name in HEADLINE:
        started = time.monotonic()
        QUERIES[name](spark, base).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.monotonic() - started, 3)
    release_scratch(spark)
    print(json.dumps({"metric": "headline queries, total wall time", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(base.rstrip("/")).removeprefix("sf"),
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
