"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import REGISTRY  # noqa: E402
from tidemart.session import build_session, drop_materialized  # noqa: E402

HEADLINE = (
    "top_products", "message_facts", "image_detection_facts", "visual_content", "quality_checks", "message_search", "child_averages",
    "clean_reviews", "review_statistics", "missing_values", "describe_by_class", "cardinality", "iqr_outliers", "duplicate_rows",
    "price_histogram", "event_boxes", "roc_area", "latest_per_channel", "percent_changes", "rolling_volatility", "cumulative_returns",
    "rolling_correlation", "daily_sentiment", "segment_kpis", "claims_chi_square", "margin_kruskal", "spearman_price_quantity",
    "correlation_matrix", "customer_aggregates", "country_ranges", "customer_rfm", "common_phrases", "term_weights", "lexicon_sentiment",
    "text_chunks", "nearest_vectors", "stratified_split", "regression_metrics", "linear_price_model",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # start the executors
    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    drop_materialized(spark)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir).removeprefix("sf")}))


if __name__ == "__main__":
    main()
