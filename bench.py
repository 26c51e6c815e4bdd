"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS (default 8)
the local cores. Each query's full result is written to Spark's no-op sink, so
every column of every row is computed.
"""

import json
import os
import sys
import time

from tallyroom.catalog import all_queries
from tallyroom.session import build_session

HEADLINE = [
    "f1_topic_metrics", "f2_user_engagement", "f3_daily_activity", "f4_hourly_activity", "f5_document_usage",
    "f6_recommendation_features", "f10_daily_trend", "f18_knowledge_map", "f20_smart_recommendations",
    "f22_learning_profile", "g2_study_streak", "g4_score_trend", "g5_topic_trend", "g6_activity_feed",
    "d1_silver_union", "d3_document_registry", "d7_question_quality", "h1_profile", "h2_numeric_summary",
    "h5_correlation_matrix", "h6_detect_anomalies", "h8_build_time_series", "i2_windowed_topic_metrics",
    "j3_chunk_text", "j7_units", "j10_word_frequencies", "j14_tfidf_summary", "j15_textrank_summary", "j17_topics",
    "j20_hierarchical_summary", "j21_pagewise_summary", "k2_lexical_top_k", "k3_vector_top_k", "k7_page_units",
    "k14_build_questions",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    names = sys.argv[1:] or HEADLINE
    queries["c10_complete_events"](spark, folder).count()  # start the JVM's code paths once
    times = {}
    for name in names:
        started = time.perf_counter()
        queries[name](spark, folder).write.mode("overwrite").format("noop").save()
        times[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(os.path.normpath(folder)).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
