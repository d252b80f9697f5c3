"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import importlib.util
import json
import os
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from almanac.session import build_session  # noqa: E402

HEADLINE = [
    "daily_series_flagship", "pipeline_ingest", "dedupe_keep_first", "daily_text_rollup", "lag_lead_returns",
    "rolling_volatility", "rolling_means", "correlation_long", "return_classes", "class_report", "tokenise",
    "lemma_join", "chunk_500", "tfidf_weights", "sentiment_stats", "daily_sentiment", "feature_join",
    "html_to_text", "extractive_summary", "knn_same_class", "smote_resample", "stream_ingest",
    "daily_lemma_counts", "sentiment_model", "summary_sentiment", "price_vs_spread", "late_page_ingest",
    "late_item_ingest", "bucketed_anti_join", "tfidf_pca2", "feature_correlations", "lemma_join_large",
]
# The operators on training text, where they are present.
TEXT_OPERATORS = tuple(f"op{n}_" for n in range(1, 14))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__driver__memory="12g", spark__sql__shuffle__partitions=cpus,
        spark__driver__host="127.0.0.1", spark__driver__bindAddress="127.0.0.1",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(HERE, "__spark_entry__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    queries = module.queries()
    names = sys.argv[1:] or [*HEADLINE, *sorted(q for q in queries if q.startswith(TEXT_OPERATORS))]
    # The first query of a session pays for start-up; it is not part of any figure.
    queries["scan_projection"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(os.path.normpath(sf_dir)), "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
