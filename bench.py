"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the number of threads,
``BENCH_RUNS`` the timed runs of a query after its warm-up (the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from pyspark.sql import SparkSession  # noqa: E402

from checks import registry  # noqa: E402

HEADLINE = [
    "bm25_search",
    "hybrid_search",
    "dense_topk",
    "quantized_topk",
    "ann_topk",
    "rerank",
    "minhash_signature",
    "dedup_keep_first",
    "dedup_corpus",
    "embed_documents",
    "term_neighbours",
    "semantic_chunks",
    "html_blocks",
    "process_corpus",
    "throttle_state",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        started = time.perf_counter()
        # every column of every row is computed
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    chosen = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in chosen:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    documents = registry.table(spark, folder, "documents").count()
    queries = registry.table(spark, folder, "benchmark").count()
    result = {
        "metric": "total wall seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")),
        "cpus": int(cpus),
    }
    if not sys.argv[1:]:
        result["recall_at_10"] = {
            "int8_rescored": registry.quantization_benchmark(spark, folder).first()[0],
            "approximate": registry.ann_recall(spark, folder).first()[0],
        }
        result["dedup_docs_per_minute"] = round(60 * documents / seconds["dedup_keep_first"])
        result["hybrid_ms_per_query"] = round(1000 * seconds["hybrid_search"] / queries, 1)
    spark.stop()
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
