"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
Every query is run to the end and its rows are discarded. One run of the flagship
query warms the JVM and is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from corpusmill.plans.queries import all_queries  # noqa: E402
from corpusmill.session import clear_scratch, local_session  # noqa: E402

HEADLINE = [
    "clean_text", "corpus_funnel", "train_val_split", "word_vocab", "token_stats", "token_ids",
    "pack_blocks", "training_windows", "token_bin_roundtrip", "coherence_by_lang", "bigram_perplexity",
    "evaluation_report", "elements_single", "csv_documents", "json_documents", "jsonl_documents",
    "text_documents", "token_window_chunks", "regex_split_start", "recursive_chunks", "language_chunks",
    "file_manifest", "mime_detect", "expand_archives", "process_files", "stream_ingest",
]


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - start
    clear_scratch(spark)
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=cpus)
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-bench-"))
    queries = all_queries()
    run(queries["token_stats"], spark, sf_dir)
    seconds = {name: round(run(queries[name], spark, sf_dir), 3) for name in only}
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    total = round(sum(seconds.values()), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1], "cpus": cpus, "documents": documents,
                "token_stats_docs_per_sec": round(documents / seconds["token_stats"])
                if "token_stats" in seconds else None,
            }
        )
    )


if __name__ == "__main__":
    main()
