"""Headline queries, timed: prints one JSON line.

Every query runs in full into a sink that discards the rows. `BENCH_SF_DIR` names
the tables, `BENCH_CPUS` the number of cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

os.environ.setdefault("PYARROW_IGNORE_TIMEZONE", "1")
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = [
    "clean_text", "retention_rate", "tail_split", "tail_split_with_validation", "head_per_split", "tokenizer_corpus",
    "global_index_by_key", "pretoken_counts", "pair_counts", "train_bpe", "encode_corpus", "encode_corpus_merged",
    "decode_corpus", "roundtrip_audit", "causal_lm_inputs", "masked_lm_inputs", "document_token_offsets",
    "concat_token_streams", "sliding_windows", "training_batches", "token_to_id", "top5_accuracy", "cross_entropy",
    "validation_loss", "nucleus_filter", "sample_next_token", "metric_averages", "moving_average",
    "moving_average_series", "best_so_far", "early_stopping", "checkpoint_retention", "throughput_summary",
    "generation_diversity", "stream_metric_tracker",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("corpusflow-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from corpusflow.plans.queries import QUERIES

    names = sys.argv[1:] or HEADLINE
    QUERIES["metric_averages"](spark, sf_dir).collect()  # start the session before the clock
    timings = {}
    for name in names:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - began, 3)
        print(name, timings[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
