"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "redact_documents", "pii_digit_runs", "pii_by_source", "mask_spans", "hybrid_redaction", "redact_json",
    "span_islands", "manifest_totals", "text_scan", "global_row_index", "running_total", "shard_contiguous",
    "bleu_4", "rouge_2", "distinct_3_corpus", "vocab_build", "tf_idf", "causal_samples", "tag_segments",
    "lexicon_matches", "neg_entities", "full_negatives", "mean_reciprocal_rank", "augment_delete",
    "telemetry_rollup", "latency_summary", "group_advantage",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from veilframe import plans
    queries = plans.load().QUERIES
    queries[HEADLINE[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm the session
    times = {}
    for name in HEADLINE:
        start = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    chars = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("sum(n_chars)").first()[0]
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "redact_chars_per_second": round(chars / times["redact_documents"])}))


if __name__ == "__main__":
    main()
