"""Time the headline queries and print one JSON line.

Reads ``BENCH_SF_DIR``, ``BENCH_CPUS`` and ``BENCH_RUNS`` (best of, default 1).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from peakloom import configure
from peakloom.catalog import QUERIES

HEADLINE = [
    "differential_regions",
    "count_in_regions",
    "overlap_join",
    "best_overlap",
    "merge_intervals",
    "pileup",
    "frip",
    "dedup_reads",
    "p_adjust_bh",
    "merge_n_sets",
    "scan_pwm",
    "score_quantiles",
    "multi_model_roc",
    "spacing_enrichment",
    "kmer_enrichment",
    "extract_sequences",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(max(int(cpus), 8)))
        # The tables are single files; smaller splits let every core read.
        .config("spark.sql.files.maxPartitionBytes", str(4 << 20))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
