"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line: total and per-query wall seconds. Every query runs to
completion through the ``noop`` sink (full execution, no driver collect).

The given tables are single files with one row group, which Spark reads in one
task. Before the clock starts they are copied into a scratch folder as several
files, so that the plans timed are those of a large input: scans with more
splits than cores, and no extra shuffle. The time of the copy is reported as
``copy_sec``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "read_lines", "pretoken_histogram", "lookup_ids", "aligned_shuffle", "split_quota",
    "concat_ordered", "sort_shards", "read_segments", "mlm_examples_toy", "lca_interval",
    "bpe_pair_counts", "bpe_train", "bpe_encode", "mlm_examples", "unigram_train",
    "unigram_encode",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from linemill.plans.catalog import QUERIES
    from linemill.session import local_session
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16)
    t0, copy = time.time(), tempfile.mkdtemp(prefix="linemill-bench-")
    for name in ("documents", "embeddings"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(
            2 * spark.sparkContext.defaultParallelism).write.parquet(f"{copy}/{name}.parquet")
    copied = round(time.time() - t0, 3)
    # warm-up: JVM, codegen caches, Python workers
    QUERIES["read_lines"](spark, copy).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for n in names:
        t0 = time.time()
        QUERIES[n](spark, copy).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "copy_sec": copied,
                      "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
