"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from shardweave.plans.catalog import QUERIES  # noqa: E402
from shardweave.session import local_session  # noqa: E402

HEADLINE = [
    "stats_by_source", "round_robin", "char_encode", "packed_tokens", "shard_layout",
    "word_counts", "bpe_merges", "bpe_encode", "batch_plan", "batch_windows", "topk_softmax",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus), "16g", "bench")
    # One untimed query warms the JVM and the Python workers.
    QUERIES["char_encode"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(name, seconds[name], file=sys.stderr)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rsplit("sf", 1)[-1].strip("/")}))
    spark.stop()


if __name__ == "__main__":
    main()
