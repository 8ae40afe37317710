"""Time the headline CDC queries at one scale factor; print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewater import catalog  # noqa: E402
from tidewater.session import build_session  # noqa: E402

HEADLINE = [
    "flagship", "pk_split", "latest_per_key", "merge_upsert", "schema_evolve", "change_feed",
    "latest_per_rrn", "pivot_counts", "count_rollup_incr", "registry_ingest", "structured_stream",
    "fanout_tables", "late_arrival", "decode_payload", "encrypt_roundtrip", "publish_drain", "publish_tables",
    "merge_replay",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", "tidewater-bench", {
        "spark.sql.shuffle.partitions": str(max(int(cpus), 1) * 2),
        "spark.driver.memory": "16g",
    })
    # Warm the JVM (class loading, JIT, generated-code cache) by running each
    # query once on the smallest scale, outside the timings.
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm) and os.environ.get("BENCH_WARMUP", "1") == "1":
        for name in names:
            catalog.QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in names:
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "cdc_headline_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
