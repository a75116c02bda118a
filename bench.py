"""Benchmark the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEATS (default 3; the median is reported), BENCH_WARMUP (default 1 run per
query, discarded: the first run of a plan shape pays code generation and class
loading), BENCH_QUERIES (comma list).
Each query runs to completion through the ``noop`` sink (no rows to the
driver); eager commits inside versioned queries are part of the time.
Prints one JSON line. Beside each query's seconds, ``commit_sec`` has the part in which the
query built its dataset and made its commits, ``read_sec`` the part in which the returned
frame was run, and ``input_mb`` the size of the tables as stored.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "word_top100",          # text job: split/lower/regex, broadcast anti join, partial+final count, top-k
    "impute_group_mean",    # aggregate + join + union imputation
    "agg_mean_multikey",
    "merge_upsert",         # file-level copy-on-write merge of ~2/3 of orders into the rest
    "update_rows",
    "point_lookup",         # cluster + stored file stats + read 1 of n files
    "cluster_by_columns",   # Z-order rewrite
    "version_diff",
    "changes_by_version",
    "incremental_aggregate",  # per-key counts from the change stream
    "line_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "3")))
    warmup = max(0, int(os.environ.get("BENCH_WARMUP", "1")))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from lakeops.plans.registry import all_queries
    from lakeops.session import get_session

    spark = get_session(app="lakeops-bench", master=f"local[{cpus}]", shuffle_partitions=cpus * 2)
    reg = all_queries()

    def run(name: str) -> tuple[float, float]:
        t0 = time.perf_counter()
        out = reg[name].fn(spark, sf_dir)
        t1 = time.perf_counter()
        out.write.format("noop").mode("overwrite").save()
        return t1 - t0, time.perf_counter() - t1

    run("agg_max")  # warm-up: JVM, class loading, first file listing
    per_query, commit_sec, read_sec = {}, {}, {}
    for n in names:
        for _ in range(warmup):
            run(n)
        times = [run(n) for _ in range(repeats)]
        per_query[n] = round(statistics.median(a + b for a, b in times), 3)
        commit_sec[n], read_sec[n] = (round(statistics.median(t[i] for t in times), 3) for i in (0, 1))
    total = round(sum(per_query.values()), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": total,
        "unit": "sec",
        "queries": per_query,
        "commit_sec": commit_sec,
        "read_sec": read_sec,
        "input_mb": round(sum(f.stat().st_size for f in Path(sf_dir).rglob("*.parquet")) / 1e6, 1),
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeats": repeats,
        "warmup_runs_discarded": warmup,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
