"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

The tables are first landed in several files each (not timed).  Each query
runs once to warm up, then three times; the median is reported.
A run builds the plan (including any writes the operator performs) and
executes it fully through the ``noop`` sink (no collect to the driver).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "rls_build",
    "rls_lookup_member",
    "rls_secured_fact",
    "clean_table",
    "clean_failure_rate",
    "profile_type_upgrade",
    "profile_varchar_overflow",
    "load_replace_groups_not_dd",
    "load_replace_groups_expanded",
    "load_error_tolerance",
    "sink_parquet_roundtrip",
    "src_csv_gzip",
    "merge_upsert",
    "merge_upsert_partitioned",
    "recon_counts",
    "pipeline_historical_load",
    "stream_file_ingest",
]


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations")


def landed(spark, sf_dir: str, files: int) -> str:
    """The tables as several files each, as a lake has them: a table of one row group is one task, whatever the plan."""
    from saleslake.session import scratch_path

    root = scratch_path(spark, "bench")
    for name in TABLES:
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        n = files if df.count() >= 10_000 else 1
        df.repartition(n).write.parquet(f"{root}/{name}.parquet")
    return root


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from saleslake.plans.queries import QUERIES
    from saleslake.session import get_spark

    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    given, sf_dir = sf_dir, landed(spark, sf_dir, int(cpus))
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    out: dict[str, float] = {}
    for name in names:
        times = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i > 0:
                times.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(times), 3)
    # the loads apart from the set-up of the table they work on
    if not sys.argv[1:]:
        from saleslake.plans import q_load

        for name, (group, load) in q_load.LOADS.items():
            times = []
            for i in range(runs + 1):
                f, root = q_load._seed_fact(spark, sf_dir, group)
                t0 = time.perf_counter()
                load(spark, f, root)
                if i > 0:
                    times.append(time.perf_counter() - t0)
            out[f"{name}:load_only"] = round(statistics.median(times), 3)
    sf = os.path.basename(given.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_sec",
        "value": round(sum(v for k, v in out.items() if ":" not in k), 3),
        "unit": "sec",
        "queries": out,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
