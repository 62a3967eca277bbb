"""Benchmark the headline queries; print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs once on sf0.001 to warm the JVM (not timed), then is timed
``BENCH_RUNS`` times (default 3) on ``BENCH_SF_DIR`` with a ``noop``
write, which computes every row without collecting it to the driver; the
median run is reported (building the DataFrame is part of the time).

Then the two report jobs run once each, comma files in and tab-separated files out, over
``BENCH_JOB_ROWS`` trips (default 10 million; 0: none), copies of the trips of
``BENCH_SF_DIR`` in 16 files that are made anew in a temporary folder.
"""

from __future__ import annotations

import contextlib
import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from punctuality.operators.sampling import replicate  # noqa: E402
from punctuality.plans import jobs  # noqa: E402
from punctuality.plans.catalog import QUERIES  # noqa: E402
from punctuality.schemas import FLIGHTS_CARRIER, FLIGHTS_CAUSES  # noqa: E402
from punctuality.session import get_session  # noqa: E402
from punctuality.sources.fixtures import flights  # noqa: E402
from punctuality.sources.sinks import write_dataset  # noqa: E402

HEADLINE = [
    "carrier_profile",
    "carrier_profile_sql",
    "carrier_profile_text",
    "tier_stats",
    "cause_counts",
    "top_causes_text",
    "delay_report",
    "delay_report_text",
    "prep_causes",
    "null_profile",
    "distinct_profile",
    "sample_exact_check",
    "replicate",
    "csv_roundtrip",
    "text_good_rows",
]
WARM_DIR = "/root/testdata/sf0.001"


def _run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def _job(spark, name: str, schema, sf_dir: str, rows: int, folder: str) -> float:
    trips = flights(spark, sf_dir)
    copies = max(1, round(rows / trips.count()))
    source = f"{folder}/{name}-in"
    write_dataset(replicate(trips.select(*schema.fieldNames()).repartition(16), copies), source, fmt="csv")
    t0 = time.perf_counter()
    jobs.run(spark, [name, source, f"{folder}/{name}-out"])
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(
        f"local[{cpus}]",
        app_name="punctuality-bench",
        shuffle_partitions=cpus,
        extra={"spark.driver.memory": "16g", "spark.sql.files.maxPartitionBytes": str(32 << 20)},
    )
    spark.sparkContext.setLogLevel("ERROR")
    if os.path.isdir(WARM_DIR) and os.path.abspath(WARM_DIR) != os.path.abspath(sf_dir):
        for n in names:
            try:
                _run(spark, n, WARM_DIR)
            except Exception:  # the timed run reports it
                pass
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    times, errors = {}, {}
    for n in names:
        try:
            times[n] = round(statistics.median(_run(spark, n, sf_dir) for _ in range(runs)), 3)
        except Exception as exc:  # report the others; a failed query is named, not timed
            errors[n] = f"{type(exc).__name__}: {str(exc)[:200]}"
    job_rows = int(os.environ.get("BENCH_JOB_ROWS", "10000000")) if names is HEADLINE else 0
    if job_rows:
        with tempfile.TemporaryDirectory(prefix="punctuality-bench-") as folder, contextlib.redirect_stdout(sys.stderr):
            for n, schema in (("carrier_profile", FLIGHTS_CARRIER), ("delay_report", FLIGHTS_CAUSES)):
                try:
                    times[f"job_{n}"] = round(_job(spark, n, schema, sf_dir, job_rows, folder), 3)
                except Exception as exc:
                    errors[f"job_{n}"] = f"{type(exc).__name__}: {str(exc)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "stat": f"median of {runs} runs",
                "job_rows": job_rows,
                **({"errors": errors} if errors else {}),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
