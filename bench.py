"""Wall time of every registered query, of a full rebuild, and of two streams; one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from editpulse.operators.quality import run_contracts  # noqa: E402
from editpulse.plans import registered  # noqa: E402
from editpulse.plans.contracts import CONTRACTS  # noqa: E402
from editpulse.plans.warehouse import MARTS, relations  # noqa: E402
from editpulse.session import build_session  # noqa: E402

RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def seconds(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def timed(action) -> float:
    """Median after one warm-up."""
    action()
    return round(statistics.median(seconds(action) for _ in range(RUNS)), 3)


def drain(rows) -> None:
    rows.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    work = tempfile.mkdtemp(prefix="editpulse-bench-")
    spark = build_session(
        "editpulse-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__checkpoint__dir=f"{work}/shared",
        spark__sql__warehouse__dir=f"{work}/warehouse",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def marts() -> None:
        stored = registered.warehouse(spark, sf_dir)
        for name in MARTS:
            drain(stored.derive(name))

    times: dict[str, float] = {}
    registered.rebuild(spark, sf_dir)
    for name, query in registered.queries().items():
        times[name] = timed(lambda query=query: drain(query(spark, sf_dir)))
    extra = {
        "warehouse_rebuild": round(seconds(lambda: registered.rebuild(spark, sf_dir)), 3),
        "marts_rebuild": timed(marts),
        "contracts_61": timed(
            lambda: run_contracts(CONTRACTS, relations(registered.warehouse(spark, sf_dir))).collect()
        ),
    }
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    rates = {f"{name}_rows_per_s": round(events / times[name]) for name in ("land_edits", "stream_vandalism")}
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        **extra,
        **rates,
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
