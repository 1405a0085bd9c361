"""Times loading and querying at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import statistics
import time

from laborlake import testbed as tb
from laborlake.model import DATASETS
from laborlake.operators import ledger
from laborlake.operators.ledger import Ledger
from laborlake.plans import reports
from laborlake.plans.load import load
from laborlake.session import local_session, new_folder
from laborlake.sources import store as tables
from laborlake.sources.files import discover, list_files
from laborlake.sources.headers import with_headers

RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def timed(action, runs: int = RUNS) -> float:
    """Median of some runs after one to warm up."""
    action()
    seconds = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    target = DATASETS["vinculos"]
    queries: dict[str, float] = {}
    extra: dict[str, float] = {}

    stores = {}
    for layouts in ("historic", "new", "mixed"):
        source = tb.job_link_tree(spark, sf_dir, layouts)
        size = sum(r.size_bytes for r in list_files(spark, source).collect())
        last = {}

        def ingest(source=source, last=last):
            last["store"] = new_folder(spark, "bench-store")
            last["rows"] = load(spark, source, last["store"]).total_rows

        name = f"ingest_{layouts}"
        queries[name] = timed(ingest, runs=2)
        extra[f"{name}_rows_per_sec"] = round(last["rows"] / queries[name])
        extra[f"{name}_mb_per_sec"] = round(size / 1e6 / queries[name], 1)
        stores[layouts] = (source, last["store"])

    source, store = stores["mixed"]
    links = lambda **options: tables.read(spark, store, target, **options)
    files = discover(spark, source).select("path", "size_bytes")
    actions = {
        "load_nothing_new": lambda: load(spark, source, store),
        "discover_files": lambda: discover(spark, source).collect(),
        "read_headers": lambda: with_headers(files).collect(),
        "sector_summary": lambda: reports.sector_summary(links()).collect(),
        "sector_summary_one_state": lambda: reports.sector_summary(links(), state="13").collect(),
        "count_by_year": lambda: reports.count_by_year(links()).collect(),
        "global_count_avg": lambda: reports.count_and_mean_pay(links()).collect(),
        "distinct_states": lambda: reports.states(links()).collect(),
        "partition_scan": lambda: links(years=[1996], states=["13"]).write.format("noop").mode("overwrite").save(),
        "manifest_totals": lambda: ledger.status_with_total(Ledger(spark, store).current()).collect(),
    }
    for name, action in actions.items():
        queries[name] = timed(action)
    done, stored = Ledger(spark, store).current(), tables.stored_files(spark, store)
    extra["compression_ratio"] = round(ledger.compression(done, stored).first().ratio, 4)

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": float(sf.group(1)) if sf else None,
                **extra,
            }
        )
    )


if __name__ == "__main__":
    main()
