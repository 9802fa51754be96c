"""Times the headline queries; prints one JSON line.

Each query runs whole (derived grid, its storage, planning, result) and is
written to the no-op sink; the better of two runs counts. The loads from cells
start at a stored cell table, as a user's do.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wardgrid.layouts import LAYOUTS  # noqa: E402
from wardgrid.plans.winter import load_sitreps  # noqa: E402
from wardgrid.session import build_session  # noqa: E402
from wardgrid.workloads import registry  # noqa: E402
from wardgrid.workloads.frames import winter_grid  # noqa: E402
from wardgrid.workloads.stored import store_cells  # noqa: E402

HEADLINE = (
    "tidy_report",
    "tidy_report_customers",
    "heading_ordinal",
    "densify_grid",
    "unpivot_measures",
    "pivot_series",
    "date_text_normalise",
    "cast_trunc",
    "merge_two_series",
    "spine_join_2key",
    "spine_join_3key",
    "later_band_join",
    "snapshot_roundtrip",
    "load_2019_20",
    "load_2022_23",
)
# Loads timed from a stored cell table, without laying the grid out first.
FROM_CELLS = (("2015-16", "error"), ("2019-20", "error"), ("2022-23", "error"), ("2022-23", "multiply"))
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "wardgrid-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    seconds = {}

    def measure(name: str, run: Callable[[], DataFrame]) -> None:
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            run().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
        print(f"{name}: {seconds[name]} s", file=sys.stderr, flush=True)

    for name in HEADLINE:
        measure(name, partial(queries[name], spark, sf_dir))
    for winter, duplicates in FROM_CELLS:
        grid = store_cells(spark, winter_grid(spark, sf_dir, LAYOUTS[winter]), f"bench-{winter}")
        suffix = "_by_joins" if duplicates == "multiply" else ""
        measure(
            f"load_{winter.replace('-', '_')}_from_cells{suffix}",
            partial(load_sitreps, spark, winter, grid, duplicates=duplicates),
        )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
