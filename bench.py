"""Times the batch run and the headline queries on the star tables and prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of local cores. `batch_run` is one whole run from raw
CSV files to dashboards: check, profile, clean, validate, publish, views, 32 reports, exports and summary. Every
other query is timed by itself from the star tables to its last row; nothing is cached between queries.

With arguments, only the named queries are timed; `all` means every registered query.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import driver_queries  # noqa: E402
from checks.raw_files import write_raw_files  # noqa: E402
from merchlens.plans import operations, regional, sales  # noqa: E402
from merchlens.plans.run import Run  # noqa: E402
from merchlens.plans.run import run as run_batch  # noqa: E402
from merchlens.session import build_session  # noqa: E402
from merchlens.sources.star_tables import STAR_CALENDAR  # noqa: E402

HEADLINES = (
    *sales.REPORTS,
    *operations.REPORTS,
    *regional.REPORTS,
    "order_facts",
    "sales_dashboard",
    "operations_dashboard",
    "regional_dashboard",
    "data_quality_summary",
    "data_quality_by_category",
    "profile_columns",
    "cleaning_summary",
    "validation",
)


def time_batch_run(spark, folder: str) -> float:
    """Seconds of one batch run over raw files that are written beforehand."""
    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    raw = write_raw_files(spark, folder, f"{work}/raw_files")
    begun = time.perf_counter()
    run_batch(Run(spark, raw, f"{work}/work", calendar=STAR_CALENDAR))
    return time.perf_counter() - begun


def main() -> dict:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "merchlens-bench",
        master=f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.log.level": "ERROR",
        },
    )
    queries = driver_queries.queries()
    chosen = sys.argv[1:]
    names = list(queries) if chosen == ["all"] else chosen or HEADLINES
    # One untimed query starts the JVM's executor threads and loads classes.
    queries["cancellation_rate"](spark, folder).collect()
    seconds = {}
    for name in names:
        begun = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begun, 3)
    if not chosen:
        seconds["batch_run"] = round(time_batch_run(spark, folder), 3)
    spark.stop()
    scale = Path(folder).name.removeprefix("sf")
    return {
        "metric": f"total time of {len(seconds)} queries",
        "value": round(sum(seconds.values()), 2),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }


if __name__ == "__main__":
    print(json.dumps(main()))
