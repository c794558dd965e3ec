"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ascentframe.queries import QUERIES  # noqa: E402
from ascentframe.session import build_session  # noqa: E402

HEADLINE = [
    "long_table",
    "long_table_by_month",
    "survivor_selection",
    "import_plan",
    "thermal_tropopause",
    "enriched_levels",
    "sounding_diagnostics",
    "import_monitor",
    "tracking_state",
    "launches",
    "profile_reconciliation",
    "header_reconciliation",
    "archive_member_revisions",
    "sounding_verdicts",
    "monthly_export_round_trip",
]
# a given table is one file with one row group, which no scan can split; a real store has many files
LAID_OUT = ("lineitem", "orders", "customer", "events")


def lay_out(spark, sf_dir: str, files: int) -> str:
    """A folder with the given tables, the large ones in several files; its time is reported as a query of its own."""
    folder = tempfile.mkdtemp(prefix="bench-")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)
        if name.removesuffix(".parquet") in LAID_OUT:
            spark.read.parquet(path).repartition(files).write.parquet(f"{folder}/{name}")
        else:
            os.symlink(path, f"{folder}/{name}")
    return folder


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            # small local shuffles carry much computation per byte
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()  # start-up is not part of any query
    start = time.perf_counter()
    laid_out = lay_out(spark, sf_dir, 2 * int(cpus))
    seconds = {"lay_out_tables": round(time.perf_counter() - start, 3)}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, laid_out).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
