"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; print one JSON line.

Each query runs once to warm up and then REPEATS times; the median counts. A run plans the query from
scratch and computes every row and column (``noop`` sink). ``stored`` times the six reports on
ERP tables that were written to Parquet before, read back by ``load_tables``, also from the parts of the side,
from a roll-up by day, and as one batch; ``planning`` is the share of a stored report's time that passes before its first
job. Neither is part of ``value``.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.registry import ENTRIES
from rollbook import standins
from rollbook.plans import reports
from rollbook.plans.batch import report_batch
from rollbook.plans.days import parts_from_days, write_day_rollup
from rollbook.plans.shared import keep, new_path
from rollbook.schema import TABLES
from rollbook.sources.tables import load_tables

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
HEADLINE = [*reports.REPORTS, "open_documents_topk", "supplier_metrics", "customer_metrics",
            "supplier_site_metrics", "qualified_supplier_tax_ids", "qualified_customer_tax_ids",
            "valid_sites", "party_documents", "exclude_by_record", "first_contact_by_type",
            "site_codes_text", "column_width_profile"]


def session() -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
             .config("spark.driver.memory", "16g")
             .config("spark.sql.shuffle.partitions", CPUS)
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def median_seconds(run: Callable[[], DataFrame]) -> float:
    times = []
    for _ in range(REPEATS + 1):
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 3)


def median_planning(run: Callable[[], DataFrame]) -> float:
    times = []
    for _ in range(REPEATS):
        start = time.perf_counter()
        run()._jdf.queryExecution().executedPlan()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def stored_tables(spark: SparkSession, role: str):
    """The stand-in tables under their stored names, written once."""
    out = new_path(spark, f"bench-{role}")
    tables = standins.tables(spark, FOLDER, role)
    for name, (stored, columns) in TABLES.items():
        tables[name].selectExpr(*[f"{ours} AS {raw}" for raw, ours, _ in columns]).write.parquet(
            f"{out}/{stored}")
    return load_tables(spark, out, trim=())


def main() -> None:
    spark = session()
    seconds = {name: median_seconds(lambda e=ENTRIES[name]: e.run(spark, FOLDER))
               for name in HEADLINE}
    p, stored, planning = standins.params(), {}, {}
    for role in ("supplier", "customer"):
        t = stored_tables(spark, role)
        stored[f"{role}_parts"] = median_seconds(lambda: reports.report_parts(t, p, role))
        parts = keep(reports.report_parts(t, p, role), "bench-parts")
        path = new_path(spark, "bench-days")
        write_day_rollup(t["document"], p, role, path)
        stored[f"{role}_parts_from_days"] = median_seconds(lambda: parts_from_days(spark, path, p, role))
        names = [n for n in reports.REPORTS if reports.SIDE[n] == role]
        start = time.perf_counter()
        report_batch(spark, t, p, new_path(spark, "bench-batch"), names)
        stored[f"{role}_batch"] = round(time.perf_counter() - start, 3)
        for name in reports.REPORTS:
            if reports.SIDE[name] == role:
                stored[name] = median_seconds(lambda: reports.REPORTS[name](t, p))
                planning[name] = median_planning(lambda: reports.REPORTS[name](t, p))
                stored[f"{name}_from_parts"] = median_seconds(
                    lambda: reports.REPORTS[name](t, p, parts))
    print(json.dumps({
        "metric": "sum of median query times", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "stored": stored, "planning": planning,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"), "cpus": int(CPUS),
        "repeats": REPEATS, "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
