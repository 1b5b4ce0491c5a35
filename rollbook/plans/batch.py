"""All reports in one run."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rollbook.functions.labels import post_transform
from rollbook.operators.sets import limit_report
from rollbook.params import Params
from rollbook.plans.layouts import LAYOUTS, display_names
from rollbook.plans.reports import REPORTS, SIDE, report_parts
from rollbook.plans.shared import kept
from rollbook.sinks.files import export_report, manifest

LOG_SCHEMA = "report string, status string, rows bigint, path string, error string"
WORKERS = 3


def report_batch(spark: SparkSession, tables: Mapping[str, DataFrame], p: Params, out: str,
                 names: Iterable[str] = tuple(REPORTS), limit: int | None = None,
                 fmt: str = "csv",
                 hooks: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
                 run: str | None = None, workers: int = WORKERS) -> DataFrame:
    """Write each report to ``out/<name>`` and return the run log, one row per report, in the order of ``names``.

    The documents are read once per side: their parts are written to the shared folder for the
    length of the run, and all reports of the side start from there, ``workers`` of them at a time, each
    in a scheduler pool of its own (with ``spark.scheduler.mode`` FAIR they share the executors). A failing report
    is logged, leaves the last good one in place, and the others go on. Rows are counted while they are written.

    ``run`` names a run: reports that were published under the same name, with the same parameters, are not
    computed again but logged as ``kept``, so a run that broke off is finished by repeating it.
    """
    names = list(names)
    about = {"run": run, "asked": repr((p, limit, fmt))}

    def done(name: str) -> int | None:
        said = manifest(spark, f"{out}/{name}") if run is not None else None
        return said["rows"] if said and {k: said.get(k) for k in about} == about else None

    def write(name: str, parts: DataFrame) -> tuple:
        report = limit_report(REPORTS[name](tables, p, parts), limit)
        report = post_transform(report, (hooks or {}).get(name))
        seen = Observation()
        counted = report.observe(seen, F.count(F.lit(1)).alias("rows"))
        export_report(counted, f"{out}/{name}", fmt, names=display_names(LAYOUTS[name]),
                      about=lambda: {**about, "rows": seen.get["rows"]})
        return name, "ok", seen.get["rows"], f"{out}/{name}", None

    def logged(name: str) -> tuple:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            rows = done(name)
            if rows is not None:
                return name, "kept", rows, f"{out}/{name}", None
            part = shared[SIDE[name]]
            if isinstance(part, Exception):
                raise part
            return write(name, part)
        except Exception as error:  # a failing report must not stop the batch
            return name, "failed", None, None, f"{type(error).__name__}: {error}"
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ExitStack() as written:
        shared: dict[str, DataFrame | Exception] = {}
        for side in dict.fromkeys(SIDE[n] for n in names if n in SIDE and done(n) is None):
            try:
                shared[side] = written.enter_context(
                    kept(report_parts(tables, p, side), f"{side}-parts"))
            except Exception as error:  # logged with each of its reports
                shared[side] = error
        with ThreadPoolExecutor(max(1, workers)) as pool:
            # each thread has properties of its own, and so its own scheduler pool
            started = [pool.submit(inheritable_thread_target(spark)(logged), n) for n in names]
            log = [one.result() for one in started]
    return spark.createDataFrame(log, LOG_SCHEMA)
