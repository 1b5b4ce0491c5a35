"""Reports for several dates from one roll-up by day, with documents on the edges."""

from __future__ import annotations

from datetime import datetime

import pytest
from world import AS_OF, DAY, TICK, rows, years_ago

from rollbook import standins
from rollbook.params import Params
from rollbook.plans import reports
from rollbook.plans.days import edge_days, parts_from_days, write_day_rollup

FOLDER = "/root/testdata/sf0.001"


def test_edge_days():
    assert [str(d) for d in edge_days(datetime(2024, 2, 29, 23))] == ["2019-02-28", "2022-02-28", "2023-02-28"]
    assert [str(d) for d in edge_days(datetime(2025, 2, 28))] == ["2020-02-28", "2023-02-28", "2024-02-28"]


@pytest.fixture(scope="module", params=["supplier", "customer"])
def side(request, spark, tmp_path_factory):
    """The stand-in tables, with copies of documents moved onto the edges of three dates, a tick before and after, and to no date."""
    t = dict(standins.tables(spark, FOLDER, request.param))
    doc = t["document"]
    moments = [m + d for a in dates() for n in (1, 2, 5) for m in [years_ago(n, a)] for d in (-TICK, 0 * TICK, TICK, -DAY, DAY)]
    listed = ", ".join(f"TIMESTAMP_NTZ '{m.isoformat(sep=' ')}'" for m in moments)
    k = f"pmod(xxhash64(party, number), {len(moments)})"
    moved = doc.selectExpr(*[f"get(array({listed}), int({k})) AS {c}" if c in ("created", "due") else c for c in doc.columns])
    undated = doc.where("pmod(xxhash64(number), 11) = 0").selectExpr(*[f"CAST(NULL AS TIMESTAMP_NTZ) AS {c}" if c in ("created", "due") else f"CAST(NULL AS {k}) AS {c}" if c in ("amount",) else c for c, k in doc.dtypes])
    t["document"] = doc.unionByName(moved).unionByName(undated)
    path = str(tmp_path_factory.mktemp(request.param))
    write_day_rollup(t["document"], standins.params(), request.param, path)
    return request.param, t, path


def dates():
    first = standins.params().as_of
    return [first, first.replace(hour=13, minute=7, second=1, microsecond=5) + 40 * DAY, AS_OF]


@pytest.mark.usefixtures("few_rows")
def test_parts_for_three_dates(spark, side):
    role, t, path = side
    for as_of in dates():
        p = Params(as_of=as_of)
        want, got = reports.report_parts(t, p, role), parts_from_days(spark, path, p, role)
        assert got.dtypes == want.dtypes
        zero = lambda df: rows(df.fillna(0).na.fill(0), *df.columns)  # a sum over nothing is NULL or 0
        assert zero(got) == zero(want), as_of


@pytest.mark.usefixtures("few_rows")
def test_reports_from_days(spark, side):
    """Each report of a side for another date; the parts, from which they all start, are compared for all dates above."""
    role, t, path = side
    for as_of, name in zip(dates(), [n for n in reports.REPORTS if reports.SIDE[n] == role]):
        p = Params(as_of=as_of)
        got = reports.REPORTS[name](t, p, parts_from_days(spark, path, p, role))
        assert rows(got) == rows(reports.REPORTS[name](t, p)), (name, as_of)


def test_only_edge_days_are_read_in_detail(spark, side):
    role, t, path = side
    plan = parts_from_days(spark, path, Params(as_of=AS_OF), role)._jdf.queryExecution().executedPlan().toString()
    detail = [x for x in plan.split("FileScan")[1:] if "/detail" in x]
    assert len(detail) == 1 and "PartitionFilters: [month#" in detail[0] and "PushedFilters: [In(day" in detail[0]


def test_further_documents_are_appended(spark, tmp_path):
    t, p = standins.tables(spark, FOLDER, "supplier"), standins.params()
    doc = t["document"]
    for test, mode in (("number % 2 = 0", "errorifexists"), ("NOT coalesce(number % 2 = 0, false)", "append")):
        write_day_rollup(doc.where(test), p, "supplier", str(tmp_path), mode)
    got, want = parts_from_days(spark, str(tmp_path), p, "supplier"), reports.report_parts(t, p, "supplier")
    assert rows(got.fillna(0), *got.columns) == rows(want.fillna(0), *want.columns)
