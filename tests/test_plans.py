"""What the physical plans must and must not contain, on stored ERP tables."""

from __future__ import annotations

import re

import pytest

from rollbook import standins
from rollbook.plans import reports
from rollbook.plans.shared import keep
from rollbook.schema import PADDED, TABLES
from rollbook.sources.tables import load_tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", params=["supplier", "customer"])
def side(request, spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp(request.param))
    t = standins.tables(spark, FOLDER, request.param)
    for name, (stored, columns) in TABLES.items():
        t[name].selectExpr(*[f"concat({ours}, '  ') AS {raw}" if kind == PADDED else f"{ours} AS {raw}"
                              for raw, ours, kind in columns]).write.parquet(
            f"{out}/{stored}")
    return request.param, load_tables(spark, out)


def plan_of(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    return df._jdf.queryExecution().executedPlan().toString()


def document_scans(plan: str) -> list[str]:
    return [x for x in re.findall(r"FileScan parquet .*", plan) if "DocCab" in x]


@pytest.fixture
def planned_reuse(spark):
    """Adaptive execution finds equal exchanges while it runs; without it the plan shows them."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.usefixtures("planned_reuse")
def test_documents_are_read_once_with_filters_in_the_scan(side):
    role, t = side
    p = standins.params()
    for name in reports.REPORTS:
        if reports.SIDE[name] != role:
            continue
        plan = plan_of(reports.REPORTS[name](t, p))
        scans = document_scans(plan)
        # also where a report needs two grains
        assert len(scans) == 1, name
        for scan in scans:
            assert "In(DocTipCod" in scan and "Not(EqualTo(DocEst,0))" in scan, name
            assert "In(OriCod" in scan, name
            assert "DocNum" not in scan.split("ReadSchema")[1], name


def test_tags_are_read_once(side):
    role, t = side
    if role == "supplier":
        plan = plan_of(reports.supplier_site(t, standins.params()))
        stored = TABLES["site_tag"][0]
        assert len([x for x in re.findall(r"FileScan parquet .*", plan) if f"/{stored}]" in x]) == 1


def test_shared_parts_remove_the_documents(side):
    role, t = side
    p = standins.params()
    parts = keep(reports.report_parts(t, p, role), "parts")
    for name in reports.REPORTS:
        if reports.SIDE[name] == role:
            assert document_scans(plan_of(reports.REPORTS[name](t, p, parts))) == [], name


def test_no_cross_joins_and_nothing_outside_the_jvm(side):
    role, t = side
    for name in reports.REPORTS:
        if reports.SIDE[name] == role:
            plan = plan_of(reports.REPORTS[name](t, standins.params()))
            for word in ("Cartesian", "NestedLoop", "Python", "Arrow", "SinglePartition"):
                assert word not in plan, (name, word)


def test_partial_aggregation_before_the_document_shuffle(side):
    role, t = side
    plan = plan_of(reports.report_parts(t, standins.params(), role))
    assert plan.count("Exchange hashpartitioning(origin") == 1
    assert plan.index("Exchange") < plan.index("partial_sum")  # below the exchange in the tree


def test_ranks_are_cut_before_the_shuffle(spark, side):
    role, t = side
    base = getattr(reports, f"{role}_base")(t, standins.params())
    from rollbook.operators import joins, sets
    for df in (sets.dedupe_by_tax_id(base), joins.first_active_site(t["site"])):
        plan = plan_of(df)
        assert "row_number(), 1, Partial" in plan and "row_number(), 1, Final" in plan
