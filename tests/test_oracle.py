"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

import pytest
from compare import differences, duck

from checks.registry import ENTRIES
from checks.standin_sql import ctes
from checks import oracle
from rollbook import standins

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", ENTRIES)
def test_query_matches_sql(spark, con, name):
    entry = ENTRIES[name]
    assert differences(entry.run(spark, FOLDER), con, entry.sql) == []


@pytest.mark.parametrize("role", ["supplier", "customer"])
def test_standins_match_sql(spark, con, role):
    tables = standins.tables(spark, FOLDER, role)
    assert len(tables) == 17
    for name, df in tables.items():
        columns = ", ".join(df.columns)
        assert differences(df, con, oracle.sql(role, f"SELECT {columns} FROM {name}")) == [], name
    assert set(ctes(role)) - set(tables) == {"people", "nations"}


def test_every_report_returns_rows(spark):
    for name in ("supplier_header", "supplier_site", "customer_header", "customer_site"):
        assert ENTRIES[name].run(spark, FOLDER).count() > 0
