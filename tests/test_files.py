"""Readers, writers, the batch run and the shared folder."""

from __future__ import annotations

import csv
import glob
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from world import World, params, rows

from checks import registry
from rollbook import standins
from rollbook.functions.labels import blank_columns, post_transform, rename_columns
from rollbook.plans import reports
from rollbook.plans.batch import report_batch
from rollbook.plans.layouts import LAYOUTS
from rollbook.plans.shared import keep, new_path, shared_folder
from rollbook.schema import CODE, PADDED, TABLES
from rollbook.sinks.files import CSV_ROWS, column_width_profile, export_report, manifest, read_export
from rollbook.sources.tables import (FETCH_ROWS, conform, load_tables, partitioned_read,
                                     cut_predicates, quantile_cuts, range_predicates, tag_cuts, tag_pieces)

pytestmark = pytest.mark.usefixtures("few_rows")


def some_suppliers() -> World:
    w = World().party("P", "1", sites=("001", "002")).party("Q", "2")
    return w.qualify("P").qualify("P", site="002").qualify("Q")


def test_load_tables_trims_codes_and_fixes_types(spark, tmp_path):
    t = some_suppliers().tables(spark)
    for name, (stored, columns) in TABLES.items():
        t[name].selectExpr(*[
            f"concat({ours}, '  ') AS {raw}" if kind == "padded" else
            f"cast({ours} AS double) AS {raw}" if kind == "decimal(18,2)" else f"{ours} AS {raw}"
            for raw, ours, kind in columns]).write.parquet(f"{tmp_path}/{stored}")
    loaded = load_tables(spark, str(tmp_path))
    assert len(loaded) == 17
    for name in TABLES:
        assert rows(loaded[name]) == rows(t[name]), name
        assert loaded[name].dtypes == t[name].dtypes, name
    report = reports.supplier_site(loaded, params())
    assert rows(report, "vendor_id", "location_id") == [("P", "001"), ("P", "002"), ("Q", "001")]


def test_codes_keep_their_filters_in_the_scan(spark, tmp_path):
    some_suppliers().tables(spark)["document"].selectExpr(
        *[f"{ours} AS {raw}" for raw, ours, _ in TABLES["document"][1]]).write.parquet(
        f"{tmp_path}/DocCab")
    for trim in ((), (PADDED,), (PADDED, CODE)):
        doc = load_tables(spark, str(tmp_path), trim=trim, names=["document"])["document"]
        plan = doc.where("type = 'FE' AND party = 'P'")._jdf.queryExecution().executedPlan().toString()
        assert ("EqualTo(DocTipCod,FE)" in plan) is (CODE not in trim)
        assert ("EqualTo(CiaCod,P)" in plan) is (PADDED not in trim)


def test_csv_cells_survive_whole(spark, tmp_path):
    cells = [("  lead and trail  ", 1), ('say "hi", twice', 2), ("two\nlines\r\n", 3), (None, 4), ("", 5), ("\\ back, slash \"", 6), (" ", 7)]
    df = spark.createDataFrame(cells, "a string, k int")
    export_report(df.coalesce(1), str(tmp_path / "r"), names={"a": "Text (M)"})
    assert rows(read_export(spark, str(tmp_path / "r"), "a string, k int")) == rows(df)
    with open(glob.glob(f"{tmp_path}/r/part-*")[0], newline="") as file:
        assert '"say ""hi"", twice"' in file.read()


def test_batch_log_keeps_the_whole_error(spark, tmp_path):
    def fail(df):
        raise ValueError("x" * 2000 + "cause")

    log = report_batch(spark, some_suppliers().tables(spark), params(), str(tmp_path), ["supplier_site"], hooks={"supplier_site": fail})
    assert log.first()["error"] == "ValueError: " + "x" * 2000 + "cause"


@pytest.mark.parametrize("side", ["supplier", "customer"])
def test_amounts_that_are_all_null_are_zero(spark, side):
    from rollbook import standins

    t = dict(standins.tables(spark, "/root/testdata/sf0.001", side))
    t["document"] = t["document"].selectExpr(*[f"cast(NULL AS decimal(18,2)) AS {c}" if c == "amount" else c for c in t["document"].columns])
    for name in reports.REPORTS:
        if reports.SIDE[name] == side:
            report = reports.REPORTS[name](t, standins.params())
            amounts = [c for c, kind in report.dtypes if kind.startswith("decimal")]
            assert report.count() > 0 and report.where(" OR ".join(f"{c} IS NULL" for c in amounts)).count() == 0, name


@settings(max_examples=60, deadline=None)
@given(st.integers(-100, 100), st.integers(1, 200), st.integers(1, 12),
       st.one_of(st.none(), st.integers(-1000, 1000)))
def test_range_predicates_hold_for_exactly_one_piece(lower, span, pieces, value):
    tests = range_predicates("x", lower, lower + span, pieces)
    assert 1 <= len(tests) <= pieces
    python = [t.replace("x IS NULL", "x is None").replace("AND", "and").replace("OR", "or")
              .replace("1 = 1", "True") for t in tests]

    def holds(test: str) -> bool:
        if value is None:
            return test == "True" or "x is None" in test
        return bool(eval(test, {"x": value}))

    assert sum(map(holds, python)) == 1


def test_range_predicates_reject_bad_bounds():
    with pytest.raises(ValueError):
        range_predicates("x", 5, 5, 3)
    with pytest.raises(ValueError):
        range_predicates("x", 1, 5, 0)


def test_pieces_cover_a_table(spark):
    df = spark.range(100).selectExpr("CASE WHEN id < 95 THEN id END AS x")
    tagged = tag_pieces(df, "x", 10, 50, 4)
    assert rows(tagged.groupBy("piece").count()) == [(0, 25), (1, 10), (2, 10), (3, 55)]


def test_partitioned_read_passes_pieces_and_fetch_size():
    seen = {}

    class Reader:
        def jdbc(self, url, table, predicates, properties):
            seen.update(url=url, table=table, predicates=predicates, properties=properties)

    class Session:
        read = Reader()

    partitioned_read(Session(), {"url": "u", "dbtable": "t", "user": "me"}, "id", 0, 100, 4)
    assert seen["url"] == "u" and seen["table"] == "t" and len(seen["predicates"]) == 4
    assert seen["properties"] == {"fetchsize": str(FETCH_ROWS), "user": "me"}


def test_conform_takes_a_database_reader(spark):
    stored = spark.createDataFrame([("011 ", "CO  ")], "OriCod string, PaiCod string")
    tables = load_tables(spark, "", names=["origin"], read=lambda name: stored)
    assert rows(tables["origin"]) == rows(conform(stored, "origin")) == [("011 ", "CO  ")]
    assert rows(conform(stored, "origin", (CODE,))) == [("011", "CO")]


def test_csv_export(spark, tmp_path):
    df = spark.createDataFrame(
        [(i, f"t{i}", datetime(2024, 1, 1 + i, 13)) for i in range(7)],
        "n int, t string, d timestamp_ntz").coalesce(1)
    out = str(tmp_path / "r")
    export_report(df.limit(1), out)
    export_report(df, out, max_rows=3, names={"n": "N (M)"})  # replaces the first
    files = sorted(glob.glob(out + "/*.csv"))
    parts = [list(csv.reader(open(f))) for f in files]
    assert sorted(len(p) - 1 for p in parts) == [1, 3, 3]
    assert all(p[0] == ["N (M)", "t", "d"] for p in parts)
    assert ["0", "t0", "2024-01-01"] in [r for p in parts for r in p]


def test_csv_files_stay_small_enough_for_one_task(spark, tmp_path):
    n = 2 * CSV_ROWS + 10
    export_report(spark.range(n).coalesce(1), str(tmp_path / "r"))
    files = [list(csv.reader(open(f))) for f in sorted(glob.glob(str(tmp_path / "r/*.csv")))]
    assert [len(f) - 1 for f in files] == [CSV_ROWS, CSV_ROWS, 10]
    assert [int(r[0]) for f in files for r in f[1:]] == list(range(n))
    assert read_export(spark, str(tmp_path / "r"), "id bigint").count() == n


def test_common_tables_are_stored_once(spark, tmp_path, monkeypatch):
    day = "TIMESTAMP_NTZ '2000-01-01 00:00:00'"
    columns = {
        "nation": "int(id) AS n_nationkey; concat('N', id) AS n_name; int(id % 2) AS n_regionkey",
        "customer": "id AS c_custkey; 'c' AS c_name; 1 AS c_nationkey; 10D AS c_acctbal; 'BUILDING' AS c_mktsegment",
        "supplier": "id AS s_suppkey; 's' AS s_name; 1 AS s_nationkey; 10D AS s_acctbal",
        "orders": f"id AS o_orderkey; id AS o_custkey; 'O' AS o_orderstatus; 5D AS o_totalprice; {day} AS o_orderdate; '1' AS o_orderpriority",
        "lineitem": f"id AS l_orderkey; id AS l_partkey; id AS l_suppkey; 1 AS l_linenumber; 1D AS l_quantity; 1D AS l_extendedprice; "
                    f"0D AS l_discount; 0D AS l_tax; 'N' AS l_returnflag; 'O' AS l_linestatus; {day} AS l_shipdate",
        "events": f"id AS event_id; id AS user_id; {day} AS ts; 'click' AS event_type; 1D AS value",
    }
    for name in standins.STORED:
        spark.range(5).selectExpr(*columns[name].split("; ")).write.parquet(str(tmp_path / f"{name}.parquet"))
    stored = []
    monkeypatch.setattr(registry, "new_path", lambda spark, name: stored.append(tmp_path / f"stored-{len(stored)}") or str(stored[-1]))
    found = registry.ENTRIES["load_tables"].run(spark, str(tmp_path)).collect()
    assert sorted(f.name for s in stored for f in s.iterdir() if f.name == TABLES["site_tag"][0]) == [TABLES["site_tag"][0]]
    for name in standins.COMMON:
        of = {role: sorted(r.cells for r in found if (r.role, r.name) == (role, name)) for role in ("supplier", "customer")}
        assert of["supplier"] == of["customer"] and of["supplier"]


def test_parquet_export_keeps_times(spark, tmp_path):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 13),)], "d timestamp_ntz")
    export_report(df, str(tmp_path / "p"), fmt="parquet")
    assert rows(spark.read.parquet(str(tmp_path / "p"))) == [(datetime(2024, 1, 1, 13),)]


def test_width_profile(spark):
    df = spark.createDataFrame([("a" * 9, None, "x" * 70), (None, None, "y")],
                               "a string, long_header string, c string")
    assert rows(column_width_profile(df)) == [("a", 11), ("c", 50), ("long_header", 13)]
    assert rows(column_width_profile(df.limit(0))) == [("a", 3), ("c", 3), ("long_header", 13)]


def test_batch_goes_on_after_a_failure(spark, tmp_path):
    t = some_suppliers().tables(spark)

    def broken(df):
        raise RuntimeError("no such luck")

    log = report_batch(spark, t, params(), str(tmp_path),
                       ["supplier_header", "unknown", "supplier_site", "supplier_header_by_record"],
                       hooks={"supplier_header": broken,
                              "supplier_site": lambda df: df.where("vendor_id = 'P'")})
    got = {r["report"]: r for r in log.collect()}
    assert [got[n]["status"] for n in got] == ["failed", "failed", "ok", "ok"]
    assert "no such luck" in got["supplier_header"]["error"]
    assert got["supplier_site"]["rows"] == 2 and got["supplier_header_by_record"]["rows"] == 2
    written = spark.read.option("header", True).csv(got["supplier_site"]["path"])
    assert written.columns == [d for d, _ in LAYOUTS["supplier_site"]]
    assert written.count() == 2


def test_batch_limit_and_parquet(spark, tmp_path):
    log = report_batch(spark, some_suppliers().tables(spark), params(), str(tmp_path),
                       ["supplier_site"], limit=1, fmt="parquet")
    (row,) = log.collect()
    assert row["rows"] == 1 and spark.read.parquet(row["path"]).count() == 1


def test_shared_parts_give_the_same_report(spark):
    t, p = some_suppliers().tables(spark), params()
    parts = keep(reports.report_parts(t, p, "supplier"), "parts")
    for name in ("supplier_header", "supplier_site", "supplier_site_self_qualified"):
        plan = reports.REPORTS[name]
        assert rows(plan(t, p, parts)) == rows(plan(t, p)), name
    assert shared_folder(spark) and new_path(spark, "x") != new_path(spark, "x")


def test_hooks_and_renames(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert post_transform(df) is df and rename_columns(df, None) is df
    assert rename_columns(df, {"a": "A (M)"}).columns == ["A (M)"]
    assert rows(blank_columns(df, ["b"])) == [(1, "")]


def files_of(path):
    return sorted(x.name for x in path.iterdir())


def test_a_failed_export_leaves_the_former_report(spark, tmp_path):
    out = tmp_path / "r"
    export_report(spark.createDataFrame([(1,), (2,)], "n int"), str(out))
    bad = spark.range(0, 1000, 1, 4).selectExpr("if(id = 900, raise_error('in mid-write'), id) AS n")
    with pytest.raises(Exception, match="in mid-write"):
        export_report(bad, str(out))
    assert rows(read_export(spark, str(out), "n int")) == [(1,), (2,)]
    assert files_of(tmp_path) == ["r"]  # nothing is left beside it
    export_report(spark.createDataFrame([(3,)], "n int"), str(out))
    assert rows(read_export(spark, str(out), "n int")) == [(3,)] and files_of(tmp_path) == ["r"]


def test_a_run_that_broke_off_between_renames(spark, tmp_path):
    out = tmp_path / "r"
    export_report(spark.createDataFrame([(1,)], "n int"), str(out), about=lambda: {"rows": 1})
    out.rename(tmp_path / "r.former")  # the new folder was not put in place
    assert rows(read_export(spark, str(out), "n int")) == [(1,)] and manifest(spark, str(out)) == {"rows": 1}
    export_report(spark.createDataFrame([(2,)], "n int"), str(out), about=lambda: {"rows": 5})
    assert rows(read_export(spark, str(out), "n int")) == [(2,)] and manifest(spark, str(out)) == {"rows": 5}
    assert files_of(tmp_path) == ["r"] and manifest(spark, str(tmp_path / "none")) is None


def test_a_repeated_run_does_what_failed(spark, tmp_path):
    t, names, seen = some_suppliers().tables(spark), ["supplier_header", "supplier_site"], []

    def hook(name, fail=False):
        def run(df):
            seen.append(name)
            if fail:
                raise RuntimeError("lost")
            return df
        return run

    batch = lambda fail, run="monday", **kw: [tuple(r)[:3] for r in report_batch(
        spark, t, params(), str(tmp_path), names, run=run, hooks={"supplier_header": hook("h"), "supplier_site": hook("s", fail)}, **kw).collect()]
    assert batch(True) == [("supplier_header", "ok", 2), ("supplier_site", "failed", None)] and sorted(seen) == ["h", "s"]
    seen.clear()
    assert batch(False) == [("supplier_header", "kept", 2), ("supplier_site", "ok", 3)] and seen == ["s"]
    seen.clear()
    assert [r[1] for r in batch(False)] == ["kept", "kept"] and not seen
    assert [r[1] for r in batch(False, "tuesday")] == ["ok", "ok"] and sorted(seen) == ["h", "s"]
    assert [r[1] for r in batch(False, "tuesday", limit=1)] == ["ok", "ok"]  # other parameters
    assert [r[1] for r in batch(False, None)] == ["ok", "ok"]


def test_batch_reports_run_side_by_side(spark, tmp_path):
    """Each waits for the other one, so they have to be under way at the same time."""
    import threading

    both = threading.Barrier(2, timeout=60)
    pools = []

    def meet(df):
        both.wait()
        pools.append(df.sparkSession.sparkContext.getLocalProperty("spark.scheduler.pool"))
        return df

    names = ["supplier_site", "supplier_header"]
    log = report_batch(spark, some_suppliers().tables(spark), params(), str(tmp_path), names, hooks=dict.fromkeys(names, meet), workers=2)
    assert [(r["report"], r["status"]) for r in log.collect()] == [(n, "ok") for n in names] and sorted(pools) == sorted(names)


@pytest.mark.parametrize("pieces", [1, 3, 8])
def test_cuts_by_quantiles(spark, pieces):
    keys = spark.range(4000).selectExpr("CASE WHEN id % 400 = 0 THEN NULL ELSE id * id END AS k")
    cuts = quantile_cuts(keys, "k", pieces)
    sizes = [r["count"] for r in tag_cuts(keys, "k", cuts).groupBy("piece").count().collect()]
    assert len(sizes) == pieces and sum(sizes) == 4000 and max(sizes) < 1.1 * 4000 / pieces
    assert quantile_cuts(keys.limit(0), "k", pieces) == [] and cut_predicates("k", []) == ["1 = 1"]
    with pytest.raises(ValueError):
        quantile_cuts(keys, "k", 0)
