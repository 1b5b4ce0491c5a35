"""Whole reports on hand-made tables: one test per rule that is easy to get wrong, and per point
where two reports of the same side differ."""

from __future__ import annotations

from decimal import Decimal

import pytest
from world import AS_OF, DAY, TICK, World, chf, params, rows, years_ago

from rollbook.operators import sets
from rollbook.plans import reports
from rollbook.plans.layouts import LAYOUTS, display_names, plain_name
from rollbook.functions.labels import rename_columns


def run(spark, world, name, *columns, p=None):
    return rows(reports.REPORTS[name](world.tables(spark), p or params()), *columns)


pytestmark = pytest.mark.usefixtures("few_rows")
SUPPLIERS = ("supplier_header", "supplier_header_by_record", "supplier_site",
             "supplier_site_self_qualified")


@pytest.mark.parametrize("name,count", [
    ("supplier_header", 53), ("supplier_header_by_record", 53), ("supplier_site", 56),
    ("supplier_site_self_qualified", 56), ("customer_header", 51), ("customer_site", 41)])
def test_columns_and_display_names(spark, name, count):
    layout = LAYOUTS[name]
    df = reports.REPORTS[name](World().tables(spark), params())
    assert len(df.columns) == len(set(df.columns)) == count
    assert df.columns == [plain_name(d) for d, _ in layout]
    assert rename_columns(df, display_names(layout)).columns == [d for d, _ in layout]


def test_simplest_supplier_in_all_four(spark):
    w = World().party("P", "900").doc("P", "FE", balance=50)
    for name in SUPPLIERS:
        assert run(spark, w, name, "vendor_num", "trx_op_bal_chf", "supplier_trx_source_list") == [
            ("900", chf(50), "INV_1Y")], name


def test_fused_header(spark):
    """One row per tax id from the smallest origin, ties by party, with metrics of all records."""
    w = World().party("B", "1", origin="F490401").party("Z", "1", origin="011")
    w.party("Y", "1", origin="011").party("C", "1", origin="F490411")
    for party, origin in (("B", "F490401"), ("Z", "011"), ("Y", "011"), ("C", "F490411")):
        w.doc(party, "FE", amount=10, balance=1, origin=origin)
    assert run(spark, w, "supplier_header", "vendor_id", "trx_1y_amount_chf") == [("Y", chf(40))]
    assert run(spark, w, "supplier_header_by_record", "vendor_id", "trx_1y_amount_chf") == [
        (x, chf(10)) for x in "BCYZ"]


def test_chosen_record_without_active_site_loses_the_tax_id(spark):
    w = World().party("A", "1", sites=()).site("A", "001", "0").party("B", "1", origin="F490401")
    w.doc("A", "FE", balance=5).doc("B", "FE", balance=5, origin="F490401")
    assert run(spark, w, "supplier_header") == []
    assert run(spark, w, "supplier_header_by_record", "vendor_id") == [("B",)]


def test_repeated_class_tag_counts_documents_twice_per_tax_id_and_repeats_records(spark):
    w = World().party("P", "1").doc("P", "FE", amount=10, balance=1)
    w.add("party_class", origin="011", party="P", tag_group="6", tag_code="2")
    assert run(spark, w, "supplier_header", "trx_1y_amount_chf", "trx_1y_count") == [(chf(20), 2)]
    assert run(spark, w, "supplier_header_by_record", "trx_1y_amount_chf", "trx_1y_count") == [
        (chf(10), 1)] * 2
    assert len(run(spark, w, "supplier_site", "vendor_id")) == 2


def test_lookups_that_multiply_rows(spark):
    w = World().party("P", "1").qualify("P")
    for n in "AB":
        w.add("account", origin="011", party="P", number=n, type="T", status="1")
    for origin in ("011", "F490401", "999"):
        w.add("party_param", party="P", origin=origin, code="7941", value=f"sic {origin}")
    for n in "CD":
        w.add("contact_person", party="P", site="001", role="Director Ejecutivo", first_name=n)
    w.add("contact_person", party="P", site="001", role="Other", first_name="x")
    counts = {n: len(run(spark, w, n, "vendor_id")) for n in SUPPLIERS}
    # accounts x2 and sic x3 everywhere they are joined; contacts x2 in headers only
    assert counts == {"supplier_header": 6, "supplier_header_by_record": 12, "supplier_site": 6,
                      "supplier_site_self_qualified": 6}


def test_customer_accounts(spark):
    w = World().customer("P", "1").qualify("P", type="FA")
    for n in "AB":
        w.add("account", origin="011", party="P", number=n, type="T" + n, status="1")
    for name in ("customer_header", "customer_site"):
        assert run(spark, w, name, "party_id", "account_description", "party_site_id") == [
            ("A", "TA", "P001"), ("B", "TB", "P001")]


def test_order_needs_an_open_balance_only_in_the_fused_reports(spark):
    w = World().party("P", "1").doc("P", "OC", balance=0)
    kept = {n: len(run(spark, w, n, "vendor_id")) for n in SUPPLIERS}
    assert kept == {"supplier_header": 0, "supplier_header_by_record": 1, "supplier_site": 0,
                    "supplier_site_self_qualified": 1}
    tag = "supplier_trx_source_list"
    assert run(spark, w, "supplier_header_by_record", tag) == [("POH_OP",)]
    assert run(spark, w, "supplier_site_self_qualified", tag) == [("POH_OP",)]
    w.doc("P", "FE", years_ago(3), balance=0).doc("P", "C2", balance=5)
    assert run(spark, w, "supplier_header", tag) == [("NO_TRX_AT_ALL",)]
    assert run(spark, w, "supplier_site", tag) == [("NO_TRX_AT_ALL",)]


def test_open_order_qualifies_the_fused_reports(spark):
    w = World().party("P", "1").doc("P", "OS", years_ago(2), balance=1)
    columns = ("supplier_trx_source_list", "po_1y_op_count", "po_2y_op_count", "po_op_count")
    for name in SUPPLIERS:
        assert run(spark, w, name, *columns) == [("POH_OP", 0, 1, 1)], name


def test_excluding_document(spark):
    def world(site, status="1"):
        w = World().party("A", "1").party("B", "1", origin="F490401")
        w.qualify("A").qualify("B", origin="F490401")
        return w.doc("A", "EC", site=site, status=status)

    def kept(w):
        return {n: [r[0] for r in run(spark, w, n, "vendor_id")] for n in SUPPLIERS}

    # at a valid site: the tax id goes in fused reports, the record in the others
    assert kept(world("001")) == {
        "supplier_header": [], "supplier_header_by_record": ["B"], "supplier_site": [],
        "supplier_site_self_qualified": ["B"]}
    # at an unknown site: only the self-qualified report looks there
    assert kept(world("009")) == {
        "supplier_header": ["A"], "supplier_header_by_record": ["A", "B"],
        "supplier_site": ["A", "B"], "supplier_site_self_qualified": ["B"]}
    # void: nobody minds
    assert kept(world("001", status="0"))["supplier_site_self_qualified"] == ["A", "B"]


def test_two_recent_invoices_and_a_recent_transaction(spark):
    for types, kept in ((["FE"], 0), (["FD", "FD"], 0), (["FE", "FD"], 1), (["FE", "AP"], 0)):
        w = World().party("P", "1")
        for type in types:
            w.doc("P", type, years_ago(2))
        assert len(run(spark, w, "supplier_header", "vendor_id")) == kept, types
    w = World().party("P", "1").doc("P", "FE", years_ago(2)).doc("P", "FE", years_ago(2) - TICK)
    assert run(spark, w, "supplier_header") == []


def test_inactive_sites(spark):
    """Status '0' with an open document is valid; other statuses only count where no valid-site
    test is made; NULL never passes."""
    w = World().party("P", "1")
    for site, status in (("002", "0"), ("003", "0"), ("004", "2"), ("005", None)):
        w.site("P", site, status)
    for site in ("001", "002", "004", "005"):
        w.doc("P", "FE", site=site, balance=5, amount=1)
    w.doc("P", "FE", site="003", amount=1)
    t, p = w.tables(spark), params()
    assert [r[2] for r in rows(sets.valid_sites(t["site"], t["document"], p.supplier))] == [
        "001", "002"]
    assert run(spark, w, "supplier_header", "trx_1y_count") == [(2,)]
    for name in ("supplier_site", "supplier_site_self_qualified"):
        assert [r[0] for r in run(spark, w, name, "location_id")] == ["001", "002", "004"], name
    c = World().customer("P", "1")
    for site, status in (("002", "0"), ("003", "0"), ("004", "2"), ("005", None)):
        c.site("P", site, status)
    for site in ("001", "002", "004", "005"):
        c.doc("P", "FA", site=site, balance=5)
    c.doc("P", "FA", site="003")
    assert [r[0] for r in run(spark, c, "customer_site", "party_site_number")] == ["001", "002"]


def test_negative_open_balance_of_an_inactive_site(spark):
    w = World().party("P", "1").qualify("P").site("P", "002", "0")
    w.doc("P", "NP", site="002", balance=5).doc("P", "FE", site="002").doc("P", "FE", site="002")
    assert [r[0] for r in run(spark, w, "supplier_site", "location_id")] == ["001", "002"]
    assert [r[0] for r in run(spark, w, "supplier_site_self_qualified", "location_id")] == ["001"]


def test_site_report_wants_a_metric(spark):
    w = World().party("P", "1", sites=("001", "002", "003")).qualify("P")
    w.doc("P", "C2", years_ago(3), site="002").doc("P", "CX", years_ago(9), site="003", balance=1)
    assert [r[0] for r in run(spark, w, "supplier_site", "location_id")] == ["001", "003"]
    assert [r[0] for r in run(spark, w, "supplier_site_self_qualified", "location_id")] == ["001"]


def test_tags(spark):
    w = World().party("P", "1", sites=("001", "002", "003", "004"))
    for code, name in (("1", "one"), ("2", None), ("3", "three"), ("10", "ten")):
        w.add("tag_type", origin="011", tag_group="9", tag_code=code, name=name)
    w.add("tag_type", origin="F490401", tag_group="9", tag_code="1", name="elsewhere")
    for site, group, code in (("002", "9", "1"), ("003", "9", "3"), ("003", "9", "1"),
                              ("003", "9", "2"), ("003", "9", "1"), ("003", "9", "10"),
                              ("004", "8", "7"), ("004", "8", "3"), ("004", "8", "7")):
        w.add("site_tag", origin="011", party="P", site=site, tag_group=group, tag_code=code)
    for site in ("001", "002", "003", "004"):
        w.doc("P", "FE", site=site, balance=5)
    columns = ("location_id", "vendor_site_code", "po_usage")
    assert run(spark, w, "supplier_site", *columns) == [
        ("001", None, None), ("002", "one", None), ("003", "one, one, ten, three", "Payment"),
        ("004", None, "Payment, Purchasing, Payment, Purchasing, Payment")]
    assert run(spark, w, "supplier_site_self_qualified", *columns) == [
        ("001", None, None), ("002", "one", None), ("003", None, None), ("003", "one", None),
        ("003", "one", None), ("003", "ten", None), ("003", "three", "Payment"),
        ("004", None, "Payment"), ("004", None, "Purchasing, Payment"),
        ("004", None, "Purchasing, Payment")]


def test_contacts(spark):
    w = World().party("P", "1", sites=("001", "002")).qualify("P").qualify("P", site="002")
    for site, code, type, status, number in (
            ("001", "2", 1, "1", "phone 2"), ("001", "1", 1, "0", "phone 1"),
            ("001", "3", 1, "1", "phone 3"), ("001", "9", 3, "1", "mail"),
            ("001", "8", 4, "1", "url"), ("002", "1", 2, "1", "fax")):
        w.add("contact_point", origin="011", party="P", site=site, code=code, type=type,
              status=status, number=number)
    assert run(spark, w, "supplier_site", "location_id", "phone", "email_address") == [
        ("001", "phone 2", "mail"), ("002", None, None)]
    assert run(spark, w, "supplier_header", "remittance_email", "url") == [("mail", "url")]


def test_missing_origin_row(spark):
    """Suppliers stay with blank origin look-ups, customers go."""
    w = World().party("P", "1", origin="F494151").qualify("P", origin="F494151")
    w.add("contact_point", origin="F494151", party="P", site="001", code="1", type=3, status="1",
          number="mail")
    assert run(spark, w, "supplier_header", "default_rep_country_code", "remittance_email") == [
        (None, None)]
    assert run(spark, w, "supplier_site", "org_name", "email_address") == [(None, None)]
    c = World().customer("P", "1", origin="F494151").qualify("P", type="FA", origin="F494151")
    c.add("id_type", origin="F494151", id_type_code=1, name="x")
    assert run(spark, c, "customer_header") == run(spark, c, "customer_site") == []


def geo_world(role, state_status="1", country=True):
    w = World().party("P", "1", role=role).qualify("P", type="FE" if role == "2" else "FA")
    if country:
        w.add("country", country="CO", name="Colombia")
    w.add("state", origin="011", country="CO", state="1", name="S", status=state_status)
    w.add("province", origin="011", country="CO", state="1", province="2", name="V")
    return w.add("district", origin="011", country="CO", state="1", province="2", district="3",
                 name="D", postal_code="110")


def test_geography(spark):
    header = ("country", "city", "postal_code", "state", "province")
    site = ("country", "city", "zip", "state", "province")
    assert run(spark, geo_world("2"), "supplier_header", *header) == [("Colombia", "D", "110", "S", "V")]
    # an inactive state hides itself and its province, not the district
    for name, columns in (("supplier_header", header), ("supplier_site", site)):
        assert run(spark, geo_world("2", "0"), name, *columns) == [("Colombia", "D", "110", None, None)]
    # without a country row, headers lose the district and sites keep it
    assert run(spark, geo_world("2", country=False), "supplier_header", *header) == [
        (None, None, None, "S", "V")]
    assert run(spark, geo_world("2", country=False), "supplier_site", *site) == [
        (None, "D", "110", "S", "V")]
    assert run(spark, geo_world("4", country=False), "customer_header", *header) == [
        (None, None, None, "S", "V")]
    assert run(spark, geo_world("4", country=False), "customer_site", *header) == [
        (None, "D", "110", "S", "V")]


def test_who_is_a_base_party(spark):
    w = World()
    for code, tax, kw in (("OK", "1", {}), ("F", "F2", {}), ("N", None, {}), ("I", "3", {"status": "0"}),
                          ("O", "4", {"origin": "999"}), ("F490421", "5", {}), ("2000022410", "6", {}),
                          ("f", "f7", {})):
        w.party(code, tax, **kw).qualify(code, origin=kw.get("origin", "011"))
        w.add("party_class", origin=kw.get("origin", "011"), party=code, tag_group="6", tag_code="4")
        w.doc(code, "FA", balance=5, origin=kw.get("origin", "011"))
    w.party("W", "8", role="9").qualify("W")
    assert [r[0] for r in run(spark, w, "supplier_header", "vendor_id")] == ["OK", "f"]
    assert [r[0] for r in run(spark, w, "customer_header", "registry_id")] == ["1", "6", "f7"]


def test_customers_qualify_by_balance_documents_or_quotes(spark):
    w = World()
    for code in ("BAL", "DOC", "OLD", "QUO", "DRAFT", "OLDQ", "NONE"):
        w.customer(code, code)
    w.doc("BAL", "FV", years_ago(8), balance=1).doc("DOC", "NC", years_ago(5))
    w.doc("OLD", "NC", years_ago(5) - TICK).doc("NONE", "FV")
    for code, created, status in (("QUO", years_ago(5), 1), ("DRAFT", AS_OF, 0), ("DRAFT", AS_OF, 6),
                                  ("DRAFT", AS_OF, None), ("OLDQ", years_ago(5) - TICK, 1)):
        w.add("quote", origin="011", party=code, created=created, status=status)
    assert run(spark, w, "customer_header", "registry_id", "customer_trx_source_list",
               "doc_trx_0y5_op_count", "min_trx_year") == [
        ("BAL", "PAY_SCHE_NO_TRX", 0, 2016), ("DOC", "TRX_2Y5", 1, 2019),
        ("QUO", "PAY_SCHE_NO_TRX", 0, None)]
    assert [r[0] for r in run(spark, w, "customer_site", "registry_id")] == ["DOC"]


def test_business_model(spark):
    w = World()
    names = {"MUNICIPIO X": "B2G", "alcaldía de x": "B2G", "X ESE Y": "B2G", "ESE Y": "B2B",
             "X E.S.P": "B2G", "X EXSXP": "B2B", "AGENCIA LOGÍSTICA": "B2G",
             "AGENCIA LOGISTICA": "B2B", "RAM A JUDICIAL": "B2G", "RAMA JUDICIAL": "B2B"}
    for i, name in enumerate(names):
        w.customer(f"P{i}", str(i), name=name, id_type_code=5).qualify(f"P{i}", type="FA")
    w.customer("T1", "t1", id_type_code=1).qualify("T1", type="FA")
    w.customer("T3", "t3", id_type_code=3).qualify("T3", type="FA")
    got = dict(run(spark, w, "customer_header", "party_name", "business_model_b2x"))
    assert {n: v[:3] for n, v in got.items()} == {**names, "name T1": "B2B", "name T3": "B2C"}


def test_every_site_of_the_site_report_belongs_to_a_header(spark):
    w = World()
    for i in range(12):
        w.party(f"P{i}", str(i // 2), sites=("001", "002"), origin=("011", "F490401")[i % 2])
        w.doc(f"P{i}", ("FE", "OC", "C2")[i % 3], AS_OF - 100 * i * DAY, balance=i % 4 // 3,
              origin=("011", "F490401")[i % 2], site=f"00{i % 2 + 1}")
    header = {r[0] for r in run(spark, w, "supplier_header", "vendor_num")}
    site = {r[0] for r in run(spark, w, "supplier_site", "vendor_num")}
    assert site <= header and 0 < len(header) < 6


def test_order_and_limit(spark):
    w = World()
    for party, tax in (("B", "2"), ("A", "2"), ("C", "1")):
        w.party(party, tax, sites=("002", "001")).qualify(party).qualify(party, site="002")
    t, p = w.tables(spark), params()
    df = reports.supplier_site(t, p).select("vendor_num", "vendor_id", "location_id")
    wanted = [("1", "C", "001"), ("1", "C", "002"), ("2", "A", "001"), ("2", "A", "002"),
              ("2", "B", "001"), ("2", "B", "002")]
    assert [tuple(r) for r in df.collect()] == wanted
    assert [tuple(r) for r in sets.limit_report(df, 3).collect()] == wanted[:3]
    assert sets.limit_report(df, 0) is df and sets.limit_report(df, None) is df
    by_party = reports.supplier_site_self_qualified(t, p).select("vendor_id", "location_id")
    assert [r[0] for r in by_party.collect()] == list("AABBCC")


def test_totals_are_sums_of_shown_values(spark):
    w = World().customer("P", "1").doc("P", "FA", amount=10**9, balance=10**8)
    (row,) = run(spark, w, "customer_header", "tot_trx_0y2_amount_chf", "tot_trx_op_amount_chf",
                 "tot_trx_0y5_op_amount_chf", "doc_trx_0y5_op_count")
    assert row[2] == row[0] + row[1] and row[3] == 2
    assert row[0] == round(chf(chf(10**9)), 6) == Decimal("44.394069")
