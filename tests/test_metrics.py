"""Windows, signs, counts and money on hand-computed documents."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from world import AS_OF, DAY, TICK, World, chf, params, rows, years_ago

from rollbook.operators import filters, metrics
from rollbook.plans import reports
from rollbook.schema import RECORD, SITE


pytestmark = pytest.mark.usefixtures("few_rows")


def by_tax(spark, world, role="supplier", p=None):
    t, p = world.tables(spark), p or params()
    base = getattr(reports, f"{role}_base")(t, p)
    parts = getattr(reports, f"{role}_parts")(t, p)
    return metrics.base_record_parts(parts, t["site"], base), p


def test_supplier_windows_are_half_open(spark):
    w = World().party("P", "1")
    for amount, created in [(1, years_ago(1)), (10, years_ago(1) - TICK), (100, years_ago(2)),
                            (1000, years_ago(2) - TICK), (10000, AS_OF + 400 * DAY)]:
        w.doc("P", "FE", created, amount)
    parts, p = by_tax(spark, w)
    assert rows(metrics.period_amounts(parts, ["tax_id"], p, p.supplier)) == [
        ("1", chf(10001), chf(110))]
    assert rows(metrics.document_counts(parts, ["tax_id"], p, p.supplier)) == [("1", 2, 2, 0)]


def test_customer_windows_share_their_bound(spark):
    w = World().customer("P", "1")
    for amount, created in [(10**6, years_ago(2)), (10**7, years_ago(2) - TICK),
                            (10**8, years_ago(5)), (10**9, years_ago(5) - TICK)]:
        w.doc("P", "FA", created, amount)
    parts, p = by_tax(spark, w, "customer")

    def twice(amount):
        return round(chf(chf(amount)), 6)

    assert rows(metrics.period_amounts(parts, ["tax_id"], p, p.customer)) == [
        ("1", twice(10**6), twice(10**6 + 10**7 + 10**8), Decimal(0))]
    assert rows(metrics.document_counts(parts, ["tax_id"], p, p.customer),
                "doc_trx_0y2_count", "doc_trx_2y5_count") == [(1, 3)]


def test_second_conversion_can_be_switched_off(spark):
    w = World().customer("P", "1").doc("P", "FA", amount=10**6)
    parts, p = by_tax(spark, w, "customer", params(rate_outer=Decimal(1)))
    assert rows(metrics.period_amounts(parts, ["tax_id"], p, p.customer),
                "tot_trx_0y2_amount_chf") == [(chf(10**6),)]


def test_leap_day_keeps_the_time(spark):
    as_of = datetime(2024, 2, 29, 13)
    bound = datetime(2023, 2, 28, 13)
    w = World().party("P", "1").doc("P", "FE", bound, 1).doc("P", "FE", bound - TICK, 10)
    parts, p = by_tax(spark, w, p=params(as_of))
    assert rows(metrics.period_amounts(parts, ["tax_id"], p, p.supplier)) == [
        ("1", chf(1), chf(10))]


def test_signs_and_types_that_only_count(spark):
    w = World().party("P", "1")
    for type in ("FE", "FD", "DE", "NP", "NA", "C2", "FP", "LG", "NO", "RG", "M2", "N2"):
        w.doc("P", type, amount=100, balance=7)
    w.doc("P", "XX", amount=100, balance=7).doc("P", "OC", amount=100, balance=7)
    parts, p = by_tax(spark, w)
    assert rows(metrics.period_amounts(parts, ["tax_id"], p, p.supplier),
                "trx_1y_amount_chf") == [(chf(100),)]  # 3 invoices - 2 credit notes
    assert rows(metrics.open_balance(parts, ["tax_id"], p)) == [("1", chf(7 * (8 - 4)))]
    assert rows(metrics.document_counts(parts, ["tax_id"], p, p.supplier)) == [("1", 12, 0, 12)]


def test_customer_open_count_needs_a_recent_due_date_and_no_debit_note(spark):
    w = World().customer("P", "1")
    w.doc("P", "FA", years_ago(4), balance=1, due=years_ago(2))
    w.doc("P", "FA", years_ago(4), balance=1, due=years_ago(2) - TICK)
    w.doc("P", "ND", balance=1)
    parts, p = by_tax(spark, w, "customer")
    assert rows(metrics.document_counts(parts, ["tax_id"], p, p.customer)) == [("1", 1, 2, 1)]
    assert rows(metrics.customer_flags(parts, ["tax_id"], p)) == [("1", True, True, True)]


def test_null_status_balance_and_date(spark):
    w = World().party("P", "1").party("N", None).party("F", "F1")
    w.doc("P", "FE", status=None).doc("P", "FE", balance=None, amount=5)
    w.add("document", origin="011", party="P", site="001", type="FE", status="1",
          amount=Decimal(3), balance=Decimal(2), created=None, due=None)
    w.qualify("N").qualify("F")
    parts, p = by_tax(spark, w)
    got = metrics.supplier_metrics(parts, ["tax_id"], p)
    assert rows(got, "tax_id", "trx_1y_amount_chf", "trx_op_bal_chf", "trx_1y_count",
                "trx_op_count", "min_trx_date") == [("1", chf(5), chf(2), 1, 1, AS_OF - 30 * DAY)]


def test_big_money_does_not_overflow_or_round(spark):
    amount = Decimal("9876543210987654.32")
    w = World().party("P", "1")
    for _ in range(50):
        w.doc("P", "FE", amount=amount, balance=amount)
    parts, p = by_tax(spark, w)
    assert rows(metrics.supplier_metrics(parts, ["tax_id"], p), "trx_1y_amount_chf",
                "trx_op_bal_chf") == [(50 * chf(amount), 50 * chf(amount))]


def test_rate_with_whole_part(spark):
    w = World().party("P", "1").doc("P", "FE", amount="12345678901234.56")
    parts, p = by_tax(spark, w, p=params(rate=Decimal("4321.123456789")))
    assert rows(metrics.period_amounts(parts, ["tax_id"], p, p.supplier), "trx_1y_amount_chf") == [
        (Decimal("12345678901234.56") * Decimal("4321.123456789"),)]


def test_orders(spark):
    w = World().party("P", "1")
    w.doc("P", "OC", years_ago(1), balance=1).doc("P", "OS", years_ago(2), balance=1)
    w.doc("P", "OC", years_ago(2) - TICK, balance=1).doc("P", "OC", balance=0)
    w.doc("P", "CX", years_ago(9), balance=1).doc("P", "CX", balance=0)
    parts, p = by_tax(spark, w)
    assert rows(metrics.order_metrics(parts, ["tax_id"], p)) == [
        ("1", 1, 2, 3, years_ago(2) - TICK, years_ago(1), 1)]


def test_roll_up_of_sites_is_the_header(spark):
    """Header metrics equal the sum of site metrics over valid sites."""
    w = World().party("P", "1", sites=("001", "002")).party("Q", "1", origin="F490401")
    w.site("P", "003", status="0").site("P", "004", status="0")
    for i, site in enumerate(("001", "002", "003", "004", "009")):
        w.doc("P", "FE", site=site, amount=10 ** i, balance=5 if site == "003" else 0)
    w.doc("Q", "NP", origin="F490401", amount=7)
    t, p = w.tables(spark), params()
    parts = reports.supplier_parts(t, p)
    valid = metrics.in_valid_sites(parts, t["site"])
    assert rows(valid, *SITE) == [("011", "P", "001"), ("011", "P", "002"), ("011", "P", "003"),
                                  ("F490401", "Q", "001")]
    header = metrics.period_amounts(
        metrics.base_record_parts(parts, t["site"], reports.supplier_base(t, p)), ["tax_id"], p,
        p.supplier)
    assert rows(header, "trx_1y_amount_chf") == [(chf(111 - 7),)]


def test_result_does_not_depend_on_partitioning(spark):
    w = World().party("P", "1", sites=("001", "002"))
    for i in range(40):
        w.doc("P", ("FE", "NP", "OC", "C2")[i % 4], years_ago(i % 3) - i * DAY, amount=i,
              balance=i % 5, site=f"00{i % 2 + 1}")
    t, p = w.tables(spark), params()
    one = rows(metrics.all_supplier_columns(metrics.site_parts(t["document"], p, p.supplier), SITE, p))
    many = rows(metrics.all_supplier_columns(metrics.site_parts(
        t["document"].orderBy("amount").repartition(7), p, p.supplier), SITE, p))
    assert one == many


def test_qualification_per_record_and_per_site(spark):
    w = World().party("P", "1", sites=("001", "002"))
    w.doc("P", "FE", site="001").doc("P", "FD", site="002")
    t, p = w.tables(spark), params()
    parts = reports.supplier_parts(t, p)
    # FD is an invoice but not a recent-transaction type, so only site 001 qualifies.
    assert rows(filters.qualified_sites(parts)) == [("011", "P", "001")]
    assert rows(filters.qualified_records(metrics.record_parts(parts, t["site"]))) == [("011", "P")]
    one_invoice = World().party("P", "1").doc("P", "FE").tables(spark)
    assert rows(filters.qualified_sites(reports.supplier_parts(one_invoice, p))) == []
    assert RECORD == SITE[:2]
