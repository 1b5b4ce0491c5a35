"""Row filters and the qualification rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from rollbook.functions.windows import one_of, since
from rollbook.operators.metrics import roll_up
from rollbook.params import Params, RoleCodes
from rollbook.schema import RECORD, SITE


def base_parties(party: DataFrame, party_class: DataFrame, p: Params, codes: RoleCodes) -> DataFrame:
    """Active parties of the wanted origins that carry the side's class tag.

    A repeated tag repeats the party.
    """
    tags = party_class.where(f"tag_group = '{codes.class_group}' AND tag_code = '{codes.class_code}'")
    kept = party.where(
        f"{one_of('origin', p.origins)} AND status = '1' "
        f"AND NOT ({one_of('party', codes.excluded_parties)}) AND tax_id NOT LIKE 'F%'")
    return kept.join(tags.select(*RECORD), RECORD)


def transactional_documents(doc: DataFrame, codes: RoleCodes) -> DataFrame:
    return doc.where(one_of("type", codes.document_types)).where("status != '0'")


def site_keep(df: DataFrame, cmp: str = "ne", status: str = "site_status",
              balance: str = "open_balance") -> DataFrame:
    """Active sites, and sites of another non-NULL status with an open balance (``ne`` 0 or ``gt`` 0)."""
    test = {"ne": "!=", "gt": ">"}[cmp]
    return df.where(f"{status} = '1' OR ({status} != '1' AND coalesce({balance}, 0) {test} 0)")


def nonzero_metrics(df: DataFrame, amounts: Sequence[str], counts: Sequence[str]) -> DataFrame:
    tests = [f"coalesce({a}, 0) != 0" for a in amounts] + [f"coalesce({c}, 0) > 0" for c in counts]
    return df.where(" OR ".join(tests))


def supplier_rule(open_orders: bool = True) -> str:
    """Open balance, or a recent purchase order, or more than one recent invoice together with a
    recent transaction; never with a document of an excluding type. For grouped parts."""
    order = "n_order_2y" if open_orders else "n_order_any_2y"
    return (f"n_excluding = 0 AND (sum_open_balance > 0 OR {order} > 0 "
            "OR (n_invoice_2y > 1 AND n_recent_2y > 0))")


def customer_rule() -> str:
    return "sum_open_balance > 0 OR n_moving_5y > 0"


def qualified_suppliers(base_parts: DataFrame) -> DataFrame:
    """Tax ids that pass the supplier rule over all their records, one row each."""
    return roll_up(base_parts, ["tax_id"]).where(supplier_rule()).select("tax_id")


def quoted(base: DataFrame, quote: DataFrame, p: Params) -> DataFrame:
    """Tax ids with a quote in five years whose status is not excluded.

    Quotes are reduced to distinct records before the join, so a busy record is one row.
    """
    records = (quote.where(since("created", p.as_of, 5))
               .where(f"NOT ({one_of('status', p.quote_status_excluded)})")
               .select(*RECORD).distinct())
    return base.select(*RECORD, "tax_id").join(records, RECORD).select("tax_id").distinct()


def qualified_customers(base_parts: DataFrame, quotes: DataFrame) -> DataFrame:
    """Tax ids that pass the customer rule, or have a quote; ``quotes`` comes from :func:`quoted`."""
    by_documents = roll_up(base_parts, ["tax_id"]).where(customer_rule()).select("tax_id")
    return by_documents.unionByName(quotes).distinct()


def qualified_records(parts_by_record: DataFrame) -> DataFrame:
    """Per-record form of the supplier rule; a purchase order need not be open."""
    return parts_by_record.where(supplier_rule(open_orders=False)).select(*RECORD)


def qualified_site_parts(parts: DataFrame) -> DataFrame:
    """Per-site form, keeping the parts: balance, order and transaction at the site itself,
    invoices of the whole record, and no excluding document anywhere at the record."""
    whole = parts.select(*RECORD, "n_invoice_2y", "n_excluding")
    record = roll_up(whole, RECORD).withColumnsRenamed(
        {"n_invoice_2y": "record_invoices", "n_excluding": "record_excluding"})
    return (parts.join(record, RECORD)
            .where("record_excluding = 0 AND (sum_open_balance > 0 OR n_order_any_2y > 0 "
                   "OR (record_invoices > 1 AND n_recent_2y > 0))")
            .drop("record_invoices", "record_excluding"))


def qualified_sites(parts: DataFrame) -> DataFrame:
    return qualified_site_parts(parts).select(*SITE)
