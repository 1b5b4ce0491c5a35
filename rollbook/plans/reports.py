"""The six party reports. Each takes the tables and the parameters and returns a DataFrame with
plain column names (``layouts.display_names`` maps them to the display names).

Every report reads the documents once, also where it needs them at two grains
(``metrics.at_two_grains``). Reports accept ``parts`` that were computed before (``plans.shared``, ``plans.days``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook import params as P
from rollbook.functions import labels
from rollbook.functions.windows import one_of
from rollbook.operators import filters, joins, metrics, sets, tags
from rollbook.operators.lookup import lookup, multiply, repeat_rows
from rollbook.params import Params
from rollbook.plans.layouts import LAYOUTS, arrange
from rollbook.schema import RECORD, SITE

Tables = Mapping[str, DataFrame]


def supplier_parts(t: Tables, p: Params) -> DataFrame:
    return metrics.site_parts(t["document"], p, p.supplier)


def customer_parts(t: Tables, p: Params) -> DataFrame:
    return metrics.site_parts(t["document"], p, p.customer)


def report_parts(t: Tables, p: Params, side: str) -> DataFrame:
    """Parts of one side as far as reports need them: documents of other origins meet no base party,
    so they are left out at the scan."""
    doc = t["document"].where(one_of("origin", p.origins))
    return metrics.site_parts(doc, p, getattr(p, side))


def supplier_base(t: Tables, p: Params) -> DataFrame:
    return filters.base_parties(t["party"], t["party_class"], p, p.supplier)


def customer_base(t: Tables, p: Params) -> DataFrame:
    return filters.base_parties(t["party"], t["party_class"], p, p.customer)


def _fused(base: DataFrame, by_tax_id: DataFrame, party: DataFrame) -> DataFrame:
    """The chosen record of each tax id in ``by_tax_id``, with its full party columns."""
    keys = sets.dedupe_by_tax_id(base.select("tax_id", *RECORD))
    return party.join(keys.join(by_tax_id, "tax_id"), ["tax_id", *RECORD])


def _at_first_site(df: DataFrame, t: Tables) -> DataFrame:
    return df.join(joins.site_columns(joins.first_active_site(t["site"])), RECORD)


def _supplier_header_columns(df: DataFrame, t: Tables) -> DataFrame:
    df = _at_first_site(df, t)
    df = joins.origin_lookup(df, t["origin"])
    df = joins.party_param(df, t["party_param"], P.PARAM_SIC, "sic")
    df = joins.party_param(df, t["party_param"], P.PARAM_TAX_REGISTRATION, "tax_registration",
                           origin=P.HOME_ORIGIN)
    df = joins.geo_lookup(df, t, origin="origin_found", district_via="country")
    df = joins.id_type(df, t["id_type"], origin=P.HOME_ORIGIN)
    df = joins.contact_person(df, t["contact_person"])
    df = joins.contact_lookup(df, t["contact_point"], {"email": P.EMAIL, "url": P.URL},
                              origin="origin_found")
    return labels.supplier_source_tag(labels.contact_full_name(df))


def supplier_header(t: Tables, p: Params, parts: DataFrame | None = None) -> DataFrame:
    """One row per qualified tax id (times look-up fan-out), described by its chosen record."""
    parts = report_parts(t, p, "supplier") if parts is None else parts
    base = supplier_base(t, p)
    by_tax_id = metrics.roll_up(metrics.base_record_parts(parts, t["site"], base), ["tax_id"])
    values = metrics.all_supplier_columns(
        by_tax_id.where(filters.supplier_rule()), ["tax_id"], p)
    df = _supplier_header_columns(_fused(base, values, t["party"]), t)
    return arrange(repeat_rows(df), LAYOUTS["supplier_header"])


def supplier_header_by_record(t: Tables, p: Params, parts: DataFrame | None = None) -> DataFrame:
    """One row per qualified party record; purchase orders need not be open. The account and the
    own-origin identification type select nothing but multiply rows."""
    parts = report_parts(t, p, "supplier") if parts is None else parts
    by_record = metrics.record_parts(parts, t["site"])
    values = metrics.all_supplier_columns(
        by_record.where(filters.supplier_rule(open_orders=False)), RECORD, p, open_orders=False)
    df = _supplier_header_columns(supplier_base(t, p).join(values, RECORD), t)
    df = multiply(df, t["id_type"], joins.ID_TYPE_KEY)
    df = multiply(df, t["account"], joins.ACCOUNT_KEY)
    return arrange(repeat_rows(df), LAYOUTS["supplier_header_by_record"])


def _supplier_site_columns(df: DataFrame, t: Tables) -> DataFrame:
    """Look-ups of a site row. Identification type, SIC parameter and account select nothing but
    multiply rows; the count is carried and rows are repeated at the end."""
    df = multiply(df, t["id_type"], joins.ID_TYPE_KEY)
    df = multiply(df, joins.param_rows(t["party_param"], P.PARAM_SIC), {"party": "party"})
    df = multiply(df, t["account"], joins.ACCOUNT_KEY)
    df = joins.origin_lookup(df, t["origin"])
    df = joins.geo_lookup(df, t)
    df = joins.contact_lookup(df, t["contact_point"], {"phone": P.PHONE, "email": P.EMAIL},
                              origin="origin_found")
    df = labels.org_name(df, "origin_found")
    return labels.supplier_source_tag(labels.site_identifier(df))


def supplier_site(t: Tables, p: Params, parts: DataFrame | None = None) -> DataFrame:
    """One row per site with a non-zero metric, of tax ids that pass the header rule; ordered."""
    parts = metrics.at_two_grains(report_parts(t, p, "supplier")) if parts is None else parts
    base = supplier_base(t, p)
    qualified = filters.qualified_suppliers(metrics.base_record_parts(parts, t["site"], base))
    values = filters.nonzero_metrics(
        metrics.all_supplier_columns(parts, SITE, p),
        metrics.AMOUNTS_AND_COUNTS["supplier"][:3], metrics.AMOUNTS_AND_COUNTS["supplier"][3:])
    # Sites without a metric are dropped in any case, so the metric join is an inner one.
    df = (base.join(qualified, "tax_id").join(joins.site_columns(t["site"]), RECORD)
          .join(values, SITE))
    df = filters.site_keep(df, "ne", balance="trx_op_bal_chf")
    df = _supplier_site_columns(df, t)
    df = lookup(df, tags.site_tag_texts(t["site_tag"], t["tag_type"]), joins.SITE_KEY,
                {"site_codes": "site_codes", "po_usage": "po_usage"})
    return arrange(repeat_rows(sets.order_sites(df, "origin")), LAYOUTS["supplier_site"])


def supplier_site_self_qualified(t: Tables, p: Params, parts: DataFrame | None = None) -> DataFrame:
    """One row per site and site tag, for sites that pass the rule themselves; ordered by party."""
    parts = metrics.at_two_grains(report_parts(t, p, "supplier")) if parts is None else parts
    values = metrics.all_supplier_columns(
        filters.qualified_site_parts(parts), SITE, p, open_orders=False)
    df = (supplier_base(t, p).join(joins.site_columns(t["site"]), RECORD).join(values, SITE))
    df = filters.site_keep(df, "gt", balance="trx_op_bal_chf")
    df = joins.site_tags_counted(df, t["site_tag"], t["tag_type"])
    df = labels.po_usage_label(df).withColumnRenamed("tag_name", "site_codes")
    df = _supplier_site_columns(df, t)
    df = sets.order_by_party(df, "origin", "tag_group", "tag_code", "tax_id")
    return arrange(repeat_rows(df), LAYOUTS["supplier_site_self_qualified"])


def _customer_columns(df: DataFrame, t: Tables, district_via: str) -> DataFrame:
    df = joins.id_type(df, t["id_type"], how="inner")
    df = joins.origin_lookup(df, t["origin"], how="inner")
    df = joins.party_param(df, t["party_param"], P.PARAM_SIC, "sic")
    df = joins.geo_lookup(df, t, district_via=district_via)
    df = joins.contact_lookup(df, t["contact_point"], {"phone": P.PHONE, "email": P.EMAIL})
    df = joins.accounts(df, t["account"])
    df = labels.customer_source_tag(labels.customer_totals(df))
    return labels.site_identifier(labels.party_status(df))


def customer_header(t: Tables, p: Params, parts: DataFrame | None = None) -> DataFrame:
    """One row per qualified tax id and account, described by its chosen record."""
    parts = report_parts(t, p, "customer") if parts is None else parts
    base = customer_base(t, p)
    values = metrics.customer_metrics(
        metrics.base_record_parts(parts, t["site"], base), ["tax_id"], p)
    quotes = filters.quoted(base, t["quote"], p).withColumn("quoted", F.lit(True))
    keys = sets.dedupe_by_tax_id(base.select("tax_id", *RECORD))
    keys = metrics.attach_metrics(keys, values, ["tax_id"]).join(quotes, "tax_id", "left")
    keys = keys.where("open_balance > 0 OR has_trx_5y OR quoted")
    df = _at_first_site(t["party"].join(keys, ["tax_id", *RECORD]), t)
    df = labels.business_model(_customer_columns(df, t, district_via="country"),
                               p.government_patterns)
    return arrange(repeat_rows(df), LAYOUTS["customer_header"])


def customer_site(t: Tables, p: Params, parts: DataFrame | None = None) -> DataFrame:
    """One row per site with a non-zero metric (times accounts) of qualified tax ids; ordered."""
    parts = metrics.at_two_grains(report_parts(t, p, "customer")) if parts is None else parts
    base = customer_base(t, p)
    valid_parts = metrics.in_valid_sites(parts, t["site"])
    qualified = filters.qualified_customers(
        metrics.roll_up(valid_parts, RECORD).join(base.select(*RECORD, "tax_id"), RECORD),
        filters.quoted(base, t["quote"], p))
    values = filters.nonzero_metrics(
        metrics.customer_metrics(valid_parts, SITE, p),
        metrics.AMOUNTS_AND_COUNTS["customer"][:3], metrics.AMOUNTS_AND_COUNTS["customer"][3:])
    df = (base.join(qualified, "tax_id").join(joins.site_columns(t["site"]), RECORD)
          .join(values, SITE))
    df = filters.site_keep(df, "gt")
    df = labels.org_name(_customer_columns(df, t, district_via="site"), "origin")
    df = sets.order_sites(df, "origin", "sic", "account_number", "account_type", "account_status")
    return arrange(repeat_rows(df), LAYOUTS["customer_site"])


REPORTS = {
    "supplier_header": supplier_header,
    "supplier_header_by_record": supplier_header_by_record,
    "supplier_site": supplier_site,
    "supplier_site_self_qualified": supplier_site_self_qualified,
    "customer_header": customer_header,
    "customer_site": customer_site,
}
SIDE = {name: name.partition("_")[0] for name in REPORTS}
