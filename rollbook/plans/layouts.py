"""Output columns of the reports, in order: display name and the column it is taken from.

An empty source is a blank text column, ``'1'`` a constant.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

Layout = list[tuple[str, str]]
BLANK = "''"

# Display names and their order.
SUPPLIER_HEADER: Layout = [
    ("VENDOR_NAME (M)", "name"),
    ("VENDOR_NUM (M)", "tax_id"),
    ("VENDOR_ID (M)", "party"),
    ("VENDOR_NAME_ALT (M)", "short_name"),
    ("SIC", "sic"),
    ("EMPLOYEE_ID", ""),
    ("VENDOR_TYPE_LOOKUP_CODE (M)", ""),
    ("CEO_TITLE", ""),
    ("CEO_NAME", "contact_name"),
    ("PRINCIPAL_TITLE", ""),
    ("PRINCIPAL_NAME", ""),
    ("TAX_REGISTRATION_NUM (M)", "tax_id"),
    ("TAXPAYER_ID (M)", "tax_id"),
    ("REMITTANCE_EMAIL", "email"),
    ("DEFAULT_REP_COUNTRY_CODE", "origin_country"),
    ("DEFAULT_REP_REG_NUMBER", "tax_id"),
    ("DEFAULT_REP_TAX_REG_TYPE", "tax_registration"),
    ("PARENT_PARTY_ID", ""),
    ("PARENT_VENDOR_ID", ""),
    ("PARTY_ALIAS", "short_name"),
    ("URL", "url"),
    ("PARTY_ID (M)", "party"),
    ("REGISTRY_ID (M)", "tax_id"),
    ("PARTY_NAME (M)", "name"),
    ("PARTY_TYPE (M)", "id_type_name"),
    ("TAX_NAME", ""),
    ("COUNTRY (M)", "country_name"),
    ("ADDRESS1 (M)", "address"),
    ("ADDRESS2", ""),
    ("ADDRESS3", ""),
    ("ADDRESS4", ""),
    ("CITY (M)", "district_name"),
    ("POSTAL_CODE (M)", "postal_code"),
    ("STATE", "state_name"),
    ("PROVINCE", "province_name"),
    ("TRX_1Y_AMOUNT_CHF (M)", "trx_1y_amount_chf"),
    ("TRX_2Y_AMOUNT_CHF (M)", "trx_2y_amount_chf"),
    ("TRX_OP_BAL_CHF (M)", "trx_op_bal_chf"),
    ("TRX_1Y_COUNT (M)", "trx_1y_count"),
    ("TRX_2Y_COUNT (M)", "trx_2y_count"),
    ("TRX_OP_COUNT (M)", "trx_op_count"),
    ("MIN_TRX_DATE (M)", "min_trx_date"),
    ("MAX_TRX_DATE (M)", "max_trx_date"),
    ("MIN_TRX_YEAR (M)", "min_trx_year"),
    ("MAX_TRX_YEAR (M)", "max_trx_year"),
    ("VENDOR_CREATION_DATE (M)", "created"),
    ("SUPPLIER_TRX_SOURCE_LIST (M)", "source_tag"),
    ("PO_1Y_OP_COUNT (M)", "po_1y_op_count"),
    ("PO_2Y_OP_COUNT (M)", "po_2y_op_count"),
    ("PO_OP_COUNT (M)", "po_op_count"),
    ("MIN_PO_DATE (M)", "min_po_date"),
    ("MAX_PO_DATE (M)", "max_po_date"),
    ("PO_Agreement_COUNT (M)", "po_agreement_count"),
]
SUPPLIER_SITE: Layout = [
    ("ORG_NAME (M)", "org_name"),
    ("ORGANIZATION_ID (M)", ""),
    ("BUSINESS_GROUP_ID (M)", ""),
    ("VENDOR_NAME (M)", "name"),
    ("VENDOR_NUM (M)", "tax_id"),
    ("VENDOR_SITE_CODE (M)", "site_codes"),
    ("VENDOR_CREATION_DATE (M)", "created"),
    ("VENDOR_SITE_CREATION_DATE (M)", ""),
    ("ADDRESS_STYLE (M)", ""),
    ("LANGUAGE", ""),
    ("PROVINCE", "province_name"),
    ("COUNTRY (M)", "country_name"),
    ("AREA_CODE", ""),
    ("PHONE", "phone"),
    ("EMAIL_ADDRESS", "email"),
    ("CUSTOMER_NUM", ""),
    ("VENDOR_SITE_CODE_ALT", ""),
    ("ADDRESS_LINE1 (M)", "address"),
    ("ADDRESS_LINE2", ""),
    ("ADDRESS_LINE3", ""),
    ("ADDRESS_LINES_ALT", ""),
    ("CITY", "district_name"),
    ("STATE", "state_name"),
    ("ZIP", "postal_code"),
    ("ADDRESS_LINE4", ""),
    ("VAT_REGISTRATION_NUM", ""),
    ("VAT_CODE", ""),
    ("DEFAULT_REP_COUNTRY_CODE", "origin_country"),
    ("DEFAULT_REP_REG_NUMBER", "tax_id"),
    ("DEFAULT_REP_TAX_REG_TYPE", ""),
    ("PARTY_SITE_ID (M)", ""),
    ("PARTY_ID (M)", ""),
    ("VENDOR_ID (M)", "party"),
    ("VENDOR_SITE_ID (M)", "site_identifier"),
    ("LOCATION_ID (M)", "site"),
    ("VENDOR_SITE_ID_2 (M)", "site_identifier"),
    ("ADDRESS_NAME (M)", ""),
    ("ADDRESSEE", ""),
    ("TRX_1Y_AMOUNT_CHF (M)", "trx_1y_amount_chf"),
    ("TRX_2Y_AMOUNT_CHF (M)", "trx_2y_amount_chf"),
    ("TRX_OP_BAL_CHF (M)", "trx_op_bal_chf"),
    ("TRX_1Y_COUNT (M)", "trx_1y_count"),
    ("TRX_2Y_COUNT (M)", "trx_2y_count"),
    ("TRX_OP_COUNT (M)", "trx_op_count"),
    ("MIN_TRX_DATE (M)", "min_trx_date"),
    ("MAX_TRX_DATE (M)", "max_trx_date"),
    ("MIN_TRX_YEAR (M)", "min_trx_year"),
    ("MAX_TRX_YEAR (M)", "max_trx_year"),
    ("SUPPLIER_TRX_SOURCE_LIST (M)", "source_tag"),
    ("PO_2Y_OP_COUNT (M)", "po_2y_op_count"),
    ("PO_1Y_OP_COUNT (M)", "po_1y_op_count"),
    ("PO_OP_COUNT (M)", "po_op_count"),
    ("MIN_PO_DATE (M)", "min_po_date"),
    ("MAX_PO_DATE (M)", "max_po_date"),
    ("PO_Agreement_COUNT (M)", "po_agreement_count"),
    ("PO_Usage", "po_usage"),
]
CUSTOMER_HEADER: Layout = [
    ("Business Model (B2X)", "business_model"),
    ("PARTY_NAME (M)", "name"),
    ("PARTY_STATUS", "party_status"),
    ("PARTY_ID (M)", "account_number"),
    ("REGISTRY_ID", "tax_id"),
    ("KNOWN_AS", "short_name"),
    ("NAME_PRONUNCIATION", "name"),
    ("TRANSLATED_CUSTOMER_NAME", "name"),
    ("SIC_CODE", "sic"),
    ("DEFAULT_REP_COUNTRY_CODE (M)", "origin_country"),
    ("DEFAULT_REP_REG_NUMBER (M)", "tax_id"),
    ("DEFAULT_REP_TAX_REG_TYPE (M)", "id_type_name"),
    ("PARENT_COMPANY", ""),
    ("TAXPAYER_ID (M)", "tax_id"),
    ("PARTY_SITE_STATUS", "'1'"),
    ("TAX_REGISTRATION_NUMBER (M)", "tax_id"),
    ("ACCOUNT_NUMBER (M)", "account_number"),
    ("PARTY_SITE_NAME", "site_name"),
    ("ACCOUNT_DESCRIPTION", "account_type"),
    ("CUST_ACCOUNT_ID", "account_number"),
    ("ACCOUNT_STATUS (M)", "account_status"),
    ("PARTY_SITE_NUMBER", "site"),
    ("PARTY_SITE_ID", "site_identifier"),
    ("CUST_ACCT_SITE_ID (M)", ""),
    ("COUNTRY (M)", "country_name"),
    ("ADDRESS1 (M)", "address"),
    ("ADDRESS2", ""),
    ("ADDRESS3", ""),
    ("ADDRESS4", ""),
    ("CITY (M)", "district_name"),
    ("POSTAL_CODE (M)", "postal_code"),
    ("STATE (M)", "state_name"),
    ("PROVINCE (M)", "province_name"),
    ("COUNTY (M)", "district_name"),
    ("ADDRESSEE", "address"),
    ("STATUS (M)", "site_status"),
    ("ACCOUNT_SITE_PHONE_NUMBER", "phone"),
    ("ACCOUNT_SITE_EMAIL", "email"),
    ("TOT_TRX_0Y2_AMOUNT_CHF (M)", "tot_trx_0y2_amount_chf"),
    ("TOT_TRX_2Y5_AMOUNT_CHF (M)", "tot_trx_2y5_amount_chf"),
    ("TOT_TRX_OP_AMOUNT_CHF (M)", "tot_trx_op_amount_chf"),
    ("TOT_TRX_0Y5_OP_AMOUNT_CHF (M)", "tot_trx_0y5_op_amount_chf"),
    ("DOC_TRX_0Y2_COUNT (M)", "doc_trx_0y2_count"),
    ("DOC_TRX_2Y5_COUNT (M)", "doc_trx_2y5_count"),
    ("DOC_TRX_OP_COUNT (M)", "doc_trx_op_count"),
    ("DOC_TRX_0Y5_OP_COUNT (M)", "doc_trx_0y5_op_count"),
    ("MIN_TRX_DATE (M)", "min_trx_date"),
    ("MAX_TRX_DATE (M)", "max_trx_date"),
    ("MIN_TRX_YEAR (M)", "min_trx_year"),
    ("MAX_TRX_YEAR (M)", "max_trx_year"),
    ("CUSTOMER_TRX_SOURCE_LIST (M)", "source_tag"),
]
CUSTOMER_SITE: Layout = [
    ("ORG_NAME (M)", "org_name"),
    ("PARTY_NAME (M)", "name"),
    ("PARTY_STATUS", "party_status"),
    ("PARTY_ID (M)", "account_number"),
    ("REGISTRY_ID", "tax_id"),
    ("SIC_CODE", "sic"),
    ("DEFAULT_REP_COUNTRY_CODE (M)", "origin_country"),
    ("DEFAULT_REP_REG_NUMBER (M)", "tax_id"),
    ("DEFAULT_REP_TAX_REG_TYPE (M)", "id_type_name"),
    ("TAXPAYER_ID (M)", "tax_id"),
    ("TAX_REGISTRATION_NUMBER (M)", "tax_id"),
    ("ACCOUNT_NUMBER (M)", "account_number"),
    ("PARTY_SITE_NAME", "site_name"),
    ("ACCOUNT_DESCRIPTION", "account_type"),
    ("CUST_ACCOUNT_ID", "account_number"),
    ("ACCOUNT_STATUS (M)", "account_status"),
    ("PARTY_SITE_NUMBER", "site"),
    ("PARTY_SITE_ID", "site_identifier"),
    ("COUNTRY (M)", "country_name"),
    ("ADDRESS1 (M)", "address"),
    ("CITY (M)", "district_name"),
    ("POSTAL_CODE (M)", "postal_code"),
    ("STATE (M)", "state_name"),
    ("PROVINCE (M)", "province_name"),
    ("COUNTY (M)", "district_name"),
    ("STATUS (M)", "site_status"),
    ("ACCOUNT_SITE_PHONE_NUMBER", "phone"),
    ("ACCOUNT_SITE_EMAIL", "email"),
    ("TOT_TRX_0Y2_AMOUNT_CHF (M)", "tot_trx_0y2_amount_chf"),
    ("TOT_TRX_2Y5_AMOUNT_CHF (M)", "tot_trx_2y5_amount_chf"),
    ("TOT_TRX_OP_AMOUNT_CHF (M)", "tot_trx_op_amount_chf"),
    ("TOT_TRX_0Y5_OP_AMOUNT_CHF (M)", "tot_trx_0y5_op_amount_chf"),
    ("DOC_TRX_0Y2_COUNT (M)", "doc_trx_0y2_count"),
    ("DOC_TRX_2Y5_COUNT (M)", "doc_trx_2y5_count"),
    ("DOC_TRX_OP_COUNT (M)", "doc_trx_op_count"),
    ("DOC_TRX_0Y5_OP_COUNT (M)", "doc_trx_0y5_op_count"),
    ("MIN_TRX_DATE (M)", "min_trx_date"),
    ("MAX_TRX_DATE (M)", "max_trx_date"),
    ("MIN_TRX_YEAR (M)", "min_trx_year"),
    ("MAX_TRX_YEAR (M)", "max_trx_year"),
    ("CUSTOMER_TRX_SOURCE_LIST (M)", "source_tag"),
]

LAYOUTS: dict[str, Layout] = {
    "supplier_header": SUPPLIER_HEADER,
    "supplier_header_by_record": SUPPLIER_HEADER,
    "supplier_site": SUPPLIER_SITE,
    "supplier_site_self_qualified": SUPPLIER_SITE,
    "customer_header": CUSTOMER_HEADER,
    "customer_site": CUSTOMER_SITE,
}


def plain_name(display: str) -> str:
    """``'VENDOR_NAME (M)'`` → ``'vendor_name'``: the name used until export."""
    return re.sub(r"\W+", "_", display.removesuffix(" (M)")).strip("_").lower()


def arrange(df: DataFrame, layout: Layout) -> DataFrame:
    """Select the layout's columns in order, under plain names."""
    return df.selectExpr(*[f"{source or BLANK} AS {plain_name(display)}"
                           for display, source in layout])


def display_names(layout: Layout) -> dict[str, str]:
    """Mapping for ``rename_columns`` at export."""
    return {plain_name(display): display for display, _ in layout}
