"""Row-level projections: labels, names and codes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook import params as P
from rollbook.functions.windows import one_of, quoted_text


def _case(column: str, labels: Mapping[str, str]) -> Column:
    pairs = " ".join(f"WHEN {quoted_text(c)} THEN {quoted_text(v)}" for c, v in labels.items())
    return F.expr(f"CASE {column} {pairs} END")


def business_model(df: DataFrame, patterns: Sequence[str] = P.GOVERNMENT_NAME_PATTERNS) -> DataFrame:
    """Government if the upper-case name matches a pattern, otherwise by identification type."""
    listed = ", ".join(quoted_text(x) for x in patterns)
    return df.withColumn("business_model", F.expr(
        f"CASE WHEN upper(name) LIKE ANY ({listed}) THEN '{P.B2G}' "
        f"WHEN {one_of('id_type_code', P.B2C_ID_TYPES)} THEN '{P.B2C}' ELSE '{P.B2B}' END"))


def party_status(df: DataFrame) -> DataFrame:
    return df.withColumn("party_status", _case("status", P.STATUS_LABELS))


def org_name(df: DataFrame, origin: str = "origin") -> DataFrame:
    return df.withColumn("org_name", F.expr(
        f"if({origin} = '{P.HOME_ORIGIN}', '{P.HOME_ORG_NAME}', {origin})"))


def site_identifier(df: DataFrame) -> DataFrame:
    return df.withColumn("site_identifier", F.expr(
        "concat(rtrim(coalesce(party, '')), coalesce(site, ''))"))


def contact_full_name(df: DataFrame) -> DataFrame:
    """Both parts joined without a blank; empty text when there is no contact."""
    return df.withColumn("contact_name", F.expr(
        "concat(coalesce(first_name, ''), coalesce(last_name, ''))"))


def supplier_source_tag(df: DataFrame) -> DataFrame:
    return df.withColumn("source_tag", F.expr(
        "CASE WHEN has_inv_op_old THEN 'INV_OP' WHEN has_inv_1y THEN 'INV_1Y' "
        "WHEN has_inv_2y THEN 'INV_2Y' WHEN has_po_2y THEN 'POH_OP' ELSE 'NO_TRX_AT_ALL' END"))


def customer_source_tag(df: DataFrame) -> DataFrame:
    return df.withColumn("source_tag", F.expr(
        "CASE WHEN has_op_trx THEN 'OP_TRX' WHEN has_trx_02y THEN 'TRX_02Y' "
        "WHEN has_trx_5y THEN 'TRX_2Y5' ELSE 'PAY_SCHE_NO_TRX' END"))


def customer_totals(df: DataFrame) -> DataFrame:
    def total(*names: str) -> Column:
        return F.expr(" + ".join(f"coalesce({n}, 0)" for n in names))

    return df.withColumns({
        "tot_trx_0y5_op_amount_chf": total(
            "tot_trx_0y2_amount_chf", "tot_trx_2y5_amount_chf", "tot_trx_op_amount_chf"),
        "doc_trx_0y5_op_count": total(
            "doc_trx_0y2_count", "doc_trx_2y5_count", "doc_trx_op_count"),
    })


def po_usage_label(df: DataFrame) -> DataFrame:
    return df.withColumn("po_usage", _case("tag_code", P.USAGE_BY_TAG))


def blank_columns(df: DataFrame, names: Sequence[str], value: str = "") -> DataFrame:
    return df.withColumns({n: F.lit(value) for n in names})


def rename_columns(df: DataFrame, mapping: Mapping[str, str] | None) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping)) if mapping else df


def post_transform(df: DataFrame, hook: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Caller's own step on a finished report, before renaming."""
    return df.transform(hook) if hook else df
