"""Semi and anti joins on documents, and look-ups of addresses, contacts and codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollbook import params as P
from rollbook.functions.windows import one_of, since
from rollbook.operators.lookup import lookup, repeat_rows, spread_lookup
from rollbook.params import Params
from rollbook.schema import RECORD, SITE

Tables = Mapping[str, DataFrame]


# --- documents -----------------------------------------------------------------------------------

def _live(doc: DataFrame, types: Sequence[str]) -> DataFrame:
    return doc.where(one_of("type", types)).where("status != '0'")


def open_document_sites(doc: DataFrame, types: Sequence[str]) -> DataFrame:
    """Distinct sites with an open, non-void document; distinct before any join, against hot sites."""
    return _live(doc, types).where("balance > 0").select(*SITE).distinct()


def sites_with_open_documents(site: DataFrame, doc: DataFrame, types: Sequence[str]) -> DataFrame:
    return site.join(open_document_sites(doc, types), SITE, "left_semi")


def documents_in_valid_sites(doc: DataFrame, valid: DataFrame) -> DataFrame:
    return doc.join(valid, SITE, "left_semi")


def party_documents(base: DataFrame, doc: DataFrame, valid: DataFrame) -> DataFrame:
    """Documents of base parties at valid sites, once per base row.

    Base and valid sites are joined first, so documents are shuffled once, by site.
    """
    wanted = base.select(*RECORD, "tax_id").join(valid, RECORD)
    return doc.join(wanted, SITE)


def has_document_since(doc: DataFrame, keys: Sequence[str], types: Sequence[str], p: Params,
                       years: int = 2, open_only: bool = False) -> DataFrame:
    """Distinct keys with a non-void document of these types in the last ``years`` years."""
    found = _live(doc, types).where(since("created", p.as_of, years))
    return (found.where("balance > 0") if open_only else found).select(*keys).distinct()


def excluding_records(doc: DataFrame, types: Sequence[str],
                      valid: DataFrame | None = None) -> DataFrame:
    """Distinct records with a non-void document of these types, at valid sites or anywhere."""
    sites = _live(doc, types).select(*SITE).distinct()
    return (sites if valid is None else sites.join(valid, SITE, "left_semi")).select(*RECORD).distinct()


def exclude_by_record(df: DataFrame, doc: DataFrame, types: Sequence[str],
                      valid: DataFrame | None = None) -> DataFrame:
    return df.join(excluding_records(doc, types, valid), RECORD, "left_anti")


def excluded_tax_ids(base: DataFrame, doc: DataFrame, types: Sequence[str],
                     valid: DataFrame | None = None) -> DataFrame:
    records = excluding_records(doc, types, valid)
    return base.select(*RECORD, "tax_id").join(records, RECORD).select("tax_id").distinct()


def exclude_by_tax_id(df: DataFrame, excluded: DataFrame) -> DataFrame:
    return df.join(excluded, "tax_id", "left_anti")


def exists_or_rule(base: DataFrame, metrics: DataFrame, flags: DataFrame) -> DataFrame:
    """Tax ids with a positive open balance or a row in ``flags``: EXISTS combined by OR.

    Both sides hold one row per tax id, and the flag side is a set, so the left join adds no rows.
    """
    marked = flags.select("tax_id").distinct().withColumn("found", F.lit(True))
    ids = base.select("tax_id").distinct()
    return (ids.join(metrics.select("tax_id", "open_balance"), "tax_id", "left")
            .join(marked, "tax_id", "left")
            .where("coalesce(open_balance, 0) > 0 OR found")
            .select("tax_id"))


# --- parties and sites ---------------------------------------------------------------------------

def chosen_record(base: DataFrame, party: DataFrame) -> DataFrame:
    """From the chosen (tax id, origin, party) back to the full party rows."""
    return party.join(base.select("tax_id", *RECORD), ["tax_id", *RECORD])


def first_active_site(site: DataFrame) -> DataFrame:
    """The active site with the smallest code of each record; records with none are absent.

    ``rank = 1`` is also applied before the shuffle, so a record with many sites sends one row per
    partition. Equal site codes are told apart by the remaining columns.
    """
    order = Window.partitionBy(*RECORD).orderBy(
        "site", "name", "address", "country", "state", "province", "district")
    return (site.where("status = '1'").withColumn("rank", F.row_number().over(order))
            .where("rank = 1").drop("rank"))


def site_columns(site: DataFrame) -> DataFrame:
    """Site rows under names that do not clash with party columns."""
    return site.selectExpr(
        *SITE, "status AS site_status", "name AS site_name", "address", "country AS country_code",
        "state AS state_code", "province AS province_code", "district AS district_code")


# --- look-ups ------------------------------------------------------------------------------------

def origin_lookup(df: DataFrame, origin: DataFrame, how: str = "left") -> DataFrame:
    """Adds ``origin_found`` (NULL without a row) and ``origin_country``."""
    return lookup(df, origin, {"origin": "origin"},
                  {"origin_found": "origin", "origin_country": "country"}, how)


def geo_lookup(df: DataFrame, t: Tables, origin: str = "origin",
               district_via: str = "site", state_origin: str | None = None) -> DataFrame:
    """Country, district, active state and province names, all by left joins.

    ``district_via='country'`` takes the district's country from the matched country row, so an
    unknown country has no district. A province needs a matched active state.
    """
    state_origin = state_origin or origin
    df = lookup(df, t["country"], {"country_code": "country"},
                {"country_found": "country", "country_name": "name"})
    via = "country_found" if district_via == "country" else "country_code"
    df = lookup(df, t["district"],
                {"district_code": "district", via: "country", "state_code": "state",
                 "province_code": "province", origin: "origin"},
                {"district_name": "name", "postal_code": "postal_code"})
    df = lookup(df, t["state"].where("status = '1'"),
                {"state_code": "state", state_origin: "origin", "country_code": "country"},
                {"state_found": "state", "state_name": "name"})
    df = lookup(df, t["province"],
                {"province_code": "province", origin: "origin", "country_code": "country",
                 "state_found": "state"}, {"province_name": "name"})
    return df.drop("country_found", "state_found")


def param_rows(params: DataFrame, code: str, origin: str | None = None) -> DataFrame:
    rows = params.where(one_of("code", [code]))
    return rows if origin is None else rows.where(one_of("origin", [origin]))


def party_param(df: DataFrame, params: DataFrame, code: str, new: str,
                origin: str | None = None) -> DataFrame:
    """Party parameter by party code; ``origin`` fixes the parameter's origin.

    This and the next look-ups may match several rows; the result carries ``copies``.
    """
    return spread_lookup(df, param_rows(params, code, origin), {"party": "party"}, {new: "value"})


ID_TYPE_KEY = {"id_type_code": "id_type_code", "origin": "origin"}


def id_type(df: DataFrame, types: DataFrame, how: str = "left", origin: str | None = None,
            new: str = "id_type_name") -> DataFrame:
    """Identification type by code, of the row's own origin or of a fixed one."""
    if origin is None:
        return lookup(df, types, ID_TYPE_KEY, {new: "name"}, how)
    return lookup(df, types.where(one_of("origin", [origin])), {"id_type_code": "id_type_code"},
                  {new: "name"}, how)


ACCOUNT_KEY = {"party": "party", "origin": "origin"}


def accounts(df: DataFrame, account: DataFrame) -> DataFrame:
    """Accounts of the record; several multiply rows."""
    return spread_lookup(df, account, ACCOUNT_KEY, {
        "account_number": "number", "account_type": "type", "account_status": "status"})


def contact_person(df: DataFrame, people: DataFrame, role: str = P.CONTACT_ROLE) -> DataFrame:
    """Contacts with the role, by party and site but not origin."""
    return spread_lookup(df, people.where(one_of("role", [role])),
                         {"party": "party", "site": "site"},
                         {"first_name": "first_name", "last_name": "last_name"})


SITE_KEY = {"origin": "origin", "party": "party", "site": "site"}


def _tag_names(df: DataFrame, tag_type: DataFrame) -> DataFrame:
    return lookup(df, tag_type.where(one_of("tag_group", [P.SITE_CODE_GROUP])),
                  {"tag_group": "tag_group", "tag_code": "tag_code", "origin": "origin"},
                  {"tag_name": "name"})


def site_tags_exploded(df: DataFrame, site_tag: DataFrame, tag_type: DataFrame) -> DataFrame:
    """One row per site tag, with the description of tags in the site-code group; keeps sites
    without tags."""
    return repeat_rows(site_tags_counted(df, site_tag, tag_type))


def site_tags_counted(df: DataFrame, site_tag: DataFrame, tag_type: DataFrame) -> DataFrame:
    """The same with equal tags of a site counted in ``copies``."""
    return _tag_names(spread_lookup(
        df, site_tag, SITE_KEY, {"tag_group": "tag_group", "tag_code": "tag_code"}), tag_type)


def first_contact(contact_point: DataFrame, types: Mapping[str, int]) -> DataFrame:
    """Per site and wanted ``{column: type}``, the number with the smallest code among active ones.

    All types come from one pass; the minimum is taken before the shuffle as well.
    """
    first = "min(CASE WHEN type = {} THEN struct(code, number) END).number AS {}"
    return (contact_point.where("status = '1'").where(one_of("type", types.values()))
            .groupBy(*SITE).agg(*[F.expr(first.format(k, n)) for n, k in types.items()]))


def contact_lookup(df: DataFrame, contact_point: DataFrame, types: Mapping[str, int],
                   origin: str = "origin") -> DataFrame:
    return lookup(df, first_contact(contact_point, types),
                  {origin: "origin", "party": "party", "site": "site"}, {n: n for n in types})
