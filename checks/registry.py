"""Every operator and report as a named query on the stand-in tables, with its expected SQL."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracle as O
from rollbook import standins
from rollbook.functions import labels
from rollbook.operators import filters, joins, metrics, sets, tags
from rollbook.operators.lookup import repeat_rows
from rollbook.params import EMAIL, HOME_ORIGIN, PARAM_SIC, PARAM_TAX_REGISTRATION, PHONE, URL, Params
from rollbook.plans import reports
from rollbook.plans.batch import WORKERS, report_batch
from rollbook.plans.days import parts_from_days, write_day_rollup
from rollbook.plans.layouts import LAYOUTS, display_names
from rollbook.plans.shared import new_path
from rollbook.schema import PADDED, RECORD, SITE, TABLES, TIME
from rollbook.sinks.files import column_width_profile, export_report, read_export
from rollbook.sources.tables import load_tables, quantile_cuts, tag_cuts, tag_pieces

Query = Callable[[SparkSession, str], DataFrame]
Step = Callable[[dict[str, DataFrame], Params], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str


ENTRIES: dict[str, Entry] = {}


def _add(name: str, role: str, step: Step, body: str) -> None:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return step(standins.tables(spark, folder, role), standins.params())

    ENTRIES[name] = Entry(run, O.sql(role, body))


def supplier(name: str, step: Step, body: str) -> None:
    _add(name, "supplier", step, body)


def customer(name: str, step: Step, body: str) -> None:
    _add(name, "customer", step, body)


TAX = ["tax_id"]


def _tax_parts(t, p, role="supplier"):
    if role == "supplier":
        base, parts = reports.supplier_base(t, p), reports.supplier_parts(t, p)
    else:
        base, parts = reports.customer_base(t, p), reports.customer_parts(t, p)
    return metrics.base_record_parts(parts, t["site"], base)


def _valid(t, codes):
    return sets.valid_sites(t["site"], t["document"], codes)


def _with_sites(base: DataFrame, t) -> DataFrame:
    return base.join(joins.site_columns(t["site"]), RECORD)


# --- reports -------------------------------------------------------------------------------------

def _report(name: str):
    plan = reports.REPORTS[name]
    return lambda t, p: plan(t, p)


for _name in reports.REPORTS:
    _add(_name, reports.SIDE[_name], _report(_name), O.REPORT_SQL[_name])

def _from_days(name: str, side: str) -> Query:
    """A report of the same date from a roll-up of the documents by day."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        t, p, path = standins.tables(spark, folder, side), standins.params(), new_path(spark, "days")
        write_day_rollup(t["document"], p, side, path)
        return reports.REPORTS[name](t, p, parts_from_days(spark, path, p, side))
    return run


for _name in ("supplier_header", "customer_site"):
    ENTRIES[f"{_name}_from_days"] = Entry(_from_days(_name, reports.SIDE[_name]), O.sql(reports.SIDE[_name], O.REPORT_SQL[_name]))

customer("open_documents_topk", lambda t, p: sets.open_documents_topk(t["document"]), """
    SELECT party, type, number, balance FROM document WHERE CAST(status AS INTEGER) >= 4
    ORDER BY number DESC, party, type, balance LIMIT 10""")


# --- sources and sinks ---------------------------------------------------------------------------

def _store(spark: SparkSession, tables: Mapping[str, DataFrame], names: Iterable[str], path: str) -> None:
    """Write tables under their database names with padded codes, a few side by side."""
    def write(name: str, stored: DataFrame) -> None:
        stored.write.parquet(f"{path}/{TABLES[name][0]}")

    raw = {name: tables[name].select(*[
        (F.concat(F.col(ours), F.lit("   ")) if kind == PADDED else F.col(ours)).alias(source)
        for source, ours, kind in TABLES[name][1]]) for name in names}
    with ThreadPoolExecutor(WORKERS) as pool:
        for one in [pool.submit(inheritable_thread_target(spark)(write), *item) for item in raw.items()]:
            one.result()


def _load_tables(spark: SparkSession, folder: str) -> DataFrame:
    """All tables of both roles, stored under their database names with padded codes, read back.

    Tables that both roles have in common are stored and read once, and each of their rows is given for both.
    """
    roles = ("supplier", "customer")
    own = [n for n in TABLES if n not in standins.COMMON]
    out = []
    for of, names in (*(((r,), own) for r in roles), (roles, standins.COMMON)):
        path = new_path(spark, "erp")
        _store(spark, standins.tables(spark, folder, of[0]), names, path)
        for name, df in load_tables(spark, path, names=names).items():
            cells = [F.date_format(c, "yyyy-MM-dd HH:mm:ss") if kind == TIME else F.col(c).cast("string")
                     for _, c, kind in TABLES[name][1]]
            cells = F.concat_ws("|", *[F.coalesce(c, F.lit("NULL")) for c in cells])
            role = F.explode(F.array(*map(F.lit, of))).alias("role")
            out.append(df.select(cells.alias("cells")).select(role, F.lit(name).alias("name"), "cells"))
    return reduce(DataFrame.unionByName, out)


def _table_rows(role: str) -> str:
    def cells(columns) -> str:
        texts = [f"strftime({c}, '%Y-%m-%d %H:%M:%S')" if kind == TIME else f"CAST({c} AS VARCHAR)" for _, c, kind in columns]
        return "concat_ws('|', " + ", ".join(f"coalesce({x}, 'NULL')" for x in texts) + ")"
    return O.sql(role, "\nUNION ALL\n".join(
        f"SELECT '{role}' AS role, '{name}' AS name, {cells(columns)} AS cells FROM {name}"
        for name, (_, columns) in TABLES.items()))


ENTRIES["load_tables"] = Entry(_load_tables, "\nUNION ALL\n".join(
    f"SELECT * FROM ({_table_rows(role)})" for role in ("supplier", "customer")))
ENTRIES["partitioned_read"] = Entry(
    lambda spark, folder: tag_pieces(
        spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_custkey"),
        "o_orderkey", 0, 10_000, 8),
    """SELECT o_orderkey, o_custkey,
        CAST(least(greatest(o_orderkey // 1250, 0), 7) AS INTEGER) AS piece FROM orders""")


def _balanced_read(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of equal size by quantiles of the key: all rows are in one, and the largest has at most twice the rows of the median one."""
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey")
    sizes = tag_cuts(orders, "o_orderkey", quantile_cuts(orders, "o_orderkey", 8)).groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.count(F.lit(1)).alias("pieces"), F.sum("n").alias("n_rows"), (F.max("n") <= 2 * F.median("n")).alias("balanced"))


ENTRIES["balanced_read"] = Entry(_balanced_read, "SELECT 8 AS pieces, count(*) AS n_rows, true AS balanced FROM orders")


def cell_schema(report: DataFrame) -> str:
    """Types of a report's cells in CSV: dates are text there."""
    return ", ".join(f"{c} {'string' if kind in ('timestamp', 'timestamp_ntz') else kind}" for c, kind in report.dtypes)


_ODD = "concat('  ', name, ' \"q\", ', short_name, '\n ')"


def _export_report(spark: SparkSession, folder: str) -> DataFrame:
    """A whole report, with blanks at the edges, quotes, line breaks and NULLs, through CSV files."""
    t = dict(standins.tables(spark, folder, "customer"))
    t["party"] = t["party"].selectExpr(
        *[c for c in t["party"].columns if c not in ("name", "short_name")], f"{_ODD} AS name",
        "if(id_type_code % 2 = 0, NULL, short_name) AS short_name")
    report = reports.REPORTS["customer_header"](t, standins.params())
    path = new_path(spark, "export")
    export_report(report, path, max_rows=500, names=display_names(LAYOUTS["customer_header"]))
    return read_export(spark, path, cell_schema(report))


ENTRIES["export_report"] = Entry(_export_report, O.exported_customer_header())
customer("column_width_profile", lambda t, p: column_width_profile(t["document"]),
         "\nUNION ALL\n".join(
             f"""SELECT '{c}' AS "column", least(greatest(coalesce(max(length(
                 CAST({c} AS VARCHAR))), 0), {len(c)}) + 2, 50) AS width FROM document"""
             for c in [name for _, name, _ in TABLES["document"][1]]))


def _report_batch(role: str) -> Query:
    """Rows of every written report, read back: count, filled text cells, and a sum over the hashes of whole rows."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        names = [n for n in reports.REPORTS if reports.SIDE[n] == role]
        t, out = standins.tables(spark, folder, role), new_path(spark, "batch")
        log = report_batch(spark, t, standins.params(), out, names)
        found = []
        for name in names:
            cells = read_export(spark, f"{out}/{name}", cell_schema(reports.REPORTS[name](t, standins.params())))
            found.append(cells.select(F.lit(name).alias("report"), *_summary(O.text_cells(name)), _row_hash(cells)).groupBy("report").agg(
                F.count(F.lit(1)).alias("n_read"), F.sum("filled").alias("filled"), F.sum("chars").alias("chars"),
                F.sum("row").cast("string").alias("cells")))
        return log.select("report", "status", "rows").join(reduce(DataFrame.unionByName, found), "report", "left")
    return run


def _row_hash(cells: DataFrame):
    """48 bits of the hash of a row's cells as text, amounts with 11 places."""
    text = [f"coalesce(CAST({f'CAST({c} AS DECIMAL(38,11))' if kind.startswith('decimal') else c} AS STRING), 'NULL')" for c, kind in cells.dtypes]
    return F.expr(f"CAST(CAST(conv(substr(md5(concat_ws('|', {', '.join(text)})), 1, 12), 16, 10) AS BIGINT) AS DECIMAL(20,0))").alias("row")


def _summary(cells) -> list:
    """Filled text cells of a row and their characters."""
    filled = " + ".join(f"int(coalesce({c}, '') != '')" for c in cells)
    chars = " + ".join(f"coalesce(length({c}), 0)" for c in cells)
    return [F.expr(f"bigint({filled})").alias("filled"), F.expr(f"bigint({chars})").alias("chars")]


for _role, _key in (("supplier", "report_batch"), ("customer", "report_batch_customers")):
    ENTRIES[_key] = Entry(_report_batch(_role), O.sql(_role, "\nUNION ALL\n".join(
        O.batch_row(n) for n in reports.REPORTS if reports.SIDE[n] == _role)))


# --- filters and qualification -------------------------------------------------------------------

supplier("base_parties",
         lambda t, p: reports.supplier_base(t, p).select("tax_id", *RECORD, "name", "created"),
         "SELECT tax_id, origin, party, name, created FROM base")
customer("transactional_documents",
         lambda t, p: filters.transactional_documents(t["document"], p.customer),
         "SELECT * FROM typed")


def _site_balance(t, p, role, valid_only=False):
    parts = reports.supplier_parts(t, p) if role == "supplier" else reports.customer_parts(t, p)
    if valid_only:
        parts = metrics.in_valid_sites(parts, t["site"])
    rows = joins.site_columns(t["site"]).select(*SITE, "site_status")
    return rows.join(metrics.open_balance(parts, SITE, p), SITE, "left").withColumn(
        "open_balance", F.coalesce("open_balance", F.lit(0)))


_KEEP = """SELECT s.origin, s.party, s.site, s.status AS site_status,
        CAST(coalesce(v.b, 0) AS DECIMAL(38,11)) AS open_balance
    FROM site s LEFT JOIN (SELECT origin, party, site, {sum} AS b FROM {docs} GROUP BY ALL) v
        USING (origin, party, site)
    WHERE s.status = '1' OR (s.status <> '1' AND coalesce(v.b, 0) {test} 0)"""
supplier("site_keep_active_or_open",
         lambda t, p: filters.site_keep(_site_balance(t, p, "supplier"), "ne"),
         _KEEP.format(sum=O.S_BALANCE, docs="typed", test="<>"))
supplier("site_keep_open_positive",
         lambda t, p: filters.site_keep(_site_balance(t, p, "supplier"), "gt"),
         _KEEP.format(sum=O.S_BALANCE, docs="typed", test=">"))
customer("customer_site_keep",
         lambda t, p: filters.site_keep(_site_balance(t, p, "customer", True), "gt"),
         _KEEP.format(sum=O.C_BALANCE, docs="valid_docs", test=">"))

_S_AMOUNTS, _S_COUNTS = (metrics.AMOUNTS_AND_COUNTS["supplier"][i] for i in
                         (slice(0, 3), slice(3, None)))
_C_AMOUNTS, _C_COUNTS = (metrics.AMOUNTS_AND_COUNTS["customer"][i] for i in
                         (slice(0, 3), slice(3, None)))


def _nonzero_supplier(t, p):
    rows = metrics.all_supplier_columns(reports.supplier_parts(t, p), SITE, p)
    return filters.nonzero_metrics(rows, _S_AMOUNTS, _S_COUNTS).select(
        *SITE, *_S_AMOUNTS, *_S_COUNTS)


supplier("nonzero_metrics_supplier", _nonzero_supplier, f"""
    SELECT * FROM (
        SELECT o.origin, o.party, o.site,
            {', '.join(f'CAST(coalesce(m.{c}, 0) AS DECIMAL(38,11)) AS {c}' for c in _S_AMOUNTS)},
            {', '.join(f'coalesce(m.{c}, 0) AS {c}' for c in _S_COUNTS[:3])},
            {', '.join(f'o.{c}' for c in _S_COUNTS[3:])}
        FROM site_orders o LEFT JOIN site_metrics m USING (origin, party, site))
    WHERE {' OR '.join(f'{c} <> 0' for c in _S_AMOUNTS + _S_COUNTS)}""")
customer("nonzero_metrics_customer", lambda t, p: filters.nonzero_metrics(
    metrics.customer_metrics(reports.customer_parts(t, p), SITE, p), _C_AMOUNTS, _C_COUNTS,
).select(*SITE, *_C_AMOUNTS, *_C_COUNTS), f"""
    SELECT * FROM (SELECT origin, party, site, {O.C_AMOUNTS}, {O.C_COUNTS} FROM typed GROUP BY ALL)
    WHERE {' OR '.join(f'{c} <> 0' for c in _C_AMOUNTS + _C_COUNTS)}""")
supplier("qualified_supplier_tax_ids",
         lambda t, p: filters.qualified_suppliers(_tax_parts(t, p)), "SELECT tax_id FROM qualified")
customer("qualified_customer_tax_ids", lambda t, p: filters.qualified_customers(
    _tax_parts(t, p, "customer"), filters.quoted(reports.customer_base(t, p), t["quote"], p)),
    "SELECT tax_id FROM qualified")
supplier("qualified_supplier_records", lambda t, p: filters.qualified_records(
    metrics.record_parts(reports.supplier_parts(t, p), t["site"])),
    "SELECT origin, party FROM qualified_records")
supplier("qualified_supplier_sites",
         lambda t, p: filters.qualified_sites(reports.supplier_parts(t, p)),
         "SELECT origin, party, site FROM qualified_sites")


# --- joins ---------------------------------------------------------------------------------------

customer("sites_with_open_documents", lambda t, p: joins.sites_with_open_documents(
    t["site"], t["document"], p.customer.open_types).select(*SITE, "status"), """
    SELECT s.origin, s.party, s.site, s.status FROM site s
    WHERE (s.origin, s.party, s.site) IN (SELECT (origin, party, site) FROM open_sites)""")
supplier("documents_in_valid_sites", lambda t, p: joins.documents_in_valid_sites(
    t["document"], _valid(t, p.supplier)), "SELECT document.* FROM document SEMI JOIN valid USING (origin, party, site)")
customer("party_documents", lambda t, p: joins.party_documents(
    reports.customer_base(t, p), t["document"], _valid(t, p.customer)).select(
    "tax_id", *SITE, "type", "number", "amount"), """
    SELECT b.tax_id, d.origin, d.party, d.site, d.type, d.number, d.amount
    FROM base b JOIN document d USING (origin, party) JOIN valid USING (origin, party, site)""")
supplier("chosen_record", lambda t, p: joins.chosen_record(
    sets.dedupe_by_tax_id(reports.supplier_base(t, p)), t["party"]), """
    SELECT b.* FROM party b JOIN chosen k
      ON k.tax_id = b.tax_id AND k.origin = b.origin AND k.party = b.party""")

_GEO_SQL = ", ".join(f"{v} AS {k}" for k, v in O._GEO_COLUMNS.items())
_GEO_NAMES = list(O._GEO_COLUMNS)


def _geo(t, p, via):
    return joins.geo_lookup(joins.site_columns(t["site"]), t, district_via=via).select(
        *SITE, *_GEO_NAMES)


supplier("geo_lookup", lambda t, p: _geo(t, p, "site"), f"""
    SELECT s.origin, s.party, s.site, {_GEO_SQL} FROM site s {O._geo('s', 's.origin', 's.country')}""")
supplier("geo_lookup_via_country", lambda t, p: _geo(t, p, "country"), f"""
    SELECT s.origin, s.party, s.site, {_GEO_SQL} FROM site s {O._geo('s', 's.origin', 'pt.country')}""")


def _params(t, p):
    df = joins.party_param(t["party"].select(*RECORD), t["party_param"], PARAM_SIC, "sic")
    return repeat_rows(joins.party_param(df, t["party_param"], PARAM_TAX_REGISTRATION,
                                         "tax_registration", origin=HOME_ORIGIN))


supplier("party_param_lookup", _params, """
    SELECT b.origin, b.party, sic.sic, tax_reg.tax_registration FROM party b
    LEFT JOIN sic USING (party) LEFT JOIN tax_reg USING (party)""")


def _id_types(t, p):
    df = joins.id_type(t["party"].select(*RECORD, "id_type_code"), t["id_type"], origin=HOME_ORIGIN,
                       new="home_name")
    df = joins.id_type(df, t["id_type"], new="left_name")
    return joins.id_type(df, t["id_type"], how="inner", new="inner_name")


customer("id_type_lookup", _id_types, """
    SELECT b.origin, b.party, b.id_type_code, h.name AS home_name, l.name AS left_name,
        i.name AS inner_name
    FROM party b
    LEFT JOIN id_type h ON h.id_type_code = b.id_type_code AND h.origin = '011'
    LEFT JOIN id_type l ON l.id_type_code = b.id_type_code AND l.origin = b.origin
    JOIN id_type i ON i.id_type_code = b.id_type_code AND i.origin = b.origin""")
customer("account_lookup", lambda t, p: repeat_rows(joins.accounts(
    t["party"].select(*RECORD), t["account"])), """
    SELECT b.origin, b.party, a.number AS account_number, a.type AS account_type,
        a.status AS account_status FROM party b LEFT JOIN account a USING (origin, party)""")
supplier("contact_person_lookup", lambda t, p: repeat_rows(joins.contact_person(
    t["site"].select(*SITE), t["contact_person"])), """
    SELECT s.origin, s.party, s.site, c.first_name, c.last_name FROM site s
    LEFT JOIN contact_person c ON c.party = s.party AND c.site = s.site
        AND c.role = 'Director Ejecutivo'""")
supplier("origin_lookup", lambda t, p: joins.origin_lookup(t["party"].select(*RECORD), t["origin"]), """
    SELECT b.origin, b.party, o.origin AS origin_found, o.country AS origin_country
    FROM party b LEFT JOIN origin o ON o.origin = b.origin""")
customer("origin_lookup_inner", lambda t, p: joins.origin_lookup(
    t["party"].select(*RECORD), t["origin"], "inner"), """
    SELECT b.origin, b.party, o.origin AS origin_found, o.country AS origin_country
    FROM party b JOIN origin o ON o.origin = b.origin""")
supplier("exclude_by_record", lambda t, p: joins.exclude_by_record(
    t["party"].select(*RECORD, "tax_id"), t["document"], p.supplier.excluding_types,
    _valid(t, p.supplier)), f"""
    SELECT b.origin, b.party, b.tax_id FROM party b WHERE NOT EXISTS (
        SELECT 1 FROM valid_docs d WHERE d.origin = b.origin AND d.party = b.party
            AND d.type IN {O.EXCLUDING})""")
supplier("exclude_by_record_all_sites", lambda t, p: joins.exclude_by_record(
    t["party"].select(*RECORD, "tax_id"), t["document"], p.supplier.excluding_types), f"""
    SELECT b.origin, b.party, b.tax_id FROM party b WHERE NOT EXISTS (
        SELECT 1 FROM live d WHERE d.origin = b.origin AND d.party = b.party
            AND d.type IN {O.EXCLUDING})""")


def _excluded(t, p):
    return joins.excluded_tax_ids(reports.supplier_base(t, p), t["document"],
                                  p.supplier.excluding_types, _valid(t, p.supplier))


supplier("exclude_by_tax_id", lambda t, p: joins.exclude_by_tax_id(
    reports.supplier_base(t, p).select("tax_id", *RECORD), _excluded(t, p)), """
    SELECT tax_id, origin, party FROM base WHERE tax_id NOT IN (SELECT tax_id FROM tax_excluded)""")
customer("exists_or_rule", lambda t, p: joins.exists_or_rule(
    reports.customer_base(t, p), metrics.open_balance(_tax_parts(t, p, "customer"), TAX, p),
    filters.quoted(reports.customer_base(t, p), t["quote"], p)), """
    SELECT DISTINCT b.tax_id FROM base b LEFT JOIN tax_metrics m USING (tax_id)
    WHERE coalesce(m.open_balance, 0) > 0
       OR EXISTS (SELECT 1 FROM quoted q WHERE q.tax_id = b.tax_id)""")


def _since(t, p):
    def found(types, open_only, kind):
        return joins.has_document_since(t["document"], SITE, types, p, 2, open_only).withColumn(
            "kind", F.lit(kind))

    return (found(p.supplier.order_types, True, "open order")
            .unionByName(found(p.supplier.order_types, False, "order"))
            .unionByName(found(p.supplier.recent_types, False, "transaction")))


supplier("has_document_since", _since, f"""
    SELECT DISTINCT origin, party, site, 'open order' AS kind FROM live
    WHERE type IN {O.ORDER} AND created >= {O.T2} AND balance > 0
    UNION ALL SELECT DISTINCT origin, party, site, 'order' FROM live
    WHERE type IN {O.ORDER} AND created >= {O.T2}
    UNION ALL SELECT DISTINCT origin, party, site, 'transaction' FROM live
    WHERE type IN {O.RECENT} AND created >= {O.T2}""")
supplier("site_tag_join", lambda t, p: joins.site_tags_exploded(
    t["site"].select(*SITE), t["site_tag"], t["tag_type"]), """
    SELECT s.origin, s.party, s.site, t.tag_group, t.tag_code, d.name AS tag_name FROM site s
    LEFT JOIN site_tag t USING (origin, party, site)
    LEFT JOIN tag_type d ON d.tag_group = t.tag_group AND d.tag_code = t.tag_code
        AND d.origin = s.origin AND d.tag_group = '9'""")
supplier("first_contact_by_type", lambda t, p: joins.contact_lookup(
    t["site"].select(*SITE), t["contact_point"], {"phone": PHONE, "email": EMAIL, "url": URL}), """
    SELECT s.origin, s.party, s.site, c.phone, c.email, c.url
    FROM site s LEFT JOIN contacts c USING (origin, party, site)""")
customer("first_active_site", lambda t, p: joins.first_active_site(t["site"]), """
    SELECT origin, party, site, site_status AS status, site_name AS name, address, country, state,
        province, district FROM first_site""")
supplier("metrics_left_join", lambda t, p: metrics.attach_metrics(
    reports.supplier_base(t, p).select("tax_id", *RECORD),
    metrics.supplier_metrics(_tax_parts(t, p), TAX, p), TAX), f"""
    SELECT b.tax_id, b.origin, b.party, {', '.join(
        f'{O._S_VALUES[c]} AS {c}' for c in metrics.SUPPLIER_TRX)}
    FROM base b LEFT JOIN tax_metrics m USING (tax_id)""")


# --- aggregations --------------------------------------------------------------------------------

def _by_tax(role: str, columns: str) -> str:
    return (f"SELECT tax_id, {columns} FROM tax_docs WHERE type IN {O.TYPED[role]} "
            "GROUP BY tax_id")


supplier("supplier_period_amounts", lambda t, p: metrics.period_amounts(
    _tax_parts(t, p), TAX, p, p.supplier), _by_tax("supplier", O.S_AMOUNTS))
customer("customer_period_amounts", lambda t, p: metrics.period_amounts(
    _tax_parts(t, p, "customer"), TAX, p, p.customer), _by_tax("customer", O.C_AMOUNTS))
supplier("open_balance", lambda t, p: metrics.open_balance(_tax_parts(t, p), TAX, p),
         _by_tax("supplier", f"{O.S_BALANCE} AS open_balance"))
customer("open_balance_customer", lambda t, p: metrics.open_balance(
    _tax_parts(t, p, "customer"), TAX, p), _by_tax("customer", f"{O.C_BALANCE} AS open_balance"))
supplier("supplier_document_counts", lambda t, p: metrics.document_counts(
    _tax_parts(t, p), TAX, p, p.supplier), _by_tax("supplier", O.S_COUNTS))
customer("customer_document_counts", lambda t, p: metrics.document_counts(
    _tax_parts(t, p, "customer"), TAX, p, p.customer), _by_tax("customer", O.C_COUNTS))
supplier("document_date_range", lambda t, p: metrics.document_date_range(_tax_parts(t, p), TAX),
         _by_tax("supplier", O.DATES))
supplier("supplier_flags", lambda t, p: metrics.supplier_flags(_tax_parts(t, p), TAX, p),
         "SELECT * FROM tax_flags")
supplier("supplier_flags_by_record", lambda t, p: metrics.supplier_flags(
    metrics.in_valid_sites(reports.supplier_parts(t, p), t["site"]), RECORD, p, open_orders=False),
    "SELECT * FROM record_flags")
supplier("supplier_flags_by_site", lambda t, p: metrics.supplier_flags(
    reports.supplier_parts(t, p), SITE, p), "SELECT * FROM site_flags")
supplier("supplier_flags_by_site_any_order", lambda t, p: metrics.supplier_flags(
    reports.supplier_parts(t, p), SITE, p, open_orders=False), "SELECT * FROM site_flags_any")
customer("customer_flags", lambda t, p: metrics.customer_flags(
    _tax_parts(t, p, "customer"), TAX, p), _by_tax("customer", O.C_FLAGS))
supplier("purchase_order_metrics", lambda t, p: metrics.order_metrics(_tax_parts(t, p), TAX, p),
         "SELECT * FROM tax_orders")
supplier("purchase_order_metrics_by_site", lambda t, p: metrics.order_metrics(
    reports.supplier_parts(t, p), SITE, p), "SELECT * FROM site_orders")
supplier("invoice_count_2y", lambda t, p: metrics.invoice_count(_tax_parts(t, p), TAX, p),
         "SELECT * FROM tax_invoices")
supplier("supplier_site_metrics", lambda t, p: metrics.supplier_metrics(
    reports.supplier_parts(t, p), SITE, p), "SELECT * FROM site_metrics")
customer("customer_site_metrics", lambda t, p: metrics.customer_metrics(
    metrics.in_valid_sites(reports.customer_parts(t, p), t["site"]), SITE, p),
    "SELECT * FROM site_metrics")
customer("customer_metrics", lambda t, p: metrics.customer_metrics(
    _tax_parts(t, p, "customer"), TAX, p), "SELECT * FROM tax_metrics")
supplier("supplier_metrics", lambda t, p: metrics.supplier_metrics(_tax_parts(t, p), TAX, p),
         "SELECT * FROM tax_metrics")
customer("quoted_tax_ids", lambda t, p: filters.quoted(reports.customer_base(t, p), t["quote"], p),
         "SELECT tax_id FROM quoted")
supplier("site_codes_text", lambda t, p: tags.site_codes(t["site_tag"], t["tag_type"]),
         "SELECT * FROM codes")
supplier("po_usage_text", lambda t, p: tags.po_usage(t["site_tag"], t["tag_type"]), "SELECT * FROM usage")


# --- sets, order, limit --------------------------------------------------------------------------

customer("dedupe_by_tax_id", lambda t, p: sets.dedupe_by_tax_id(
    reports.customer_base(t, p)).select("tax_id", *RECORD, "name"),
    "SELECT tax_id, origin, party, name FROM chosen")
customer("order_sites", lambda t, p: sets.order_sites(
    _with_sites(t["party"].select(*RECORD, "tax_id"), t).select("tax_id", *SITE)), """
    SELECT b.tax_id, s.origin, s.party, s.site FROM party b JOIN site s USING (origin, party)
    ORDER BY b.tax_id, s.party, s.site""")
supplier("order_by_party", lambda t, p: sets.order_by_party(t["site"].select(*SITE)),
         "SELECT origin, party, site FROM site ORDER BY party, site")
customer("report_limit", lambda t, p: sets.limit_report(sets.order_sites(
    _with_sites(t["party"].select(*RECORD, "tax_id"), t).select("tax_id", *SITE)), 10), """
    SELECT b.tax_id, s.origin, s.party, s.site FROM party b JOIN site s USING (origin, party)
    ORDER BY b.tax_id, s.party, s.site LIMIT 10""")
supplier("valid_sites", lambda t, p: _valid(t, p.supplier), "SELECT * FROM valid")
customer("valid_sites_customer", lambda t, p: _valid(t, p.customer), "SELECT * FROM valid")


def _tax_id_sets(t, p):
    base, valid = reports.supplier_base(t, p), _valid(t, p.supplier)

    def of(types, open_only, kind):
        sites = joins.has_document_since(t["document"], SITE, types, p, 2, open_only)
        records = sites.join(valid, SITE, "left_semi").select(*RECORD).distinct()
        return (base.select(*RECORD, "tax_id").join(records, RECORD).select("tax_id").distinct()
                .withColumn("kind", F.lit(kind)))

    return (of(p.supplier.order_types, True, "open order 2y")
            .unionByName(of(p.supplier.recent_types, False, "transaction 2y"))
            .unionByName(_excluded(t, p).withColumn("kind", F.lit("excluded"))))


supplier("tax_id_sets", _tax_id_sets, """
    SELECT tax_id, 'open order 2y' AS kind FROM tax_orders_2y
    UNION ALL SELECT tax_id, 'transaction 2y' FROM tax_recent_2y
    UNION ALL SELECT tax_id, 'excluded' FROM tax_excluded""")


# --- projections ---------------------------------------------------------------------------------

customer("business_model", lambda t, p: labels.business_model(t["party"]).select(
    *RECORD, "name", "id_type_code", "business_model"), f"""
    SELECT b.origin, b.party, b.name, b.id_type_code, {O._MODEL} AS business_model FROM party b""")
customer("party_status", lambda t, p: labels.party_status(t["site"]).select(
    *SITE, "status", "party_status"), """
    SELECT origin, party, site, status,
        CASE status WHEN '1' THEN 'ACTIVO' WHEN '0' THEN 'INACTIVO' END AS party_status FROM site""")
supplier("org_name", lambda t, p: labels.org_name(t["party"]).select(*RECORD, "org_name"), """
    SELECT origin, party, CASE origin WHEN '011' THEN 'F490101' ELSE origin END AS org_name
    FROM party""")
supplier("site_identifier", lambda t, p: labels.site_identifier(t["site"]).select(
    *SITE, "site_identifier"), "SELECT origin, party, site, party || site AS site_identifier FROM site")
supplier("contact_full_name", lambda t, p: labels.contact_full_name(t["contact_person"]).select(
    "party", "site", "role", "contact_name"), """
    SELECT party, site, role, coalesce(first_name, '') || coalesce(last_name, '') AS contact_name
    FROM contact_person""")
supplier("supplier_source_tag", lambda t, p: labels.supplier_source_tag(
    metrics.supplier_flags(reports.supplier_parts(t, p), SITE, p)).select(*SITE, "source_tag"), f"""
    SELECT origin, party, site, {O._SUPPLIER_TAG} AS source_tag FROM site_flags f""")
customer("customer_source_tag", lambda t, p: labels.customer_source_tag(
    metrics.customer_flags(_tax_parts(t, p, "customer"), TAX, p)).select("tax_id", "source_tag"), f"""
    SELECT tax_id, {O._CUSTOMER_TAG} AS source_tag FROM tax_metrics m""")
customer("customer_totals", lambda t, p: labels.customer_totals(
    metrics.customer_metrics(_tax_parts(t, p, "customer"), TAX, p)).select(
    "tax_id", "tot_trx_0y5_op_amount_chf", "doc_trx_0y5_op_count"), f"""
    SELECT tax_id, {O._C_VALUES['tot_trx_0y5_op_amount_chf']} AS tot_trx_0y5_op_amount_chf,
        {O._C_VALUES['doc_trx_0y5_op_count']} AS doc_trx_0y5_op_count FROM tax_metrics m""")
supplier("po_usage_label", lambda t, p: labels.po_usage_label(t["site_tag"]), """
    SELECT *, CASE tag_code WHEN '7' THEN 'Purchasing, Payment' WHEN '3' THEN 'Payment' END
        AS po_usage FROM site_tag""")
supplier("blank_columns", lambda t, p: labels.blank_columns(
    labels.blank_columns(t["party"].select(*RECORD), ["tax_name", "parent_party_id"]),
    ["site_status"], "1"), """
    SELECT origin, party, '' AS tax_name, '' AS parent_party_id, '1' AS site_status FROM party""")
customer("rename_columns", lambda t, p: labels.rename_columns(
    t["party"].select(F.col("tax_id").alias("registry_id"), F.col("name").alias("party_name")),
    display_names(LAYOUTS["customer_header"])), """
    SELECT tax_id AS "REGISTRY_ID", name AS "PARTY_NAME (M)" FROM party""")
customer("post_transform", lambda t, p: labels.post_transform(
    t["party"].select(*RECORD, "tax_id"),
    lambda df: df.withColumn("is_home", F.col("origin") == HOME_ORIGIN)), """
    SELECT origin, party, tax_id, origin = '011' AS is_home FROM party""")
