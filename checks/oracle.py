"""Expected results in DuckDB SQL, written per operator from documents up.

Documents are joined with parties and valid sites first and aggregated last, which is the other
way round than the Spark side, so the two agree only if the roll-up is right. The dates are those of
``standins.AS_OF`` minus 1, 2 and 5 years.
"""

from __future__ import annotations

import re

from checks.standin_sql import ctes

# Codes.
T1, T2, T5 = (f"TIMESTAMP '{d}'" for d in ("2000-08-02", "1999-08-02", "1996-08-02"))
RATE = "CAST(0.000210699 AS DECIMAL(10,9))"
ORIGINS = "('011','F490401','F490411','F491201','F494101','F494151')"
NOT_PARTIES = {
    "supplier": "('0000000012','0000000011','F491201','F490411','F490401','F490421',"
                "'2000022410','2000103488')",
    "customer": "('0000000012','0000000011','F491201','F490411','F490401','F490421')"}
PLUS, MINUS = "('C2','DE','FD','FE','FP','LG','NO','RG')", "('M2','N2','NA','NP')"
TYPED = {"supplier": "('C2','DE','FD','FE','FP','LG','NO','RG','M2','N2','NA','NP')",
         "customer": "('AB','AG','AN','FA','FV','NC','ND')"}
OPENABLE = {"supplier": TYPED["supplier"], "customer": "('AB','AG','AN','FA','FV','NC')"}
INVOICE, CREDIT, ORDER = "('FE','FD','DE')", "('NP','NA')", "('OC','OS')"
RECENT = "('AP','C2','FE','FP','NP','NA','DE','NO')"
EXCLUDING = "('EC','ER','SB','SD')"
READ = {"supplier": "('C2','DE','FD','FE','FP','LG','NO','RG','M2','N2','NA','NP',"
                    "'OC','OS','CX','AP','EC','ER','SB','SD')",
        "customer": TYPED["customer"]}


def _chf(value: str, plus: str, minus: str) -> str:
    return (f"CAST(CASE WHEN type IN {plus} THEN {value} WHEN type IN {minus} THEN -{value} "
            f"ELSE 0 END AS DECIMAL(28,2)) * {RATE}")


def _total(value: str, test: str, scale: str = "DECIMAL(38,11)") -> str:
    return f"CAST(coalesce(sum({value}) FILTER (WHERE {test}), 0) AS {scale})"


def _count(test: str) -> str:
    return f"count(*) FILTER (WHERE {test})"


_AMOUNT = _chf("amount", INVOICE, CREDIT)
_BALANCE = _chf("balance", PLUS, MINUS)
S_AMOUNTS = f"""{_total(_AMOUNT, f'created >= {T1}')} AS trx_1y_amount_chf,
    {_total(_AMOUNT, f'created >= {T2} AND created < {T1}')} AS trx_2y_amount_chf"""
S_BALANCE = _total(_BALANCE, "balance > 0")
S_COUNTS = f"""{_count(f'created >= {T1}')} AS trx_1y_count,
    {_count(f'created >= {T2} AND created < {T1}')} AS trx_2y_count,
    {_count('balance > 0')} AS trx_op_count"""
DATES = """min(created) AS min_trx_date, max(created) AS max_trx_date,
    min(year(created)) AS min_trx_year, max(year(created)) AS max_trx_year"""
S_METRICS = f"{S_AMOUNTS}, {S_BALANCE} AS trx_op_bal_chf, {S_COUNTS}, {DATES}"
ORDERS = f"""{_count(f"type IN {ORDER} AND balance > 0 AND created >= {T1}")} AS po_1y_op_count,
    {_count(f"type IN {ORDER} AND balance > 0 AND created >= {T2}")} AS po_2y_op_count,
    {_count(f"type IN {ORDER} AND balance > 0")} AS po_op_count,
    min(created) FILTER (WHERE type IN {ORDER} AND balance > 0) AS min_po_date,
    max(created) FILTER (WHERE type IN {ORDER} AND balance > 0) AS max_po_date,
    {_count("type = 'CX' AND balance > 0")} AS po_agreement_count"""


def _flag(test: str) -> str:
    return f"({_count(test)}) > 0"


def _s_flags(open_orders: bool) -> str:
    extra = "AND balance > 0 " if open_orders else ""
    return f"""{_flag(f"type IN {INVOICE} AND created >= {T1}")} AS has_inv_1y,
    {_flag(f"type IN {INVOICE} AND created >= {T2}")} AS has_inv_2y,
    {_flag(f"type IN {INVOICE} AND balance > 0 AND created < {T2}")} AS has_inv_op_old,
    {_flag(f"type IN {ORDER} {extra}AND created >= {T2}")} AS has_po_2y"""


_C_AMOUNT, _C_OPEN = (_chf(v, "('FA','ND')", "('NC')") for v in ("amount", "balance"))
_C_BALANCE = _chf("balance", "('FA','FV')", "('AB','AG','AN','NC')")


def _twice(value: str, test: str) -> str:
    return f"CAST(round({_total(value, test)} * {RATE}, 6) AS DECIMAL(38,6))"


C_AMOUNTS = f"""{_twice(_C_AMOUNT, f'created >= {T2}')} AS tot_trx_0y2_amount_chf,
    {_twice(_C_AMOUNT, f'created <= {T2} AND created >= {T5}')} AS tot_trx_2y5_amount_chf,
    {_twice(_C_OPEN, 'balance > 0')} AS tot_trx_op_amount_chf"""
C_BALANCE = _total(_C_BALANCE, "balance > 0")
C_COUNTS = f"""{_count(f'created >= {T2}')} AS doc_trx_0y2_count,
    {_count(f'created <= {T2} AND created >= {T5}')} AS doc_trx_2y5_count,
    {_count(f"balance > 0 AND due >= {T2} AND type <> 'ND'")} AS doc_trx_op_count"""
C_FLAGS = f"""{_flag("type IN ('FA','ND') AND balance > 0")} AS has_op_trx,
    {_flag(f"type IN ('FA','NC','ND') AND created >= {T2}")} AS has_trx_02y,
    {_flag(f"type IN ('FA','NC','ND') AND created >= {T5}")} AS has_trx_5y"""
C_METRICS = f"{C_AMOUNTS}, {C_BALANCE} AS open_balance, {C_COUNTS}, {DATES}, {C_FLAGS}"


def _steps(role: str) -> dict[str, str]:
    cls = "2" if role == "supplier" else "4"
    steps = {
        "base": f"""
            SELECT party.* FROM party JOIN party_class c USING (origin, party)
            WHERE origin IN {ORIGINS} AND status = '1' AND c.tag_group = '6'
              AND c.tag_code = '{cls}' AND party NOT IN {NOT_PARTIES[role]}
              AND tax_id NOT LIKE 'F%'""",
        "live": "SELECT * FROM document WHERE status <> '0'",
        "typed": f"SELECT * FROM live WHERE type IN {TYPED[role]}",
        "interesting": f"SELECT * FROM live WHERE type IN {READ[role]}",
        "open_sites": f"""
            SELECT DISTINCT origin, party, site FROM live
            WHERE balance > 0 AND type IN {OPENABLE[role]}""",
        "valid": """
            SELECT DISTINCT s.origin, s.party, s.site FROM site s
            WHERE s.status = '1' OR (s.status = '0' AND EXISTS (
                SELECT 1 FROM open_sites o
                WHERE o.origin = s.origin AND o.party = s.party AND o.site = s.site))""",
        "valid_docs": "SELECT interesting.* FROM interesting JOIN valid USING (origin, party, site)",
        "tax_docs": """SELECT d.*, b.tax_id FROM base b
            JOIN valid_docs d ON d.origin = b.origin AND d.party = b.party""",
        "first_site": """
            SELECT origin, party, site, name AS site_name, address, country, state, province,
                district, status AS site_status
            FROM site WHERE status = '1'
            QUALIFY row_number() OVER (PARTITION BY origin, party ORDER BY site) = 1""",
        "chosen": """SELECT DISTINCT ON (tax_id) * FROM base ORDER BY tax_id, origin, party""",
        "contacts": """
            SELECT origin, party, site,
                arg_min(number, code) FILTER (WHERE type = 1) AS phone,
                arg_min(number, code) FILTER (WHERE type = 3) AS email,
                arg_min(number, code) FILTER (WHERE type = 4) AS url
            FROM contact_point WHERE status = '1' GROUP BY ALL""",
        "codes": """
            SELECT t.origin, t.party, t.site,
                string_agg(d.name, ', ' ORDER BY t.tag_code, d.name) AS site_codes
            FROM site_tag t JOIN tag_type d USING (origin, tag_group, tag_code)
            WHERE t.tag_group = '9' AND d.name IS NOT NULL GROUP BY ALL""",
        "usage": """
            SELECT origin, party, site, string_agg(CASE tag_code WHEN '7' THEN
                'Purchasing, Payment' ELSE 'Payment' END, ', ' ORDER BY tag_code) AS po_usage
            FROM site_tag WHERE tag_code IN ('3', '7') GROUP BY ALL""",
        "sic": "SELECT party, value AS sic FROM party_param WHERE code = '7941'",
        "tax_reg": """SELECT party, value AS tax_registration FROM party_param
            WHERE code = '140' AND origin = '011'""",
    }
    if role == "supplier":
        steps |= {
            "tax_metrics": f"""SELECT tax_id, {S_METRICS} FROM tax_docs
                WHERE type IN {TYPED[role]} GROUP BY tax_id""",
            "tax_orders": f"SELECT tax_id, {ORDERS} FROM tax_docs GROUP BY tax_id",
            "tax_flags": f"SELECT tax_id, {_s_flags(True)} FROM tax_docs GROUP BY tax_id",
            "tax_invoices": f"""SELECT tax_id, count(*) AS doc_count_2y FROM tax_docs
                WHERE type IN {INVOICE} AND created >= {T2} GROUP BY tax_id""",
            "tax_orders_2y": f"""SELECT DISTINCT tax_id FROM tax_docs
                WHERE type IN {ORDER} AND balance > 0 AND created >= {T2}""",
            "tax_recent_2y": f"""SELECT DISTINCT tax_id FROM tax_docs
                WHERE type IN {RECENT} AND created >= {T2}""",
            "tax_excluded": f"SELECT DISTINCT tax_id FROM tax_docs WHERE type IN {EXCLUDING}",
            "qualified": """
                SELECT DISTINCT b.tax_id FROM base b
                LEFT JOIN tax_metrics m USING (tax_id) LEFT JOIN tax_invoices i USING (tax_id)
                WHERE (m.trx_op_bal_chf > 0
                       OR b.tax_id IN (SELECT tax_id FROM tax_orders_2y)
                       OR (i.doc_count_2y > 1 AND b.tax_id IN (SELECT tax_id FROM tax_recent_2y)))
                  AND b.tax_id NOT IN (SELECT tax_id FROM tax_excluded)""",
            "record_metrics": f"""SELECT origin, party, {S_METRICS} FROM valid_docs
                WHERE type IN {TYPED[role]} GROUP BY ALL""",
            "record_orders": f"SELECT origin, party, {ORDERS} FROM valid_docs GROUP BY ALL",
            "record_flags": f"SELECT origin, party, {_s_flags(False)} FROM valid_docs GROUP BY ALL",
            "qualified_records": f"""
                SELECT DISTINCT v.origin, v.party FROM valid_docs v
                LEFT JOIN record_metrics m USING (origin, party)
                LEFT JOIN (SELECT origin, party, count(*) AS n FROM valid_docs
                           WHERE type IN {INVOICE} AND created >= {T2} GROUP BY ALL) i
                  USING (origin, party)
                WHERE (m.trx_op_bal_chf > 0
                   OR EXISTS (SELECT 1 FROM valid_docs d WHERE d.origin = v.origin
                        AND d.party = v.party AND d.type IN {ORDER} AND d.created >= {T2})
                   OR (i.n > 1 AND EXISTS (SELECT 1 FROM valid_docs d WHERE d.origin = v.origin
                        AND d.party = v.party AND d.type IN {RECENT} AND d.created >= {T2})))
                  AND NOT EXISTS (SELECT 1 FROM valid_docs d WHERE d.origin = v.origin
                        AND d.party = v.party AND d.type IN {EXCLUDING})""",
            "site_metrics": f"""SELECT origin, party, site, {S_METRICS} FROM typed
                GROUP BY ALL""",
            "site_orders": f"SELECT origin, party, site, {ORDERS} FROM interesting GROUP BY ALL",
            "site_flags": f"SELECT origin, party, site, {_s_flags(True)} FROM interesting GROUP BY ALL",
            "site_flags_any": f"""SELECT origin, party, site, {_s_flags(False)} FROM interesting
                GROUP BY ALL""",
            "qualified_sites": f"""
                SELECT DISTINCT l.origin, l.party, l.site FROM interesting l
                LEFT JOIN site_metrics m USING (origin, party, site)
                WHERE (m.trx_op_bal_chf > 0
                   OR (l.origin, l.party, l.site) IN (SELECT (origin, party, site) FROM live
                        WHERE type IN {ORDER} AND created >= {T2})
                   OR ((l.origin, l.party) IN (SELECT (origin, party) FROM live
                        WHERE type IN {INVOICE} AND created >= {T2}
                        GROUP BY origin, party HAVING count(*) > 1)
                       AND (l.origin, l.party, l.site) IN (SELECT (origin, party, site) FROM live
                        WHERE type IN {RECENT} AND created >= {T2})))
                  AND (l.origin, l.party) NOT IN (SELECT (origin, party) FROM live
                        WHERE type IN {EXCLUDING})""",
        }
    else:
        steps |= {
            "tax_metrics": f"SELECT tax_id, {C_METRICS} FROM tax_docs GROUP BY tax_id",
            "site_metrics": f"""SELECT origin, party, site, {C_METRICS} FROM valid_docs
                GROUP BY ALL""",
            "quoted": f"""SELECT DISTINCT b.tax_id FROM base b JOIN quote q USING (origin, party)
                WHERE q.created >= {T5} AND q.status NOT IN (0, 6)""",
            "qualified": """
                SELECT DISTINCT b.tax_id FROM base b LEFT JOIN tax_metrics m USING (tax_id)
                WHERE m.open_balance > 0 OR m.has_trx_5y
                   OR b.tax_id IN (SELECT tax_id FROM quoted)""",
        }
    return steps


def _geo(row: str, origin: str, via: str) -> str:
    return f"""
        LEFT JOIN country pt ON pt.country = {row}.country
        LEFT JOIN district dt ON dt.district = {row}.district AND dt.country = {via}
            AND dt.state = {row}.state AND dt.province = {row}.province AND dt.origin = {origin}
        LEFT JOIN state st ON st.state = {row}.state AND st.origin = {origin}
            AND st.country = {row}.country AND st.status = '1'
        LEFT JOIN province pv ON pv.province = {row}.province AND pv.origin = {origin}
            AND pv.country = {row}.country AND pv.state = st.state"""


# The reports' columns in order, each as `name=source` (`name=` is blank text).
COLUMNS = {
    "supplier_header": """
        vendor_name=name vendor_num=tax_id vendor_id=party vendor_name_alt=short_name sic=sic
        employee_id= vendor_type_lookup_code= ceo_title= ceo_name=contact_name principal_title=
        principal_name= tax_registration_num=tax_id taxpayer_id=tax_id remittance_email=email
        default_rep_country_code=origin_country default_rep_reg_number=tax_id
        default_rep_tax_reg_type=tax_registration parent_party_id= parent_vendor_id=
        party_alias=short_name url=url party_id=party registry_id=tax_id party_name=name
        party_type=id_type_name tax_name= country=country_name address1=address address2=
        address3= address4= city=district_name postal_code=postal_code state=state_name
        province=province_name trx_1y_amount_chf=trx_1y_amount_chf
        trx_2y_amount_chf=trx_2y_amount_chf trx_op_bal_chf=trx_op_bal_chf
        trx_1y_count=trx_1y_count trx_2y_count=trx_2y_count trx_op_count=trx_op_count
        min_trx_date=min_trx_date max_trx_date=max_trx_date min_trx_year=min_trx_year
        max_trx_year=max_trx_year vendor_creation_date=created
        supplier_trx_source_list=source_tag po_1y_op_count=po_1y_op_count
        po_2y_op_count=po_2y_op_count po_op_count=po_op_count min_po_date=min_po_date
        max_po_date=max_po_date po_agreement_count=po_agreement_count""",
    "supplier_header_by_record": """
        vendor_name=name vendor_num=tax_id vendor_id=party vendor_name_alt=short_name sic=sic
        employee_id= vendor_type_lookup_code= ceo_title= ceo_name=contact_name principal_title=
        principal_name= tax_registration_num=tax_id taxpayer_id=tax_id remittance_email=email
        default_rep_country_code=origin_country default_rep_reg_number=tax_id
        default_rep_tax_reg_type=tax_registration parent_party_id= parent_vendor_id=
        party_alias=short_name url=url party_id=party registry_id=tax_id party_name=name
        party_type=id_type_name tax_name= country=country_name address1=address address2=
        address3= address4= city=district_name postal_code=postal_code state=state_name
        province=province_name trx_1y_amount_chf=trx_1y_amount_chf
        trx_2y_amount_chf=trx_2y_amount_chf trx_op_bal_chf=trx_op_bal_chf
        trx_1y_count=trx_1y_count trx_2y_count=trx_2y_count trx_op_count=trx_op_count
        min_trx_date=min_trx_date max_trx_date=max_trx_date min_trx_year=min_trx_year
        max_trx_year=max_trx_year vendor_creation_date=created
        supplier_trx_source_list=source_tag po_1y_op_count=po_1y_op_count
        po_2y_op_count=po_2y_op_count po_op_count=po_op_count min_po_date=min_po_date
        max_po_date=max_po_date po_agreement_count=po_agreement_count""",
    "supplier_site": """
        org_name=org_name organization_id= business_group_id= vendor_name=name vendor_num=tax_id
        vendor_site_code=site_codes vendor_creation_date=created vendor_site_creation_date=
        address_style= language= province=province_name country=country_name area_code=
        phone=phone email_address=email customer_num= vendor_site_code_alt=
        address_line1=address address_line2= address_line3= address_lines_alt=
        city=district_name state=state_name zip=postal_code address_line4= vat_registration_num=
        vat_code= default_rep_country_code=origin_country default_rep_reg_number=tax_id
        default_rep_tax_reg_type= party_site_id= party_id= vendor_id=party
        vendor_site_id=site_identifier location_id=site vendor_site_id_2=site_identifier
        address_name= addressee= trx_1y_amount_chf=trx_1y_amount_chf
        trx_2y_amount_chf=trx_2y_amount_chf trx_op_bal_chf=trx_op_bal_chf
        trx_1y_count=trx_1y_count trx_2y_count=trx_2y_count trx_op_count=trx_op_count
        min_trx_date=min_trx_date max_trx_date=max_trx_date min_trx_year=min_trx_year
        max_trx_year=max_trx_year supplier_trx_source_list=source_tag
        po_2y_op_count=po_2y_op_count po_1y_op_count=po_1y_op_count po_op_count=po_op_count
        min_po_date=min_po_date max_po_date=max_po_date po_agreement_count=po_agreement_count
        po_usage=po_usage""",
    "supplier_site_self_qualified": """
        org_name=org_name organization_id= business_group_id= vendor_name=name vendor_num=tax_id
        vendor_site_code=site_codes vendor_creation_date=created vendor_site_creation_date=
        address_style= language= province=province_name country=country_name area_code=
        phone=phone email_address=email customer_num= vendor_site_code_alt=
        address_line1=address address_line2= address_line3= address_lines_alt=
        city=district_name state=state_name zip=postal_code address_line4= vat_registration_num=
        vat_code= default_rep_country_code=origin_country default_rep_reg_number=tax_id
        default_rep_tax_reg_type= party_site_id= party_id= vendor_id=party
        vendor_site_id=site_identifier location_id=site vendor_site_id_2=site_identifier
        address_name= addressee= trx_1y_amount_chf=trx_1y_amount_chf
        trx_2y_amount_chf=trx_2y_amount_chf trx_op_bal_chf=trx_op_bal_chf
        trx_1y_count=trx_1y_count trx_2y_count=trx_2y_count trx_op_count=trx_op_count
        min_trx_date=min_trx_date max_trx_date=max_trx_date min_trx_year=min_trx_year
        max_trx_year=max_trx_year supplier_trx_source_list=source_tag
        po_2y_op_count=po_2y_op_count po_1y_op_count=po_1y_op_count po_op_count=po_op_count
        min_po_date=min_po_date max_po_date=max_po_date po_agreement_count=po_agreement_count
        po_usage=po_usage""",
    "customer_header": """
        business_model_b2x=business_model party_name=name party_status=party_status
        party_id=account_number registry_id=tax_id known_as=short_name name_pronunciation=name
        translated_customer_name=name sic_code=sic default_rep_country_code=origin_country
        default_rep_reg_number=tax_id default_rep_tax_reg_type=id_type_name parent_company=
        taxpayer_id=tax_id party_site_status='1' tax_registration_number=tax_id
        account_number=account_number party_site_name=site_name account_description=account_type
        cust_account_id=account_number account_status=account_status party_site_number=site
        party_site_id=site_identifier cust_acct_site_id= country=country_name address1=address
        address2= address3= address4= city=district_name postal_code=postal_code
        state=state_name province=province_name county=district_name addressee=address
        status=site_status account_site_phone_number=phone account_site_email=email
        tot_trx_0y2_amount_chf=tot_trx_0y2_amount_chf
        tot_trx_2y5_amount_chf=tot_trx_2y5_amount_chf
        tot_trx_op_amount_chf=tot_trx_op_amount_chf
        tot_trx_0y5_op_amount_chf=tot_trx_0y5_op_amount_chf doc_trx_0y2_count=doc_trx_0y2_count
        doc_trx_2y5_count=doc_trx_2y5_count doc_trx_op_count=doc_trx_op_count
        doc_trx_0y5_op_count=doc_trx_0y5_op_count min_trx_date=min_trx_date
        max_trx_date=max_trx_date min_trx_year=min_trx_year max_trx_year=max_trx_year
        customer_trx_source_list=source_tag""",
    "customer_site": """
        org_name=org_name party_name=name party_status=party_status party_id=account_number
        registry_id=tax_id sic_code=sic default_rep_country_code=origin_country
        default_rep_reg_number=tax_id default_rep_tax_reg_type=id_type_name taxpayer_id=tax_id
        tax_registration_number=tax_id account_number=account_number party_site_name=site_name
        account_description=account_type cust_account_id=account_number
        account_status=account_status party_site_number=site party_site_id=site_identifier
        country=country_name address1=address city=district_name postal_code=postal_code
        state=state_name province=province_name county=district_name status=site_status
        account_site_phone_number=phone account_site_email=email
        tot_trx_0y2_amount_chf=tot_trx_0y2_amount_chf
        tot_trx_2y5_amount_chf=tot_trx_2y5_amount_chf
        tot_trx_op_amount_chf=tot_trx_op_amount_chf
        tot_trx_0y5_op_amount_chf=tot_trx_0y5_op_amount_chf doc_trx_0y2_count=doc_trx_0y2_count
        doc_trx_2y5_count=doc_trx_2y5_count doc_trx_op_count=doc_trx_op_count
        doc_trx_0y5_op_count=doc_trx_0y5_op_count min_trx_date=min_trx_date
        max_trx_date=max_trx_date min_trx_year=min_trx_year max_trx_year=max_trx_year
        customer_trx_source_list=source_tag""",
}
# Name patterns of public bodies.
PUBLIC_BODIES = (
    "%ALCALD%", "%MUNICIP%", "%GOBERN%", "%MINISTER%", "%PRESIDEN%", "%SECRETAR%",
    "%SUPERINTEND%", "%CONTRALOR%", "%PROCURAD%", "%PERSONER%", "%DEFENSOR%", "%REGISTRADUR%",
    "%DEPARTAMENTO%", "%E.S.E%", "% ESE %", "%E.S.P%", "% ESP %", "%SERVICIOS PUBLICOS%",
    "%BANCO DE LA REPUBLICA%", "%AUDITORIA GENERAL DE LA REPUBLICA%", "%CORPORACION AUTONOMA%",
    "%CORPORACION PARA%", "%AGENCIA LOGÍSTICA%", "%AGENCIA NACIONAL%",
    "%AGENCIA DE RENOVACION%", "%TERRITORIAL%", "%ATENEA%", "%UNTA CENTRAL DE CONTADORES%", "%SANIDAD%",
    "%ECOPETROL%", "%CENIT%", "%EMPRESA SOCIAL DEL ESTADO%", "%POLICIA%", "%EJERCITO%",
    "%ARMADA%", "%FUERZA AEREA%", "%FISCALIA%", "%RAM A JUDICIAL%", "%JUZGAD%", "%TRIBUNAL%",
)
_GEO_COLUMNS = {"country_name": "pt.name", "district_name": "dt.name",
                "postal_code": "dt.postal_code", "state_name": "st.name", "province_name": "pv.name"}
_SUPPLIER_TAG = """CASE WHEN f.has_inv_op_old THEN 'INV_OP' WHEN f.has_inv_1y THEN 'INV_1Y'
    WHEN f.has_inv_2y THEN 'INV_2Y' WHEN f.has_po_2y THEN 'POH_OP' ELSE 'NO_TRX_AT_ALL' END"""
_CUSTOMER_TAG = """CASE WHEN m.has_op_trx THEN 'OP_TRX' WHEN m.has_trx_02y THEN 'TRX_02Y'
    WHEN m.has_trx_5y THEN 'TRX_2Y5' ELSE 'PAY_SCHE_NO_TRX' END"""
_MODEL = ("CASE WHEN " + " OR ".join(f"upper(b.name) LIKE '{x}'" for x in PUBLIC_BODIES)
          + """ THEN 'B2G - Business To Government'
    WHEN b.id_type_code IN (3, 4, 7, 8) THEN 'B2C - Business To Customers'
    ELSE 'B2B - Business To Business' END""")


def _zero(column: str, kind: str) -> str:
    return f"CAST(coalesce({column}, 0) AS {kind})"


_S_VALUES = {
    **{c: _zero(f"m.{c}", "DECIMAL(38,11)")
       for c in ("trx_1y_amount_chf", "trx_2y_amount_chf", "trx_op_bal_chf")},
    **{c: _zero(f"m.{c}", "BIGINT") for c in ("trx_1y_count", "trx_2y_count", "trx_op_count")},
    **{c: f"m.{c}" for c in ("min_trx_date", "max_trx_date", "min_trx_year", "max_trx_year")},
    **{c: _zero(f"o.{c}", "BIGINT")
       for c in ("po_1y_op_count", "po_2y_op_count", "po_op_count", "po_agreement_count")},
    **{c: f"o.{c}" for c in ("min_po_date", "max_po_date")},
    "source_tag": _SUPPLIER_TAG,
}
_C_AMOUNT_NAMES = ("tot_trx_0y2_amount_chf", "tot_trx_2y5_amount_chf", "tot_trx_op_amount_chf")
_C_COUNT_NAMES = ("doc_trx_0y2_count", "doc_trx_2y5_count", "doc_trx_op_count")
_C_VALUES = {
    **{c: _zero(f"m.{c}", "DECIMAL(38,6)") for c in _C_AMOUNT_NAMES},
    **{c: _zero(f"m.{c}", "BIGINT") for c in _C_COUNT_NAMES},
    "tot_trx_0y5_op_amount_chf": "CAST(" + " + ".join(
        f"coalesce(m.{c}, 0)" for c in _C_AMOUNT_NAMES) + " AS DECIMAL(38,6))",
    "doc_trx_0y5_op_count": " + ".join(f"coalesce(m.{c}, 0)" for c in _C_COUNT_NAMES),
    **{c: f"m.{c}" for c in ("min_trx_date", "max_trx_date", "min_trx_year", "max_trx_year")},
    "source_tag": _CUSTOMER_TAG,
}
_PARTY = {c: f"b.{c}" for c in ("tax_id", "party", "name", "short_name", "created")}
_ORG = "CASE WHEN og.origin = '011' THEN 'F490101' ELSE og.origin END"


def _report(name: str, sources: dict[str, str], body: str) -> str:
    def column(source: str) -> str:
        if not source:
            return "''"
        return source if source.startswith("'") else sources[source]

    pairs = [x.split("=", 1) for x in COLUMNS[name].split()]
    listed = ",\n".join(f"{column(s)} AS {n}" for n, s in pairs)
    return f"SELECT {listed}\n{body}"


_HEADER_SOURCES = {
    **_PARTY, **_GEO_COLUMNS, **_S_VALUES, "sic": "sic.sic",
    "tax_registration": "tax_reg.tax_registration", "origin_country": "og.country",
    "contact_name": "coalesce(cp.first_name, '') || coalesce(cp.last_name, '')",
    "email": "ct.email", "url": "ct.url", "id_type_name": "it.name", "address": "fs.address"}
_HEADER_JOINS = f"""
    JOIN first_site fs ON fs.origin = b.origin AND fs.party = b.party
    LEFT JOIN origin og ON og.origin = b.origin
    LEFT JOIN sic ON sic.party = b.party
    LEFT JOIN tax_reg ON tax_reg.party = b.party
    {_geo('fs', 'og.origin', 'pt.country')}
    LEFT JOIN id_type it ON it.id_type_code = b.id_type_code AND it.origin = '011'
    LEFT JOIN contact_person cp ON cp.party = b.party AND cp.site = fs.site
        AND cp.role = 'Director Ejecutivo'
    LEFT JOIN contacts ct ON ct.origin = og.origin AND ct.party = b.party AND ct.site = fs.site"""
_SITE_SOURCES = {
    **_PARTY, **_GEO_COLUMNS, **_S_VALUES, "org_name": _ORG, "origin_country": "og.country",
    "phone": "ct.phone", "email": "ct.email", "site": "s.site", "address": "s.address",
    "site_identifier": "b.party || s.site"}
_SITE_JOINS = f"""
    LEFT JOIN id_type c ON c.origin = b.origin AND c.id_type_code = b.id_type_code
    LEFT JOIN origin og ON og.origin = s.origin
    LEFT JOIN sic ON sic.party = s.party
    {_geo('s', 's.origin', 's.country')}
    LEFT JOIN contacts ct ON ct.origin = og.origin AND ct.party = s.party AND ct.site = s.site
    LEFT JOIN account a ON a.origin = b.origin AND a.party = b.party"""
_SAME_SITE = "{0}.origin = s.origin AND {0}.party = s.party AND {0}.site = s.site"
_CUSTOMER_SOURCES = {
    **_PARTY, **_GEO_COLUMNS, **_C_VALUES, "business_model": _MODEL, "sic": "sic.sic",
    "party_status": "CASE b.status WHEN '1' THEN 'ACTIVO' WHEN '0' THEN 'INACTIVO' END",
    "account_number": "a.number", "account_type": "a.type", "account_status": "a.status",
    "origin_country": "og.country", "id_type_name": "it.name", "phone": "ct.phone",
    "email": "ct.email", "org_name": _ORG}


def _customer_joins(row: str, via: str) -> str:
    return f"""
    JOIN id_type it ON it.origin = b.origin AND it.id_type_code = b.id_type_code
    JOIN origin og ON og.origin = b.origin
    LEFT JOIN sic ON sic.party = b.party
    {_geo(row, row + '.origin', via)}
    LEFT JOIN contacts ct ON ct.origin = og.origin AND ct.party = b.party AND ct.site = {row}.site
    LEFT JOIN account a ON a.origin = b.origin AND a.party = b.party"""


def _row_sources(row: str) -> dict[str, str]:
    return {"site": f"{row}.site", "address": f"{row}.address", "site_name": f"{row}." + (
        "site_name" if row == "fs" else "name"), "site_status": f"{row}." + (
        "site_status" if row == "fs" else "status"), "site_identifier": f"{row}.party || {row}.site"}


REPORT_SQL = {
    "supplier_header": _report("supplier_header", _HEADER_SOURCES, f"""
        FROM chosen k JOIN party b
          ON b.tax_id = k.tax_id AND b.origin = k.origin AND b.party = k.party
        {_HEADER_JOINS}
        LEFT JOIN tax_metrics m ON m.tax_id = k.tax_id
        LEFT JOIN tax_orders o ON o.tax_id = k.tax_id
        LEFT JOIN tax_flags f ON f.tax_id = k.tax_id
        WHERE k.tax_id IN (SELECT tax_id FROM qualified)"""),
    "supplier_header_by_record": _report("supplier_header_by_record", _HEADER_SOURCES, f"""
        FROM base b {_HEADER_JOINS}
        LEFT JOIN id_type c ON c.origin = b.origin AND c.id_type_code = b.id_type_code
        LEFT JOIN account a ON a.origin = b.origin AND a.party = b.party
        LEFT JOIN record_metrics m ON m.origin = b.origin AND m.party = b.party
        LEFT JOIN record_orders o ON o.origin = b.origin AND o.party = b.party
        LEFT JOIN record_flags f ON f.origin = b.origin AND f.party = b.party
        WHERE (b.origin, b.party) IN (SELECT (origin, party) FROM qualified_records)"""),
    "supplier_site": _report(
        "supplier_site",
        {**_SITE_SOURCES, "site_codes": "codes.site_codes", "po_usage": "usage.po_usage"}, f"""
        FROM base b JOIN site s ON s.origin = b.origin AND s.party = b.party {_SITE_JOINS}
        LEFT JOIN codes ON {_SAME_SITE.format('codes')}
        LEFT JOIN usage ON {_SAME_SITE.format('usage')}
        LEFT JOIN site_metrics m ON {_SAME_SITE.format('m')}
        LEFT JOIN site_orders o ON {_SAME_SITE.format('o')}
        LEFT JOIN site_flags f ON {_SAME_SITE.format('f')}
        WHERE b.tax_id IN (SELECT tax_id FROM qualified)
          AND (s.status = '1' OR (s.status <> '1' AND coalesce(m.trx_op_bal_chf, 0) <> 0))
          AND (coalesce(m.trx_1y_amount_chf, 0) <> 0 OR coalesce(m.trx_2y_amount_chf, 0) <> 0
            OR coalesce(m.trx_op_bal_chf, 0) <> 0 OR coalesce(m.trx_1y_count, 0)
             + coalesce(m.trx_2y_count, 0) + coalesce(m.trx_op_count, 0)
             + coalesce(o.po_op_count, 0) + coalesce(o.po_2y_op_count, 0)
             + coalesce(o.po_agreement_count, 0) > 0)"""),
    "supplier_site_self_qualified": _report(
        "supplier_site_self_qualified",
        {**_SITE_SOURCES, "site_codes": "d.name", "po_usage":
            "CASE t.tag_code WHEN '7' THEN 'Purchasing, Payment' WHEN '3' THEN 'Payment' END"}, f"""
        FROM base b JOIN site s ON s.origin = b.origin AND s.party = b.party {_SITE_JOINS}
        LEFT JOIN site_tag t ON {_SAME_SITE.format('t')}
        LEFT JOIN tag_type d ON d.tag_group = t.tag_group AND d.tag_code = t.tag_code
            AND d.origin = s.origin AND d.tag_group = '9'
        LEFT JOIN site_metrics m ON {_SAME_SITE.format('m')}
        LEFT JOIN site_orders o ON {_SAME_SITE.format('o')}
        LEFT JOIN site_flags_any f ON {_SAME_SITE.format('f')}
        WHERE (s.origin, s.party, s.site) IN (SELECT (origin, party, site) FROM qualified_sites)
          AND (s.status = '1' OR (s.status <> '1' AND m.trx_op_bal_chf > 0))"""),
    "customer_header": _report("customer_header", {**_CUSTOMER_SOURCES, **_row_sources("fs")}, f"""
        FROM chosen k JOIN party b
          ON b.tax_id = k.tax_id AND b.origin = k.origin AND b.party = k.party
        JOIN first_site fs ON fs.origin = b.origin AND fs.party = b.party
        {_customer_joins('fs', 'pt.country')}
        LEFT JOIN tax_metrics m ON m.tax_id = k.tax_id
        WHERE k.tax_id IN (SELECT tax_id FROM qualified)"""),
    "customer_site": _report("customer_site", {**_CUSTOMER_SOURCES, **_row_sources("s")}, f"""
        FROM base b JOIN site s ON s.origin = b.origin AND s.party = b.party
        {_customer_joins('s', 's.country')}
        LEFT JOIN site_metrics m ON {_SAME_SITE.format('m')}
        WHERE b.tax_id IN (SELECT tax_id FROM qualified)
          AND (s.status = '1' OR (s.status <> '1' AND coalesce(m.open_balance, 0) > 0))
          AND ({' OR '.join(f'm.{c} <> 0' for c in _C_AMOUNT_NAMES)}
            OR {' OR '.join(f'm.{c} > 0' for c in _C_COUNT_NAMES)})"""),
}


def text_cells(name: str) -> list[str]:
    """The columns of a report that are taken from a text."""
    texts = {"name", "short_name", "address", "country_name", "state_name", "province_name", "district_name",
             "postal_code", "contact_name", "email", "url", "phone", "site_codes", "po_usage", "sic",
             "tax_registration", "account_number", "org_name", "site_name", "source_tag"}
    return [n for n, s in (x.split("=", 1) for x in COLUMNS[name].split()) if s in texts]


def cell_text(column: str, source: str) -> str:
    """A cell as text: dates without time, amounts with 11 places."""
    if source in ("created", "min_trx_date", "max_trx_date", "min_po_date", "max_po_date"):
        return f"strftime({column}, '%Y-%m-%d')"
    if source.endswith(("_amount_chf", "_bal_chf")) or source == "open_balance":
        return f"CAST(CAST({column} AS DECIMAL(38,11)) AS VARCHAR)"
    return f"CAST({column} AS VARCHAR)"


def batch_row(name: str) -> str:
    """One report's row of the batch check: its rows, filled text cells and their characters, and a sum over the hashes of whole rows."""
    cells = [f"coalesce({c}, '')" for c in text_cells(name)]
    filled = " + ".join(f"CAST({c} <> '' AS INTEGER)" for c in cells)
    chars = " + ".join(f"length({c})" for c in cells)
    texts = ", ".join(f"coalesce({cell_text(*x.split('=', 1))}, 'NULL')" for x in COLUMNS[name].split())
    return (f"SELECT '{name}' AS report, 'ok' AS status, count(*) AS rows, count(*) AS n_read, "
            f"CAST(sum({filled}) AS BIGINT) AS filled, CAST(sum({chars}) AS BIGINT) AS chars, "
            f"CAST(sum(CAST('0x' || substr(md5(concat_ws('|', {texts})), 1, 12) AS BIGINT)) AS VARCHAR) AS cells "
            f"FROM ({REPORT_SQL[name]})")


def exported_customer_header() -> str:
    """The customer header over parties with odd names, with dates as text."""
    dates = [n for n, s in (x.split("=", 1) for x in COLUMNS["customer_header"].split())
             if s in ("created", "min_trx_date", "max_trx_date")]
    odd = f"""SELECT * REPLACE ('  ' || name || ' "q", ' || short_name || chr(10) || ' ' AS name,
        CASE WHEN id_type_code % 2 <> 0 THEN short_name END AS short_name) FROM ({ctes("customer")["party"]})"""
    texts = ", ".join(f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates)
    return sql("customer", f"SELECT * REPLACE ({texts}) FROM ({REPORT_SQL['customer_header']})", {"party": odd})


def sql(role: str, body: str, instead: dict[str, str] | None = None) -> str:
    """``body`` with the CTEs it needs, in order; ``instead`` replaces some."""
    known = {**ctes(role), **_steps(role), **(instead or {})}
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"[a-z_0-9]+", text)) & known.keys() - needed:
            needed.add(word)
            visit(known[word])

    visit(body)
    # A step may only use steps listed before it, so listing order is a valid order.
    listed = ",\n".join(f"{n} AS ({known[n]})" for n in known if n in needed)
    return f"WITH {listed}\n{body}" if listed else body
