"""The stand-in tables in DuckDB SQL, one text per table and side."""

from __future__ import annotations

_CODES = "['011','F490401','F490411','F491201','F494101','F494151','F490101','999']"


def _origin(key: str) -> str:
    return f"{_CODES}[CAST(({key} // 3) % 8 AS INTEGER) + 1]"


def _code(value: str, width: int = 10) -> str:
    return f"lpad(CAST({value} AS VARCHAR), {width}, '0')"


def _text(value: str) -> str:
    return f"CAST({value} AS VARCHAR)"


def _people(role: str) -> str:
    if role == "supplier":
        return f"""SELECT s_suppkey AS k, s_name AS full_name, s_nationkey AS nation,
            s_acctbal AS bal, {_origin('s_suppkey')} AS origin, {_code('s_suppkey')} AS party
            FROM supplier"""
    return f"""SELECT c_custkey AS k, CASE c_mktsegment WHEN 'BUILDING' THEN 'Municipio '
            WHEN 'MACHINERY' THEN 'Clinica ESE ' WHEN 'FURNITURE' THEN 'E.S.P. ' ELSE '' END
            || c_name AS full_name, c_nationkey AS nation, c_acctbal AS bal,
            {_origin('c_custkey')} AS origin, {_code('c_custkey')} AS party FROM customer"""


def _document(role: str) -> str:
    if role == "supplier":
        return f"""
        SELECT {_origin('l_suppkey')} AS origin, {_code('l_suppkey')} AS party,
            {_code('l_linenumber', 3)} AS site,
            CASE WHEN l_returnflag = 'R' AND l_discount >= 0.095 AND l_tax < 0.005
                      AND l_quantity >= 48
                 THEN ['EC','ER','SB','SD'][CAST(l_partkey % 4 AS INTEGER) + 1]
                 WHEN l_returnflag = 'N' AND l_linestatus = 'O' AND l_discount < 0.005 THEN 'CX'
                 WHEN l_returnflag = 'A'
                 THEN ['FE','FD','DE','C2','FP','LG'][CAST(l_partkey % 6 AS INTEGER) + 1]
                 WHEN l_returnflag = 'R'
                 THEN ['NP','NA','M2','N2','NO','RG'][CAST(l_partkey % 6 AS INTEGER) + 1]
                 ELSE ['OC','OS','AP','XX'][CAST(l_partkey % 4 AS INTEGER) + 1] END AS type,
            CASE WHEN l_tax >= 0.075 THEN '0' ELSE '1' END AS status,
            CASE WHEN l_suppkey % 23 <> 5 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS amount,
            CAST(CASE WHEN l_linestatus = 'F' THEN 0
                 WHEN l_returnflag = 'N' AND l_quantity >= 45 THEN l_extendedprice
                 WHEN l_quantity >= 50 AND l_discount < 0.035 THEN l_extendedprice
                 WHEN l_quantity < 2 THEN -l_extendedprice ELSE 0 END AS DECIMAL(18,2)) AS balance,
            l_shipdate - to_years(CAST(l_suppkey % 6 AS INTEGER)) AS created,
            l_shipdate - to_years(CAST(l_suppkey % 6 AS INTEGER)) + INTERVAL 30 DAY AS due,
            l_orderkey AS number
        FROM lineitem"""
    return f"""
        SELECT {_origin('o_custkey')} AS origin, {_code('o_custkey')} AS party,
            {_code('(o_orderkey % 4 + 1)', 3)} AS site,
            ['FA','ND','NC','AB','FV','AG','AN','XX'][CAST(o_orderkey // 4 % 8 AS INTEGER) + 1] AS type,
            CASE WHEN o_orderstatus = 'F' THEN '0' ELSE substr(o_orderpriority, 1, 1) END AS status,
            CASE WHEN o_custkey % 23 <> 5 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS amount,
            CAST(CASE WHEN o_orderstatus = 'O' AND o_totalprice > 400000 THEN o_totalprice
                 WHEN o_totalprice < 10000 THEN -o_totalprice ELSE 0 END AS DECIMAL(18,2)) AS balance,
            o_orderdate - to_years(CAST(o_custkey % 8 AS INTEGER)) AS created,
            o_orderdate - to_years(CAST(o_custkey % 8 AS INTEGER)) + INTERVAL 30 DAY AS due,
            o_orderkey AS number
        FROM orders"""


def ctes(role: str) -> dict[str, str]:
    own, other = ("2", "4") if role == "supplier" else ("4", "2")
    last, active = (7, 4) if role == "supplier" else (4, 2)
    return {
        "people": _people(role),
        "nations": f"SELECT n.*, u.origin FROM nation n, (SELECT unnest({_CODES}) AS origin) u",
        "party": """
            SELECT origin, party,
                CASE WHEN bal < -500 THEN 'F' ELSE '' END || CAST(k // 2 AS VARCHAR) AS tax_id,
                full_name AS name, 'P-' || CAST(k AS VARCHAR) AS short_name,
                TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(k % 3650 AS INTEGER)) AS created,
                CAST(k % 9 AS INTEGER) AS id_type_code,
                CASE WHEN bal > 9500 THEN '0' ELSE '1' END AS status FROM people""",
        "party_class": f"""
            SELECT origin, party, '6' AS tag_group,
                CASE WHEN k % 10 = 7 THEN '{other}' ELSE '{own}' END AS tag_code FROM people
            UNION ALL SELECT origin, party, '6', '{own}' FROM people WHERE bal BETWEEN 0 AND 1000
            UNION ALL SELECT origin, party, '9', '{own}' FROM people""",
        "site": f"""
            SELECT origin, party, {_code('n', 3)} AS site,
                CASE WHEN n <= {active} AND (k % 10 = 9 OR (n = 1 AND k % 3 = 0)) THEN '0'
                     WHEN n <= {active} THEN '1' WHEN n < {last} THEN '0'
                     WHEN k % 2 = 0 THEN '2' END AS status,
                'Site ' || {_text('n')} AS name,
                'Street ' || {_text('k')} || '-' || {_text('n')} AS address,
                CASE WHEN n = 3 THEN '99' ELSE {_text('nation')} END AS country,
                {_text('nation % 5')} AS state, {_text('nation % 3')} AS province,
                {_text('n')} AS district
            FROM people, (SELECT unnest(range(1, {last + 1})) AS n)""",
        "document": _document(role),
        "quote": f"""
            SELECT {_origin('user_id')} AS origin, {_code('user_id')} AS party,
                ts - to_years(CAST(22 + user_id % 10 AS INTEGER)) AS created,
                CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 6 WHEN 'purchase' THEN 1
                     WHEN 'signup' THEN 2 END AS status FROM events""",
        "contact_point": f"""
            SELECT {_origin('user_id')} AS origin, {_code('user_id')} AS party,
                {_code(f'(event_id % {last} + 1)', 3)} AS site, {_code('event_id', 12)} AS code,
                CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 1 WHEN 'error' THEN 2
                     WHEN 'purchase' THEN 3 ELSE 4 END AS type,
                CASE WHEN value < 100 THEN '1' ELSE '0' END AS status,
                'n' || CAST(event_id AS VARCHAR) AS number FROM events""",
        "contact_person": f"""
            SELECT {_code('c_custkey // 5')} AS party, {_code('(c_custkey % 3 + 1)', 3)} AS site,
                CASE c_mktsegment WHEN 'BUILDING' THEN 'Director Ejecutivo'
                     ELSE c_mktsegment END AS role, c_name AS first_name,
                CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS last_name FROM customer""",
        "account": """
            SELECT origin, party, 'A' || CAST(k AS VARCHAR) AS number,
                'T' || CAST(k % 3 AS VARCHAR) AS type, '1' AS status FROM people WHERE bal >= 0
            UNION ALL SELECT origin, party, 'B' || CAST(k AS VARCHAR), 'T9', '0'
            FROM people WHERE k % 5 = 0""",
        "party_param": """
            SELECT party, origin, '7941' AS code, 'sic' || CAST(k % 4 AS VARCHAR) AS value
            FROM people WHERE bal > 2000
            UNION ALL SELECT party, '999', '7941', 'alt' || CAST(k % 4 AS VARCHAR)
            FROM people WHERE k % 4 = 0
            UNION ALL SELECT party, CASE WHEN k % 2 = 0 THEN '011' ELSE origin END, '140',
            'reg' || CAST(k % 3 AS VARCHAR) FROM people""",
        "site_tag": f"""
            SELECT {_origin('l_suppkey')} AS origin, {_code('l_suppkey')} AS party,
                {_code('l_linenumber', 3)} AS site,
                CASE WHEN l_tax < 0.055 THEN '9' ELSE '8' END AS tag_group,
                CAST(l_partkey % 10 AS VARCHAR) AS tag_code
            FROM lineitem""",
        "tag_type": """
            SELECT origin, tag_group, tag_code,
                CASE WHEN tag_code <> '4' THEN name END AS name
            FROM (SELECT origin, CAST(n_nationkey % 10 AS VARCHAR) AS tag_code, min(n_name) AS name
                  FROM nations GROUP BY ALL), (SELECT unnest(['9', '8']) AS tag_group)""",
        "origin": f"""
            SELECT * FROM (SELECT {_CODES}[CAST(n_nationkey % 8 AS INTEGER) + 1] AS origin,
                CAST(min(n_nationkey) AS VARCHAR) AS country FROM nation GROUP BY 1)
            WHERE origin <> 'F494151'""",
        "country": "SELECT CAST(n_nationkey AS VARCHAR) AS country, n_name AS name FROM nation",
        "state": """
            SELECT origin, CAST(n_nationkey AS VARCHAR) AS country,
                CAST(n_nationkey % 5 AS VARCHAR) AS state, n_name || ' state' AS name,
                CASE WHEN n_regionkey = 2 THEN '0' ELSE '1' END AS status FROM nations""",
        "province": """
            SELECT origin, CAST(n_nationkey AS VARCHAR) AS country,
                CAST(n_nationkey % 5 AS VARCHAR) AS state,
                CAST(n_nationkey % 3 AS VARCHAR) AS province, n_name || ' province' AS name
            FROM nations""",
        "district": """
            SELECT origin, CAST(n_nationkey AS VARCHAR) AS country,
                CAST(n_nationkey % 5 AS VARCHAR) AS state,
                CAST(n_nationkey % 3 AS VARCHAR) AS province, CAST(d AS VARCHAR) AS district,
                n_name || ' city ' || CAST(d AS VARCHAR) AS name,
                CAST(n_nationkey AS VARCHAR) || '-' || CAST(d AS VARCHAR) AS postal_code
            FROM nations, (SELECT unnest(range(1, 6)) AS d)""",
        "id_type": """
            SELECT origin, CAST(n_nationkey % 9 AS INTEGER) AS id_type_code, min(n_name) AS name
            FROM nations WHERE n_nationkey % 9 <> 6 GROUP BY 1, 2""",
    }
