"""ERP-shaped tables derived from the TPC-H-like test tables (see FIXTURES.md).

Each function is a projection (or a small dictionary) of one stored table, so a job on stand-ins
scans and shuffles like one on real tables. Documents carry their origin by a rule on the party key,
so no join is needed to build them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.params import ORIGINS, Params

AS_OF = datetime(2001, 8, 2)
ORIGIN_CODES = [*ORIGINS, "F490101", "999"]


def params() -> Params:
    return Params(as_of=AS_OF)


_CODES = "array(" + ", ".join(f"'{c}'" for c in ORIGIN_CODES) + ")"


def _origin(key: str) -> str:
    return f"get({_CODES}, cast({key} div 3 % 8 AS int))"


def _code(value: str, width: int = 10) -> str:
    return f"lpad(cast({value} AS string), {width}, '0')"


class _OnDemand(Mapping):
    """Tables that are planned when first asked for, so a job opens only the files it needs."""

    def __init__(self, make: Mapping[str, Callable[[], DataFrame]]) -> None:
        self._make, self._made = make, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._make[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._make)

    def __len__(self) -> int:
        return len(self._make)


_Source = Mapping[str, DataFrame]
STORED = ("nation", "customer", "supplier", "orders", "lineitem", "events")


def _people(src: _Source, role: str) -> DataFrame:
    """Suppliers or customers under common names."""
    if role == "supplier":
        return src["supplier"].selectExpr(
            "s_suppkey AS k", "s_name AS full_name", "s_nationkey AS nation", "s_acctbal AS bal",
            f"{_origin('s_suppkey')} AS origin", f"{_code('s_suppkey')} AS party")
    return src["customer"].selectExpr(
        "c_custkey AS k",
        """concat(CASE c_mktsegment WHEN 'BUILDING' THEN 'Municipio '
            WHEN 'MACHINERY' THEN 'Clinica ESE ' WHEN 'FURNITURE' THEN 'E.S.P. ' ELSE '' END,
            c_name) AS full_name""",
        "c_nationkey AS nation", "c_acctbal AS bal",
        f"{_origin('c_custkey')} AS origin", f"{_code('c_custkey')} AS party")


def _party(src: _Source, role: str) -> DataFrame:
    return _people(src, role).selectExpr(
        "origin", "party",
        "concat(if(bal < -500, 'F', ''), cast(k div 2 AS string)) AS tax_id",
        "full_name AS name", "concat('P-', k) AS short_name",
        "TIMESTAMP_NTZ '1995-01-01 00:00:00' + make_dt_interval(cast(k % 3650 AS int)) AS created",
        "cast(k % 9 AS int) AS id_type_code",
        "if(bal > 9500, '0', '1') AS status")


def _party_class(src: _Source, role: str) -> DataFrame:
    own, other = ("2", "4") if role == "supplier" else ("4", "2")
    people = _people(src, role)
    main = people.selectExpr("origin", "party", "'6' AS tag_group",
                             f"if(k % 10 = 7, '{other}', '{own}') AS tag_code")
    again = people.where("bal BETWEEN 0 AND 1000").selectExpr(
        "origin", "party", "'6' AS tag_group", f"'{own}' AS tag_code")
    noise = people.selectExpr("origin", "party", "'9' AS tag_group", f"'{own}' AS tag_code")
    return main.unionByName(again).unionByName(noise)


def _site(src: _Source, role: str) -> DataFrame:
    last, active = (7, 4) if role == "supplier" else (4, 2)
    return (_people(src, role).selectExpr("*", f"explode(sequence(1, {last})) AS n").selectExpr(
        "origin", "party", f"{_code('n', 3)} AS site",
        f"""CASE WHEN n <= {active} AND k % 10 = 9 THEN '0' WHEN n = 1 AND k % 3 = 0 THEN '0'
            WHEN n <= {active} THEN '1' WHEN n < {last} THEN '0' WHEN k % 2 = 0 THEN '2'
            END AS status""",
        "concat('Site ', n) AS name", "concat('Street ', k, '-', n) AS address",
        "if(n = 3, '99', cast(nation AS string)) AS country",
        "cast(nation % 5 AS string) AS state", "cast(nation % 3 AS string) AS province",
        "cast(n AS string) AS district"))


def _supplier_document(src: _Source) -> DataFrame:
    return src["lineitem"].selectExpr(
        f"{_origin('l_suppkey')} AS origin", f"{_code('l_suppkey')} AS party",
        f"{_code('l_linenumber', 3)} AS site",
        """CASE WHEN l_returnflag = 'R' AND l_discount >= 0.095D AND l_tax < 0.005D
                     AND l_quantity >= 48 THEN get(array('EC','ER','SB','SD'), int(l_partkey % 4))
                WHEN l_returnflag = 'N' AND l_linestatus = 'O' AND l_discount < 0.005D THEN 'CX'
                WHEN l_returnflag = 'A'
                THEN get(array('FE','FD','DE','C2','FP','LG'), int(l_partkey % 6))
                WHEN l_returnflag = 'R'
                THEN get(array('NP','NA','M2','N2','NO','RG'), int(l_partkey % 6))
                ELSE get(array('OC','OS','AP','XX'), int(l_partkey % 4)) END AS type""",
        "if(l_tax >= 0.075D, '0', '1') AS status",
        "if(l_suppkey % 23 = 5, NULL, cast(l_extendedprice AS decimal(18,2))) AS amount",
        """cast(CASE WHEN l_linestatus = 'F' THEN 0D
                WHEN l_returnflag = 'N' AND l_quantity >= 45 THEN l_extendedprice
                WHEN l_quantity >= 50 AND l_discount < 0.035D THEN l_extendedprice
                WHEN l_quantity < 2 THEN -l_extendedprice ELSE 0D END AS decimal(18,2)) AS balance""",
        "l_shipdate - make_ym_interval(int(l_suppkey % 6)) AS created",
        "l_shipdate - make_ym_interval(int(l_suppkey % 6)) + INTERVAL '30' DAY AS due",
        "l_orderkey AS number")


def _customer_document(src: _Source) -> DataFrame:
    return src["orders"].selectExpr(
        f"{_origin('o_custkey')} AS origin", f"{_code('o_custkey')} AS party",
        f"{_code('o_orderkey % 4 + 1', 3)} AS site",
        """get(array('FA','ND','NC','AB','FV','AG','AN','XX'), int(o_orderkey div 4 % 8))
            AS type""",
        "if(o_orderstatus = 'F', '0', substring(o_orderpriority, 1, 1)) AS status",
        "if(o_custkey % 23 = 5, NULL, cast(o_totalprice AS decimal(18,2))) AS amount",
        """cast(CASE WHEN o_orderstatus = 'O' AND o_totalprice > 400000 THEN o_totalprice
                WHEN o_totalprice < 10000 THEN -o_totalprice ELSE 0D END AS decimal(18,2))
            AS balance""",
        "o_orderdate - make_ym_interval(int(o_custkey % 8)) AS created",
        "o_orderdate - make_ym_interval(int(o_custkey % 8)) + INTERVAL '30' DAY AS due",
        "o_orderkey AS number")


def _quote(src: _Source) -> DataFrame:
    return src["events"].selectExpr(
        f"{_origin('user_id')} AS origin", f"{_code('user_id')} AS party",
        "ts - make_ym_interval(22 + int(user_id % 10)) AS created",
        """CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 6 WHEN 'purchase' THEN 1
            WHEN 'signup' THEN 2 END AS status""")


def _contact_point(src: _Source, role: str) -> DataFrame:
    sites = 7 if role == "supplier" else 4
    return src["events"].selectExpr(
        f"{_origin('user_id')} AS origin", f"{_code('user_id')} AS party",
        f"{_code(f'event_id % {sites} + 1', 3)} AS site", f"{_code('event_id', 12)} AS code",
        """CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 1 WHEN 'error' THEN 2
            WHEN 'purchase' THEN 3 ELSE 4 END AS type""",
        "if(value < 100, '1', '0') AS status", "concat('n', event_id) AS number")


def _contact_person(src: _Source) -> DataFrame:
    return src["customer"].selectExpr(
        f"{_code('c_custkey div 5')} AS party", f"{_code('c_custkey % 3 + 1', 3)} AS site",
        "if(c_mktsegment = 'BUILDING', 'Director Ejecutivo', c_mktsegment) AS role",
        "c_name AS first_name", "if(c_acctbal >= 0, c_mktsegment, NULL) AS last_name")


def _account(src: _Source, role: str) -> DataFrame:
    people = _people(src, role)
    first = people.where("bal >= 0").selectExpr(
        "origin", "party", "concat('A', k) AS number", "concat('T', k % 3) AS type",
        "'1' AS status")
    second = people.where("k % 5 = 0").selectExpr(
        "origin", "party", "concat('B', k) AS number", "'T9' AS type", "'0' AS status")
    return first.unionByName(second)


def _party_param(src: _Source, role: str) -> DataFrame:
    people = _people(src, role)
    sic = people.where("bal > 2000").selectExpr(
        "party", "origin", "'7941' AS code", "concat('sic', k % 4) AS value")
    sic_elsewhere = people.where("k % 4 = 0").selectExpr(
        "party", "'999' AS origin", "'7941' AS code", "concat('alt', k % 4) AS value")
    tax = people.selectExpr("party", "if(k % 2 = 0, '011', origin) AS origin", "'140' AS code",
                            "concat('reg', k % 3) AS value")
    return sic.unionByName(sic_elsewhere).unionByName(tax)


def _site_tag(src: _Source) -> DataFrame:
    return src["lineitem"].selectExpr(
        f"{_origin('l_suppkey')} AS origin", f"{_code('l_suppkey')} AS party",
        f"{_code('l_linenumber', 3)} AS site", "if(l_tax < 0.055D, '9', '8') AS tag_group",
        "cast(l_partkey % 10 AS string) AS tag_code")


def _per_origin(src: _Source) -> DataFrame:
    """Nations repeated for every origin code: the base of the dictionaries."""
    return src["nation"].selectExpr("*", f"explode({_CODES}) AS origin")


_STATE_KEY = ["origin", "cast(n_nationkey AS string) AS country",
              "cast(n_nationkey % 5 AS string) AS state"]
_PROVINCE_KEY = [*_STATE_KEY, "cast(n_nationkey % 3 AS string) AS province"]


def _tag_type(src: _Source) -> DataFrame:
    tags = (_per_origin(src).groupBy("origin", F.expr("string(n_nationkey % 10)").alias("tag_code"))
            .agg(F.min("n_name").alias("name")))
    return tags.selectExpr("origin", "explode(array('9', '8')) AS tag_group", "tag_code",
                           "if(tag_code != '4', name, NULL) AS name")


def _origin_table(src: _Source) -> DataFrame:
    code = F.expr(f"get({_CODES}, n_nationkey % 8)")
    return (src["nation"].groupBy(code.alias("origin"))
            .agg(F.expr("string(min(n_nationkey))").alias("country"))
            .where("origin != 'F494151'"))


def _country(src: _Source) -> DataFrame:
    return src["nation"].selectExpr("string(n_nationkey) AS country", "n_name AS name")


def _state(src: _Source) -> DataFrame:
    return _per_origin(src).selectExpr(
        *_STATE_KEY, "concat(n_name, ' state') AS name", "if(n_regionkey = 2, '0', '1') AS status")


def _province(src: _Source) -> DataFrame:
    return _per_origin(src).selectExpr(*_PROVINCE_KEY, "concat(n_name, ' province') AS name")


def _district(src: _Source) -> DataFrame:
    return _per_origin(src).selectExpr("*", "explode(sequence(1, 5)) AS d").selectExpr(
        *_PROVINCE_KEY, "string(d) AS district", "concat(n_name, ' city ', d) AS name",
        "concat(n_nationkey, '-', d) AS postal_code")


def _id_type(src: _Source) -> DataFrame:
    return (_per_origin(src).groupBy("origin", F.expr("int(n_nationkey % 9)").alias("id_type_code"))
            .agg(F.min("n_name").alias("name")).where("id_type_code != 6"))


def _document(src: _Source, role: str) -> DataFrame:
    return _supplier_document(src) if role == "supplier" else _customer_document(src)


#: Tables that are the same for both sides.
_COMMON = {"quote": _quote, "contact_person": _contact_person, "site_tag": _site_tag,
           "origin": _origin_table, "country": _country, "state": _state,
           "province": _province, "district": _district, "id_type": _id_type,
           "tag_type": _tag_type}
COMMON = tuple(_COMMON)


def tables(spark: SparkSession, folder: str, role: str) -> Mapping[str, DataFrame]:
    """The 17 tables of one side (``supplier`` or ``customer``)."""
    src = _OnDemand({name: partial(spark.read.parquet, f"{folder}/{name}.parquet")
                     for name in STORED})
    by_role = {"party": _party, "party_class": _party_class, "site": _site, "document": _document,
               "party_param": _party_param, "contact_point": _contact_point, "account": _account}
    return _OnDemand({**{n: partial(f, src, role) for n, f in by_role.items()},
                      **{n: partial(f, src) for n, f in _COMMON.items()}})
