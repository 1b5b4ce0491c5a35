"""Small hand-made ERP tables: only the rows a test is about."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rollbook.params import Params
from rollbook.schema import TABLES

AS_OF = datetime(2024, 6, 15, 10, 30)
RATE = Decimal("0.000210699")
DAY, TICK = timedelta(days=1), timedelta(microseconds=1)


def years_ago(n: int, as_of: datetime = AS_OF) -> datetime:
    return as_of.replace(year=as_of.year - n)


def params(as_of: datetime = AS_OF, **kw) -> Params:
    return Params(as_of=as_of, **kw)

_MADE: dict = {}  # tables by content; most of them are the same in every test


class World:
    def __init__(self) -> None:
        self.rows: dict[str, list[dict]] = {name: [] for name in TABLES}
        for origin in ("011", "F490401", "F490411"):
            self.add("origin", origin=origin, country="CO")
            for code in (1, 3, 5):
                self.add("id_type", origin=origin, id_type_code=code, name=f"type {code}")

    def add(self, table: str, **columns) -> World:
        self.rows[table].append(columns)
        return self

    def party(self, party: str, tax_id: str | None, origin: str = "011", sites=("001",),
              role: str = "2", **kw) -> World:
        self.add("party", **{**dict(
            party=party, tax_id=tax_id, origin=origin, name=f"name {party}",
            short_name=party.lower(), created=datetime(2010, 1, 1), id_type_code=1, status="1"), **kw})
        self.add("party_class", origin=origin, party=party, tag_group="6", tag_code=role)
        for s in sites:
            self.site(party, s, origin=origin)
        return self

    def customer(self, party: str, tax_id: str | None, **kw) -> World:
        return self.party(party, tax_id, role="4", **kw)

    def site(self, party: str, site: str, status: str | None = "1", origin: str = "011",
             **kw) -> World:
        return self.add("site", **{**dict(
            party=party, site=site, origin=origin, status=status, name=f"site {site}",
            address=f"street {site}", country="CO", state="1", province="2", district="3"), **kw})

    def doc(self, party: str, type: str, created: datetime | None = None, amount=100, balance=0,
            site: str = "001", origin: str = "011", status: str | None = "1",
            due: datetime | None = None, number: int = 0) -> World:
        created = AS_OF - 30 * DAY if created is None else created
        return self.add(
            "document", origin=origin, party=party, site=site, type=type, status=status,
            amount=None if amount is None else Decimal(amount),
            balance=None if balance is None else Decimal(balance), created=created,
            due=due or created, number=number)

    def qualify(self, party: str, **kw) -> World:
        """An open invoice, which qualifies a supplier or customer by open balance."""
        return self.doc(party, kw.pop("type", "FE"), balance=50, **kw)

    def tables(self, spark):
        other = {"contact_point.code": "string", "document.number": "bigint"}
        out = {}
        for name, (_, columns) in TABLES.items():
            types = [(c, other.get(f"{name}.{c}", kind) if kind is None else
                      ("string" if kind in ("code", "padded") else kind)) for _, c, kind in columns]
            rows = [tuple(r.get(c) for c, _ in types) for r in self.rows[name]]
            key = (name, repr(rows))
            if key not in _MADE:
                schema = StructType.fromDDL(", ".join(f"{c} {t}" for c, t in types))
                arrow = to_arrow_schema(schema)
                columns = list(zip(*rows)) or [[] for _ in types]
                _MADE[key] = spark.createDataFrame(pa.table(
                    [pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow), schema)
            out[name] = _MADE[key]
        return out


def rows(df, *columns: str) -> list[tuple]:
    """Rows as sorted tuples, NULLs first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()),
                  key=lambda t: tuple((x is not None, x if x is not None else 0) for x in t))


def chf(amount) -> Decimal:
    return Decimal(amount) * RATE
