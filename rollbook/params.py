"""Run parameters. ``as_of`` has no default, so that a run can be repeated."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from decimal import Decimal

# Code sets and constants that the results depend on.
ORIGINS = ("011", "F490401", "F490411", "F491201", "F494101", "F494151")
CUSTOMER_EXCLUDED = ("0000000012", "0000000011", "F491201", "F490411", "F490401", "F490421")
SUPPLIER_EXCLUDED = CUSTOMER_EXCLUDED + ("2000022410", "2000103488")
RATE = Decimal("0.000210699")
GOVERNMENT_NAME_PATTERNS = (
    "%ALCALD%", "%MUNICIP%", "%GOBERN%", "%MINISTER%", "%PRESIDEN%", "%SECRETAR%",
    "%SUPERINTEND%", "%CONTRALOR%", "%PROCURAD%", "%PERSONER%", "%DEFENSOR%", "%REGISTRADUR%",
    "%DEPARTAMENTO%", "%E.S.E%", "% ESE %", "%E.S.P%", "% ESP %", "%SERVICIOS PUBLICOS%",
    "%BANCO DE LA REPUBLICA%", "%AUDITORIA GENERAL DE LA REPUBLICA%", "%CORPORACION AUTONOMA%",
    "%CORPORACION PARA%", "%AGENCIA LOGÍSTICA%", "%AGENCIA NACIONAL%", "%AGENCIA DE RENOVACION%",
    "%TERRITORIAL%", "%ATENEA%", "%UNTA CENTRAL DE CONTADORES%", "%SANIDAD%", "%ECOPETROL%",
    "%CENIT%", "%EMPRESA SOCIAL DEL ESTADO%", "%POLICIA%", "%EJERCITO%", "%ARMADA%",
    "%FUERZA AEREA%", "%FISCALIA%", "%RAM A JUDICIAL%", "%JUZGAD%", "%TRIBUNAL%",
)
B2G, B2B, B2C = ("B2G - Business To Government", "B2B - Business To Business",
                 "B2C - Business To Customers")
B2C_ID_TYPES = (3, 4, 7, 8)
CONTACT_ROLE = "Director Ejecutivo"
PARAM_SIC, PARAM_TAX_REGISTRATION = "7941", "140"
HOME_ORIGIN, HOME_ORG_NAME = "011", "F490101"
PHONE, EMAIL, URL = 1, 3, 4
SITE_CODE_GROUP = "9"
USAGE_BY_TAG = {"7": "Purchasing, Payment", "3": "Payment"}
STATUS_LABELS = {"1": "ACTIVO", "0": "INACTIVO"}


@dataclass(frozen=True)
class RoleCodes:
    """Code sets of one side (suppliers or customers)."""

    role: str
    class_code: str
    excluded_parties: tuple[str, ...]
    document_types: tuple[str, ...]
    open_types: tuple[str, ...]
    amount_plus: tuple[str, ...]
    amount_minus: tuple[str, ...]
    balance_plus: tuple[str, ...]
    balance_minus: tuple[str, ...]
    order_types: tuple[str, ...] = ()
    agreement_types: tuple[str, ...] = ()
    recent_types: tuple[str, ...] = ()
    excluding_types: tuple[str, ...] = ()
    class_group: str = "6"

    @property
    def read_types(self) -> tuple[str, ...]:
        """Every document type that some metric of this side looks at."""
        return tuple(sorted({*self.document_types, *self.order_types, *self.agreement_types,
                             *self.recent_types, *self.excluding_types}))


# Document types of each side.
SUPPLIER = RoleCodes(
    role="supplier", class_code="2", excluded_parties=SUPPLIER_EXCLUDED,
    document_types=("C2", "DE", "FD", "FE", "FP", "LG", "NO", "RG", "M2", "N2", "NA", "NP"),
    open_types=("C2", "DE", "FD", "FE", "FP", "LG", "NO", "RG", "M2", "N2", "NA", "NP"),
    amount_plus=("FE", "FD", "DE"), amount_minus=("NP", "NA"),
    balance_plus=("C2", "DE", "FD", "FE", "FP", "LG", "NO", "RG"),
    balance_minus=("M2", "N2", "NA", "NP"),
    order_types=("OC", "OS"), agreement_types=("CX",),
    recent_types=("AP", "C2", "FE", "FP", "NP", "NA", "DE", "NO"),
    excluding_types=("EC", "ER", "SB", "SD"),
)
CUSTOMER = RoleCodes(
    role="customer", class_code="4", excluded_parties=CUSTOMER_EXCLUDED,
    document_types=("AB", "AG", "AN", "FA", "FV", "NC", "ND"),
    open_types=("AB", "AG", "AN", "FA", "FV", "NC"),
    amount_plus=("FA", "ND"), amount_minus=("NC",),
    balance_plus=("FA", "FV"), balance_minus=("AB", "AG", "AN", "NC"),
)


@dataclass(frozen=True)
class Params:
    as_of: datetime
    rate: Decimal = RATE
    rate_outer: Decimal = RATE  # customer amounts are converted a second time; 1 switches it off
    origins: tuple[str, ...] = ORIGINS
    supplier: RoleCodes = field(default=SUPPLIER)
    customer: RoleCodes = field(default=CUSTOMER)
    quote_status_excluded: tuple[int, ...] = (0, 6)
    government_patterns: tuple[str, ...] = GOVERNMENT_NAME_PATTERNS

    def __post_init__(self) -> None:
        if self.as_of.tzinfo is not None:
            raise ValueError("as_of must be without a time zone, like the stored times")
