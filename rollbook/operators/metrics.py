"""Document metrics.

Every metric is a sum, count, minimum or maximum over documents, so all of them roll up. The
document table is read once and aggregated to one row per (origin, party, site) — the *parts* — with
a partial aggregation before the only wide shuffle, so a party or site that owns a large share of
all documents costs one row per input partition. Joins with sites and parties then run on parts.
Operators below take parts (or joined parts) and group them by any keys; columns that an operator
does not use are pruned back through the aggregation to the scan.

Parts hold unconverted amounts; conversion and rounding come after the last sum.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions.money import convert, convert_twice
from rollbook.functions.windows import between_closed, between_half_open, one_of, since
from rollbook.params import Params, RoleCodes
from rollbook.schema import RECORD, SITE

@dataclass(frozen=True)
class Form:
    """How the rows look that are measured: documents, or sums of documents of one day (``plans.days``).

    Sums have a ``kind``: by day of creation, which is what counts, or by the day they are due.
    """

    created: str = "created"
    due: str = "due"
    is_open: str = "balance > 0"
    money: str = "decimal(18,2)"
    summed: bool = False

    def _of(self, test: str | None, kind: str = "created") -> str:
        return " AND ".join([f"kind = '{kind}'"] * self.summed + [test] * bool(test)) or "true"

    def signed(self, value: str, plus: Sequence[str], minus: Sequence[str]) -> str:
        return (f"CASE WHEN {one_of('type', plus)} THEN {value} "
                f"WHEN {one_of('type', minus)} THEN cast(-{value} AS {self.money}) "
                f"ELSE cast(0 AS {self.money}) END")

    def sum_if(self, test: str, value: str) -> str:
        total = f"sum(CASE WHEN {self._of(test)} THEN {value} ELSE cast(0 AS {self.money}) END)"
        return f"cast({total} AS decimal(28,2))" if self.summed else total

    def count_if(self, test: str | None = None, kind: str = "created") -> str:
        if self.summed:
            return f"sum(CASE WHEN {self._of(test, kind)} THEN n ELSE 0L END)"
        return f"count_if({test})" if test else "count(1)"

    def first(self, test: str | None = None) -> str:
        return f"min(CASE WHEN {self._of(test)} THEN {'first' if self.summed else 'created'} END)"

    def last(self, test: str | None = None) -> str:
        return f"max(CASE WHEN {self._of(test)} THEN {'last' if self.summed else 'created'} END)"


DOCUMENTS = Form()
DAYS = Form(created="time", due="time", is_open="is_open", money="decimal(28,2)", summed=True)


def live_documents(doc: DataFrame, codes: RoleCodes) -> DataFrame:
    """Documents that any metric of this side reads: of a known type and not void.

    The tests are on stored columns, so they reach the file scan.
    """
    return doc.where("status != '0'").where(one_of("type", codes.read_types))


def _supplier_measures(p: Params, f: Form) -> tuple[dict[str, str], dict[str, str]]:
    """Row columns (evaluated once per document) and the aggregates over them."""
    c = p.supplier
    rows = {
        "typed": one_of("type", c.document_types),
        "invoice": one_of("type", c.amount_plus),
        "purchase": one_of("type", c.order_types),
        "agreement": one_of("type", c.agreement_types),
        "recent": one_of("type", c.recent_types),
        "excluding": one_of("type", c.excluding_types),
        "is_open": f.is_open,
        "in_1y": since(f.created, p.as_of, 1),
        "in_2y": since(f.created, p.as_of, 2),
        "in_year_2": between_half_open(f.created, p.as_of, 2, 1),
        "signed_amount": f.signed("amount", c.amount_plus, c.amount_minus),
        "signed_balance": f.signed("balance", c.balance_plus, c.balance_minus),
    }
    return rows, {
        "sum_1y": f.sum_if("in_1y", "signed_amount"),
        "sum_2y": f.sum_if("in_year_2", "signed_amount"),
        "sum_open_balance": f.sum_if("is_open", "signed_balance"),
        "n_typed": f.count_if("typed"),
        "n_1y": f.count_if("typed AND in_1y"),
        "n_2y": f.count_if("typed AND in_year_2"),
        "n_open": f.count_if("typed AND is_open"),
        "min_created": f.first("typed"),
        "max_created": f.last("typed"),
        "n_invoice_1y": f.count_if("invoice AND in_1y"),
        "n_invoice_2y": f.count_if("invoice AND in_2y"),
        "n_invoice_old_open": f.count_if("invoice AND is_open AND NOT in_2y"),
        "n_order_any_2y": f.count_if("purchase AND in_2y"),
        "n_order_1y": f.count_if("purchase AND is_open AND in_1y"),
        "n_order_2y": f.count_if("purchase AND is_open AND in_2y"),
        "n_order": f.count_if("purchase AND is_open"),
        "min_order": f.first("purchase AND is_open"),
        "max_order": f.last("purchase AND is_open"),
        "n_agreement": f.count_if("agreement AND is_open"),
        "n_recent_2y": f.count_if("recent AND in_2y"),
        "n_excluding": f.count_if("excluding"),
    }


def _customer_measures(p: Params, f: Form) -> tuple[dict[str, str], dict[str, str]]:
    c = p.customer
    rows = {
        "is_open": f.is_open,
        "openable": one_of("type", c.open_types),
        "charge": one_of("type", c.amount_plus),
        "moving": one_of("type", c.amount_plus + c.amount_minus),
        "due_in_2y": since(f.due, p.as_of, 2),
        "in_2y": since(f.created, p.as_of, 2),
        "in_5y": since(f.created, p.as_of, 5),
        "in_2y5": between_closed(f.created, p.as_of, 5, 2),
        "signed_amount": f.signed("amount", c.amount_plus, c.amount_minus),
        "signed_open": f.signed("balance", c.amount_plus, c.amount_minus),
        "signed_balance": f.signed("balance", c.balance_plus, c.balance_minus),
    }
    return rows, {
        "sum_0y2": f.sum_if("in_2y", "signed_amount"),
        "sum_2y5": f.sum_if("in_2y5", "signed_amount"),
        "sum_open": f.sum_if("is_open", "signed_open"),
        "sum_open_balance": f.sum_if("is_open", "signed_balance"),
        "n_typed": f.count_if(),
        "n_0y2": f.count_if("in_2y"),
        "n_2y5": f.count_if("in_2y5"),
        "n_open_due": f.count_if("is_open AND due_in_2y AND openable", "due"),
        "n_open": f.count_if("is_open AND openable"),
        "min_created": f.first(),
        "max_created": f.last(),
        "n_charge_open": f.count_if("charge AND is_open"),
        "n_moving_2y": f.count_if("moving AND in_2y"),
        "n_moving_5y": f.count_if("moving AND in_5y"),
    }


def measures(p: Params, codes: RoleCodes, form: Form = DOCUMENTS) -> tuple[dict[str, str], dict[str, str]]:
    """Row columns and aggregates of one side."""
    return (_supplier_measures if codes.role == "supplier" else _customer_measures)(p, form)


def site_parts(doc: DataFrame, p: Params, codes: RoleCodes) -> DataFrame:
    """All measures of one side per (origin, party, site), in one pass over the documents."""
    rows, aggregates = measures(p, codes)
    return (live_documents(doc, codes)
            .selectExpr(*SITE, "created", *[f"{e} AS {n}" for n, e in rows.items()])
            .groupBy(*SITE).agg(*[F.expr(f"{e} AS {n}") for n, e in aggregates.items()]))


def at_two_grains(parts: DataFrame) -> DataFrame:
    """The same parts for a plan that uses them at two grains.

    Each use would keep columns of its own, and so aggregate the documents on its own. Here all columns count as
    used, by a test that every row passes, which makes the uses alike up to the shuffle, and the planner runs it
    once and reads it twice. The row number in the test keeps the planner from deriving conditions from it.
    """
    return parts.where(f"xxhash64({', '.join(parts.columns)}) >= -9223372036854775808BD "
                       "OR monotonically_increasing_id() < 0")


def roll_up(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Parts of coarser keys. Row multiplicity of the input counts, as it does for documents."""
    again = {"sum": "sum", "n": "sum", "min": "min", "max": "max"}
    measures = [(c, again[c.partition("_")[0]]) for c in parts.columns
                if c.partition("_")[0] in again]
    return parts.groupBy(*keys).agg(*[F.expr(f"{f}({c}) AS {c}") for c, f in measures])


def in_valid_sites(parts: DataFrame, site: DataFrame) -> DataFrame:
    """Parts of valid sites: an active row, or an inactive ('0') row and an open document.

    The open-document test is a measure of the parts, so documents are not read again.
    """
    known = (site.where("status IN ('0', '1')").groupBy(*SITE)
             .agg(F.expr("max(status = '1') AS active")))
    return parts.join(known, SITE).where("active OR n_open > 0").drop("active")


def record_parts(parts: DataFrame, site: DataFrame) -> DataFrame:
    """Parts per (origin, party) over valid sites."""
    return roll_up(in_valid_sites(parts, site), RECORD)


def base_record_parts(parts: DataFrame, site: DataFrame, base: DataFrame) -> DataFrame:
    """Record parts of base parties, with their tax id; a repeated base row repeats its parts."""
    return record_parts(parts, site).join(base.select(*RECORD, "tax_id"), RECORD)


# --- metric operators ----------------------------------------------------------------------------

def _amount(total: str) -> str:
    """Zero if all amounts of the group are NULL."""
    return f"coalesce({total}, 0)"


def _supplier_columns(p: Params, open_orders: bool = True) -> dict[str, str]:
    return {
        "trx_1y_amount_chf": _amount(convert("sum_1y", p.rate)),
        "trx_2y_amount_chf": _amount(convert("sum_2y", p.rate)),
        "trx_op_bal_chf": _amount(convert("sum_open_balance", p.rate)),
        "trx_1y_count": "n_1y",
        "trx_2y_count": "n_2y",
        "trx_op_count": "n_open",
        **_DATES,
        "has_inv_1y": "n_invoice_1y > 0",
        "has_inv_2y": "n_invoice_2y > 0",
        "has_inv_op_old": "n_invoice_old_open > 0",
        "has_po_2y": "n_order_2y > 0" if open_orders else "n_order_any_2y > 0",
        "po_1y_op_count": "n_order_1y",
        "po_2y_op_count": "n_order_2y",
        "po_op_count": "n_order",
        "min_po_date": "min_order",
        "max_po_date": "max_order",
        "po_agreement_count": "n_agreement",
        "doc_count_2y": "n_invoice_2y",
    }


def _customer_columns(p: Params) -> dict[str, str]:
    return {
        "tot_trx_0y2_amount_chf": _amount(convert_twice("sum_0y2", p.rate, p.rate_outer)),
        "tot_trx_2y5_amount_chf": _amount(convert_twice("sum_2y5", p.rate, p.rate_outer)),
        "tot_trx_op_amount_chf": _amount(convert_twice("sum_open", p.rate, p.rate_outer)),
        "open_balance": _amount(convert("sum_open_balance", p.rate)),
        "doc_trx_0y2_count": "n_0y2",
        "doc_trx_2y5_count": "n_2y5",
        "doc_trx_op_count": "n_open_due",
        **_DATES,
        "has_op_trx": "n_charge_open > 0",
        "has_trx_02y": "n_moving_2y > 0",
        "has_trx_5y": "n_moving_5y > 0",
    }


_DATES = {
    "min_trx_date": "min_created",
    "max_trx_date": "max_created",
    # The year grows with the date, so the year of the minimum is the minimum year.
    "min_trx_year": "bigint(year(min_created))",
    "max_trx_year": "bigint(year(max_created))",
}


def _finish(grouped: DataFrame, keys: Sequence[str], columns: dict[str, str],
            names: Sequence[str] | None = None) -> DataFrame:
    return grouped.selectExpr(*keys, *[f"{columns[n]} AS {n}" for n in (names or columns)])


def _grouped(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Parts per ``keys``; site parts are already grouped."""
    return parts if list(keys) == SITE else roll_up(parts, keys)


def _typed(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _grouped(parts, keys).where("n_typed > 0")


def period_amounts(parts: DataFrame, keys: Sequence[str], p: Params, codes: RoleCodes) -> DataFrame:
    """Signed amounts per window. Supplier windows do not touch; customer windows share an instant."""
    if codes.role == "supplier":
        return _finish(_typed(parts, keys), keys, _supplier_columns(p),
                       ["trx_1y_amount_chf", "trx_2y_amount_chf"])
    return _finish(_typed(parts, keys), keys, _customer_columns(p),
                   ["tot_trx_0y2_amount_chf", "tot_trx_2y5_amount_chf", "tot_trx_op_amount_chf"])


def open_balance(parts: DataFrame, keys: Sequence[str], p: Params) -> DataFrame:
    """Signed sum of positive balances, converted once."""
    return _finish(_typed(parts, keys), keys,
                   {"open_balance": _amount(convert("sum_open_balance", p.rate))})


def document_counts(parts: DataFrame, keys: Sequence[str], p: Params, codes: RoleCodes) -> DataFrame:
    """Counts of all typed documents, also of those that add nothing to the amounts."""
    if codes.role == "supplier":
        return _finish(_typed(parts, keys), keys, _supplier_columns(p),
                       ["trx_1y_count", "trx_2y_count", "trx_op_count"])
    return _finish(_typed(parts, keys), keys, _customer_columns(p),
                   ["doc_trx_0y2_count", "doc_trx_2y5_count", "doc_trx_op_count"])


def document_date_range(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _finish(_typed(parts, keys), keys, _DATES)


def supplier_flags(parts: DataFrame, keys: Sequence[str], p: Params,
                   open_orders: bool = True) -> DataFrame:
    return _finish(_grouped(parts, keys), keys, _supplier_columns(p, open_orders),
                   ["has_inv_1y", "has_inv_2y", "has_inv_op_old", "has_po_2y"])


def customer_flags(parts: DataFrame, keys: Sequence[str], p: Params) -> DataFrame:
    return _finish(_typed(parts, keys), keys, _customer_columns(p),
                   ["has_op_trx", "has_trx_02y", "has_trx_5y"])


def order_metrics(parts: DataFrame, keys: Sequence[str], p: Params) -> DataFrame:
    """Open purchase orders by window, their dates, and open agreements."""
    return _finish(_grouped(parts, keys), keys, _supplier_columns(p),
                   ["po_1y_op_count", "po_2y_op_count", "po_op_count", "min_po_date",
                    "max_po_date", "po_agreement_count"])


def invoice_count(parts: DataFrame, keys: Sequence[str], p: Params) -> DataFrame:
    """Invoices in two years; groups without one are absent."""
    return (_finish(roll_up(parts, keys), keys, _supplier_columns(p), ["doc_count_2y"])
            .where("doc_count_2y > 0"))


SUPPLIER_TRX = ["trx_1y_amount_chf", "trx_2y_amount_chf", "trx_op_bal_chf", "trx_1y_count",
                "trx_2y_count", "trx_op_count", "min_trx_date", "max_trx_date", "min_trx_year",
                "max_trx_year"]


def supplier_metrics(parts: DataFrame, keys: Sequence[str], p: Params) -> DataFrame:
    """Amounts, open balance, counts and dates per key (tax id, record or site)."""
    return _finish(_typed(parts, keys), keys, _supplier_columns(p), SUPPLIER_TRX)


def customer_metrics(parts: DataFrame, keys: Sequence[str], p: Params) -> DataFrame:
    """The customer metrics and flags per key, from the same pass."""
    return _finish(_typed(parts, keys), keys, _customer_columns(p))


def all_supplier_columns(grouped: DataFrame, keys: Sequence[str], p: Params,
                         open_orders: bool = True) -> DataFrame:
    """Every supplier metric, order metric and flag of grouped parts, one row per group."""
    return _finish(grouped, keys, _supplier_columns(p, open_orders))


AMOUNTS_AND_COUNTS = {
    "supplier": ["trx_1y_amount_chf", "trx_2y_amount_chf", "trx_op_bal_chf", "trx_1y_count",
                 "trx_2y_count", "trx_op_count", "po_1y_op_count", "po_2y_op_count",
                 "po_op_count", "po_agreement_count"],
    "customer": ["tot_trx_0y2_amount_chf", "tot_trx_2y5_amount_chf", "tot_trx_op_amount_chf",
                 "doc_trx_0y2_count", "doc_trx_2y5_count", "doc_trx_op_count"],
}


def attach_metrics(df: DataFrame, metrics: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join; missing amounts and counts become zero, missing dates and flags stay NULL."""
    filled = {*AMOUNTS_AND_COUNTS["supplier"], *AMOUNTS_AND_COUNTS["customer"]}
    joined = df.join(metrics, list(keys), "left")
    values = set(metrics.columns) & filled
    return joined.selectExpr(
        *[f"coalesce({c}, 0) AS {c}" if c in values else c for c in joined.columns])
