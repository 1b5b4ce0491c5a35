"""Exact decimal conversion, as SQL expressions.

Amounts are summed unconverted at scale 2 and multiplied by the rate once per group. Decimal
multiplication distributes over the sum, so nothing is lost, and a row costs no decimal product.
"""

from __future__ import annotations

from decimal import Decimal

RATE_SCALE = 9


def convert(total: str, rate: Decimal) -> str:
    """``total * rate`` as ``decimal(38,11)``."""
    whole_digits = max(1, len(str(int(abs(rate)))))
    precision = RATE_SCALE + whole_digits
    return (f"cast({total} AS decimal({37 - precision},2)) * "
            f"cast('{rate:f}' AS decimal({precision},{RATE_SCALE}))")


def convert_twice(total: str, rate: Decimal, rate_outer: Decimal) -> str:
    """``round(total * rate * rate_outer, 6)`` as ``decimal(38,6)``, rounded once."""
    return f"round({convert(total, rate)} * cast('{rate_outer:f}' AS decimal(38,18)), 6)"
