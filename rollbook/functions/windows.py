"""Date windows relative to ``as_of`` and code sets, as SQL conditions.

All bounds are literals, so they fold to constants and can be pushed down to the scan.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime


def moment(as_of: datetime) -> str:
    return f"TIMESTAMP_NTZ '{as_of.isoformat(sep=' ')}'"


def years_before(as_of: datetime, years: int) -> str:
    """``as_of`` minus whole years; keeps the time of day, 29 Feb becomes 28 Feb."""
    return f"({moment(as_of)} - INTERVAL '{years}' YEAR)"


def since(time: str, as_of: datetime, years: int) -> str:
    """No upper bound: documents dated after ``as_of`` count."""
    return f"{time} >= {years_before(as_of, years)}"


def between_half_open(time: str, as_of: datetime, oldest: int, newest: int) -> str:
    return (f"({time} >= {years_before(as_of, oldest)} AND "
            f"{time} < {years_before(as_of, newest)})")


def between_closed(time: str, as_of: datetime, oldest: int, newest: int) -> str:
    return (f"({time} >= {years_before(as_of, oldest)} AND "
            f"{time} <= {years_before(as_of, newest)})")


def quoted_text(code: object) -> str:
    if isinstance(code, int):
        return str(code)
    return "'" + str(code).replace("\\", "\\\\").replace("'", "\\'") + "'"


def one_of(column: str, codes: Iterable[object]) -> str:
    """Membership in a code set; an empty set has no members."""
    listed = ", ".join(quoted_text(c) for c in codes)
    return f"{column} IN ({listed})" if listed else "false"
