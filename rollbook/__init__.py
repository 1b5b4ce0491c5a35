"""Party reports over ERP tables, written as PySpark DataFrame jobs."""

from rollbook.params import Params, RoleCodes

__all__ = ["Params", "RoleCodes"]
