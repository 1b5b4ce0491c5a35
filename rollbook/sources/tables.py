"""Readers for the ERP tables."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.schema import CODE, PADDED, TABLES

FETCH_ROWS = 5000


def conform(stored: DataFrame, table: str, trim: Collection[str] = (PADDED,)) -> DataFrame:
    """Our column names and types for one stored table.

    Columns of the kinds in ``trim`` lose their trailing blanks once here: none of them if the data is
    stored without padding, codes too if all of them come from fixed-width columns. Codes are
    otherwise taken as they are, as a trimmed column hides its filters from the file scan.
    """
    def column(source: str, kind: str | None) -> Column:
        value = F.col(source)
        if kind is None:
            return value
        if kind in trim:
            return F.rtrim(value.cast("string"))
        return value.cast("string" if kind in (CODE, PADDED) else kind)

    return stored.select(*[column(s, kind).alias(name) for s, name, kind in TABLES[table][1]])


def load_tables(spark: SparkSession, location: str, trim: Collection[str] = (PADDED,),
                names: Iterable[str] | None = None,
                read: Callable[[str], DataFrame] | None = None) -> dict[str, DataFrame]:
    """The ERP tables (all 17, or ``names``) from ``location/<stored name>`` in Parquet.

    ``read`` replaces the Parquet reader, for example with :func:`partitioned_read` on a database.
    Nothing is read until a report runs.
    """
    read = read or (lambda stored: spark.read.parquet(f"{location}/{stored}"))
    return {name: conform(read(TABLES[name][0]), name, trim)
            for name in (names or TABLES)}


def quantile_cuts(keys: DataFrame, column: str, pieces: int, accuracy: int = 10_000) -> list[int]:
    """Places that cut the rows, not the key's range, into ``pieces`` of about the same size.

    ``keys`` needs no other column: the key alone is read, from the table itself or from an earlier extract of it. The quantiles are
    approximate (off by a share of 1 / ``accuracy`` of the rows at most) and merged from all
    partitions; only they come to the driver. A key that holds more rows than a piece is never cut.
    """
    if pieces < 1:
        raise ValueError("need at least one piece")
    shares = [i / pieces for i in range(1, pieces)]
    found = keys.agg(F.percentile_approx(F.col(column).cast("bigint"), shares, accuracy)).first()[0] if shares else None
    return sorted(set(found or ()))


def cut_predicates(column: str, cuts: Sequence[int]) -> list[str]:
    """One more disjoint conditions than ``cuts`` that together hold for every row.

    The outer pieces are open-ended and the first one takes NULLs, so cuts that do not fit the
    data cost balance, never rows.
    """
    cuts = sorted(set(cuts))
    if not cuts:
        return ["1 = 1"]
    first = f"({column} < {cuts[0]} OR {column} IS NULL)"
    inner = [f"({column} >= {a} AND {column} < {b})" for a, b in zip(cuts, cuts[1:])]
    return [first, *inner, f"({column} >= {cuts[-1]})"]


def range_predicates(column: str, lower: int, upper: int, pieces: int) -> list[str]:
    """``pieces`` conditions of equal width on an integer column, for a key without gaps."""
    if pieces < 1 or upper <= lower:
        raise ValueError("need at least one piece and lower < upper")
    return cut_predicates(column, sorted({lower + (upper - lower) * i // pieces for i in range(1, pieces)} - {lower}))


def partitioned_read(spark: SparkSession, options: Mapping[str, str], column: str, lower: int = 0,
                     upper: int = 0, pieces: int = 1, cuts: Sequence[int] | None = None) -> DataFrame:
    """Read a database table in bounded pieces, one task and connection per piece.

    Pieces lie between ``cuts`` (:func:`quantile_cuts`), or are ``pieces`` of equal width from ``lower`` to ``upper``.
    ``options`` are the caller's JDBC options (url, dbtable, user, password, driver, …). The driver
    fetches 5,000 rows at a time unless ``fetchsize`` says otherwise; column pruning and filters
    are sent to the database.
    """
    rest = {k: str(v) for k, v in options.items() if k not in ("url", "dbtable")}
    tests = range_predicates(column, lower, upper, pieces) if cuts is None else cut_predicates(column, cuts)
    return spark.read.jdbc(
        options["url"], options["dbtable"], predicates=tests,
        properties={"fetchsize": str(FETCH_ROWS), **rest})


def _tagged(df: DataFrame, tests: Sequence[str]) -> DataFrame:
    return df.withColumn("piece", F.coalesce(*[F.when(F.expr(test), i) for i, test in enumerate(tests)]))


def tag_pieces(df: DataFrame, column: str, lower: int, upper: int, pieces: int) -> DataFrame:
    """The piece each row falls into, for checking bounds against data before a long read."""
    return _tagged(df, range_predicates(column, lower, upper, pieces))


def tag_cuts(df: DataFrame, column: str, cuts: Sequence[int]) -> DataFrame:
    """The same for cuts."""
    return _tagged(df, cut_predicates(column, cuts))
