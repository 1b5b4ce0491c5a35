"""Helpers for look-up joins."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, right: DataFrame, on: Mapping[str, str], take: Mapping[str, str],
           how: str = "left") -> DataFrame:
    """Join ``right`` on ``{left column: right column}`` and add ``{new column: right column}``.

    Several matches multiply rows, also when ``take`` is empty. No broadcast hint is given: the
    planner broadcasts a side only if its size is known to be under the session threshold, and
    adaptive execution does the same with measured sizes; otherwise both sides are shuffled.
    """
    keys = {f"__key{i}": r for i, r in enumerate(on.values())}
    side = right.selectExpr(*[f"{r} AS {k}" for k, r in keys.items()],
                            *[f"{r} AS {new}" for new, r in take.items()])
    match = " AND ".join(f"{left} = {k}" for left, k in zip(on, keys))
    return df.join(side, F.expr(match), how).drop(*keys)


COPIES = "copies"  # how often a row stands for itself, until repeat_rows
CHUNK = 10_000


def multiply(df: DataFrame, right: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """A left join of which only the row multiplicity matters.

    ``right`` is reduced to one count per key before the join, so a key with very many rows is one row;
    the product of the counts is carried in ``copies`` until :func:`repeat_rows`.
    """
    counted = right.groupBy(*on.values()).agg(F.expr("count(1) AS __n"))
    joined = lookup(df, counted, on, {"__found": "__n"})
    before = COPIES if COPIES in df.columns else "1L"
    return joined.withColumn(COPIES, F.expr(f"{before} * coalesce(__found, 1L)")).drop("__found")


def spread_lookup(df: DataFrame, right: DataFrame, on: Mapping[str, str],
                  take: Mapping[str, str]) -> DataFrame:
    """A left look-up whose right side may have any number of rows per key.

    Adaptive execution can split only the left side of a left join, but both of an inner one. So the left
    join is done as an inner half and an anti half in one: a first join with the distinct keys marks the left
    rows that have a match (one row per key, so only the left side can be hot, and be split); a second,
    inner one gives those their matches, and the others, whose key becomes NULL, the one row of NULLs that is added
    to the right side. Equal right rows are counted into ``copies`` before the shuffle. The left side is computed once.
    """
    keys = {f"__k{i}": r for i, r in enumerate(on.values())}
    rows = right.selectExpr(*[f"{r} AS {k}" for k, r in keys.items()],
                            *[f"{r} AS {new}" for new, r in take.items()]).dropna(subset=list(keys))
    # grouped by a bit of the keys too: so the join shuffles them on their own, and can split its left side
    bit = F.expr(f"xxhash64({', '.join(keys)}) & 1").alias("__bit")
    known = rows.select(*keys, bit).distinct().withColumn("__known", F.lit(True))
    rows = rows.groupBy(*rows.columns).agg(F.expr("count(1) AS __n"))
    kinds = dict(rows.dtypes)
    nothing = df.sparkSession.range(1).selectExpr(
        *[f"CAST(NULL AS {kinds[c]}) AS {c}" for c in [*keys, *take]], "1L AS __n")
    marked = lookup(df, known, dict(zip(on, keys)), {"__found": "__known"})
    marked = marked.withColumns({f"__m{i}": F.expr(f"if(__found, {left}, NULL)")
                                 for i, left in enumerate(on)}).drop("__found")
    match = " AND ".join(f"__m{i} <=> __k{i}" for i in range(len(on)))
    before = COPIES if COPIES in df.columns else "1L"
    joined = marked.join(rows.unionByName(nothing), F.expr(match))
    return (joined.withColumn(COPIES, F.expr(f"{before} * __n"))
            .drop("__n", *keys, *[f"__m{i}" for i in range(len(on))]))


def in_chunks(df: DataFrame) -> DataFrame:
    """Rows with a large count as several rows with at most ``CHUNK`` copies each, told apart by
    ``chunk``: done before an order, it lets the order spread them."""
    if COPIES not in df.columns:
        return df.withColumn("chunk", F.lit(0))
    return (df.withColumn("chunk", F.expr(f"explode(sequence(0L, ({COPIES} - 1) div {CHUNK}))"))
            .withColumn(COPIES, F.expr(f"least({CHUNK}L, {COPIES} - chunk * {CHUNK})")))


def repeat_rows(df: DataFrame) -> DataFrame:
    """Each row ``copies`` times; keeps the order, and needs no shuffle.

    Rows are produced in chunks, so a large count is never one large array. Without a count the
    rows are as they should be.
    """
    if COPIES not in df.columns:
        return df
    chunks = df.withColumn("__chunk", F.expr(
        f"explode(sequence(0L, ({COPIES} - 1) div {CHUNK}))"))
    return (chunks.withColumn("__copy", F.expr(
        f"explode(sequence(1L, least({CHUNK}L, {COPIES} - __chunk * {CHUNK})))"))
        .drop("__chunk", "__copy", COPIES))
