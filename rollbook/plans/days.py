"""Parts for any ``as_of`` from a roll-up of the documents by day.

All document measures are sums, counts, minima and maxima over windows that begin or end some whole years before
``as_of``. Within a day that holds no such edge, all documents are on the same side of each, so the roll-up
has one row per (origin, party, site, type, open or not, day), for the day of creation and, for open documents of customers,
for the day they are due. Days that hold an edge are read in detail, from a copy of the documents
that is laid out by month and sorted by day, so an edge is exact to the microsecond and no other month is touched. Another ``as_of``
reads the roll-up and its few edge days, never the documents.

Roll-ups are additive: one of further documents is appended to the same folder.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.functions.windows import one_of
from rollbook.operators.metrics import DAYS, live_documents, measures
from rollbook.params import Params, RoleCodes
from rollbook.schema import SITE

#: Whole years before ``as_of`` at which some window begins or ends.
EDGES = (1, 2, 5)
#: Documents of a month are spread over so many tasks before they are laid out.
SPREAD = 16
_MONEY = "decimal(28,2)"
DETAIL = ("origin string, party string, site string, type string, created timestamp_ntz, due timestamp_ntz, "
          "amount decimal(18,2), balance decimal(18,2), is_open boolean, day date, kind string, month string")


def _day(time: str) -> str:
    return f"CAST({time} AS DATE)"


def write_day_rollup(doc: DataFrame, p: Params, side: str, path: str, mode: str = "errorifexists") -> None:
    """Write the roll-up (``path/days``) and the detail by day (``path/detail``) of one side's documents."""
    codes: RoleCodes = getattr(p, side)
    rows = (live_documents(doc.where(one_of("origin", p.origins)), codes)
            .select(*SITE, "type", "created", "due", "amount", "balance"))
    keys = [*SITE, "type", "is_open", "kind", "day"]
    opened = rows.withColumn("is_open", F.expr("coalesce(balance > 0, false)"))
    by_created = opened.withColumn("kind", F.lit("created")).withColumn("day", F.expr(_day("created")))
    by_due = opened.where("is_open").withColumn("kind", F.lit("due")).withColumn("day", F.expr(_day("due")))
    both = by_created if side == "supplier" else by_created.unionByName(by_due)
    sums = both.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.expr("sum(amount) AS amount"), F.expr("sum(balance) AS balance"),
        F.expr("min(created) AS first"), F.expr("max(created) AS last"))
    sums.write.mode(mode).parquet(f"{path}/days")
    # rows without a day lie on no edge
    detail = both.where("day IS NOT NULL").withColumns({
        "month": F.expr("date_format(day, 'yyyy-MM')"), "spread": F.expr(f"pmod(xxhash64(party, created, amount), {SPREAD})")})
    (detail.repartition("kind", "month", "spread").drop("spread").sortWithinPartitions("kind", "month", "day")
     .write.mode(mode).partitionBy("kind", "month").parquet(f"{path}/detail"))


def edge_days(as_of: datetime) -> list[date]:
    """Days of which some documents may be before an edge and others not."""
    def before(years: int) -> date:
        try:
            return as_of.replace(year=as_of.year - years).date()
        except ValueError:  # 29 Feb becomes 28 Feb, as in the windows
            return as_of.replace(year=as_of.year - years, day=28).date()

    return sorted({before(n) for n in EDGES})


def parts_from_days(spark: SparkSession, path: str, p: Params, side: str) -> DataFrame:
    """The parts of ``report_parts`` for the ``as_of`` of ``p``, from a roll-up."""
    codes: RoleCodes = getattr(p, side)
    edges = ", ".join(f"DATE '{d}'" for d in edge_days(p.as_of))
    months = ", ".join(sorted({f"'{d:%Y-%m}'" for d in edge_days(p.as_of)}))
    days = spark.read.parquet(f"{path}/days")
    # null days stay: they are in no window
    rolled = days.where(f"coalesce(day NOT IN ({edges}), true)").selectExpr(
        *SITE, "type", "is_open", "kind", "CAST(day AS TIMESTAMP_NTZ) AS time", "n",
        f"CAST(amount AS {_MONEY}) AS amount", f"CAST(balance AS {_MONEY}) AS balance", "first", "last")
    # one filter leaves the folders of a few months, the other reaches the scan
    detail = spark.read.option("basePath", f"{path}/detail").schema(DETAIL).parquet(f"{path}/detail")
    exact = detail.where(f"month IN ({months})").where(f"day IN ({edges})").selectExpr(
        *SITE, "type", "is_open", "kind", "if(kind = 'due', due, created) AS time", "1L AS n",
        f"CAST(amount AS {_MONEY}) AS amount", f"CAST(balance AS {_MONEY}) AS balance", "created AS first", "created AS last")
    rows, aggregates = measures(p, codes, DAYS)
    return (rolled.unionByName(exact)
            .selectExpr(*SITE, "n", "kind", "first", "last", *[f"{e} AS {n}" for n, e in rows.items()])
            .groupBy(*SITE).agg(*[F.expr(f"{e} AS {n}") for n, e in aggregates.items()]))
