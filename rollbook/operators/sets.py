"""Sets, de-duplication, order and limit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollbook.operators.joins import sites_with_open_documents
from rollbook.operators.lookup import in_chunks
from rollbook.params import RoleCodes
from rollbook.schema import SITE


def valid_sites(site: DataFrame, doc: DataFrame, codes: RoleCodes) -> DataFrame:
    """Distinct active sites, and inactive ('0') ones with an open document.

    Reports use :func:`rollbook.operators.metrics.in_valid_sites`, which gives the same set from
    the parts without a second look at the documents.
    """
    active = site.where("status = '1'").select(*SITE)
    inactive = site.where("status = '0'").select(*SITE)
    return active.unionByName(
        sites_with_open_documents(inactive, doc, codes.open_types)).distinct()


def dedupe_by_tax_id(base: DataFrame) -> DataFrame:
    """One record per tax id: smallest origin, then smallest party code.

    The rank filter also runs before the shuffle, so a tax id shared by many records sends one row
    per partition.
    """
    order = Window.partitionBy("tax_id").orderBy("origin", "party")
    return (base.withColumn("rank", F.row_number().over(order)).where("rank = 1")
            .drop("rank"))


def order_sites(df: DataFrame, *then: str) -> DataFrame:
    """By tax id, party and site, then by ``then`` and chunk, so that the rows of one site, however
    many, differ in the order and can be sorted in several tasks."""
    return in_chunks(df).orderBy("tax_id", "party", "site", *then, "chunk").drop("chunk")


def order_by_party(df: DataFrame, *then: str) -> DataFrame:
    """By party code; site, ``then`` and chunk make the order stable and let it be split."""
    return in_chunks(df).orderBy("party", "site", *then, "chunk").drop("chunk")


def limit_report(df: DataFrame, n: int | None) -> DataFrame:
    """First ``n`` rows of a report for a trial run; 0 or None means all. Reports repeat rows after
    their order, so an ordered report is sorted as a whole and then cut."""
    return df.limit(n) if n else df


def open_documents_topk(doc: DataFrame, n: int = 10, min_status: int = 4) -> DataFrame:
    """Highest document numbers among documents whose numeric status is at least ``min_status``."""
    return (doc.where(f"try_cast(status AS int) >= {int(min_status)}").select("party", "type", "number", "balance")
            .orderBy(F.col("number").desc(), "party", "type", "balance").limit(n))
