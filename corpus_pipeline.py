"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next one's documents. All but the last return the columns of documents. A document is dropped by
quality rules, as a near copy of another, or for an overlap with the benchmark; repeated passages are cut
out of the texts that stay. A verdict holds for the rows of its id and text, so rows whose id is null or
repeats are judged each by its own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm.decontaminate import decontaminate
from rollbook.llm.near_dedup import near_rows, row_key
from rollbook.llm.packing import pack
from rollbook.llm.quality_rules import quality_rules
from rollbook.llm.scratch import keep
from rollbook.llm.substring_dedup import substring_dedup

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def those(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Documents whose row key is (`left_semi`) or isn't (`left_anti`) in `rows`."""
    return docs.withColumn("row", row_key()).join(rows, "row", how)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules(docs, carry=COLUMNS).filter("kept").select(*COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; of rows with one id and text, one row, unless the text is blank."""
    judged = near_rows(docs)
    gone = judged.filter("NOT kept").select("row").distinct()
    several = judged.filter("kept AND n_shingles > 0").groupBy("row").count().filter("count > 1").select("row")
    stay = those(docs, gone, "left_anti")
    rest = [c for c in COLUMNS if c not in ("doc_id", "text")]
    once = those(stay, several, "left_semi").groupBy("row").agg(F.min(F.struct(*rest, "doc_id", "text")).alias("one")).select("one.*")
    return those(stay, several, "left_anti").select(*COLUMNS).unionByName(once.select(*COLUMNS))


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that repeat."""
    cut = substring_dedup(docs.select(*COLUMNS))
    changed = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", changed).select(*COLUMNS)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't overlap with the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = decontaminate(docs.withColumn("row", row_key()), benchmark, doc_key="row").select("row").distinct()
    return those(docs, leaks, "left_anti").select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return pack(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("substring_dedup", substring_stage),
    ("decontaminate", decontaminate_stage),
    ("packing", packing_stage),
]

#: Hashing, tokenizing and best fit aren't expressible in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
