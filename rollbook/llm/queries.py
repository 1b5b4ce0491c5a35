"""The named queries of this subpackage and, where SQL can express them, their expected results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm import sql
from rollbook.llm.chat_format import chat_format
from rollbook.llm.decontaminate import decontaminate
from rollbook.llm.license_scan import license_scan
from rollbook.llm.merkle_manifest import merkle_manifest
from rollbook.llm.near_dedup import near_dedup
from rollbook.llm.packing import pack
from rollbook.llm.pieces import tokenizer_path
from rollbook.llm.quality_classifier import quality_classifier
from rollbook.llm.quality_rules import quality_rules
from rollbook.llm.scratch import keep, new_folder
from rollbook.llm.substring_dedup import substring_dedup
from rollbook.llm.token_alignment import groups_digest, score_alignment
from rollbook.llm.token_counts import commit_batch, count_tokens, totals
from rollbook.llm.token_files import read_token_files, write_token_files
from rollbook.llm.warc import read_warc, write_warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents inserted under two tokenizer versions, some counted anew with an end id, some deleted; one batch comes twice."""
    versions = {"byte_bpe_50k": "byte_bpe_50k.json", "byte_bpe_multi_50k": "byte_bpe_multi_50k.tiktoken"}
    counts = count_tokens(table(spark, sf_dir, "documents"), {name: tokenizer_path(file) for name, file in versions.items()})
    # written with the counts, so a row's id is the same whenever a batch is read
    counts = keep(counts.withColumn("change_id", F.monotonically_increasing_id()), "counts")
    ledger = new_folder(spark, "ledger")
    keys = ["change_id", "doc_id", "source", "lang", "tokenizer"]
    anew = "doc_id % 10 = 3 AND tokenizer = 'byte_bpe_50k'"
    inserts = counts.select(F.lit("insert").alias("kind"), *keys, "n_tokens", F.lit(None).cast("bigint").alias("old_tokens"))
    revised = counts.filter(anew).select(F.lit("revise").alias("kind"), *keys, (F.col("n_tokens") + 1).alias("n_tokens"), F.col("n_tokens").alias("old_tokens"))
    gone = counts.filter("doc_id % 25 = 7").select(
        F.lit("delete").alias("kind"), *keys, F.expr(f"n_tokens + if({anew}, 1, 0)").alias("n_tokens"), F.lit(None).cast("bigint").alias("old_tokens")
    )
    for name in versions:
        commit_batch(inserts.filter(F.col("tokenizer") == name), ledger, f"load-{name}")
    for batch, changes in (("recount", revised), ("removal", gone), ("recount", revised)):
        commit_batch(changes, ledger, batch)
    return totals(spark, ledger)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), folder)
    return read_token_files(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    blanks = r"[\\x20\\x09-\\x0D]+"
    kept = F.sha2(F.expr(f"trim(regexp_replace(coalesce(text, ''), '{blanks}', ' '))").cast("binary"), 256)
    return rows.select("doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules(table(spark, sf_dir, "documents"))
    asked = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return rows.select(*asked, *(c for c in rows.columns if c not in asked))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat_format(table(spark, sf_dir, "conversations"))
    return rows.selectExpr(
        "conv_id", "block", "perspective", "n_turns", "n_own", "rendered",
        "array_join(transform(mask, m -> concat(m.start, '-', m.end)), ',') AS mask_spans",
    )


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.drop("text")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_dedup(table(spark, sf_dir, "documents"), shingle=3, percent=85)
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_alignment(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"), groups_digest, "groups_sha256 string")


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), folder)
    return read_warc(spark, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_decontaminate": op2_decontaminate,
    "op3_packing": op3_packing,
    "op4_token_files": op4_token_files,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_chat_format": op7_chat_format,
    "op8_license_scan": op8_license_scan,
    "op9_near_dedup": op9_near_dedup,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_token_alignment": op12_token_alignment,
    "op13_warc": op13_warc,
}
SQL: dict[str, str] = {
    "op5_substring_dedup": sql.SUBSTRING_DEDUP,
    "op9_near_dedup": sql.NEAR_DEDUP,
    "op6_quality_rules": sql.QUALITY_RULES,
    "op7_chat_format": sql.CHAT_FORMAT,
    "op11_merkle_manifest": sql.MERKLE_MANIFEST,
    "op13_warc": sql.WARC,
}
