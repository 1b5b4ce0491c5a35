"""Token totals kept up to date by signed deltas.

A change says that a document was inserted, deleted or counted anew. A batch of changes becomes one row
of signed sums per source, language and tokenizer, written to a folder of its own in the ledger. A batch
that is committed again replaces its own folder, so retries and replays change nothing; the totals are
the sums over all batches. Nothing is ever read to be updated, so commits don't depend on each other. A batch is written
beside its folder and renamed when it is complete: a commit that fails leaves what was there, and one that breaks off between
its two renames is put right by whoever looks at the ledger next.

A change row may carry a change_id; replays of one change have the same one, other changes have others.

Cases: changes equal in all columns, the change_id included, count once per batch; without a doc_id and a
change_id nothing tells a replay from another document, and each row counts; null sources, languages and tokenizers are
groups of their own; null counts are 0; an unknown or null kind is an error; a batch without changes is
committed as an empty one; a ledger without batches, or that doesn't exist, has no totals; other columns are not looked at.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rollbook.llm.pieces import TEXT_BYTES, Cut, coder
from rollbook.llm.textblocks import blocks

CHANGES = ("kind", "doc_id", "source", "lang", "tokenizer", "n_tokens", "old_tokens")
CHANGE_ID = "change_id"
GROUPS = ("source", "lang", "tokenizer")
FORMER = "_former-"
TOTALS = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"


def count_tokens(docs: DataFrame, tokenizers: dict[str, str]) -> DataFrame:
    """doc_id, source, lang, tokenizer and n_tokens: a row per document and tokenizer version (name to file)."""
    docs = docs.select("doc_id", "source", "lang", "text")
    schema = T.StructType([*docs.schema.fields[:3], T.StructField("tokenizer", T.StringType()), T.StructField("n_tokens", T.LongType())])
    layout = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in blocks(batch.column(3), TEXT_BYTES):
                cut, keys = Cut(texts), [batch.column(k).slice(row, len(texts)) for k in range(3)]
                for name, path in tokenizers.items():
                    yield pa.RecordBatch.from_arrays([*keys, pa.array([name] * len(texts)), pa.array(coder(path).count(cut), pa.int64())], schema=layout)

    return docs.mapInArrow(run, schema)


def signed_deltas(changes: DataFrame) -> DataFrame:
    """Signed sums of a batch by source, language and tokenizer; hot groups are summed before they are shuffled."""
    sign = F.expr("CASE kind WHEN 'insert' THEN 1 WHEN 'delete' THEN -1 WHEN 'revise' THEN 0 ELSE raise_error(concat('unknown change: ', coalesce(kind, 'null'))) END")
    tokens = F.expr("CASE kind WHEN 'delete' THEN -coalesce(n_tokens, 0) WHEN 'revise' THEN coalesce(n_tokens, 0) - coalesce(old_tokens, 0) ELSE coalesce(n_tokens, 0) END")
    known = changes if CHANGE_ID in changes.columns else changes.withColumn(CHANGE_ID, F.lit(None).cast("string"))
    once = known.groupBy(*CHANGES, CHANGE_ID).agg(F.count(F.lit(1)).alias("_rows"))
    times = F.expr(f"if(doc_id IS NULL AND {CHANGE_ID} IS NULL, _rows, 1)")
    return once.groupBy(*GROUPS).agg(F.sum(sign * times).cast("bigint").alias("n_docs"), F.sum(tokens * times).cast("bigint").alias("n_tokens"))


def _ledger(spark: SparkSession, ledger: str):
    """The ledger's file system and a function for paths below it, after commits that broke off were put right."""
    root = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    at = lambda name: spark._jvm.org.apache.hadoop.fs.Path(root, name)
    if files.exists(root):
        for status in files.listStatus(root):
            name = status.getPath().getName()
            batch = name.removeprefix(FORMER)
            if batch != name and not files.exists(at(f"batch_id={batch}")):
                files.rename(at(name), at(f"batch_id={batch}"))
    return files, at


def commit_batch(changes: DataFrame, ledger: str, batch_id: str) -> None:
    """Write a batch's deltas; the same batch id always leaves the same state."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch_id):
        raise ValueError(f"not a batch id: {batch_id!r}")
    # readers of the ledger pass over names that begin with an underscore
    staging = f"_staging-{uuid.uuid4().hex}"
    files, at = _ledger(changes.sparkSession, ledger)
    try:
        signed_deltas(changes).write.parquet(f"{ledger}/{staging}")
    except BaseException:
        files.delete(at(staging), True)
        raise
    final, former = at(f"batch_id={batch_id}"), at(f"{FORMER}{batch_id}")
    if files.exists(final):
        files.delete(former, True)
        files.rename(final, former)
    if not files.rename(at(staging), final):
        raise OSError(f"could not publish {batch_id} in {ledger}")
    files.delete(former, True)


def totals(spark: SparkSession, ledger: str) -> DataFrame:
    """Documents and tokens by source, language and tokenizer over all batches; groups that came to nothing are left out."""
    files, at = _ledger(spark, ledger)
    if files.exists(at(".")):
        deltas = spark.read.schema(f"{TOTALS}, batch_id string").parquet(ledger)
    else:
        deltas = spark.createDataFrame([], TOTALS)
    sums = deltas.groupBy(*GROUPS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    return sums.filter("n_docs != 0 OR n_tokens != 0")
