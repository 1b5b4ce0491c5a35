"""Token ids in binary blocks with a shared zstandard dictionary and an offset index.

A folder holds three tables of files. `dictionary` is one row: the dictionary, its hash, the tokenizer and
the end id. `blocks` are in ascending document order: each has the frames of consecutive documents one
after another (a frame is one document's ids, little-endian unsigned 32-bit, compressed on its own), the
dictionary's hash, and an index of key, byte length and number of ids for every document. `parts` says
how many ids come before each range of documents. A single document is read by its block's key range
and its place in the index, and only its frame is decompressed.

The dictionary is trained on the ids of at most SAMPLE_DOCS documents, SAMPLE_BYTES of each; all documents
are written. Without enough to train on, frames have no dictionary and the hash is that of nothing.

Cases: a null or empty text is the end id alone; documents without a key come first; rows with equal keys
follow in order of a hash of the text, each with a frame of its own; an empty table gives files without
blocks, and nothing when read; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollbook.llm.pieces import TEXT_BYTES, coder, tokenizer_path
from rollbook.llm.textblocks import blocks as text_blocks

END = 2
LEVEL = 3
BLOCK_BYTES = 1 << 20
SAMPLE_DOCS = 1000
SAMPLE_BYTES = 1 << 13
DICTIONARY_BYTES = 1 << 16

_INDEX = np.dtype([("key", "<i8"), ("given", "u1"), ("bytes", "<u8"), ("ids", "<u8")])
_BLOCKS = "part bigint, block bigint, dictionary_hash string, first_doc bigint, last_doc bigint, n_docs bigint, start bigint, n_tokens bigint, doc_index binary, frames binary"


def train_dictionary(docs: DataFrame, path: str, end: int, sample: int = SAMPLE_DOCS) -> bytes:
    """A dictionary from a fixed choice of documents, by hash of the key; empty if there are too few."""
    every = max(1, docs.count() // sample)
    mark = end.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_blocks(batch.column(0)):
                ids = [(x + mark)[:SAMPLE_BYTES] for x in coder(path).encode(texts)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], ["ids"])

    chosen = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).select("text").limit(2 * sample)
    samples = [bytes(r["ids"]) for r in chosen.mapInArrow(run, "ids binary").collect()]
    if sum(map(len, samples)) < 20 * DICTIONARY_BYTES:
        return b""
    return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()


def _write(path: str, end: int, dictionary: bytes, digest: str):
    mark = end.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, start = TaskContext.get().partitionId(), 0, 0
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        frames: list[bytes] = []
        index: list[tuple] = []
        held = 0

        def block() -> pa.RecordBatch:
            nonlocal number, start, held
            known = [key for key, given, *_ in index if given]
            n = sum(entry[3] for entry in index)
            row = [part, number, digest, min(known, default=None), max(known, default=None), len(index), start, n, np.array(index, _INDEX).tobytes(), b"".join(frames)]
            number, start, held = number + 1, start + n, 0
            index.clear()
            frames.clear()
            types = [pa.int64()] * 2 + [pa.string()] + [pa.int64()] * 5 + [pa.binary()] * 2
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], [c.split()[0] for c in _BLOCKS.split(", ")])

        for batch in batches:
            for row, texts in text_blocks(batch.column(1), TEXT_BYTES):
                keys = batch.column(0).slice(row, len(texts)).to_pylist()
                for key, ids in zip(keys, coder(path).encode(texts), strict=True):
                    ids += mark
                    frames.append(press.compress(ids))
                    index.append((key or 0, key is not None, len(frames[-1]), len(ids) // 4))
                    held += len(frames[-1])
                    if held >= BLOCK_BYTES:
                        yield block()
        if index:
            yield block()

    return run


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, end: int = END) -> None:
    """Encode the column `text` of all documents and write the files in ascending order of doc_id."""
    spark = docs.sparkSession
    path = path or tokenizer_path()
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    dictionary = train_dictionary(docs, path, end)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, bytearray(dictionary), path.rsplit("/", 1)[-1], end)], "dictionary_hash string, dictionary binary, tokenizer string, end_id int").coalesce(1).write.parquet(f"{folder}/dictionary")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.withColumn("_tie", F.xxhash64("text")).repartitionByRange(ranges, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
    blocks = ordered.select("doc_id", "text").mapInArrow(_write(path, end, dictionary, digest), _BLOCKS)
    blocks.write.option("compression", "none").parquet(f"{folder}/blocks")  # frames are compressed already
    sizes = spark.read.parquet(f"{folder}/blocks").groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    # one row per range of documents, as many as there were partitions
    before = F.coalesce(F.sum("n_tokens").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sizes.select("part", before.alias("part_start"), "n_tokens").coalesce(1).write.parquet(f"{folder}/parts")


def _read(dictionary: bytes, digest: str, wanted: frozenset[int] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        open_ = zstandard.ZstdDecompressor(dict_data=shared)
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary_hash"] != digest:
                    raise ValueError(f"block {row['part']}/{row['block']} needs dictionary {row['dictionary_hash']}, the folder has {digest}")
                index = np.frombuffer(row["doc_index"], _INDEX)
                upto = np.cumsum(index["bytes"]).astype(np.int64)
                start = row["part_start"] + row["start"] + np.cumsum(index["ids"]).astype(np.int64) - index["ids"].astype(np.int64)
                take = range(len(index)) if wanted is None else [k for k, (key, given) in enumerate(zip(index["key"].tolist(), index["given"].tolist(), strict=True)) if given and key in wanted]
                frames = row["frames"]
                ids = [open_.decompress(frames[upto[k] - int(index["bytes"][k]) : upto[k]]) for k in take]
                at = np.fromiter(take, np.int64, len(take))
                keys = pa.array(index["key"][at].astype(np.int64), mask=index["given"][at] == 0)
                yield pa.RecordBatch.from_arrays([keys, pa.array(start[at]), pa.array(index["ids"][at].astype(np.int64)), pa.array(ids, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return run


def read_token_files(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids; with `doc_ids`, of those alone."""
    one = spark.read.parquet(f"{folder}/dictionary").first()
    blocks = spark.read.parquet(f"{folder}/blocks")
    if doc_ids is not None:
        near = F.lit(False)
        for k in sorted(set(doc_ids)):
            near = near | ((F.col("first_doc") <= k) & (F.col("last_doc") >= k))
        blocks = blocks.filter(near)
    # a row of two numbers for each range of documents
    parts = F.broadcast(spark.read.parquet(f"{folder}/parts").select("part", "part_start"))
    run = _read(bytes(one["dictionary"]), one["dictionary_hash"], None if doc_ids is None else frozenset(doc_ids))
    return blocks.join(parts, "part").mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
