"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader.

A text's features are its distinct single words and pairs of neighbouring words, hashed to FEATURES slots;
punctuation marks are words of their own. Each feature weighs 1 / sqrt(number of features). Training
sees a bounded sample of labelled documents, one after another and PASSES times, in a single task: the TRAIN_DOCS
with the smallest hashes, and of these, in that order, as many as have TRAIN_BYTES of text together. The sample is found where the
documents are read, and only it is sent to that task. Weights that the regularisation keeps at 0 stay 0. All documents are
scored, a block at a time, as sparse dot products with the weights, which every task gets (FEATURES
numbers, whatever the size of the table).

Cases: a null or empty text has the bias alone and its score; a label other than 0 and 1, or null, isn't
learnt from; several labels of one document count each, equal rows once; rows of one id are chosen one by one; without labels every score is 0.5; a null doc_id
is scored and never learnt from; repeated rows get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.textblocks import blocks, raw, sets, words

FEATURES = 1 << 20
TRAIN_DOCS = 8000
TRAIN_BYTES = 1 << 28
PASSES = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Slots of each text's distinct features, and where each text's begin. Slot 0 is the bias, in every text."""
    w = words(texts, lower=True, marks=True)
    at, pairs = w.windows(2)
    rows = np.arange(len(texts))
    slot = lambda h: h % np.uint64(FEATURES - 1) + np.uint64(1)
    slots = np.concatenate((np.zeros(len(texts), np.uint64), slot(w.hash), slot(pairs)))
    found, first = sets(slots, np.concatenate((rows, w.row, w.row[at])), len(texts))
    return found.astype(np.int64), first


def train(texts: pa.Array, labels: np.ndarray) -> np.ndarray:
    """Weights after PASSES over the texts in their order."""
    z, n = np.zeros(FEATURES), np.zeros(FEATURES)

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    for _ in range(PASSES):
        for row, part in blocks(texts):
            slots, first = features(part)
            for k in range(len(part)):
                on = slots[first[k] : first[k + 1]]
                w, x = weights(z[on], n[on]), 1 / np.sqrt(len(on))
                g = (1 / (1 + np.exp(-w.sum() * x)) - labels[row + k]) * x
                more = n[on] + g * g
                z[on] += g - (np.sqrt(more) - np.sqrt(n[on])) / ALPHA * w
                n[on] = more
    return weights(z, n).astype(np.float32)


def _fit(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for batch in batches:
            upto = np.cumsum(np.diff(raw(batch.column(0))[1])) + held
            found.append(batch.slice(0, int(np.searchsorted(upto, most, "right"))))
            held = int(upto[-1]) if len(upto) else held
            if held > most:
                break
        if sum(map(len, found)):
            rows = pa.Table.from_batches(found).combine_chunks()
            w = train(rows["text"].chunk(0), rows["label"].to_numpy())
            at = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays([pa.array([at.astype("<i4").tobytes()]), pa.array([w[at].astype("<f4").tobytes()])], ["slots", "weights"])

    return run


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = TRAIN_DOCS) -> DataFrame:
    """text and label of the chosen labelled documents, `sample` at most, in the order of training."""
    given = labels.select("doc_id", "label").filter("doc_id IS NOT NULL AND label IN (0, 1)")
    parts = 1_000_000
    share = min(parts, -(-sample * parts // max(1, given.count())))
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < share
    both = docs.select("doc_id", "text").filter(chosen).join(given.filter(chosen), "doc_id")
    rows = both.select("text", F.col("label").cast("int").alias("label"), F.xxhash64("doc_id", F.lit(1)).alias("turn")).distinct()
    # each partition sends its `sample` smallest at most
    return rows.orderBy("turn", "text", "label").limit(sample).select("text", "label")


def fit(docs: DataFrame, labels: DataFrame, sample: int = TRAIN_DOCS, most_bytes: int = TRAIN_BYTES) -> np.ndarray:
    """Weights learnt from documents (doc_id, text) with labels (doc_id, label)."""
    weights = np.zeros(FEATURES, np.float32)
    for row in training_rows(docs, labels, sample).mapInArrow(_fit(most_bytes), "slots binary, weights binary").collect():
        weights[np.frombuffer(row["slots"], "<i4")] = np.frombuffer(row["weights"], "<f4")
    return weights


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id and score of every row of `docs`."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            for row, texts in blocks(batch.column(1)):
                slots, first = features(texts)
                sums = np.add.reduceat(w[slots].astype(np.float64), first[:-1])
                margin = sums / np.sqrt(np.diff(first))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(texts)), pa.array(1 / (1 + np.exp(-margin)))], ["doc_id", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))


def quality_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; learns from labels (doc_id, quality) that aren't held out."""
    learnt = labels.filter(~held_out()).select("doc_id", F.col("quality").alias("label"))
    scored = score(docs, fit(docs.select("doc_id", "text"), learnt))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
