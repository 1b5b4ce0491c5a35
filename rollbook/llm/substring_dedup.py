"""Substring dedup with the least short run of each window as its anchor (winnowing).

Every run of WINDOW words that also starts anywhere else is removed, word by word. A window holds PERIOD
shorter runs of ANCHOR words; that with the smallest hash, the first of equal ones, is its anchor. It
follows from the window's words alone, so two equal windows have equal anchors at the same place within both, which are
two places in all: a window repeats only if its anchor does. Neighbouring windows mostly share their anchor, so about 2 of
PERIOD + 1 places are listed, and a place once however many windows chose it. Only windows whose anchor
repeats are then hashed at their full length and counted.

Both counts are one aggregation: a run that occurs once is its group's only row, so the group carries the
run's place, and the places of single runs go back to their documents. Runs of a passage that many
documents share are summed before they are shuffled, no group of places is ever collected, and there
are no pairs. Anchors are told apart by 64 bits, as one more that seems to repeat only adds candidates; whole windows by 128.

Cases: a null or empty text has no words and stays as it is; so does a text shorter than WINDOW; a window
that repeats within its own document goes, too; rows that repeat are documents of equal text, all of
whose windows repeat; rows with one doc_id and different texts are told apart by a 64-bit hash of the text; an
empty table gives an empty result; other columns pass, except those named like a result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rollbook.llm.scratch import keep
from rollbook.llm.textblocks import Words, blocks, released, words

WINDOW = 35
#: Anchors to choose from in a window.
PERIOD = 21
#: A perfect difference set modulo PERIOD. Places for anchors that need no comparison, but 5 of PERIOD; not used by the operator.
COVER = (0, 1, 4, 14, 16)
ANCHOR = WINDOW - PERIOD + 1
_KEY = ("_id", "_tie")
_HASHES = ("hash", "hash2")


def _anchors(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words of the windows, the first word of each one's anchor, and the hashes of all short runs by first word."""
    n = len(w.hash)
    m = max(0, n - WINDOW + 1)
    first = np.flatnonzero(w.row[n - m :] == w.row[:m])
    at, hashes = w.windows(ANCHOR)
    runs = np.zeros(n, np.uint64)  # a run over the end of a text is in no window
    runs[at] = hashes
    least, span = np.arange(n), 1
    while span < PERIOD:
        step = min(span, PERIOD - span)
        here, there = least[: len(least) - step], least[step:]
        least, span = np.where(runs[there] < runs[here], there, here), span + step
    return first, least[first], runs


def _listed(w: Words, column: pa.Array) -> np.ndarray:
    """Places within the block of the places within each text."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + np.repeat(w.first[:-1], sizes)


def _candidates(w: Words, single: np.ndarray) -> np.ndarray:
    """First words of the windows whose anchor isn't single."""
    first, anchor, _ = _anchors(w)
    alone = np.zeros(len(w.hash), bool)
    alone[single] = True
    return first[~alone[anchor]]


def _located(batch: pa.RecordBatch, row: int, w: Words, at: np.ndarray, *hashes: np.ndarray) -> pa.RecordBatch:
    """Hashes, id, tie and place of each run."""
    of = w.row[at]
    ids, ties = (batch.column(k).slice(row, len(w.first) - 1).to_numpy(zero_copy_only=False) for k in (0, 1))
    places = (at - w.first[of]).astype(np.int32)
    return pa.RecordBatch.from_arrays([*(pa.array(h.view(np.int64)) for h in hashes), pa.array(ids[of]), pa.array(ties[of]), pa.array(places)], [*_HASHES[: len(hashes)], *_KEY, "_at"])


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in released(batches):
        for row, texts in blocks(batch.column(2)):
            w = words(texts)
            _, anchor, runs = _anchors(w)
            at = np.unique(anchor)
            yield _located(batch, row, w, at, runs[at])


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in released(batches):
        single = batch.column(batch.schema.get_field_index("_single"))
        for row, texts in blocks(batch.column(2)):
            w = words(texts)
            at = _candidates(w, _listed(w, single.slice(row, len(texts))))
            (first, one), (_, two) = w.windows(WINDOW), w.windows(WINDOW, other=True)
            chosen = np.searchsorted(first, at)
            yield _located(batch, row, w, at, one[chosen], two[chosen])


def _rest(text: str, gone: np.ndarray) -> str:
    return b" ".join(compress(text.encode().split(), (~gone).tolist())).decode()


def _remove(layout: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            col = batch.schema.get_field_index
            for row, texts in blocks(batch.column(2)):
                part = batch.slice(row, len(texts))
                w = words(texts)
                at = _candidates(w, _listed(w, part.column(col("_single"))))
                alone = np.zeros(len(w.hash) + 1, bool)
                alone[_listed(w, part.column(col("_single_window")))] = True
                at = at[~alone[at]]
                step = np.zeros(len(w.hash) + 1, np.int64)
                step[at] += 1
                step[at + WINDOW] -= 1
                gone = np.cumsum(step[:-1]) > 0
                removed = np.bincount(w.row[gone], minlength=len(texts)).astype(np.int64)
                out = texts.to_pylist()
                for k in np.flatnonzero(removed):
                    out[k] = _rest(out[k], gone[w.first[k] : w.first[k + 1]])
                made = {"text": pa.array(out, layout.field("text").type), "n_words": pa.array(w.counts.astype(np.int64)), "n_removed": pa.array(removed)}
                yield pa.RecordBatch.from_arrays([made[f.name] if f.name in made else part.column(col(f.name)) for f in layout], schema=layout)

    return run


def _singles(runs: DataFrame, name: str) -> DataFrame:
    """For each document, the places of the runs that occur once in all documents."""
    # a group of one row: each minimum is that row's
    once = runs.groupBy(*(c for c in _HASHES if c in runs.columns)).agg(F.count(F.lit(1)).alias("_n"), *(F.min(c).alias(c) for c in (*_KEY, "_at"))).filter("_n = 1")
    return once.groupBy(*_KEY).agg(F.collect_list("_at").alias(name))


def substring_dedup(docs: DataFrame) -> DataFrame:
    """The columns of `docs` with repeated runs taken out of `text`, n_words and n_removed.

    A text from which nothing goes is left as it is; otherwise its kept words are joined by one blank.
    """
    own = [c for c in docs.columns if c not in ("text", "n_words", "n_removed")]
    tie = F.expr("xxhash64(doc_id IS NULL, text)")
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("_id"), tie.alias("_tie"), "text", F.struct(*(F.col(f"`{c}`") for c in own)).alias("_own"))
    layout = "hash bigint, _id bigint, _tie bigint, _at int"
    anchors = keyed.select(*_KEY, "text").mapInArrow(_anchor_rows, layout)
    single = keep(_singles(anchors, "_single"), "single-anchors")
    marked = keyed.join(single, list(_KEY), "left")
    # the exchange of `marked` is used twice: for the windows and for the removal
    windows = _singles(marked.mapInArrow(_window_rows, layout.replace(",", ", hash2 bigint,", 1)), "_single_window")
    both = marked.join(windows, list(_KEY), "left")
    made = [T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
    schema = T.StructType([both.schema["_own"], *made])
    out = both.mapInArrow(_remove(to_arrow_schema(schema)), schema)
    return out.select(*(F.col("text") if c == "text" else F.col(f"_own.`{c}`") for c in docs.columns if c not in ("n_words", "n_removed")), "n_words", "n_removed")
