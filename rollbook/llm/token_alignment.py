"""Alignment of two tokenizers' tokens by their byte ranges, and how often ids meet in a corpus.

Both tokenizers encode a blank and the text: A is byte-level, B is written in pieces and adds the blank itself. A
document's tokens are given by the bytes at which they end. The shorter of its two end lists drives: each
of its ends is searched in the longer one by steps that double, outward from where it would stand if
tokens were spread evenly, and then by halving. Ends that are found are common; they slice both lists
into groups. The ranks of a token's own end and of the one before it tell the range of the other
side's tokens that it overlaps: links.

Links are counted over the whole corpus. Blocks of about BLOCK_BYTES of text keep each pair of ids once,
with the number of its links, so a pair that is everywhere is summed before it is shuffled; the totals go back to
the blocks, which know which of their pairs a document has and how often. Ids themselves are not stored.

Cases: a null or empty text has no tokens, and neither has one whose tokens on either side don't give back
its bytes; strings of special tokens are ordinary text; null ids are carried; equal rows count each; very long texts are a block of
their own; an empty table gives an empty result; columns but doc_id and text are not looked at.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.pieces import _ALPHABET, coder
from rollbook.llm.scratch import keep
from rollbook.llm.textblocks import blocks, raw

#: A pair of ids is one number: A's id times this, and B's.
PAIR = 1 << 32
#: Text of a block, and words whose pieces a worker remembers.
BLOCK_BYTES = 1 << 20
MOST_WORDS = 100_000
#: Rows of `alignments`. Binary columns are little-endian unsigned 32-bit integers.
_ROWS = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, a binary, b binary, a_sizes binary, b_sizes binary, overlaps binary"
#: A block: of each document its counts and how many pairs it has, which of the block's pairs these are and how often (compressed); the pairs and their sums.
_BLOCK = "block bigint, docs array<struct<doc_id:bigint,n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint>>, n_pairs binary, pair binary, often binary, pairs array<bigint>, times array<bigint>"


class Pieces:
    """A sentence-piece model. Where none of its pieces goes on beyond a blank, words are encoded once each."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.tokens = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self._apart = not any("▁" in p[1:] and p.strip("▁") for p in names)
        self._known: dict[str, bytes] = {}

    def _encode(self, texts: Sequence[str]) -> list[bytes]:
        return [array("I", ids).tobytes() for ids in self.model.encode(list(texts), num_threads=1)]

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if not self._apart:
            return self._encode(texts)
        cut = [text.split(" ") for text in texts]
        if len(self._known) > MOST_WORDS:
            self._known = {}
        new = set(chain.from_iterable(cut)).difference(self._known)
        new.discard("")
        self._known.update(zip(new, self._encode(list(new)), strict=True))
        of = self._known.__getitem__
        # several blanks in a row, or one at an edge, may be a piece of their own
        return [b"".join(map(of, words)) if all(words) else self._encode([text])[0] for text, words in zip(texts, cut, strict=True)]


@cache
def _pieces(path: str) -> Pieces:
    return Pieces(path)


@cache
def _byte_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary."""
    back = {chr(to): b for b, to in _ALPHABET.items()}
    vocabulary = coder(path).vocabulary()
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        out[i] = bytes(back.get(c, ord(c) & 0xFF) for c in token)
    return out


@dataclass
class Side:
    """Tokens of a block: ids, where each ends in the bytes of the block, and the first token of each text and the end."""

    ids: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def _side(encoded: Sequence[bytes], tokens: list[bytes]) -> Side:
    ids = np.frombuffer(b"".join(encoded), "<u4").astype(np.int64)
    first = np.concatenate(([0], np.cumsum([len(e) // 4 for e in encoded], dtype=np.int64)))
    return Side(ids, np.cumsum(_sizes(tuple(map(len, tokens)))[ids]), first)


@cache
def _sizes(sizes: tuple[int, ...]) -> np.ndarray:
    return np.array(sizes, np.int64)


def gallop(ends: np.ndarray, wanted: np.ndarray, first: np.ndarray, stop: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """For each wanted number the first place from `first` on, before `stop`, whose end is not below it. There has to be one."""
    low, high = guess.copy(), guess.copy()
    up, step = np.flatnonzero(ends[high] < wanted), 1
    while len(up):
        low[up] = high[up] + 1
        high[up] = np.minimum(high[up] + step, stop[up] - 1)
        up, step = up[ends[high[up]] < wanted[up]], 2 * step
    down, step = np.flatnonzero((low == guess) & (low > first)), 1
    down = down[ends[low[down] - 1] >= wanted[down]]
    while len(down):
        high[down] = low[down] - 1
        low[down] = np.maximum(high[down] - step, first[down])
        down, step = down[(low[down] > first[down]) & (ends[np.maximum(low[down] - 1, 0)] >= wanted[down])], 2 * step
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        below = ends[middle] < wanted[open_]
        low[open_] = np.where(below, middle + 1, low[open_])
        high[open_] = np.where(below, high[open_], middle)
        open_ = open_[low[open_] < high[open_]]
    return low


def overlaps(short: Side, long: Side, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the chosen texts: places of the tokens of `short`, the first and the last token of `long` that each overlaps, and whether both end together."""
    counts = np.diff(short.first)[chosen]
    of = np.repeat(chosen, counts)
    at = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    place, first, stop = short.first[of] + at, long.first[of], long.first[of + 1]
    last = gallop(long.ends, short.ends[place], first, stop, first + at * (stop - first) // np.maximum(1, np.diff(short.first)[of]))
    common = long.ends[last] == short.ends[place]
    begin = np.concatenate(([0], last[:-1] + common[:-1])) if len(last) else last
    return place, np.where(at == 0, first, begin), last, common


def _runs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, .. for each run, one after another."""
    return np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)


@dataclass
class Aligned:
    """A block's links (places in a and b, in order of a and then b), sizes of the groups on either side, groups of each text."""

    a: Side
    b: Side
    links: tuple[np.ndarray, np.ndarray]
    a_sizes: np.ndarray
    b_sizes: np.ndarray
    n_groups: np.ndarray


def aligned(a: Side, b: Side) -> Aligned:
    """Aligns texts whose tokens have the same bytes on both sides."""
    n_a, n_b = np.diff(a.first), np.diff(b.first)
    links, common = [], []
    for short, long, chosen, swap in ((a, b, np.flatnonzero(n_a <= n_b), False), (b, a, np.flatnonzero(n_a > n_b), True)):
        place, first, last, both = overlaps(short, long, chosen)
        size = last - first + 1
        pair = np.repeat(place, size), _runs(first, size)
        links.append(pair[::-1] if swap else pair)
        ends = place[both], last[both]
        common.append(ends[::-1] if swap else ends)
    (la, lb), (ca, cb) = (tuple(np.concatenate(x) for x in zip(*some, strict=True)) for some in (links, common))
    order, at = np.lexsort((lb, la)), np.argsort(ca)
    ca, cb = ca[at], cb[at]
    per = np.searchsorted(ca, a.first[1:]) - np.searchsorted(ca, a.first[:-1])
    return Aligned(a, b, (la[order], lb[order]), np.diff(ca, prepend=-1), np.diff(cb, prepend=-1), per)


def encoded(texts: Sequence[str | None], path_a: str, path_b: str) -> tuple[Side, Side]:
    """Both sides of a block of texts; those whose bytes don't come back have no tokens."""
    bytes_a, pieces = _byte_tokens(path_a), _pieces(path_b)
    given = [t or "" for t in texts]
    ids = [coder(path_a).encode_after_blank(given), pieces.encode(given)]
    for k, text in enumerate(given):
        want = b" " + text.encode()
        if not text or any(b"".join(map(tokens.__getitem__, array("I", side[k]))) != want for tokens, side in zip((bytes_a, pieces.tokens), ids, strict=True)):
            ids[0][k] = ids[1][k] = b""
    return _side(ids[0], bytes_a), _side(ids[1], pieces.tokens)


def _cut(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The values of each document as bytes."""
    ends = np.concatenate(([0], np.cumsum(4 * sizes))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(values.astype("<u4").tobytes())])


def _rows(docs: pa.Array, x: Aligned) -> pa.Table:
    """The rows of a block as of _ROWS."""
    n_a, n_b = np.diff(x.a.first), np.diff(x.b.first)
    over = np.bincount(x.links[0], minlength=len(x.a.ids))
    upto = np.concatenate(([0], np.cumsum(over)))[x.a.first]
    lists = [_cut(c, n) for c, n in ((x.a.ids, n_a), (x.b.ids, n_b), (x.a_sizes, x.n_groups), (x.b_sizes, x.n_groups), (over, n_a))]
    return pa.table([docs, *map(pa.array, (n_a, n_b, x.n_groups, np.diff(upto))), *lists], [c.split()[0] for c in _ROWS.split(", ")])


def _blocks(path_a: str, path_b: str, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Aligned, pa.Table]]:
    for batch in batches:
        for row, texts in blocks(batch.column(1), BLOCK_BYTES):
            x = aligned(*encoded(texts.to_pylist(), path_a, path_b))
            yield x, _rows(batch.column(0).slice(row, len(texts)), x)


def alignments(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, the ids of both sides (a, b), the sizes of the groups on both, and
    the number of B's tokens that each of A's overlaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _blocks(path_a, path_b, batches):
            yield from rows.to_batches()

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, _ROWS)


def _one(values: pa.Array) -> pa.Array:
    """A column of one row, a list of all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _structs(table: pa.Table, names: Sequence[str]) -> pa.Array:
    return pa.StructArray.from_arrays([table[c].combine_chunks() for c in names], list(names))


def _counted(path_a: str, path_b: str, made: Callable[[pa.Table], pa.Table] | None):
    names = [c.split()[0] for c in _ROWS.split(", ")][:5]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, press = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(level=1)
        pressed = lambda some: pa.array([press.compress(some.astype("<u4").tobytes())])
        for x, rows in _blocks(path_a, path_b, batches):
            pairs, at, times = np.unique(x.a.ids[x.links[0]] * PAIR + x.b.ids[x.links[1]], return_inverse=True, return_counts=True)
            of = np.repeat(np.arange(rows.num_rows), rows["n_links"].to_numpy())
            own, often = np.unique(of * max(1, len(pairs)) + at, return_counts=True)
            of, at = np.divmod(own, max(1, len(pairs)))
            new = np.diff(of, prepend=-1) > 0
            columns = [pa.array([number]), _one(_structs(rows, names)), pressed(np.bincount(of, minlength=rows.num_rows)), pressed(np.where(new, at, np.diff(at, prepend=0))), pressed(often), _one(pa.array(pairs)), _one(pa.array(times))]
            if made:
                extra = made(rows)
                columns.append(_one(_structs(extra, extra.schema.names)))
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _BLOCK.split(", ")] + ["made"] * bool(made))
            number += 1

    return run


def _scored(held: pa.Table, scored: pa.Table) -> pa.Table:
    """The documents of a block, from its row and from the total of each of its pairs and the most of any pair with the same B."""
    open_ = zstandard.ZstdDecompressor()
    n_pairs, step, often = (np.frombuffer(open_.decompress(held[c][0].as_py()), "<u4").astype(np.int64) for c in ("n_pairs", "pair", "often"))
    first = np.cumsum(n_pairs) - n_pairs
    sums = np.concatenate(([0], np.cumsum(step)))
    pair = sums[1:] - np.repeat(sums[first], n_pairs)
    at, total, most = (scored.column(c).to_numpy() for c in ("pos", "total", "most"))
    totals, best = np.zeros((2, len(held["pairs"][0])), np.int64)
    totals[at], best[at] = total, total == most
    added = lambda x: pa.array(np.diff(np.concatenate(([0], np.cumsum(x * often)))[np.append(first, len(pair))]))
    lists = [held[c][0].values for c in ("docs", "made") if c in held.schema.names]
    columns = {f.name: rows.field(f.name) for rows in lists for f in rows.type}
    return pa.table(columns | {"n_best": added(best[pair]), "count_sum": added(totals[pair])})


def score_alignment(docs: DataFrame, path_a: str, path_b: str, made: Callable[[pa.Table], pa.Table] | None = None, schema: str = "") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair's count is the highest of its B id) and count_sum.

    With `made`, its columns (of `schema`) follow. It gets the rows of `alignments`, a block at a time, in the task that finds them, so
    that ids are not stored for it.
    """
    kind = f", made array<struct<{schema.replace(', ', ',').replace(' ', ':')}>>" if made else ""
    counts = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint"
    out = f"{counts}, {schema}" if made else counts
    names = [c.split()[0] for c in out.split(", ")]

    def run(key: tuple[pa.Scalar, ...], held: pa.Table, scored: pa.Table) -> pa.Table:
        return _scored(held, scored).select(names)

    texts = docs.select(F.col("doc_id").cast("bigint"), "text")
    held = keep(texts.mapInArrow(_counted(path_a, path_b, made), _BLOCK + kind), "aligned")
    totals = held.select(F.inline(F.arrays_zip("pairs", "times"))).groupBy("pairs").agg(F.sum("times").alias("total"))
    totals = keep(totals, "pair-counts")
    best = totals.groupBy(F.expr(f"pairs % {PAIR}").alias("b")).agg(F.max("total").alias("most"))
    scored = totals.withColumn("b", F.expr(f"pairs % {PAIR}")).join(best, "b").select("pairs", "total", "most")
    asked = held.select("block", F.posexplode("pairs").alias("pos", "pairs")).join(scored, "pairs").select(F.col("block").alias("of"), "pos", "total", "most")
    return held.drop("times").groupBy("block").cogroup(asked.groupBy("of")).applyInArrow(run, out)


@cache
def _digits(upto: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of the numbers below `upto`, from the left, and how many each has."""
    numbers = np.arange(upto)
    sizes = np.array([len(str(n)) for n in range(upto)], np.int64)
    wide = int(sizes.max())
    powers = np.maximum(sizes[:, None] - 1 - np.arange(wide), 0)
    return (numbers[:, None] // 10**powers % 10 + ord("0")).astype(np.uint8), sizes


def groups_text(a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray, n_groups: np.ndarray) -> list[bytes]:
    """`a1,a2|b1;a3|b2,b3` of each text: the ids of A and of B in each group."""
    if not len(a):
        return [b""] * len(n_groups)
    table, sizes = _digits(1 << int(max(a.max(), b.max())).bit_length())
    sides = np.ravel(np.column_stack((a_sizes, b_sizes)))
    first = np.cumsum(sides) - sides
    ids, mark = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
    ids[_runs(first[0::2], a_sizes)], ids[_runs(first[1::2], b_sizes)] = a, b
    ends = first + sides - 1
    mark[ends[0::2]], mark[ends[1::2]] = ord("|"), ord(";")
    rows = np.column_stack((table[ids], np.zeros(len(ids), np.uint8)))
    rows[np.arange(len(ids)), sizes[ids]] = mark
    data = rows[np.arange(rows.shape[1]) <= sizes[ids][:, None]].tobytes()
    upto = np.concatenate(([0], np.cumsum(sizes[ids] + 1)))
    groups = np.concatenate(([0], np.cumsum(n_groups)))
    at = upto[np.append(first, len(ids))[2 * groups]]
    return [data[x : max(x, y - 1)] for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def groups_digest(rows: pa.Table) -> pa.Table:
    """groups_sha256, the hash of each row's groups as text; empty without tokens."""
    flat = [raw(rows[c].combine_chunks())[0].view("<u4").astype(np.int64) for c in ("a", "b", "a_sizes", "b_sizes")]
    texts = groups_text(*flat, rows["n_groups"].to_numpy())
    return pa.table({"groups_sha256": pa.array([hashlib.sha256(t).hexdigest() if t else "" for t in texts], pa.string())})
