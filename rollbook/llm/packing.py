"""Bounded-space online packing of token ids into sequences of fixed length.

Each task keeps OPEN_WINDOWS windows. A document's ids (end id appended) are cut at full lengths; full pieces
are sequences of their own, and the rest goes to the window that it fills best. If none has room, a new
window is opened, and if there are too many, the fullest is emitted. What is open at the end of a
partition is merged: the pieces left by GROUP partitions are packed anew, largest first, best fit. A group
holds at most GROUP * OPEN_WINDOWS windows, however large the table is.

Cases: a null or empty text is the end id alone; rows that repeat are packed as often as they occur; a
null key is carried; very long texts become many full pieces; an empty table gives no rows; columns other
than the key and the text are not looked at.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rollbook.llm.pieces import TEXT_BYTES, coder, tokenizer_path
from rollbook.llm.scratch import keep
from rollbook.llm.textblocks import blocks, released

LENGTH = 1024
OPEN_WINDOWS = 64
GROUP = 64
END = 0
FLUSH_ROWS = 2000


class Windows:
    """Open windows of one partition, ordered by the room they have left."""

    def __init__(self, length: int, most: int):
        self.length, self.most, self.next = length, most, 0
        self.room: list[tuple[int, int]] = []
        self.held: dict[int, list[tuple]] = {}

    def new(self) -> int:
        self.next += 1
        return self.next - 1

    def put(self, piece: tuple, size: int) -> list[tuple[int, list[tuple]]]:
        """Place a piece; gives the window that had to be emitted, if any."""
        out, at = [], bisect_left(self.room, (size, -1))
        if at == len(self.room):
            if len(self.room) == self.most:
                number = self.room.pop(0)[1]
                out.append((number, self.held.pop(number)))
            number, room = self.new(), self.length
            self.held[number] = []
        else:
            room, number = self.room.pop(at)
        self.held[number].append(piece)
        if room > size:
            insort(self.room, (room - size, number))
        else:
            out.append((number, self.held.pop(number)))
        return out


def _pack(path: str, end: int, length: int, most: int, schema: pa.Schema):
    mark = end.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, open_, rows = TaskContext.get().partitionId(), Windows(length, most), []
        encode, step = coder(path).encode, 4 * length

        def emit(number: int, pieces: list[tuple], closed: bool) -> None:
            offset = 0
            for key, start, ids, total in pieces:
                rows.append((key, start, len(ids) // 4, ids, total, part, number, offset, closed))
                offset += len(ids) // 4

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
            rows.clear()
            return batch

        for batch in released(batches):
            for row, texts in blocks(batch.column(1), TEXT_BYTES):
                keys = batch.column(0).slice(row, len(texts)).to_pylist()
                for key, ids in zip(keys, encode(texts), strict=True):
                    ids += mark
                    total = len(ids) // 4
                    full = len(ids) - len(ids) % step
                    for at in range(0, full, step):
                        emit(open_.new(), [(key, at // 4, ids[at : at + step], total)], True)
                    if full < len(ids):
                        for number, pieces in open_.put((key, full // 4, ids[full:], total), (len(ids) - full) // 4):
                            emit(number, pieces, True)
                    if len(rows) >= FLUSH_ROWS:
                        yield flush()
        for number, pieces in open_.held.items():
            emit(number, pieces, False)
        if rows:
            yield flush()

    return run


def _merge(length: int):
    def run(key: tuple[pa.Scalar, ...], left: pa.Table) -> pa.Table:
        left = left.sort_by([("length", "descending"), ("part", "ascending"), ("number", "ascending"), ("offset", "ascending")])
        windows, numbers, offsets = Windows(length, len(left) + 1), [], []
        used: dict[int, int] = {}
        for size in left["length"].to_pylist():
            at = bisect_left(windows.room, (size, -1))
            room, number = windows.room.pop(at) if at < len(windows.room) else (length, windows.new())
            if room > size:
                insort(windows.room, (room - size, number))
            numbers.append(number)
            offsets.append(used.get(number, 0))
            used[number] = offsets[-1] + size
        for name, column in (("number", numbers), ("offset", offsets)):
            left = left.set_column(left.schema.get_field_index(name), name, pa.array(column, pa.int64()))
        return left

    return run


def pack(docs: DataFrame, key: str = "doc_id", path: str | None = None, end: int = END, length: int = LENGTH, open_windows: int = OPEN_WINDOWS) -> DataFrame:
    """One row per piece: key, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset."""
    kind = dict(docs.dtypes)[key]
    layout = f"_key {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, part bigint, number bigint, offset bigint, closed boolean"
    types = [to_arrow_type(docs.schema[key].dataType), *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 4, pa.bool_()]
    schema = pa.schema(list(zip(["_key", "start", "length", "ids", "doc_tokens", "part", "number", "offset", "closed"], types, strict=True)))
    run = _pack(path or tokenizer_path(), end, length, open_windows, schema)
    placed = keep(docs.select(key, "text").mapInArrow(run, layout), "pieces")
    columns = [F.col("_key").alias(key), "start", "length", "ids", "doc_tokens"]
    closed = placed.filter("closed").select(*columns, F.expr("shiftleft(part, 32) + number").alias("sequence_id"), "offset")
    group = F.expr(f"part div {GROUP}")
    left = placed.filter("NOT closed").groupBy(group.alias("_group")).applyInArrow(_merge(length), layout)
    left = left.select(*columns, F.expr(f"shiftleft(1L, 62) + shiftleft(part div {GROUP}, 32) + number").alias("sequence_id"), "offset")
    return closed.unionByName(left)
