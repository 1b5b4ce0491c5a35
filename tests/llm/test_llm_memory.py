"""What a Python worker holds."""

from __future__ import annotations

import pyarrow as pa

from rollbook.llm import pieces
from rollbook.llm.textblocks import released


def test_table_of_pieces_is_bounded_in_characters():
    table = pieces.Table("", lambda new: [p[:4].encode() for p in new])
    for k in range(60):
        table.learn({f"{k}x{j}" + "y" * 10_000 for j in range(100)})
    held = sum(map(len, table.known)) + sum(map(len, table._older))
    assert held <= 2 * ((1 << 23) + 2_000_000)
    table.learn(again := {f"{k}x1" + "y" * 10_000, "new"})
    assert {p: table.known[p] for p in again} == {p: p[:4].encode() for p in again}


def test_released_batches_are_all_there():
    batches = [pa.RecordBatch.from_arrays([pa.array([k, k + 1])], ["k"]) for k in range(5)]
    assert [b.column(0).to_pylist() for b in released(iter(batches))] == [[k, k + 1] for k in range(5)]


def test_pieces_in_use_are_encoded_once():
    """As many distinct words as a few dozen MB of text have, met again and again."""
    asked = []
    table = pieces.Table(" ", lambda new: asked.extend(new) or [p.encode() for p in new])
    blocks = [{f"w{k}x{j}" for j in range(20_000)} for k in range(19)]
    for _ in range(3):
        for block in blocks:
            table.learn(block)
            assert all(table.known[p] == f" {p}".encode() for p in block)
    assert len(asked) == len(set(asked)) == 380_000
