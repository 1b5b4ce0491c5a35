"""Pieces of texts have the ids that whole texts have, and are encoded as seldom as can be."""

from __future__ import annotations

import base64
import random
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from rollbook.llm import pieces

ODD = [*" " * 8, *"\n" * 6, *"abZ'.,-\"s\\1_t\t\r\x0b\x1c\x00", "'s", "'ll", "re", "é", "É", "×", "÷", "Ǝ", "ʰ", "́", "\xa0", "\x85", " ", "　",
       "​", "中", "ж", "٣", "²", "🙂", "ʼ", "ß", "the", "word", "<|endoftext|>"]


def whole(name: str, special: bool = True):
    path = public_tokenizers.path(name)
    if name.endswith(".json"):
        model = Tokenizer.from_file(path)
        model.encode_special_tokens = not special
        return lambda text: model.encode(text, add_special_tokens=False).ids
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def odd_texts(seed: int) -> list[str | None]:
    draw = random.Random(seed)
    return [None, "", " ", "\n", "\na", "a\n", "a\nb", "a\nb\nc", "É\nÉ,\nÉ", *("".join(draw.choices(ODD, k=draw.randint(1, 12))) for _ in range(3000))]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken"])
def test_pieces_give_the_ids_of_whole_texts(name):
    coder, ids, texts = pieces.Coder(public_tokenizers.path(name)), whole(name), odd_texts(7)
    column = pa.array(["before", *texts, "after"]).slice(1, len(texts))
    expected = [list(ids(text or "")) for text in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(column)] == expected
    assert coder.count(pieces.Cut(column)).tolist() == [len(x) for x in expected]
    nothing = column.slice(0, 0)
    assert coder.encode(nothing) == [] and coder.count(pieces.Cut(nothing)).tolist() == []


def test_pieces_after_a_blank_give_the_ids_of_whole_texts():
    coder, ids = pieces.Coder(pieces.tokenizer_path()), whole(pieces.TOKENIZER, special=False)
    texts = [text or "" for text in odd_texts(8)]
    assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode_after_blank(texts)] == [ids(" " + text) for text in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken"])
def test_words_on_either_side_of_a_line_break_are_encoded_once(name, monkeypatch):
    asked, encode = [], pieces.Table._encode
    monkeypatch.setattr(pieces.Table, "_encode", lambda table, new: asked.extend(new) or encode(table, new))
    letters = [a + b for a, b in product("abcdefg", repeat=2)]
    texts = [f"the end{a}.\nNext{b} é{a}\n{b}é is" for a in letters for b in letters]
    ids = whole(name)
    got = pieces.Coder(public_tokenizers.path(name)).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [list(ids(text)) for text in texts]
    assert len(asked) < 6 * len(letters)
