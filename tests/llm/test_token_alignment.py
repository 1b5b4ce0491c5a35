"""Alignment of two tokenizers against all pairs of tokens."""

from __future__ import annotations

from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rollbook.llm import queries
from rollbook.llm.pieces import tokenizer_path
from rollbook.llm.token_alignment import Side, aligned, alignments, gallop, groups_digest, score_alignment

A, B = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def models():
    byte_level = Tokenizer.from_file(A)
    byte_level.encode_special_tokens = True
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    letters = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
    return byte_level, letters, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(models, text):
    """(id, start, end) of either side; nothing if the bytes don't come back."""
    byte_level, letters, pieces = models
    a = [(i, bytes(letters[c] for c in byte_level.id_to_token(i))) for i in byte_level.encode(" " + (text or ""), add_special_tokens=False).ids]
    b = [(i, bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()) for i in pieces.encode(text or "")]
    if not text or any(b"".join(x for _, x in side) != (" " + text).encode() for side in (a, b)):
        return [], []
    out = []
    for side in (a, b):
        ends = np.cumsum([len(x) for _, x in side]).tolist()
        out.append([(i, end - len(x), end) for (i, x), end in zip(side, ends, strict=True)])
    return out


def links(a, b):
    """Pairs of ids with overlapping ranges; b's from the first that isn't over yet."""
    found, k = [], 0
    for i, start, end in a:
        while k < len(b) and b[k][2] <= start:
            k += 1
        j = k
        while j < len(b) and b[j][1] < end:
            found.append((i, b[j][0]))
            j += 1
    return found


def expected(models, rows):
    sides = [(i, *tokens(models, t)) for i, t in rows]
    counts = Counter(x for _, a, b in sides for x in links(a, b))
    most = Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    out = []
    for i, a, b in sides:
        both = sorted({x[2] for x in a} & {x[2] for x in b})
        group, text = {end: k for k, end in enumerate(both)}, []
        per = [([], []) for _ in both]
        for side, some in enumerate((a, b)):
            at = 0
            for token, _, end in some:
                per[at][side].append(str(token))
                at += end in group
        text = ";".join(f"{','.join(x)}|{','.join(y)}" for x, y in per)
        linked = links(a, b)
        out.append((i, len(a), len(b), len(both), len(linked), sum(counts[x] == most[x[1]] for x in linked), sum(counts[x] for x in linked), sha256(text.encode()).hexdigest() if a else ""))
    return out


def test_query_over_the_table(spark, models):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = [tuple(r) for r in queries.op12_token_alignment(spark, FOLDER).collect()]
    assert sorted(got) == sorted(expected(models, docs))


ODD = [
    (1, None), (2, ""), (3, " "), (4, "a  b   c"), (5, " edge "), (6, "\n\ta\r\nb"), (7, "x▁y"), (8, "<s> </s> <unk> <0x41> <|endoftext|>"), (9, "naïve ﬁn 🙂 中文字 é  z"),
    (10, "The quick brown fox. " * 30), (10, "The quick brown fox. " * 30), (None, "no id, 12345 tokens"), (None, None), (11, " ".join(f"w{k}" for k in range(30_000))), (12, "\x00\x01 a"), (13, "a" * 5000), (14, "don't WON'T"),
]


@pytest.mark.usefixtures("few_rows")
def test_odd_rows(spark, models):
    docs = spark.createDataFrame([(i, t, "a", 1, "b") for i, t in ODD], "doc_id bigint, text string, block string, a int, pairs string")
    got = [tuple(r) for r in score_alignment(docs, A, B, groups_digest, "groups_sha256 string").collect()]
    want = expected(models, ODD)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(w[1] == 0 for w in want) == 4 and all(w[4] == w[1] + w[2] - w[3] for w in want)
    assert [tuple(r) for r in sorted(score_alignment(docs, A, B).collect(), key=repr)] == [w[:-1] for w in sorted(want, key=repr)]
    assert score_alignment(docs.limit(0), A, B).count() == 0


def test_groups_and_overlaps_are_given(spark, models):
    row = alignments(spark.createDataFrame([(1, "uncharacteristically antidisestablishment 2024")], "doc_id int, text string"), A, B).first()
    a, b = tokens(models, "uncharacteristically antidisestablishment 2024")
    row = {c: np.frombuffer(row[c], "<u4").tolist() for c in ("a", "b", "a_sizes", "b_sizes", "overlaps")}
    assert (row["a"], row["b"]) == ([x[0] for x in a], [x[0] for x in b])
    assert row["overlaps"] == [sum(y[1] < x[2] and x[1] < y[2] for y in b) for x in a]
    assert (sum(row["a_sizes"]), sum(row["b_sizes"]), len(row["a_sizes"])) == (len(a), len(b), len({x[2] for x in a} & {x[2] for x in b}))


cuts = st.lists(st.tuples(st.integers(1, 60), st.sets(st.integers(1, 59)), st.sets(st.integers(1, 59))), min_size=1, max_size=5)


@settings(max_examples=200, deadline=None)
@given(cuts)
def test_any_two_cuts_of_the_same_bytes(texts):
    sides = []
    for side in (1, 2):
        ends, first, base = [], [0], 0
        for text in texts:
            ends += [base + c for c in sorted(c for c in text[side] if c < text[0])] + [base + text[0]]
            base += text[0]
            first.append(len(ends))
        sides.append(Side(np.arange(len(ends)), np.array(ends), np.array(first)))
    got = aligned(*sides)
    ranges = [list(zip([0, *s.ends[:-1].tolist()], s.ends.tolist(), strict=True)) for s in sides]
    assert list(zip(*(x.tolist() for x in got.links), strict=True)) == [(i, j) for i, (s, e) in enumerate(ranges[0]) for j, (t, f) in enumerate(ranges[1]) if s < f and t < e]
    both = sorted(set(sides[0].ends.tolist()) & set(sides[1].ends.tolist()))
    assert np.cumsum(got.a_sizes).tolist() == [sides[0].ends.tolist().index(e) + 1 for e in both]
    assert np.cumsum(got.b_sizes).tolist() == [sides[1].ends.tolist().index(e) + 1 for e in both]
    assert got.n_groups.sum() == len(both)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 500), min_size=1), st.lists(st.tuples(st.integers(0, 500), st.floats(0, 1)), min_size=1))
def test_gallop_from_any_guess(ends, asked):
    ends = np.array(sorted(ends))
    wanted = np.minimum(np.array([w for w, _ in asked]), ends[-1])
    guess = np.array([int(g * (len(ends) - 1)) for _, g in asked])
    every = np.zeros(len(wanted), np.int64)
    assert gallop(ends, wanted, every, every + len(ends), guess).tolist() == np.searchsorted(ends, wanted).tolist()
