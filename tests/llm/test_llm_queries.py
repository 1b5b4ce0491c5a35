"""The registered queries over whole tables against SQL or plain versions."""

from __future__ import annotations

import zlib
from collections import defaultdict

import brute
import pytest
from compare import differences, duck

from rollbook.llm import queries
from rollbook.llm.token_files import read_token_files, write_token_files

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


@pytest.mark.parametrize("name", queries.SQL)
def test_query_matches_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, FOLDER), duck(FOLDER), queries.SQL[name]) == []


def test_token_counts(spark, docs):
    rows = queries.op1_token_counts(spark, FOLDER).filter("tokenizer = 'byte_bpe_50k'").collect()
    stay = [(i, t) for i, t in docs if i % 25 != 7]
    assert sum(r["n_docs"] for r in rows) == len(stay)
    assert sum(r["n_tokens"] for r in rows) == sum(len(brute.ids(t)) + (i % 10 == 3) for i, t in stay)


def test_decontaminate(spark, docs):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    found = {(r["doc_id"], r["item_id"]) for r in queries.op2_decontaminate(spark, FOLDER).collect()}
    assert found == brute.overlaps(docs, items) and found


def test_packing(spark, docs):
    of, placed = defaultdict(list), defaultdict(list)
    for r in queries.op3_packing(spark, FOLDER).collect():
        of[r["doc_id"]].append(r)
        placed[r["sequence_id"]].append(r)
    for i, text in docs:
        all_ids, at = [*brute.ids(text), 0], 0
        for r in sorted(of[i], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(all_ids), brute.crc(all_ids[at : at + r["length"]]))
            at += r["length"]
        assert at == len(all_ids)
    total = 0
    for rows in placed.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
        total += at
    assert total > 0.97 * 1024 * len(placed)


def test_token_files(spark, docs):
    rows, at = sorted(queries.op4_token_files(spark, FOLDER).collect(), key=lambda r: r["start"]), 0
    for r, (i, text) in zip(rows, sorted(docs), strict=True):
        all_ids = [*brute.ids(text), 2]
        assert tuple(r) == (i, at, len(all_ids), brute.crc(all_ids))
        at += len(all_ids)


def test_single_documents_from_token_files(spark, docs, tmp_path):
    write_token_files(spark.read.parquet(f"{FOLDER}/documents.parquet"), f"file://{tmp_path}/f")
    rows = read_token_files(spark, f"file://{tmp_path}/f", [3, 77, 9999]).collect()
    assert {r["doc_id"]: zlib.crc32(bytes(r["ids"])) for r in rows} == {i: brute.crc([*brute.ids(t), 2]) for i, t in docs if i in (3, 77)}


def test_substring_dedup(spark, docs):
    rows = {r["doc_id"]: tuple(r)[1:] for r in queries.op5_substring_dedup(spark, FOLDER).collect()}
    want = brute.repeated_runs([t for _, t in docs])
    assert rows == {i: (n, k, brute.digest(s)) for (i, _), (n, k, s) in zip(docs, want, strict=True)}
    assert any(k for _, k, _ in want)


def test_license_scan(spark, docs):
    rows = {r["doc_id"]: tuple(r)[1:] for r in queries.op8_license_scan(spark, FOLDER).collect()}
    assert rows == {i: brute.scanned(t) for i, t in docs}


def test_near_dedup(spark, docs):
    rows = {r["doc_id"]: tuple(r)[1:] for r in queries.op9_near_dedup(spark, FOLDER).collect()}
    want = brute.near_components(docs, 3, 85)
    assert rows == {i: (len(brute.shingles(t, 3)), want[i], want[i] == i) for i, t in docs}
    assert any(i != c for i, c in want.items())


def test_classifier_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = queries.op10_quality_classifier(spark, folder).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    judged = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good, bad = [s for s, q in judged if q], [s for s, q in judged if not q]
    assert sum(g > b for g in good for b in bad) > 0.9 * len(good) * len(bad)
