"""The pipeline against plain versions of its stages."""

from __future__ import annotations

from collections import defaultdict

import brute
import pytest

import corpus_pipeline
from rollbook.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def expected(spark):
    """The texts that reach the last stage, by the plain versions."""
    kept = {r["doc_id"] for r in queries.op6_quality_rules(spark, FOLDER).filter("kept").collect()}  # compared with SQL elsewhere
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect() if r["doc_id"] in kept]
    of = brute.near_components(docs, 5, 80)
    docs = [(i, t) for i, t in docs if of[i] == i]
    runs = brute.repeated_runs([t for _, t in docs])
    docs = [(i, rest if gone else t) for (i, t), (_, gone, rest) in zip(docs, runs, strict=True)]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    leaks = {i for i, _ in brute.overlaps(docs, items)}
    assert leaks
    return {i: t for i, t in docs if i not in leaks}


def test_run(spark, expected):
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, FOLDER).collect():
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"]))
    assert set(pieces) == set(expected)
    for i, text in expected.items():
        ids = [*brute.ids(text), 0]
        assert all(brute.crc(ids[s : s + n]) == c for s, n, c in pieces[i]) and sum(n for _, n, _ in pieces[i]) == len(ids)


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).schema == docs.select(*corpus_pipeline.COLUMNS).schema
