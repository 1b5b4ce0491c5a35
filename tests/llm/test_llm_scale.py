"""Families of copies, hot and null ids, bounds and plans: work has to grow with the rows."""

from __future__ import annotations

import random
from pathlib import Path

import brute
import numpy as np
import pyarrow as pa
import pytest

from rollbook.llm import decontaminate as D
from rollbook.llm import near_dedup as N
from rollbook.llm import quality_classifier as Q
from rollbook.llm.license_scan import license_scan
from rollbook.llm.scratch import drop, keep, settled
from rollbook.llm.substring_dedup import substring_dedup

DOCS = "doc_id bigint, text string"


def family(m: int, kind: str, seed: int = 1) -> list[tuple[int, str]]:
    """Copies of one text of 150 words, each with its own edits, 1 to 12 of them."""
    r, out = random.Random(seed), []
    base = [f"b{r.randrange(3000)}" for _ in range(150)]
    for i in range(m):
        w = list(base)
        for _ in range(1 + int(r.random() ** 1.5 * 12)):
            at, what = r.randrange(len(w)), r.choice(["swap", "drop", "add", "cut"]) if kind == "mix" else kind
            if what == "swap":
                w[at] = f"c{r.randrange(3000)}"
            elif what == "drop":
                del w[at]
            elif what == "add":
                w.insert(at, f"c{r.randrange(3000)}")
            else:
                w = w[: -r.randrange(1, 4)]
        out.append((i, " ".join(w)))
    return out


@pytest.fixture
def pairs(monkeypatch):
    """Numbers of pairs that are asked for, round by round."""
    counted, similar = [], N.Checker.similar

    def counting(self, some):
        some = keep(some, "pairs")
        counted.append(some.count())
        return similar(self, some)

    monkeypatch.setattr(N.Checker, "similar", counting)
    return counted


def found(spark, rows, n=3, percent=85):
    return {r["doc_id"]: r["component_id"] for r in N.near_dedup(spark.createDataFrame(rows, DOCS), n, percent).collect()}


def test_no_step_of_near_dedup_is_planned_with_the_others(spark, monkeypatch):
    exchanges = {}

    def counting(df, name):
        plan = df._jdf.queryExecution().executedPlan().toString()
        exchanges[name] = max(exchanges.get(name, 0), plan.count("Exchange "))
        return keep(df, name)

    monkeypatch.setattr(N, "keep", counting)
    found(spark, family(60, "mix"))
    assert "families" in exchanges and max(exchanges.values()) <= 24


def test_dropped_tables_are_gone(spark):
    a, b = keep(spark.range(3), "a"), keep(spark.range(4), "b")
    folder = Path(a.inputFiles()[0].removeprefix("file://")).parent
    drop(a, spark.range(1))
    assert not folder.exists() and b.count() == 4


@pytest.mark.usefixtures("few_rows")
@pytest.mark.parametrize("kind", ["swap", "drop", "mix"])
def test_a_family_of_copies(spark, pairs, kind):
    rows = family(300, kind)
    assert found(spark, rows) == brute.near_components(rows, 3, 85)


@pytest.mark.usefixtures("few_rows")
def test_pairs_of_a_family_grow_with_its_rows(spark, pairs):
    per_row = []
    for m in (500, 2000):
        rows = family(m, "swap")
        pairs.clear()
        assert found(spark, rows) == brute.near_components(rows, 3, 85)
        per_row.append(sum(pairs) / m)
    assert per_row[1] < 1.5 * per_row[0] + 2


@pytest.mark.usefixtures("few_rows")
def test_texts_around_a_long_passage_make_few_pairs(spark, pairs):
    """Three fifths of each text are one passage; only those whose own part is nearly the same too are linked."""
    passage = " ".join(f"common{k}" for k in range(90))
    own = lambda i: [f"d{i}w{k}" for k in range(60)]
    rows = [(i, f"{passage} " + " ".join(own(i))) for i in range(300)]
    rows += [(1000 + i, f"{passage} " + " ".join([*own(i)[:30], "other", *own(i)[31:]])) for i in range(0, 300, 7)]
    got = found(spark, rows)
    assert got == brute.near_components(rows, 3, 85) and got[1007] == 7
    assert sum(pairs) < 10 * len(rows)


@pytest.mark.usefixtures("few_rows")
def test_leaks_under_one_null_id(spark):
    """Rows that share an id are verified each against its own alignments."""
    words = [f"w{k}" for k in range(5000 * 14)]
    rows = [(None, f"x{k} " + " ".join(words[14 * k : 14 * k + 14])) for k in range(5000)]
    items = spark.createDataFrame([(None, " ".join(words[14 * k : 14 * k + 14])) for k in range(5000)], "item_id bigint, text string")
    assert [tuple(r) for r in D.decontaminate(spark.createDataFrame(rows, DOCS), items).collect()] == [(None, None, 1, 14, 14)]
    docs = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(rows)], DOCS)
    assert D.decontaminate(docs, items).count() == 5000


@pytest.mark.usefixtures("few_rows")
def test_a_long_item_and_many_seeds(spark):
    words = [f"v{k}" for k in range(100_000)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, "a short item of some words that repeats here and there")], "item_id bigint, text string")
    rows = [(1, " ".join(words[500:530])), (2, " ".join(words[99_950:])), (3, "A short item, of some words that repeats here and THERE"), (4, "none of it")]
    docs = spark.createDataFrame(rows, DOCS)
    near = [sorted(map(tuple, D.decontaminate(docs, items, most_broadcast=most).collect())) for most in (10**9, 0)]
    assert near[0] == near[1] == [(1, 1, 0, 100_000, 30), (2, 1, 0, 100_000, 50), (3, 2, 0, 11, 11)]


def labelled(spark):
    r = random.Random(2)
    word = lambda good: r.choice(["fine", "clear", "sound", "plain"] if good else ["spam", "click", "buy", "free"]) if r.random() < 0.4 else f"w{r.randrange(50)}"
    rows = [(i, i % 2, " ".join(word(i % 2) for _ in range(r.randrange(3, 30)))) for i in range(120)]
    docs = spark.createDataFrame([(i, t) for i, _, t in rows] + [(500, None), (501, "")], DOCS)
    labels = spark.createDataFrame([(i, y) for i, y, _ in rows] + [(500, 1), (501, 0), (None, 1), (3, None), (4, 7)], "doc_id bigint, label int")
    return docs, labels


@pytest.mark.usefixtures("few_rows")
def test_weights_against_plain_ftrl(spark):
    docs, labels = labelled(spark)
    rows = [(r["text"], r["label"]) for r in Q.training_rows(docs, labels).collect()]
    assert len(rows) == 122
    got = Q.fit(docs, labels)
    slots, first = Q.features(pa.array([t for t, _ in rows], pa.string()))
    want = brute.ftrl([(slots[a:b].tolist(), y) for a, b, (_, y) in zip(first[:-1], first[1:], rows, strict=True)], Q.PASSES, Q.ALPHA, Q.BETA, Q.L1, Q.L2)
    at = np.flatnonzero(got)
    assert len(at) > 20 and np.allclose(got[at], [want.get(k, 0.0) for k in at.tolist()], rtol=1e-5, atol=1e-6)
    assert {k for k, w in want.items() if abs(w) > 1e-6} <= set(at.tolist())


@pytest.mark.usefixtures("few_rows")
def test_training_rows_are_bounded(spark):
    """Many rows under one id are chosen one by one, equal rows count once, and bytes are bounded."""
    docs = spark.createDataFrame([(1, f"text {k % 300}") for k in range(900)] + [(2, "two")], DOCS)
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0)], "doc_id bigint, label int")
    assert Q.training_rows(docs, labels).count() == 301
    assert Q.training_rows(docs, labels, sample=50).count() == 50
    assert np.count_nonzero(Q.fit(docs, labels, most_bytes=100)) < np.count_nonzero(Q.fit(docs, labels))


def test_documents_are_not_read_in_one_task(spark):
    """Only the sample meets in one partition: nothing is coalesced above the scan or the join."""
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").selectExpr("doc_id", "quality AS label")
    rows = Q.training_rows(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan and "TakeOrderedAndProject" in plan and "Exchange" in plan.split("TakeOrderedAndProject", 1)[1]


def test_matches_of_a_long_text(spark):
    """A quarter of a megabyte of matches, with places as in the plain version."""
    text = " ".join(f"w{k} MIT license and all rights reserved" for k in range(6000))
    row = license_scan(spark.createDataFrame([(1, text)], DOCS)).first()
    want = (48_000 - 6000, 6000, 5, 7 * 5999 + 4 + 1)
    assert (row["n_words"], row["n_base"], row["first_word"]) == (7 * 6000, 6000, 4) and row["last_word"] == 7 * 5999 + 4
    assert row["n_detections"] == 12_000 and row["labels"] == "mit,reserved" and want


@pytest.mark.usefixtures("few_rows")
def test_windows_need_both_hashes(spark, monkeypatch):
    """Where one hash of a window is the same for all, the other still tells them apart."""
    from rollbook.llm import textblocks

    rows = [(k, " ".join(f"d{k}w{j}" for j in range(60))) for k in range(5)] + [(9, " ".join(f"d1w{j}" for j in range(10, 50)))]
    want = {r["doc_id"]: r["n_removed"] for r in substring_dedup(spark.createDataFrame(rows, DOCS)).collect()}
    assert want == {0: 0, 1: 40, 2: 0, 3: 0, 4: 0, 9: 40}
    w = textblocks.words(pa.array([t for _, t in rows]))
    one, two = w.windows(35)[1], w.windows(35, other=True)[1]
    assert len(set(one)) == len(set(two)) and not set(one.tolist()) & set(two.tolist())


def test_a_settled_step_leaves_only_its_result(spark):
    seen = []

    def make():
        inner = settled(spark, lambda: keep(spark.range(3), "a").filter("id > 0"), "b")
        seen.append(inner.inputFiles()[0])
        return keep(inner, "c").filter("id > 1")

    out = settled(spark, make, "d")
    assert [r["id"] for r in out.collect()] == [2]
    with pytest.raises(Exception, match="(?i)not exist|not_exist"):
        spark.read.parquet(seen[0].rsplit("/", 1)[0]).count()
