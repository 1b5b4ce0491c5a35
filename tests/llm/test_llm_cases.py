"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

from __future__ import annotations

import brute
import pytest

import corpus_pipeline
from rollbook.llm import queries
from rollbook.llm.chat_format import chat_format
from rollbook.llm.components import components
from rollbook.llm.decontaminate import decontaminate
from rollbook.llm.license_scan import license_scan
from rollbook.llm.near_dedup import near_dedup
from rollbook.llm.packing import pack
from rollbook.llm.quality_classifier import fit, quality_classifier, score
from rollbook.llm.quality_rules import Rules, host_verdicts, measure, quality_rules
from rollbook.llm.scratch import new_folder
from rollbook.llm.substring_dedup import COVER, PERIOD, substring_dedup
from rollbook.llm.token_counts import commit_batch, count_tokens, totals
from rollbook.llm.token_files import read_token_files, write_token_files

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, _text string, kept string, _h string, _own string"
PROSE = " ".join(f"w{k % 97}x{k % 13} of" for k in range(400))
LONG = " ".join(f"t{k}" for k in range(60_000))


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), "a", "b", "c", "d", "e") for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, None, "a"), (2, "", None), (3, " \n\t ", "a"), (4, PROSE, "a"), (4, PROSE, "a"), (5, PROSE + " end", "b"), (None, "no id " + PROSE, None),
        (6, "A cC-bY\nAll  rights reserved. CC BY, cc by", "b"), (7, LONG, "b"), (8, "é ß 🙂 <|endoftext|> x", "b"), (4, "another text with the same id", "a"), (9, "two words", "c"), (10, "Two words", "c"),
    ]
    return docs(spark, rows)


@pytest.fixture(scope="module")
def none(spark):
    return docs(spark, [])


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def by_row(rows):
    return sorted(rows, key=repr)


def test_token_counts_and_replays(spark, odd, none):
    from rollbook.llm.pieces import tokenizer_path

    counted = count_tokens(odd, {"v1": tokenizer_path()}).collect()
    assert by_row((r["doc_id"], r["n_tokens"]) for r in counted) == by_row((i, len(brute.ids(t))) for i, t in pairs(odd))
    assert count_tokens(none, {"v1": tokenizer_path()}).count() == 0
    ledger = new_folder(spark, "ledger")
    schema = "kind string, doc_id bigint, source string, lang string, tokenizer string, n_tokens bigint, old_tokens bigint, source2 string"
    make = lambda *rows: spark.createDataFrame([(*r, "x") for r in rows], schema)
    commit_batch(make(), ledger, "none")
    assert totals(spark, ledger).count() == 0
    one = make(("insert", 1, "a", None, "v1", 10, None), ("insert", 1, "a", None, "v1", 10, None), ("insert", 2, None, "en", "v1", None, None), ("insert", 3, "a", None, "v1", 7, None))
    two = make(("revise", 1, "a", None, "v1", 4, 10), ("delete", 3, "a", None, "v1", 7, None))
    for batch, changes in (("1", one), ("2", two), ("1", one), ("2", two)):
        commit_batch(changes, ledger, batch)
    assert by_row(map(tuple, totals(spark, ledger).collect())) == by_row([("a", None, "v1", 1, 4), (None, "en", "v1", 1, 0)])
    with pytest.raises(Exception, match="unknown change"):
        commit_batch(make((None, 1, "a", "b", "v1", 1, None)), ledger, "3")
    with pytest.raises(ValueError):
        commit_batch(one, ledger, "a/b")


def test_token_counts_of_documents_alike(spark, tmp_path):
    rows = [(None, "one two", "a"), (None, "two one", "a"), (None, "one two", "a"), (4, "one two", "a"), (4, "two one", "a"), (13, "one", "a")]
    docs(spark, rows).write.parquet(f"file://{tmp_path}/documents.parquet")
    got = {r["tokenizer"]: (r["n_docs"], r["n_tokens"]) for r in queries.op1_token_counts(spark, f"file://{tmp_path}").collect()}
    assert len(got) == 2 and got["byte_bpe_50k"] == (6, sum(len(brute.ids(t)) for _, t, _ in rows) + 1)
    assert {n for n, _ in got.values()} == {6}
    ledger = new_folder(spark, "ledger")
    schema = "kind string, doc_id bigint, source string, lang string, tokenizer string, n_tokens bigint, old_tokens bigint, change_id string"
    changes = spark.createDataFrame([("insert", i, "a", "en", "v1", 5, None, c) for i, c in ((None, "x"), (None, "x"), (None, "y"), (1, "z"), (1, "u"), (None, None), (None, None))], schema)
    commit_batch(changes, ledger, "1")
    assert [tuple(r)[3:] for r in totals(spark, ledger).collect()] == [(6, 30)]


def test_decontaminate(spark, odd, none):
    words = [f"word{k}" for k in range(40)]
    swap = words.copy()
    swap[17] = "other"
    swap[30] = "other"
    rows = [(1, "Intro text. " + " ".join(words[:20]).upper() + " tail", "a"), (2, "x " + ", ".join(swap), "b"), (2, "x " + ", ".join(swap), "b"), (3, " ".join(words[::2]), "a"), (None, " ".join(words), "c"), (4, None, "a"), (5, " ".join(words[:9]), "a")]
    bench = spark.createDataFrame([(7, " ".join(words), 1), (8, None, 1), (9, "", 1), (None, " ".join(words), 1), (10, "too short", 1)], "item_id bigint, text string, doc_id int")
    found = by_row(map(tuple, decontaminate(docs(spark, rows), bench).collect()))
    assert found == by_row((d, i, f, 40, s) for i in (7, None) for d, f, s in ((1, 2, 20), (2, 1, 38), (None, 0, 40)))
    assert decontaminate(none, bench).count() == 0 and decontaminate(odd, bench.limit(0)).count() == 0
    assert decontaminate(odd, bench.filter("item_id = 7")).count() == 0


def test_decontaminate_finds_short_items(spark):
    item = lambda n: [f"i{n}w{k}" for k in range(n)]
    other = lambda n, at: " ".join("x" if k == at else w for k, w in enumerate(item(n)))
    rows = [(100 * n + k, f"some {other(n, k)} tail", "a") for n in range(1, 12) for k in range(-1, n)]
    items = [(n, " ".join(item(n))) for n in range(1, 12)]
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate(docs(spark, rows), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert found == brute.overlaps([(i, t) for i, t, _ in rows], items) and {(99 + 0, 1), (899, 9), (900, 9), (908, 9)} <= found


def check_pieces(df, packed):
    got, room = {}, {}
    for r in packed.collect():
        got.setdefault(r["doc_id"], []).append((r["start"], r["doc_tokens"], bytes(r["ids"])))
        room.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    want = {}
    for i, t in pairs(df):
        want.setdefault(i, []).append(len(brute.ids(t)) + 1)
    assert {i: sorted(n for s, n, _ in p if s == 0) for i, p in got.items()} == {i: sorted(n) for i, n in want.items()}
    for p in room.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 1024
    return got


def test_packing(spark, odd, none):
    got = check_pieces(odd, pack(odd.repartition(3)))
    assert b"".join(x for *_, x in sorted(got[7])) == b"".join(k.to_bytes(4, "little") for k in [*brute.ids(LONG), 0])
    assert pack(none).count() == 0
    many = docs(spark, [(k, PROSE[: 37 * (k % 40)], "a") for k in range(600)])
    rows = pack(many.repartition(2)).groupBy("sequence_id").sum("length").collect()
    assert sum(r[1] for r in rows) > 0.97 * 1024 * len(rows)


def test_token_files(spark, odd, none):
    folder = new_folder(spark, "files")
    write_token_files(odd, folder)
    rows = sorted(read_token_files(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 3, 4, 4, 4, 5, 6, 7, 8, 9, 10]
    assert by_row((r["doc_id"], bytes(r["ids"])) for r in rows) == by_row((i, b"".join(k.to_bytes(4, "little") for k in [*brute.ids(t), 2])) for i, t in pairs(odd))
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
    assert read_token_files(spark, folder, [4, 9]).count() == 4
    write_token_files(none, new := new_folder(spark, "files"))
    assert read_token_files(spark, new).count() == 0


def test_cover_has_all_differences():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


def test_substring_dedup(spark, odd, none):
    run = " ".join(f"r{k}" for k in range(60))
    rows = [(1, "a b " + run, "a"), (2, run + " c", "a"), (3, f"q {run} q {run}", "b"), (4, " ".join(f"r{k}" for k in range(34)), "a"), (5, "own text\n stays  so", "a"), *((6 + k, f"start {k} " * k + " ".join(f"r{x}" for x in range(k, k + 36)), "b") for k in range(25))]
    for df in (docs(spark, rows), odd):
        out = substring_dedup(df)
        assert out.columns == [*[c for c in df.columns if c != "n_words"], "n_words", "n_removed"]
        got = by_row((r["doc_id"], r["n_words"], r["n_removed"], " ".join(brute.WORD.findall(r["text"] or ""))) for r in out.collect())
        whole = pairs(df)
        assert got == by_row((i, *x) for (i, _), x in zip(whole, brute.repeated_runs([t for _, t in whole]), strict=True))
    assert substring_dedup(docs(spark, rows)).filter("doc_id = 5").first()["text"] == rows[4][1]
    assert substring_dedup(none).count() == 0


def test_substring_dedup_of_many_texts_without_id(spark):
    own = lambda k: " ".join(f"k{k}w{x}" for x in range(40 + k % 9))
    shared = lambda k: " ".join(f"s{k}w{x}" for x in range(40))
    rows = [(None, f"{own(k)} {shared(k // 2)}" if k % 2 else f"{shared(k // 2)} {own(k)}", "a") for k in range(4000)]
    df = docs(spark, rows)
    got = by_row((r["n_words"], r["n_removed"], r["text"]) for r in substring_dedup(df).collect())
    assert got == by_row(brute.repeated_runs([t for _, t, _ in rows]))


def test_quality_rules(spark, odd, none):
    got = {(r["doc_id"], r["n_words"], r["kept"], r["base_failed"]) for r in quality_rules(odd).collect()}
    assert {(1, 0, False, True), (2, 0, False, True), (9, 2, False, True), (7, 60_000, True, False)} <= got
    assert quality_rules(odd).count() == odd.count() and quality_rules(none).count() == 0
    with pytest.raises(ValueError):
        quality_rules(odd, carry=("doc_id", "kept"))


def test_bad_hosts_lose_what_they_habitually_break(spark):
    plain = lambda k: " ".join(f"{k}word{x} text" for x in range(30))
    noisy = lambda k: " ".join(f"{k}word{x} #### text" for x in range(30))
    rows = [(k, noisy(k), "bad") for k in range(40)] + [(100 + k, plain(k), "bad") for k in range(5)] + [(200 + k, plain(k), "good") for k in range(40)] + [(300, noisy(1), "good"), (301, noisy(2), "small")]
    df = docs(spark, rows)
    kept = {r["doc_id"]: r["kept"] for r in quality_rules(df).collect()}
    assert not any(kept[k] for k in range(40)) and all(kept[100 + k] for k in range(5)) and kept[300]
    rates = {r["_host"]: r["rate_symbols"] for r in host_verdicts(measure(df, ("doc_id", "source")), Rules()).collect()}
    assert 0.4 < rates["small"] < 1 and rates["good"] < 0.1 < 0.8 < rates["bad"]


def test_chat_format(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "ann", "Hi"), (1, 2, "bob", None), (1, 2, "bob", None), (1, 3, None, "é"), (1, 300, "ann", "late"), (None, None, "ann", "?"), (2, 0, "system", "alone")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id bigint, turn bigint, role string, text string, block string, _turns string")
    got = {(r["conv_id"], r["block"], r["perspective"]): r for r in chat_format(df).collect()}
    assert set(got) == {(1, 0, "ann"), (1, 0, "bob"), (1, 0, "unknown"), (None, 0, "ann")}
    bob = got[(1, 0, "bob")]
    assert bob["rendered"] == "<|system|>\nBe kind.<|end|>\n<|user|>ann\nHi<|end|>\n<|assistant|>\n<|end|>\n<|user|>unknown\né<|end|>\n<|user|>ann\nlate<|end|>\n"
    assert [bob["rendered"][m["start"] : m["end"]] for m in bob["mask"]] == ["<|end|>"]
    ann = got[(1, 0, "ann")]
    assert [ann["rendered"][m["start"] : m["end"]] for m in ann["mask"]] == ["Hi<|end|>", "late<|end|>"]
    assert [got[(1, 0, "unknown")]["rendered"][m["start"] : m["end"]] for m in got[(1, 0, "unknown")]["mask"]] == ["é<|end|>"]
    assert chat_format(df.limit(0)).count() == 0


def test_whole_dialogues(spark, tmp_path):
    rows = [(1, 0, "system", "Be kind."), *((1, k, ("ann", "bob")[k % 2], f"t{k}") for k in range(1, 300)), (1, 300, "cy", "last"), (None, None, "ann", "?"), (None, 2, "bo", "!")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    df.write.parquet(f"file://{tmp_path}/conversations.parquet")

    def plain(conv, who):
        text, spans = "", []
        for c, _, role, t in rows:
            if c == conv:
                head = "<|assistant|>\n" if role == who else "<|system|>\n" if role == "system" else f"<|user|>{role}\n"
                spans += [(len(text) + len(head), len(text) + len(head) + len(t) + 7)] * (role == who)
                text += f"{head}{t}<|end|>\n"
        return text, spans

    want = {(c, w): plain(c, w) for c, w in ((1, "ann"), (1, "bob"), (1, "cy"), (None, "ann"), (None, "bo"))}
    got = queries.op7_chat_format(spark, f"file://{tmp_path}").collect()
    assert {(r["conv_id"], r["perspective"]): (r["rendered"], r["mask_spans"]) for r in got} == {k: (t, ",".join(f"{a}-{b}" for a, b in m)) for k, (t, m) in want.items()}
    assert len(got) == 5 and {r["block"] for r in got} == {0}
    parts = {}
    for r in sorted(chat_format(df, part=500).collect(), key=lambda r: r["block"]):
        assert len(r["rendered"]) < 800
        text, spans, n = parts.setdefault((r["conv_id"], r["perspective"]), ["", [], 0])
        assert r["block"] == n
        parts[(r["conv_id"], r["perspective"])] = [text + r["rendered"], [*spans, *map(tuple, r["mask"])], n + 1]
    assert {k: (t, m) for k, (t, m, _) in parts.items()} == want and parts[(1, "cy")][2] > 10


def test_license_scan(spark, odd, none):
    rows = [
        (1, "Licensed under the Apache License, Version 2.0. Copyright 2020 x", "a"), (2, "SPDX-License-Identifier: MIT License", "a"), (3, "GNU Lesser General Public License v3 or later", "b"),
        (4, "cc by cc by cc by-sa", "b"), (5, "mit license " * 300, "b"), (6, "THE general\nPUBLIC license; Some rights reserved", "b"), (7, "Creative Commons Attribution-NonCommercial 4.0", None),
    ]
    for df in (docs(spark, rows), odd):
        out = license_scan(df)
        keys = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_detections"]
        assert by_row((r["doc_id"], *(r[k] for k in keys)) for r in out.collect()) == by_row((i, *brute.scanned(t)) for i, t in pairs(df))
        assert out.columns == [*[c for c in df.columns if c != "n_words"], *keys]
    assert license_scan(none).count() == 0


def test_near_dedup(spark, odd, none):
    base = [f"n{k}" for k in range(200)]
    vary = lambda *at: " ".join("x" + w if k in at else w for k, w in enumerate(base))
    chain = [(100 + k, " ".join(base[3 * k : 3 * k + 150]), "a") for k in range(12)]  # neighbours are near, ends are not
    group = [(200 + k, vary(k, 199 - k), "b") for k in range(80)] + [(300 + k, vary(k), "b") for k in range(80)]
    for df, n, percent in ((docs(spark, chain + group), 3, 85), (docs(spark, chain), 5, 80), (odd.filter("doc_id IS NOT NULL"), 3, 85)):
        rows = pairs(df)
        want = brute.near_components(rows, n, percent)
        got = near_dedup(df, n, percent).collect()
        assert by_row((r["doc_id"], r["component_id"], r["kept"]) for r in got) == by_row((i, want[i], want[i] == i) for i, _ in rows)
    assert {(r["doc_id"], r["component_id"]) for r in near_dedup(odd).collect()} >= {(None, 4), (5, 4), (1, 1), (2, 2)}
    assert near_dedup(none).count() == 0


def test_near_dedup_ties_no_rows_by_their_ids(spark):
    text = lambda k, *more: " ".join([*(f"g{k}n{x}" for x in range(100)), *more])
    rows = [(5, text(1), "a"), (None, text(1, "end"), "a"), (9, text(2), "a"), (None, text(2, "end"), "a"), (None, text(3), "a"), (None, text(3, "end"), "b"), (7, text(4), "a"), (7, text(5), "a"), (8, text(4, "end"), "a"), (6, text(5, "end"), "a"), (None, "", "a")]
    got = by_row((r["doc_id"], r["component_id"], r["kept"]) for r in near_dedup(docs(spark, rows)).collect())
    assert got == by_row([(5, 5, True), (None, 5, False), (9, 9, True), (None, 9, False), (None, None, True), (None, None, False), (7, 7, True), (8, 7, False), (6, 6, True), (7, 6, False), (None, None, True)])


def test_near_dedup_of_low_similarity(spark):
    text = lambda k, side: " ".join([*(f"c{k}w{x}" for x in range(48)), *(f"o{k}{side}w{x}" for x in range(50))])
    rows = [(2 * k + j, text(k, "ab"[j]), "a") for k in range(80) for j in range(2)]
    got = {r["doc_id"]: r["component_id"] for r in near_dedup(docs(spark, rows), 1, 30).collect()}
    assert got == brute.near_components([(i, t) for i, t, _ in rows], 1, 30) == {i: i - i % 2 for i in got}
    with pytest.raises(ValueError):
        near_dedup(docs(spark, rows), 1, 0)


def test_components(spark):
    links = [(k, k + 1) for k in range(50)] + [(99, 80), (80, 70), (99, 99), (60, 61), (61, 60)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in range(51)}, **dict.fromkeys((99, 80, 70), 70), 60: 60, 61: 60}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_classifier(spark, odd, none):
    labels = spark.createDataFrame([(k, k % 2, "x") for k in range(200)] + [(None, 1, "x"), (5, None, "x"), (6, 3, "x")], "doc_id bigint, quality int, text string")
    train = docs(spark, [(k, ("fine words here " if k % 2 else "@@ bad |||| ") + f"w{k}", "a") for k in range(200)])
    rows = quality_classifier(train, labels).collect()
    assert all(r["predicted"] == r["doc_id"] % 2 for r in rows if r["held_out"])
    again = quality_classifier(odd, labels)
    assert again.count() == odd.count() and again.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert {r["score"] for r in score(odd, fit(train, labels.limit(0).withColumnRenamed("quality", "label"))).collect()} == {0.5}
    assert quality_classifier(none, labels).count() == 0


def test_pipeline_on_odd_documents(spark, odd, none, tmp_path):
    names = list(corpus_pipeline.COLUMNS)
    for k, df in enumerate((odd, none)):
        folder = f"file://{tmp_path}/{k}"
        df.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, "nothing like the texts")], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
        data = spark.read.parquet(f"{folder}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            data = stage(spark, data, folder)
            assert data.columns == names
        assert {r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()} == ({4, 7} if k == 0 else set())


def test_pipeline_judges_rows_by_their_own_text(spark, tmp_path):
    text = lambda k, *more: " ".join([*(f"p{k}q{x}" for x in range(60)), *more])
    folder = f"file://{tmp_path}"
    spark.createDataFrame([(1, text(7))], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = [(None, text(1), "a"), (None, text(2), "a"), (None, text(2), "a"), (3, text(3), "a"), (None, text(3, "end"), "a"), (4, text(4), "a"), (4, text(5), "a"), (4, text(5), "b"), (None, text(7, "end"), "a"), (6, text(6), "a"), (6, text(7, "own", "end"), "a")]
    stay = lambda df: by_row((*x, r["source"]) for x, r in zip(pairs(df), df.collect(), strict=True))
    got = corpus_pipeline.near_dedup_stage(spark, docs(spark, rows[:8]), folder)
    assert stay(got) == by_row((i, t, s) for i, t, s in [*rows[:2], rows[3], *rows[5:7]])
    got = corpus_pipeline.decontaminate_stage(spark, docs(spark, rows), folder)
    assert stay(got) == by_row((i, t, s) for i, t, s in [*rows[:8], rows[9]])
