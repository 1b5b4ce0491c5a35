"""Manifests and proofs against a tree built in plain Python."""

from __future__ import annotations

from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from rollbook.llm.merkle_manifest import FANOUT, build, folded, merkle_manifest, prove

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, rank string, n int, leaf string, digest string, place int, path string"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(i, source, lang, n, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def climbed(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The top and, for each node, what stands left and right of it on the way up."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k : k + FANOUT] for k in range(0, len(nodes), FANOUT)]
        for k, path in enumerate(paths):
            run, place = runs[at[k] // FANOUT], at[k] % FANOUT
            path.append(("".join(run[:place]), "".join(run[place + 1 :])))
            at[k] //= FANOUT
        nodes = [sha("".join(run)) for run in runs]
    return (nodes or [None])[0], paths


def expected(rows: list[tuple]) -> list[tuple]:
    """Rows of merkle_manifest, of (doc_id, text, lang, source, n_chars)."""
    out, trees = [], {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    tops = {}
    for lang, some in trees.items():
        some.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r[0], r[3], r[2], r[4], r[1])))
        tops[lang] = climbed([leaf(r[0], r[3], r[2], r[4], r[1]) for r in some])
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    root, above = climbed([tops[x][0] for x in langs])
    for lang, up in zip(langs, above, strict=True):
        for (i, text, _, source, n), path in zip(trees[lang], tops[lang][1], strict=True):
            bad = i is not None and crc32(str(i).encode()) % 3 == 0 and text is not None
            node = leaf(i, source, lang, n, text.translate(LOWER) if bad else text)
            for left, right in path + up:
                node = sha(left + node + right)
            proof = sha("".join(left + right for left, right in path + up))
            out.append((i, leaf(i, source, lang, n, text), tops[lang][0], root, proof, node, node == root))
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", 3, "c", "d", 4, "e") for r in rows], COLUMNS)


def some_rows():
    rows = [(i, f"Text {i} of É", "en", "web", 9) for i in range(75)]
    rows += [(i, f"TEXT {i}", None, None, None) for i in range(9)]
    rows += [(None, "no id", "en", "web", 5), (None, "no ID", "en", None, None), (None, None, None, None, None)]
    rows += [(7, "Text 7 of É", "en", "web", 9)] * 20 + [(7, "other", "en", "web", 9)]
    rows += [(900, "", "", "", 0), (901, None, "zz", "", None), (902, "x" * 300_000 + "Y", "é", "web", 300_001)]
    return rows + [(2000 + i, "T", f"l{i:02}", "s", 1) for i in range(12)]


@pytest.mark.usefixtures("few_rows")
def test_rows_and_proofs(spark):
    rows = some_rows()
    got = [tuple(r) for r in merkle_manifest(table(spark, rows)).collect()]
    want = expected(rows)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {v for *_, v in want} == {True, False} and len({w[2] for w in want}) == 17


@pytest.mark.usefixtures("few_rows")
@pytest.mark.parametrize("rows", [[], [(1, "One", "en", "a", 3)], [(None, None, None, None, None)] * 3, [(1, "a", "en", "a", 1), (1, "a", "fr", "a", 1)]])
def test_small_tables(spark, rows):
    got = [tuple(r) for r in merkle_manifest(table(spark, rows)).collect()]
    assert sorted(got, key=repr) == sorted(expected(rows), key=repr)


@pytest.mark.usefixtures("few_rows")
def test_some_requests(spark):
    """A few leaves descend alone; a changed leaf doesn't fold to the root, whatever its place."""
    manifest = build(table(spark, [(i, f"text {i}", "en" if i < 70 else "fr", "a", 1) for i in range(72)]), {"doc_id": F.col("doc_id")})
    asked = manifest.leaves.filter("doc_id IN (0, 7, 8, 63, 64, 69, 71)")
    rows = prove(manifest, asked).withColumn("up", folded("leaf")).withColumn("other", folded("sha2(leaf, 256)")).collect()
    assert sorted(r["doc_id"] for r in rows) == [0, 7, 8, 63, 64, 69, 71]
    assert {r["up"] == r["root"] for r in rows} == {True} and {r["other"] == r["root"] for r in rows} == {False}
    assert {len(r["path"]) for r in rows if r["doc_id"] < 70} == {4} and {r["leaf"] for r in rows} == {r["leaf"] for r in asked.collect()}


def test_records_are_addressed_by_content(spark):
    manifest = build(table(spark, some_rows()))
    for level in manifest.languages.levels + manifest.whole.levels:
        assert level.filter("digest != sha2(CAST(array_join(children, '') AS BINARY), 256) OR size(children) > 8").isEmpty()
