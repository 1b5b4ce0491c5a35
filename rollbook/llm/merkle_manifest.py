"""Merkle manifest of a dataset: a content-addressed tree per language below one root.

A leaf is the hash of a document's columns, each with its length. Leaves of one language stand in order of
doc_id; every FANOUT consecutive nodes become the hash of their digests, until one is left, the subroot. The
subroots, in order of the language, become the root in the same way. Each height of the tree is a
written table of records from digest to children.

Proofs are found by descent. A request is a leaf's rank; its digits to the base FANOUT, the highest first, say
which child to take. A node looks up its record by its digest, the child that the digit selects goes on
and the digests beside it are collected. Requests with the same leading digits descend as one row, and
only nodes above some request go on, so that there is one row for each node and height; the requests of
a run part at the last step, in the task that folds them. The collected segments are in the order of
the descent, so they are reversed before a leaf is folded up to the root.

Cases: null columns are `-`, empty ones `0:`; a null language is a tree of its own and comes first; null ids
come first, rows with one id follow in order of their leaves, equal rows have equal leaves at places of their own
(and proofs of their own); a lone leaf is its subroot, a lone subroot is the root; an empty table
has no root and gives no rows; columns that aren't hashed or asked for are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.ranks import ranked
from rollbook.llm.scratch import keep

FANOUT = 8
HASHED = ("doc_id", "source", "lang", "n_chars", "text")
_SEGMENTS = "array<struct<left:string,right:string>>"
_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def field(column: Column) -> Column:
    """`-` for null, else length in bytes, `:` and value."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, columns)).cast("binary"), 256)


@dataclass
class Tree:
    """Trees of one kind. `levels[k]` has the nodes of height k + 1 (tree, rank, n, digest, children), `tops` the last node of each tree and its height."""

    levels: list[DataFrame]
    tops: DataFrame


@dataclass
class Manifest:
    """`leaves` (tree, rank, n, leaf, carried columns), the trees of the languages and the one of their subroots (tree, key, rank, n, digest, height)."""

    leaves: DataFrame
    languages: Tree
    subroots: DataFrame
    whole: Tree


def climb(nodes: DataFrame, name: str) -> Tree:
    """All levels above the nodes (tree, rank, n, digest)."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, tops = [], nodes.filter("n = 1").select("tree", "digest", F.lit(0).alias("height"))
    while most > 1:
        # a run has FANOUT nodes at most
        runs = nodes.filter("n > 1").groupBy("tree", F.expr(f"rank div {FANOUT}").alias("rank")).agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("run"))
        level = runs.select("tree", "rank", F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"), F.expr("run.digest").alias("children"))
        nodes = keep(level.withColumn("digest", F.sha2(F.array_join("children", "").cast("binary"), 256)), f"{name}-{len(levels) + 1}")
        levels.append(nodes)
        tops = tops.unionByName(nodes.filter("n = 1").select("tree", "digest", F.lit(len(levels)).alias("height")))
        most = -(-most // FANOUT)
    return Tree(levels, tops)


def build(docs: DataFrame, carry: dict[str, Column] | None = None) -> Manifest:
    """The manifest of all rows; `carry` has further columns for its leaves, by name."""
    extra = [c.alias(name) for name, c in (carry or {}).items()]
    rows = docs.select(field(F.col("lang")).alias("tree"), F.col("lang").alias("_lang"), F.col("doc_id").alias("_id"), leaf([F.col(c) for c in HASHED]).alias("leaf"), *extra)
    leaves = keep(ranked(rows, "tree", [F.asc_nulls_first("_lang"), F.asc_nulls_first("_id"), F.asc("leaf")], "leaves"), "ranked-leaves")
    languages = climb(leaves.select("tree", "rank", "n", F.col("leaf").alias("digest")), "nodes")
    names = leaves.groupBy("tree").agg(F.first("_lang").alias("_lang"))
    tops = languages.tops.join(names, "tree").select(F.col("tree").alias("key"), "_lang", "digest", "height", F.lit("").alias("tree"))
    subroots = keep(ranked(tops, "tree", [F.asc_nulls_first("_lang")], "subroots"), "ranked-subroots")
    return Manifest(leaves.drop("_lang", "_id"), languages, subroots, climb(subroots.select("tree", "rank", "n", "digest"), "top"))


def _down(nodes: DataFrame, level: DataFrame) -> DataFrame:
    """The nodes with the children that their digests' records name."""
    # equal digests have equal children, so one record stands for all
    records = level.groupBy("digest").agg(F.first("children").alias("children"))
    return nodes.join(records, "digest")


def _beside(place: str) -> Column:
    """The segment of a node whose child at `place` is selected."""
    return F.expr(f"named_struct('left', array_join(slice(children, 1, {place}), ''), 'right', array_join(slice(children, {place} + 2, {FANOUT}), ''))")


def descend(tree: Tree, starts: DataFrame, requests: DataFrame) -> DataFrame:
    """The requests (tree, rank, other columns) with `digest`, `segments` from the top down and the columns of their start.

    `starts` has tree, digest and height of the top, the segments so far, and other columns. Ranks of one tree are distinct.
    """
    ask = [c for c in requests.columns if c not in ("tree", "rank")]
    passed = [c for c in starts.columns if c not in ("tree", "digest", "height", "segments")]
    asked = requests.select("tree", "rank", F.struct(F.expr(f"CAST(rank % {FANOUT} AS INT)").alias("place"), F.col("rank").alias("rank"), *ask).alias("ask"))
    lone = starts.filter("height = 0").join(asked.filter("rank = 0"), "tree").select("tree", "digest", "segments", *passed, "ask")
    if not tree.levels:
        return lone.select("tree", "digest", "segments", *passed, "ask.rank", *(f"ask.{c}" for c in ask))
    runs = keep(asked.groupBy("tree", F.expr(f"rank div {FANOUT}").alias("prefix")).agg(F.collect_list("ask").alias("asks")), "requests")
    nodes = None
    for height in range(len(tree.levels), 0, -1):
        here = starts.filter(F.col("height") == height).withColumn("prefix", F.lit(0).cast("bigint")).drop("height")
        nodes = here if nodes is None else nodes.unionByName(here)
        if height > 1:
            wanted = runs.select("tree", F.expr(f"prefix div {FANOUT ** (height - 2)}").alias("prefix")).distinct()
            kids = _down(nodes, tree.levels[height - 1]).select("*", F.posexplode("children").alias("place", "child"))
            kids = kids.select("tree", F.expr(f"prefix * {FANOUT} + place").alias("prefix"), F.col("child").alias("digest"), F.array_append("segments", _beside("place")).alias("segments"), *passed)
            nodes = keep(kids.join(wanted, ["tree", "prefix"], "left_semi"), "descent")
    last = _down(nodes.join(runs, ["tree", "prefix"]), tree.levels[0]).select("*", F.explode("asks").alias("ask"))
    found = last.select("tree", F.expr("children[ask.place]").alias("digest"), F.array_append("segments", _beside("ask.place")).alias("segments"), *passed, "ask")
    return found.unionByName(lone).select("tree", "digest", "segments", *passed, "ask.rank", *(f"ask.{c}" for c in ask))


def folded(node: str, path: str = "path") -> Column:
    """The root that a node leads to along a path of segments, from the bottom up."""
    return F.expr(f"aggregate({path}, {node}, (digest, s) -> sha2(CAST(concat(s.left, digest, s.right) AS BINARY), 256))")


def prove(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """Proofs of some rows of `manifest.leaves` (all, if not given): their columns, leaf, subroot, root and path.

    `leaf` is the digest that the descent ends at; the path has the segments from the bottom up.
    """
    requests = manifest.leaves if requests is None else requests
    empty = F.expr(f"CAST(array() AS {_SEGMENTS})")
    start = manifest.whole.tops.select("tree", "digest", "height", empty.alias("segments"), F.col("digest").alias("root"))
    tops = descend(manifest.whole, start, manifest.subroots.select("tree", "rank", "key", F.col("height").alias("below")))
    starts = keep(tops.select(F.col("key").alias("tree"), "digest", F.col("below").alias("height"), "segments", "root", F.col("digest").alias("subroot")), "starts")
    found = descend(manifest.languages, starts, requests.drop("leaf", "n"))
    return found.withColumn("path", F.reverse("segments")).withColumnRenamed("digest", "leaf").drop("segments")


def tampered() -> Column:
    """The leaf of a row whose text is lower-cased (A-Z), where 3 divides the checksum of its id; else null."""
    changed = [F.translate(F.col(c), *_LOWER) if c == "text" else F.col(c) for c in HASHED]
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, leaf(changed))


def merkle_manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row; some leaves are tampered with before they are folded."""
    proofs = prove(build(docs, {"doc_id": F.col("doc_id"), "changed": tampered()}))
    proof = F.expr("sha2(CAST(array_join(transform(path, s -> concat(s.left, s.right)), '') AS BINARY), 256)")
    rows = proofs.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded("coalesce(changed, leaf)").alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
