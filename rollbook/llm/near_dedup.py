"""Near-duplicates by bottom-k sketches of one hash function.

A document's set is its distinct shingles; its sketch, the SKETCH smallest hashes. Documents with equal
sets form a class and are stood for by the row with the smallest id. The smallest LISTED values of each class go to
inverted lists. Two sets of the asked similarity share so many of these values, but for a chance of MISSED (the share
follows from the similarity; for little of it, more values are listed); so each class enters only the lists of its
rarest values, enough that such a pair still meets (the prefix of a set join). The more values are listed, the closer
the share is to the similarity, and sets that have a common passage, but less than that, don't meet.

Short lists yield their pairs, which are filtered by sketch (union-sketch estimate) and verified on full
sets; links join classes to components, and lists within one component are done. A long list picks a
leader, the member that is in the most crowded lists, and only its pairs are verified. The members with at least
NEAR in common with it are a family. What more than half of them have is their centre, a set that none
of them needs to be. Members so near to the centre that they must be linked to the one that is nearest to it
are the core, one component without further pairs. Any other member adds some of what its partner adds to the
centre, or removes the same, so members go on in lists of (leader, rare element that is added), where
a large family falls apart into those that share their edits. Shared removals alone can only do for a pair
if one of the two removes more than it adds, or both are hardly too far from the centre; only such members
go on in lists of (leader, rare element that is removed). Sizes of what two members add and remove tell
before they become a pair whether they can share enough (see difference_lists), and long lists pick a leader again, whose
family shares that element. The distance 1 - J is a metric: a member over NEAR + 1 - similarity has no link
with one under NEAR, and leaves the list; the others stay for the next leader, as long as some are under NEAR, and
only pairs that aren't both of one family are looked at. Lists of retained values that stay crowded are replaced by lists of the
rarest elements of their members' full sets, where those that have no more than a passage in common don't meet. From round to round
lists count as short up to GROWTH times the length, and rounds go on until no list holds two components,
so nothing is left out.

Cases: a null, empty or blank text has the empty set and no link; a text with fewer words than a shingle
has its whole sequence as one; rows are told apart by a 64-bit key of doc_id and text, so that neither a
null doc_id nor one with several texts links rows; a null doc_id sorts last and never stands for others
with an id; equal rows get equal results; an empty table gives an empty result; other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count
from math import ceil, comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql.window import WindowSpec
from pyspark.sql import functions as F

from rollbook.llm.components import components
from rollbook.llm.scratch import drop, keep, settled
from rollbook.llm.textblocks import blocks, mix, released, sets, words

SKETCH = 64
LISTED = 40
#: Chance that a pair shares fewer of the listed values than asked for.
MISSED = 1e-8
#: Members up to which a list yields all its pairs in the first round, of retained values and of differences from a leader.
SHORT, SHORT_APART = 16, 16
#: How much longer a short list may be from round to round.
GROWTH = 8
#: Percent of similarity with the leader from which members are told apart by what they add and remove, if no less is asked for.
NEAR = 50
NO_ID = (1 << 63) - 1


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Tells a row apart by its id and text; null is no id."""
    return F.xxhash64(F.col(doc_id).isNull(), F.col(doc_id).cast("bigint"), text)


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's set as ascending hashes, and where each text's begins."""
    w = words(texts, lower=True)
    at, hashes = w.windows(n)
    short = np.flatnonzero((w.counts > 0) & (w.counts < n))
    hashes = np.concatenate((hashes, w.whole()[short]))
    # the top bit goes, so that hashes keep their order as signed numbers
    return sets(hashes >> np.uint64(1), np.concatenate((w.row[at], short)), len(texts))


def prefix(percent: int) -> tuple[int, float]:
    """How many values are listed, and the share of them that a pair of `percent` has in common.

    The pair shares those of the smallest values of its union that are in both: a binomial number, at least.
    """
    if not 0 < percent <= 100:
        raise ValueError(f"not a percentage of similarity: {percent}")
    t = percent / 100
    m = max(LISTED, ceil(log(MISSED) / log(1 - t))) if t < 1 else LISTED
    need, chance = 0, (1 - t) ** m
    while chance <= MISSED:
        need += 1
        chance += comb(m, need) * t**need * (1 - t) ** (m - need)
    return m, (max(1, need) + 0.5) / m


def _sketch(n: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for row, texts in blocks(batch.column(2)):
                hashes, at = shingle_sets(texts, n)
                size = np.diff(at)
                sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ np.uint64(salt))))) for salt in (0, 0x5851F42D4C957F2D)]
                digests = [pa.array((s[at[1:]] - s[at[:-1]]).view(np.int64)) for s in sums]
                low = np.arange(len(hashes)) - np.repeat(at[:-1], size) < most
                cut = np.concatenate(([0], np.cumsum(np.minimum(size, most)))).astype(np.int32)
                sketch = pa.ListArray.from_arrays(pa.array(cut), pa.array(hashes[low].view(np.int64)))
                keys = [batch.column(k).slice(row, len(texts)) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(size.astype(np.int64)), *digests, sketch], ["id", "row", "n", "d1", "d2", "sketch"])

    return run


def _jaccard(n: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for row, left in blocks(batch.column(3)):
                right = batch.column(4).slice(row, len(left))
                (h, i), (g, j) = shingle_sets(left, n), shingle_sets(right, n)
                ids = [batch.column(k).slice(row, len(left)) for k in (0, 1)]
                led = batch.column(2).slice(row, len(left)).to_pylist()
                both, added, removed = np.zeros(len(left), np.int64), [], []
                for k in range(len(left)):
                    x, y = h[i[k] : i[k + 1]], g[j[k] : j[k + 1]]
                    both[k] = len(np.intersect1d(x, y, assume_unique=True))
                    near = led[k] and 100 * both[k] >= least * (len(x) + len(y) - both[k])
                    added.append(np.setdiff1d(x, y, assume_unique=True).view(np.int64) if near else ())
                    removed.append(np.setdiff1d(y, x, assume_unique=True).view(np.int64) if near else ())
                either = np.diff(i) + np.diff(j) - both
                yield pa.RecordBatch.from_arrays([*ids, pa.array(both), pa.array(either.astype(np.int64)), *(pa.array(x, pa.list_(pa.int64())) for x in (added, removed))], ["a", "b", "both", "either", "added", "removed"])

    return run


def _before(order: WindowSpec) -> Column:
    """The LISTED lists that come right before: two members that share one of these needn't become a pair here again."""
    return F.collect_list("value").over(order.rowsBetween(-LISTED, -1)).alias("before")


def _rarest(values: DataFrame, need: str) -> DataFrame:
    """value, rep, n, score and the lists of the class that come `before` this one, for each entry: the lists of two or more that a class belongs to.

    Of its m values, a class shares `need` with whatever it can be linked to.
    """
    often = values.groupBy("value").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    met = values.join(often, "value")
    by = W.partitionBy("rep", "n")
    met = met.withColumns({"rank": F.row_number().over(by.orderBy("often", "value")), "common": F.count(F.lit(1)).over(by)})
    # values of its own come first in a class's order, and count towards the prefix
    last = F.expr(f"m - {need} + 1")
    kept = met.filter(F.col("rank") + F.col("m") - F.col("common") <= last)
    return kept.select("value", "rep", "n", F.sum("often").over(by).alias("score"), _before(by.orderBy("rank")))


def inverted_lists(classes: DataFrame, percent: int) -> DataFrame:
    """Lists of the smallest values of each class."""
    listed, shared = prefix(percent)
    values = classes.select("rep", "n", F.least(F.size("sketch"), F.lit(listed)).alias("m"), F.explode(F.slice("sketch", 1, listed)).alias("value"))
    return _rarest(values, f"greatest(1, CAST(floor({shared} * m) AS INT))")


def _elements(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for row, texts in blocks(batch.column(1)):
                hashes, at = shingle_sets(texts, n)
                elements = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(texts)), elements], ["rep", "elements"])

    return run


def element_lists(crowded: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """In place of the crowded lists that classes stay in, lists of the rarest elements of their full sets.

    Linked sets share `percent` of the larger one at least, so they meet in these lists for certain. Sets that
    have less than that in common, a passage of some length say, do not: what sets them apart is rarer. Families that
    a class is of count as earlier lists, and a class is far here if it was in any of the crowded lists.
    """
    held = crowded.groupBy("rep").agg(F.max("far").alias("far"), F.collect_set("b").alias("of"))
    held = keep(held.select("rep", "far", F.expr("transform(of, x -> xxhash64(x, 'family'))").alias("of")), "held")
    sets_ = texts.select(F.col("row").alias("rep"), "text").join(held.select("rep"), "rep", "left_semi")
    sets_ = sets_.mapInArrow(_elements(n), "rep bigint, elements array<bigint>").select("rep", F.size("elements").alias("m"), F.explode("elements").alias("e"))
    # retained values have lists of the same hashes
    values = keep(sets_.select("rep", F.col("m").cast("bigint").alias("n"), "m", F.xxhash64("e", F.lit("element")).alias("value")), "elements")
    # rounded up: a share of the set is a whole number of elements
    lists = _rarest(values, f"CAST(({percent} * n + 99) div 100 AS INT)").join(held, "rep")
    lists = keep(lists.select("value", "rep", "n", "score", F.concat("before", "of").alias("before"), "far"), "element-lists")
    drop(held, values)
    return lists


class Checker:
    """Tells how similar many pairs of classes are: passes by sketch those that can reach a share, then counts on full sets."""

    def __init__(self, classes: DataFrame, texts: DataFrame, n: int, least: int):
        self.classes, self.texts, self.n, self.least = classes, texts, n, least

    def similar(self, pairs: DataFrame) -> DataFrame:
        """a, b, both, either and, for the leaders' pairs (`led`), what a has and b hasn't (added) and the reverse (removed); pairs that can't reach `percent` are left out."""
        one = lambda x: self.classes.select(F.col("rep").alias(x), F.col("sketch").alias(f"s{x}"))
        floor = F.expr(f"percent / 100D - 5 * sqrt(percent / 100D * (1 - percent / 100D) / {SKETCH})")
        near = pairs.join(one("a"), "a").join(one("b"), "b").withColumn("low", F.expr(f"slice(array_sort(array_union(sa, sb)), 1, {SKETCH})"))
        near = near.filter(F.expr("size(array_intersect(array_intersect(low, sa), sb))") >= floor * F.size("low")).select("a", "b", "led").distinct()
        text = lambda x: self.texts.select(F.col("row").alias(x), F.col("text").alias(f"t{x}"))
        both = near.join(text("a"), "a").join(text("b"), "b").select("a", "b", "led", "ta", "tb")
        return both.mapInArrow(_jaccard(self.n, self.least), "a bigint, b bigint, both bigint, either bigint, added array<bigint>, removed array<bigint>")


def families(near: DataFrame, percent: int) -> DataFrame:
    """Members (a) of each leader (b) with what each adds to the centre of the family and removes from it, by sizes and weights.

    Let the centre have n elements, of which a member removes R, and let it add A. Its weight is 100 R + percent A, its
    excess what that is over (100 - percent) n, and lean is percent (R - A). Two members have in common
    what neither removes and what both add, so they are linked if what both add and both remove
    are c elements with (100 + percent) c >= the excess of one + the weight of the other. A member in the core reaches this with the
    lightest of all (first, of weight lightest) where c = 0.
    """
    rest = 100 - percent
    # read five times below: as a table, each plan stays as short as its own step
    near = keep(near, "near")
    whole = F.expr("both + size(removed)")
    empty = F.expr("CAST(array() AS array<bigint>)")
    own = keep(near.groupBy("b").agg(F.max(whole).alias("n"), F.max("score").alias("score"), F.count(F.lit(1)).alias("g")), "leaders")
    leaders = own.select("b", F.col("b").alias("a"), "n", "score", empty.alias("added"), empty.alias("removed"))
    members = leaders.unionByName(near.select("a", "b", "n", "score", "added", "removed"))
    half = near.select("b", F.explode("added").alias("e"), F.lit(1).alias("adds")).unionAll(near.select("b", F.explode("removed"), F.lit(0)))
    half = half.groupBy("b", "e", "adds").agg(F.count(F.lit(1)).alias("often")).join(own.select("b", "g"), "b").filter("2 * often > g + 1")
    # no more than twice a member's elements on average
    half = half.groupBy("b").agg(F.collect_list(F.expr("if(adds = 1, e, null)")).alias("most_add"), F.collect_list(F.expr("if(adds = 0, e, null)")).alias("most_remove"))
    centre = own.select("b", F.col("n").alias("lead_n")).join(half, "b", "left").select("b", F.coalesce("most_add", empty).alias("most_add"), F.coalesce("most_remove", empty).alias("most_remove"), F.expr("lead_n + coalesce(size(most_add), 0) - coalesce(size(most_remove), 0)").alias("whole"))
    told = members.join(centre, "b").select(
        "a", "b", "n", "score", "whole",
        F.expr("concat(array_except(added, most_add), array_except(most_remove, removed))").alias("added"),
        F.expr("concat(array_except(removed, most_remove), array_except(most_add, added))").alias("removed"),
    )
    told = told.withColumns({"more": F.size("added"), "less": F.size("removed")}).withColumns({"weight": F.expr(f"100 * less + {percent} * more"), "lean": F.expr(f"{percent} * (less - more)")})
    told = keep(told.withColumn("excess", F.expr(f"weight - {rest} * whole")).drop("whole"), "families")
    drop(near, own)
    ends = told.groupBy("b").agg(F.max("lean").alias("cap"), F.min(F.struct("weight", "a")).alias("light"))
    ends = ends.select("b", "cap", F.col("light.weight").alias("lightest"), F.col("light.a").alias("first"))
    return told.join(ends, "b").withColumn("core", F.expr("excess + lightest <= 0"))


def difference_lists(told: DataFrame, percent: int, turn: int) -> DataFrame:
    """Lists of (leader, element that is added to the centre or removed from it) with two members or more.

    Only pairs with a member u outside the core matter. The partner v shares at most its own removals, so there are at
    least (excess(u) - lean(v)) / (100 + percent) that both add. Where that has to be, u meets each partner in the
    lists of the rarest elements that it adds. If u and v add nothing in common, excess(u) is at most lean(v), and they
    share (excess(u) + weight(v)) / (100 + percent) of what they remove, where weight(v) is that of the
    lightest at least: lists of removals have the rarest of such members only.

    `own` is how many of the added elements no other member has, `shared` the rest.
    """
    sure = 100 + percent
    adds = F.expr(f"if(core, 1, greatest(1, (excess - cap + {sure - 1}) div {sure}))")
    removes = F.expr(f"greatest(1, (if(core, weight + 1 - lightest, excess + lightest) + {sure - 1}) div {sure})")
    carried = ["a", "b", "n", "score", "more", "less", "weight", "excess"]
    each = told.select(*carried, F.lit(1).alias("kind"), F.col("more").alias("s"), adds.alias("need"), F.explode("added").alias("e"))
    lost = told.filter("if(core, lean + lightest > 0, excess <= cap)").select(*carried, F.lit(2).alias("kind"), F.col("less").alias("s"), removes.alias("need"), F.explode("removed").alias("e"))
    # an element is either the centre's or not, so its kind is the same for all members
    each = each.unionByName(lost)
    often = each.groupBy("b", "e").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    met = each.join(often, ["b", "e"])
    pair, by = W.partitionBy("a", "b"), W.partitionBy("a", "b", "kind")
    met = met.withColumn("value", F.xxhash64("b", "e", F.lit(turn))).withColumn("shared", F.count(F.expr("if(kind = 1, 1, null)")).over(pair))
    met = met.withColumns({"rank": F.row_number().over(by.orderBy("often", "e")), "common": F.count(F.lit(1)).over(by)})
    kept = met.filter("rank + s - common <= s - need + 1")
    own = (F.col("more") - F.col("shared")).alias("own")
    return kept.select("value", F.col("a").alias("rep"), "n", "score", _before(pair.orderBy("kind", "rank")), F.lit(SHORT_APART).alias("short"), "kind", "less", own, "shared", "weight", "excess")


#: Columns of a list's entry besides value, rep, n, score and before, and what they are in lists of retained values.
_APART = {"short": SHORT, "kind": 0, "less": 0, "own": 0, "shared": 0, "weight": 0, "excess": 0}


def class_components(lists: DataFrame, checker: Checker, percent: int) -> DataFrame:
    """node and component of every class that is linked with another. The lists are (value, rep, n, score, before)."""
    sure, rest = 100 + percent, 100 - percent
    labels = lists.sparkSession.createDataFrame([], "node bigint, component bigint")
    # far: not near any leader that the list has had
    open_ = lists.select("*", F.lit(True).alias("far"), *(F.lit(v).cast("bigint").alias(c) for c, v in _APART.items()), F.col("rep").alias("comp"))
    passed = ["value", "rep", "n", "score", "before", "far", *_APART]
    for k in count():
        sizes = open_.groupBy("value").agg(F.count(F.lit(1)).alias("m"), F.min("comp").alias("least"), F.max("comp").alias("most"), F.max("far").alias("far"))
        before, open_ = open_, keep(open_.join(sizes.filter("least != most AND far").select("value", "m"), "value"), "open")
        drop(before)
        if open_.isEmpty():
            return labels
        short, long = open_.filter(f"m <= short * {GROWTH**k}"), open_.filter(f"m > short * {GROWTH**k}")
        fits = lambda p: F.expr(f"100 * least(a_n, b_n) >= {p} * greatest(a_n, b_n)")
        ends = lambda x: short.select("value", *(F.col(c).alias(f"{x}_{c}") for c in ("n", "comp", "before", *_APART)), F.col("rep").alias(x))
        every = ends("a").join(ends("b"), "value").filter("a < b AND a_comp != b_comp").filter(fits(percent))
        # own elements keep two members apart, and so does what one adds or removes more than the other
        every = every.filter(f"{sure} * (a_own + b_own + abs(a_shared - b_shared) + abs(a_less - b_less)) <= {rest} * (a_n + b_n)")
        every = every.filter(f"a_kind = 0 OR a_excess + b_weight <= {sure} * (least(a_less, b_less) + if(a_kind = 1, least(a_shared, b_shared), 0))")
        # a pair that shares an earlier list is found there: each list sees to all of its links
        every = every.filter("NOT arrays_overlap(a_before, b_before)").select("a", "b", F.lit(False).alias("led"), F.lit(percent).alias("percent"))
        leaders = long.groupBy("value").agg(F.max_by(F.struct("rep", "n"), F.struct("score", -F.col("rep"))).alias("lead"))
        leaders = leaders.select("value", F.col("lead.rep").alias("b"), F.col("lead.n").alias("b_n"))
        member = long.join(leaders.select("value", F.col("b").alias("rep")), ["value", "rep"], "left_anti").select(*passed)
        lead = long.select("value", F.col("rep").alias("a"), F.col("n").alias("a_n"), "score").join(leaders, "value").filter("a != b")
        led = lead.filter(fits(checker.least)).select("a", "b", F.lit(True).alias("led"), F.lit(checker.least).alias("percent"))
        seen = keep(checker.similar(every.unionByName(led).distinct()), "seen")
        near = lead.groupBy("a", "b").agg(F.max("a_n").alias("n"), F.max("score").alias("score")).join(seen.filter("size(added) + size(removed) > 0"), ["a", "b"])
        told = families(near, percent)
        apart = difference_lists(told, percent, k)
        # two that are near the leader are seen to by its family's lists; whoever is so near that all it can be linked to are near, leaves this one
        marked = seen.filter(f"100 * both >= {checker.least} * either").select("a", "b", F.expr(f"100 * both >= {checker.least + rest} * either").alias("closed"))
        marked = lead.join(marked, ["a", "b"]).groupBy("value", F.col("a").alias("rep"), "b").agg(F.max("closed").alias("closed"))
        stay = member.join(marked, ["value", "rep"], "left").filter("NOT coalesce(closed, false)")
        stay = stay.withColumns({"before": F.expr("if(b IS NULL, before, array_append(before, xxhash64(b, 'family')))"), "far": F.expr("b IS NULL")})
        if k == 0:
            # lists that aren't short in the next round either; later on all retained values have short lists
            stay = keep(stay.select(*passed, "b"), "stay")
            crowded = stay.groupBy("value").agg(F.count(F.lit(1)).alias("m"), F.max("far").alias("any")).filter(f"any AND m > {SHORT * GROWTH}").select("value")
            moved = element_lists(stay.join(crowded, "value"), checker.texts, checker.n, percent)
            moved = moved.withColumns({c: F.lit(v).cast("bigint") for c, v in _APART.items()}).select(*passed)
            stay = stay.join(crowded, "value", "left_anti").select(*passed).unionByName(moved)
        stay = stay.select(*passed)
        links = seen.filter(f"100 * both >= {percent} * either").select("a", "b").union(told.filter("core").select("a", "first"))
        # earlier components are links to their smallest class
        links = links.union(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
        labels = settled(links.sparkSession, lambda links=links: components(links), "components")
        joined = labels.select(F.col("node").alias("rep"), "component")
        after = stay.unionByName(apart.withColumn("far", F.lit(True)).select(*passed)).join(joined, "rep", "left").select(*passed, F.coalesce("component", "rep").alias("comp"))
        # written before its sizes are looked at, as a plan that has all of this twice is the driver's to plan again after each of its shuffles
        after = keep(after, "lists")
        drop(open_, seen)
        open_ = after


def near_rows(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of `docs`: its key (row_key), doc_id, n_shingles, component_id and kept, all but the key as of near_dedup."""
    return settled(docs.sparkSession, lambda: _near_rows(docs, shingle, percent), "near-rows")


def _near_rows(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    texts = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"), row_key().alias("row"), "text")
    sketched = keep(texts.mapInArrow(_sketch(shingle, max(SKETCH, prefix(percent)[0])), "id bigint, row bigint, n bigint, d1 bigint, d2 bigint, sketch array<bigint>"), "sketches")
    same = ["n", "d1", "d2"]
    groups = sketched.filter("n > 0").groupBy(*same).agg(F.min(F.struct("id", "row")).alias("lead"), F.first("sketch").alias("sketch"))
    groups = keep(groups.select(*same, F.col("lead.id").alias("least"), F.col("lead.row").alias("rep"), "sketch"), "classes")
    lists = keep(inverted_lists(groups, percent), "lists")
    active = lists.select("rep").distinct()
    checker = Checker(
        keep(groups.select("rep", "sketch").join(active, "rep", "left_semi"), "active"),
        # equal rows have one key; one text for each is enough
        keep(texts.select("row", "text").join(active.select(F.col("rep").alias("row")), "row", "left_semi").dropDuplicates(["row"]), "active-texts"),
        shingle,
        min(NEAR, percent),
    )
    comps = class_components(lists, checker, percent).select(F.col("node").alias("rep"), "component")
    # a component is named for its smallest id, whose row stands for it
    best = comps.join(groups.select("rep", "least"), "rep").groupBy("component").agg(F.min(F.struct("least", "rep")).alias("lead"))
    named = comps.join(best, "component").select("rep", F.col("lead.least").alias("first"), F.col("lead.rep").alias("stands"))
    member = sketched.select("id", "row", *same).join(groups.select(*same, "least", "rep"), same, "left")
    member = member.select("id", "row", "n", F.coalesce("least", "id").alias("least"), F.coalesce("rep", "row").alias("rep"))
    return member.join(named, "rep", "left").select(
        "row",
        F.expr(f"nullif(id, {NO_ID}L)").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.expr(f"nullif(coalesce(first, least), {NO_ID}L)").alias("component_id"),
        (F.col("row") == F.coalesce("stands", "rep")).alias("kept"),
    )


def near_dedup(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept (the document that stands for its component)."""
    return near_rows(docs, shingle, percent).drop("row")
