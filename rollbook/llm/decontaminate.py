"""Benchmark decontamination by spaced-seed hashing.

Texts become lower-case words (runs of letters and digits). A mask picks some of the words of a short
span and ignores the others, so a substituted word doesn't break a seed that skips it. Masked hashes of the
benchmark are joined with those of all documents; each hit fixes how document and item lie against each
other, and that alignment is verified: some run of OVERLAP words of the item (the whole item, if it is
shorter) has to agree in all but a share of substituted words.

The different seeds of the benchmark are counted. Up to BROADCAST_SEEDS they are broadcast to pick the documents' seeds;
beyond, the documents' seeds are shuffled, once, to meet them. Either way documents are hashed once, and what is left are hits.
Documents with hits are read once more and verified, each row by its own text, and summed per document and item.

The masks find every overlap with items of 10 words or more. For shorter items there are seeds of
neighbouring words: the whole item where no word may differ, else its two halves, one of which is intact.
Documents get seeds of these lengths only if the benchmark has such items. An item of one to three words
makes every document that has them a hit, which is what a benchmark with such items asks for.

Cases: a null or empty text has no words and no hit; null ids are carried, and rows (and items) that share an id are matched each by
its own text; rows of one doc_id are reported together, with the best match; items that
repeat are reported under each id; an empty table on either side gives an empty result; other columns
are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.scratch import keep

#: Places that each mask looks at. None of them looks only at neighbours.
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8), (0, 2, 3, 5, 9, 10))
OVERLAP = 13
#: Words that may differ in a run of OVERLAP words, and as a share of a shorter item.
SUBSTITUTED = 2
BROADCAST_SEEDS = 500_000
#: Words of an item from which the masks find it.
MASKED = 10


def _neighbours(size: int) -> list[tuple[int, int]]:
    """Place and number of words of each seed of a short item."""
    half = size // 2
    return [(0, half), (half, size - half)] if SUBSTITUTED * size // OVERLAP else [(0, size)]


def _hashed(texts: DataFrame, *keys: str) -> DataFrame:
    """The key columns and _h, the hashes of the text's words, in order."""
    found = texts.select(*keys, F.expr(r"array_remove(split(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), '')").alias("_words"))
    return found.select(*keys, F.expr("transform(_words, w -> xxhash64(w))").alias("_h"))


def _row(texts: DataFrame, key: str) -> DataFrame:
    """_row, which tells rows apart by key and text, _id and text."""
    return texts.select(F.xxhash64(F.col(key).isNull(), F.col(key), "text").alias("_row"), F.col(key).alias("_id"), "text")


def _seeds(hashed: DataFrame, lengths: list[int]) -> DataFrame:
    """_row, _at and _seed of each place and mask, and of each place and run of one of the lengths.

    The hashes are made within the row, so that only they are exploded and no text is copied for each
    place. A mask that reaches beyond the end hashes fewer words, and can't match a whole one.
    """
    all_masks = [*enumerate(MASKS), *((100 + n, tuple(range(n))) for n in lengths)]
    masked = [f"transform(_h, (h, i) -> xxhash64({', '.join([str(k), 'h', *(f'get(_h, i + {p})' for p in mask[1:])])}))" for k, mask in all_masks]
    made = hashed.select("_row", F.expr("size(_h)").alias("_size"), F.expr(f"concat({', '.join(masked)})").alias("_seeds"))
    # the outer form, as for the other one Spark tests the size of the array first, and makes it twice
    placed = made.select("_row", "_size", F.posexplode_outer("_seeds").alias("_place", "_seed"))
    return placed.select("_row", F.expr("_place % _size").alias("_at"), "_seed", F.expr("_place div _size").alias("_mask"), "_size")


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id", most_broadcast: int = BROADCAST_SEEDS) -> DataFrame:
    """One row for each document and item that overlap: keys, first word of the overlap, item's words and those that agree."""
    rows = _row(docs, doc_key)
    items = keep(_hashed(_row(benchmark, item_key).dropDuplicates(["_row"]), "_row", "_id").filter("size(_h) > 0"), "items")
    # at most MASKED - 1 numbers
    sizes = sorted(r[0] for r in items.filter(f"size(_h) < {MASKED}").select(F.size("_h")).distinct().collect())
    lengths = sorted({n for size in sizes for _, n in _neighbours(size)})
    spans = ", ".join(str(mask[-1] + 1) for mask in MASKS)
    fits = [f"_mask < {len(MASKS)} AND _at + get(array({spans}), CAST(_mask AS INT)) <= _size"]
    fits += [f"_size = {size} AND _at = {at} AND _mask = {len(MASKS) + lengths.index(n)}" for size in sizes for at, n in _neighbours(size)]
    whole = _seeds(items.select("_row", "_h"), lengths).filter(" OR ".join(f"({fit})" for fit in fits))
    seeds = keep(whole.select("_seed", F.col("_row").alias("_item"), F.col("_at").alias("_from")).distinct(), "item-seeds")
    asked = keep(seeds.select("_seed").distinct(), "seeds")
    # 8 bytes each, and their number is checked
    asked = F.broadcast(asked) if asked.count() <= most_broadcast else asked
    hits = _seeds(_hashed(rows, "_row"), lengths).join(asked, "_seed").select("_row", "_at", "_seed")
    hits = keep(hits.distinct(), "hits")
    aligned = keep(hits.join(seeds, "_seed").select("_row", "_item", (F.col("_at") - F.col("_from")).alias("_shift")).distinct(), "alignments")
    sides = aligned.join(items.select(F.col("_row").alias("_item"), F.col("_id").alias("_item_id"), F.col("_h").alias("_g")), "_item")
    texts = rows.join(aligned.select("_row").distinct(), "_row", "left_semi").dropDuplicates(["_row"])
    found = _hashed(texts, "_row", "_id").join(sides, "_row")
    found = found.withColumn("_run", F.expr(f"least({OVERLAP}, size(_g))"))
    # words that agree (s, made once for each alignment), in each run that begins at a place of the item and altogether
    same = "transform(_g, (g, i) -> if(get(_h, i + _shift) <=> g, 1, 0))"
    best = "array_max(transform(sequence(0, size(s) - _run), i -> aggregate(slice(s, i + 1, _run), 0, (n, x) -> n + x)))"
    found = found.withColumn("_found", F.expr(f"element_at(transform(array({same}), s -> named_struct('best', {best}, 'agree', aggregate(s, 0, (n, x) -> n + x))), 1)"))
    good = found.filter(F.expr(f"_found.best >= _run - CAST(floor({SUBSTITUTED} * _run / {OVERLAP}) AS INT)"))
    per = good.groupBy(F.col("_id").alias(doc_key), F.col("_item_id").alias(item_key)).agg(
        F.max(F.struct(F.col("_found.agree").alias("agree"), (-F.col("_shift")).alias("back"), F.expr("size(_g)").alias("size"))).alias("_m")
    )
    return per.select(
        doc_key,
        item_key,
        F.expr("CAST(greatest(0, -_m.back) AS BIGINT)").alias("first_word"),
        F.expr("CAST(_m.size AS BIGINT)").alias("item_words"),
        F.expr("CAST(_m.agree AS BIGINT)").alias("same_words"),
    )
