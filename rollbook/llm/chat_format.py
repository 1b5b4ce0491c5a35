"""Multi-party perspective rotation.

A dialogue is rendered once for every participant: that speaker's turns become the assistant's turns and
carry the training mask, all others are users with their name, instructions (`system`) stay what they are.

A rendered turn is `<|assistant|>`, `<|system|>` or `<|user|>NAME`, a line break, the text, `<|end|>` and a
line break. The mask lists character spans [start, end): text and end mark of the assistant's turns.

A dialogue is all turns of a conversation, and every participant gets all of them. A
rendering is one row (block 0) up to about PART characters; a longer one is cut between turns into rows
that are numbered in `block` and give the whole when put together in that order. Spans count
from the beginning of the whole rendering; n_turns and n_own are those of the row.

No list is longer than a part: turns are put in order by range, so a conversation of any length is
spread over tasks, places are running sums over the ranges, and participants are joined to each part on its own.

Cases: rows equal in all four columns count once; turns with equal numbers follow in order of role, then
text, null first; null turn numbers come first; a null or blank role
is the participant `unknown`; a null text is empty; the rows with a null conversation id are one
conversation with that id; a dialogue without participants other than `system` has no perspective and
gives no row; an empty table gives none; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollbook.llm.scratch import keep

#: Characters of a rendering, with every head a user's, from which a dialogue goes on in another part.
PART = 1 << 20
_ORDER = ("turn", "speaker", "given", "text")


def _running(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Sum of `value` over the rows before, by `keys` in order; each range is summed alone, and what precedes it is added."""
    within = W.partitionBy("range", *keys).orderBy(*_ORDER).rowsBetween(W.unboundedPreceding, -1)
    sums = df.groupBy("range", *keys).agg(F.sum(value).alias("_sum"))
    ahead = sums.withColumn("_ahead", F.coalesce(F.sum("_sum").over(W.partitionBy(*keys).orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in ("range", *keys)]
    joined = df.join(ahead.select(*(F.col(k).alias(f"_{k}") for k in ("range", *keys)), "_ahead"), same)
    return joined.withColumn(name, F.col("_ahead") + F.coalesce(F.sum(value).over(within), F.lit(0))).select(*df.columns, name)


def chat_format(turns: DataFrame, part: int = PART) -> DataFrame:
    """One row per conversation, part (`block`) and participant: rendered text, mask spans and counts."""
    clean = turns.select(
        "conv_id",
        "turn",
        F.expr("coalesce(nullif(trim(role), ''), 'unknown')").alias("speaker"),
        F.expr("text IS NOT NULL").alias("given"),
        F.expr("coalesce(text, '')").alias("text"),
    ).distinct()
    ranged = clean.repartitionByRange("conv_id", *_ORDER).withColumn("range", F.spark_partition_id())
    head = "length(if(speaker = 'system', '<|system|>\n', concat('<|user|>', speaker, '\n')))"
    ranged = ranged.withColumns({"size": F.expr(f"CAST({head} + length(text) + 8 AS BIGINT)"), "one": F.lit(1).cast("bigint")})
    ranged = keep(ranged, "turns")
    placed = _running(_running(ranged, ["conv_id"], "size", "at"), ["conv_id", "speaker"], "one", "before")
    # a part ends with the turn that fills it, so its list is bounded by PART and one turn
    parts = placed.withColumn("part", F.expr(f"at div {int(part)}")).groupBy("conv_id", "part").agg(
        F.sort_array(F.collect_list(F.struct(*_ORDER, "at", "before"))).alias("_turns")
    )
    who = ranged.filter("speaker != 'system'").select(F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective")).distinct()
    # a row without text for each part and participant, so that parts of one conversation are rendered in many tasks
    asked = placed.select("conv_id", F.expr(f"at div {int(part)}").alias("_part")).distinct()
    asked = asked.join(who, F.col("conv_id").eqNullSafe(F.col("_conv"))).select("_conv", "_part", "perspective")
    sides = parts.join(asked, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")))
    # turns of their own have another head, and shift what follows them
    shift = "(length('<|assistant|>\n') - length(concat('<|user|>', perspective, '\n')))"
    sides = sides.withColumn(
        "mask",
        F.expr(
            "transform(filter(_turns, t -> t.speaker = perspective), t -> named_struct("
            f"'start', t.at + t.before * {shift} + 14, 'end', t.at + t.before * {shift} + 14 + length(t.text) + 7))"
        ),
    )
    rendered = (
        "array_join(transform(_turns, t -> concat(CASE WHEN t.speaker = perspective THEN '<|assistant|>\n' WHEN t.speaker = 'system' THEN '<|system|>\n' "
        "ELSE concat('<|user|>', t.speaker, '\n') END, t.text, '<|end|>\n')), '')"
    )
    return sides.select(
        "conv_id",
        F.col("part").alias("block"),
        "perspective",
        F.expr("CAST(size(_turns) AS BIGINT)").alias("n_turns"),
        F.expr("CAST(size(mask) AS BIGINT)").alias("n_own"),
        F.expr(rendered).alias("rendered"),
        "mask",
    )
