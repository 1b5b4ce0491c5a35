"""Lists that classes of near copies enter."""

from __future__ import annotations

from math import comb

import pytest
from pyspark.sql import functions as F

from rollbook.llm import near_dedup


@pytest.mark.parametrize("percent", [30, 60, 80, 85, 95])
def test_pairs_share_enough_listed_values(percent):
    m, share = near_dedup.prefix(percent)
    need, t = int(share * m), percent / 100
    assert sum(comb(m, k) * t**k * (1 - t) ** (m - k) for k in range(need)) <= 1e-8


def test_texts_with_a_common_passage_alone_do_not_meet(spark):
    """A third of each text is one passage; few of them are in its lists, and those give few pairs."""
    passage = " ".join(f"common{k}" for k in range(62))
    rows = [(i, f"{passage} " + " ".join(f"d{i}w{k}" for k in range(120))) for i in range(400)]
    texts = spark.createDataFrame(rows, "id bigint, text string").select("id", F.col("id").alias("row"), "text")
    sketched = texts.mapInArrow(near_dedup._sketch(3, near_dedup.SKETCH), "id bigint, row bigint, n bigint, d1 bigint, d2 bigint, sketch array<bigint>")
    lists = near_dedup.inverted_lists(sketched.withColumnRenamed("row", "rep"), 85)
    assert lists.select("rep").distinct().count() < 60
