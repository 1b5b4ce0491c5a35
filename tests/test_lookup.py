"""Look-up helpers against plain joins, with hot keys."""

from __future__ import annotations

import pytest
from world import rows

from rollbook.operators import lookup as L
from rollbook.operators import sets

pytestmark = pytest.mark.usefixtures("few_rows")


@pytest.fixture
def sides(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d"), (1, "e")], "k int, l string")
    right = spark.range(400).selectExpr(
        "CASE WHEN id < 300 THEN 1 WHEN id < 395 THEN 2 ELSE 9 END AS rk",
        "CASE WHEN id % 7 = 0 THEN NULL ELSE cast(id % 90 AS string) END AS v")
    return left, right


def test_spread_lookup_is_a_left_join(sides):
    left, right = sides
    plain = left.join(right, left.k == right.rk, "left").select("k", "l", "v")
    once = L.spread_lookup(left, right, {"k": "rk"}, {"v": "v"})
    assert {"k", "l", "v", L.COPIES} == set(once.columns)
    assert rows(L.repeat_rows(once)) == rows(plain)
    assert once.where("k = 3 OR k IS NULL").count() == 2
    both = right.selectExpr("rk", "v AS code", "concat('x', v) AS v")
    plain = left.join(both, (left.k == both.rk) & (left.l == both.code), "left").select("k", "l", both.v)
    got = L.spread_lookup(left, both, {"k": "rk", "l": "code"}, {"v": "v"})
    assert rows(L.repeat_rows(got)) == rows(plain)


def test_equal_rows_are_one_row(spark, sides):
    """Three million equal rows of one key are one row with a count, and the left row isn't repeated for them."""
    left, _ = sides
    same = spark.range(3_000_000).selectExpr("1 AS rk", "'v' AS v")
    got = L.spread_lookup(left, same, {"k": "rk"}, {"v": "v"})
    assert rows(got.where("k = 1"), "l", L.COPIES) == [("a", 3_000_000), ("e", 3_000_000)]


@pytest.mark.parametrize("hot", ["left", "right"])
def test_a_hot_key_is_split_on_either_side(spark, hot):
    """Adaptive execution deals the rows of one key out over several tasks."""
    settings = {"spark.sql.adaptive.enabled": "true", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        many = spark.range(0, 200_000, 1, 16).selectExpr("if(id % 3 = 0, 7, cast(id AS int)) AS k", "cast(id AS string) AS v")
        few = spark.range(0, 2000, 1, 4).selectExpr("cast(id AS int) AS k", "cast(id AS string) AS w")
        left, right = (many, few) if hot == "left" else (few, many)
        left, right = left.toDF("k", "l"), right.toDF("rk", "v")
        got = L.spread_lookup(left, right, {"k": "rk"}, {"v": "v"})
        assert got.count() == left.join(right, left.k == right.rk, "left").count()
        got.collect()
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_multiply_counts_without_joining_rows(sides):
    left, right = sides
    plain = left.join(right, left.k == right.rk, "left").select("k", "l")
    once = L.multiply(left, right, {"k": "rk"})
    assert rows(once) == [(None, "d", 1), (1, "a", 300), (1, "e", 300), (2, "b", 95), (3, "c", 1)]
    assert rows(L.repeat_rows(once)) == rows(plain)
    twice = L.multiply(once, right, {"k": "rk"})
    assert rows(twice, L.COPIES) == [(1,), (1,), (95 * 95,), (90000,), (90000,)]


def test_the_same_columns_for_a_tiny_and_a_large_side(spark, sides):
    left, right = sides
    large = spark.range(2_000_000).selectExpr("cast(id % 3 AS int) AS rk", "cast(id AS string) AS v")
    for look_up in (lambda r: L.spread_lookup(left, r, {"k": "rk"}, {"v": "v"}), lambda r: L.multiply(left, r, {"k": "rk"})):
        columns = [look_up(r).columns for r in (right.limit(0), right, large)]
        assert columns[0] == columns[1] == columns[2] and L.COPIES in columns[0]


def test_rows_with_large_counts_are_sorted_in_several_tasks(spark):
    party = spark.range(3_000).selectExpr("'1' AS tax_id", "'p' AS party", "'s' AS site", "string(id % 50) AS account",
                                          f"50000L AS {L.COPIES}")
    ordered = sets.order_sites(party, "account")
    places = ordered.selectExpr("spark_partition_id() AS part", "account", L.COPIES)
    got = places.groupBy("part").agg({"account": "min", L.COPIES: "sum"}).orderBy("part").collect()
    assert len(got) > 1 and sum(r[f"sum({L.COPIES})"] for r in got) == 3_000 * 50_000
    assert [r["min(account)"] for r in got] == sorted(r["min(account)"] for r in got)


def test_repeat_rows_in_chunks(spark):
    n = 2 * L.CHUNK + 5
    df = spark.createDataFrame([("x", 1), ("y", n), ("z", L.CHUNK)], f"a string, {L.COPIES} bigint")
    assert rows(L.repeat_rows(df).groupBy("a").count()) == [("x", 1), ("y", n), ("z", L.CHUNK)]
