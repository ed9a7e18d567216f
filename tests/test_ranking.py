"""Numbering and ranking against a plain window, with groups cut over partitions."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from branchvoice.operators import joins
from branchvoice.operators.ranking import first_per_key, number_rows, rank_in_group, rank_rows, top_per_key


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds more than a third of all rows; order values tie."""
    rng = random.Random(7)
    rows = [("hot" if i % 5 < 2 else f"g{rng.randrange(400)}", rng.randrange(20), i) for i in range(6000)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "g string, t int, id long").repartition(5)


@pytest.mark.parametrize("parts", [1, 7, 23])
def test_rank_in_group(skewed, parts):
    want = skewed.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("t", "id")).cast("long"))
    got = rank_in_group(skewed, "g", ["t", "id"], "r", parts).select("g", "t", "id", F.col("r").cast("long"))
    assert got.exceptAll(want.select("g", "t", "id", "r")).isEmpty() and got.count() == 6000


def test_hot_group_is_cut(skewed):
    """The range partitioning spreads the hot group, so no task holds it whole."""
    largest = (
        skewed.repartitionByRange(12, "g", "t", "id").filter("g = 'hot'")
        .groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    )
    assert largest < 2400 / 2


@pytest.mark.parametrize("parts", [None, 9])
def test_number_rows(skewed, parts):
    got = number_rows(skewed, "n", ["t", "id"], parts)
    want = skewed.withColumn("n", F.row_number().over(Window.orderBy("t", "id")).cast("long"))
    assert got.select("id", F.col("n").cast("long")).exceptAll(want.select("id", "n")).isEmpty()


def test_number_rows_as_it_lies(skewed):
    got = number_rows(skewed, "n").agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()
    assert tuple(got) == (1, 6000, 6000)


def test_first_and_top_per_key(skewed):
    first = {r["g"]: r["id"] for r in first_per_key(skewed, ["g"], ["t", "id"]).collect()}
    best = {}
    for r in skewed.collect():
        best[r["g"]] = min(best.get(r["g"], (99, 0)), (r["t"], r["id"]))
    assert first == {g: i for g, (_, i) in best.items()}
    assert top_per_key(skewed, ["g"], ["t", "id"], 2).groupBy("g").count().filter("count > 2").isEmpty()


def test_copies_are_dropped_before_the_shuffle(skewed):
    plan = first_per_key(skewed, ["g"], ["t", "id"])._jdf.queryExecution().executedPlan().toString()
    before, after = plan.find("WindowGroupLimit"), plan.rfind("WindowGroupLimit")
    assert before != after and "Exchange hashpartitioning(g" in plan[before:after]


def test_lookup_join_without_broadcast_gives_the_same(spark, skewed):
    dim = spark.createDataFrame([("hot", 1), ("g1", 2), ("g2", 3)], "g string, key long")
    small = joins.lookup_key(skewed, dim, ["g"], "key")
    large = joins.lookup_key(skewed, dim, ["g"], "key", max_bytes=0)
    assert small.exceptAll(large.select(small.columns)).isEmpty() and large.count() == 6000
    assert joins.is_small(dim) and not joins.is_small(dim, 10)


def test_rank_rows_with_and_without_hot_groups(spark, skewed):
    plain = {(r["g"], r["id"]): r["r"] for r in rank_rows(skewed, "g", ["t", "id"], "r").collect()}
    cut = {(r["g"], r["id"]): r["r"] for r in rank_rows(skewed, "g", ["t", "id"], "r", most=5).collect()}
    assert plain == cut and len(plain) == skewed.count()
