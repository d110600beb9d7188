from __future__ import annotations

import random

from conftest import rows
from helpers import executed_plan
from wardflow.operators.dedup import latest_per_key


def test_newest_row_wins_and_nulls_are_oldest(spark):
    df = spark.createDataFrame(
        [("a", 1, "old"), ("a", 3, "new"), ("a", None, "undated"), ("b", None, "only")],
        "k string, t int, v string")
    assert rows(latest_per_key(df, ["k"], ["t"])) == [("a", 3, "new"), ("b", None, "only")]


def test_survivor_does_not_depend_on_partitioning(spark):
    data = [(f"k{i % 7}", 1, i) for i in range(200)]
    seen = set()
    for seed in range(4):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, t int, v int").repartition(1 + seed * 3)
        seen.add(tuple(rows(latest_per_key(df, ["k"], ["t"]))))
    assert len(seen) == 1


def test_ties_follow_the_given_columns(spark):
    df = spark.createDataFrame([("a", 2, 9), ("a", 1, 5)], "k string, x int, y int")
    assert rows(latest_per_key(df, ["k"], [], ["x"])) == [("a", 1, 5)]


def test_hot_key_is_reduced_before_the_exchange(spark):
    df = spark.range(0, 3000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k", "id AS t")
    kept = latest_per_key(df, ["k"], ["t"])
    plan = executed_plan(kept)
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[:exchange] and "Partial" in plan[exchange:]
    assert kept.count() == 2001
    assert kept.filter("k = -1").first()["t"] == 2997
