"""Group steps against brute force, on the plain and on the split path."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ascentframe.operators import ordered
from ascentframe.operators.ordered import Group, per_group


def rows(seed=5, hot=400):
    rng = random.Random(seed)
    out = []
    for key, size in [("hot", hot), ("b", 30), ("c", 3), ("d", 1)]:
        x = 0.0
        for i in range(size):
            x += rng.choice([0.0, 0.1, 0.5, 3.0])
            out.append((key, i, x, float(rng.randint(0, 9))))
    rng.shuffle(out)
    return out


def brute(data, delta):
    out = {}
    groups = {}
    for key, i, x, v in data:
        groups.setdefault(key, []).append((x, i, v))
    for key, items in groups.items():
        items.sort()
        total = 0.0
        for n, (x, i, v) in enumerate(items):
            total += v
            ahead = next((j for xx, j, _ in items if xx >= x + delta), None)
            out[key, i] = (
                n + 1, total, items[n - 1][2] if n > 0 else None, items[n - 3][2] if n > 2 else None,
                items[n + 2][2] if n + 2 < len(items) else None, max(w for _, _, w in items), ahead,
            )
    return out


@pytest.mark.parametrize("limit", [1_000_000, 100, 20, 2])
def test_steps_match_brute_force(spark, hot_groups, limit):
    hot_groups(limit)
    data = rows()
    df = spark.createDataFrame(data, "k string, i int, x double, v double").repartition(5)

    def work(group):
        group = group.number("n").running({"total": F.col("v")}).neighbours(["v"], back=3, ahead=2)
        group = group.attach({"top": F.max("v")})
        found = group.reach_ahead("x", 2.0, ["i"], "ahead", F.lit(True), "n")
        return found.select("k", "i", "n", "total", F.col("prev1.v").alias("p1"), F.col("prev3.v").alias("p3"),
                            F.col("next2.v").alias("n2"), "top", F.col("ahead.i").alias("ahead"))

    got = per_group(df, ["k"], [F.asc("x"), F.asc("i")], work).collect()
    want = brute(data, 2.0)
    assert len(got) == len(data) == len(want)
    for r in got:
        assert (r["n"], r["total"], r["p1"], r["p3"], r["n2"], r["top"], r["ahead"]) == want[r["k"], r["i"]]


def test_plain_path_needs_one_exchange(spark):
    df = spark.createDataFrame(pd.DataFrame({"k": [1, 1, 2], "x": [1.0, 2.0, 3.0]}))
    out = per_group(df, ["k"], [F.asc("x")],
                    lambda g: g.number("n").neighbours(["x"], 1, 1).attach({"m": F.max("x")}).df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_equal_values_are_cut_by_the_rest_of_the_order(spark, hot_groups):
    hot_groups(2)
    df = spark.createDataFrame([(1, i, 5.0) for i in range(20)], "k int, i int, x double")
    out = per_group(df, ["k"], [F.asc("i")], lambda g: g.number("n").df)
    assert sorted((r["i"], r["n"]) for r in out.collect()) == [(i, i + 1) for i in range(20)]


def _all_steps(group):
    group = group.number("n").running({"total": F.col("v"), "none": F.lit(None).cast("long")})
    group = group.neighbours(["v"], back=2, ahead=1).attach({"top": F.max("v"), "size": F.count(F.lit(1))})
    found = group.reach_ahead("x", 2.0, ["i"], "ahead", F.lit(True), "n")
    return found.select("k", "i", "n", "total", "none", "prev2.v", F.col("next1.v").alias("w"), "top", "size", F.col("ahead.i").alias("a"))


def test_missing_values_and_outliers_give_one_answer(spark, hot_groups):
    """Leading NULLs in a sum, NULLs in the order, NULL keys, one far outlier and equal rows: same rows on both ways."""
    rng = random.Random(8)
    data = []
    for key in ("a", None, "b"):
        for i in range(300 if key != "b" else 7):
            x = None if i % 40 == 0 else 1e12 if i == 17 else float(rng.randint(0, 60))
            data.append((key, i, x, None if x is None or x < 3 else float(rng.randint(0, 9))))
    df = spark.createDataFrame(data, "k string, i int, x double, v double").repartition(4)
    for order in ([F.asc("x"), F.asc("i")], [F.asc_nulls_last("x"), F.asc("i")]):
        answers = []
        for limit in (1_000_000, 30, 3):
            hot_groups(limit)
            answers.append(sorted(map(repr, per_group(df, ["k"], order, _all_steps).collect())))
        assert len(answers[0]) == len(data)
        assert answers[0] == answers[1] == answers[2]


def test_cuts_follow_the_rows_not_the_width(spark, hot_groups):
    hot_groups(100)
    df = spark.range(4000).select(F.lit(1).alias("k"), F.when(F.col("id") == 0, 1e15).otherwise(F.col("id") / 1e6).alias("x"))
    sizes = per_group(df, ["k"], [F.asc("x")], lambda g: g.df.withColumn("part", F.spark_partition_id()))
    assert sizes.groupBy("part").count().agg(F.max("count")).first()[0] < 800


def _reach(df, limit, hot_groups, spark):
    if limit:
        hot_groups(limit)

    def work(group):
        group = group.number("n")
        return group.reach_ahead("alt", 2000.0, ["n", "alt"], "up", F.lit(True), "n")

    return per_group(df, ["k"], [F.asc("alt"), F.asc("id")], work).select("k", "id", "up.n", F.col("up.alt").alias("to"))


def test_very_many_rows_at_one_altitude_are_cut(spark, hot_groups, monkeypatch):
    """Two million rows at one altitude: the plain answer, and no range much over the limit."""
    limit, count = 100_000, 2_000_000
    sizes = []
    dealt = Group._dealt_on_axis

    def watched(self, both, position):
        out = dealt(self, both, position)
        sizes.append(out.groupBy("k", "_range").count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(Group, "_dealt_on_axis", watched)
    df = spark.range(count).select(F.lit(1).alias("k"), "id", F.lit(500.0).alias("alt")).unionByName(
        spark.createDataFrame([(1, count, 2499.0), (1, count + 1, 2500.0), (1, count + 2, 2500.0), (1, count + 3, 4499.5)], "k int, id long, alt double"))
    out = _reach(df, limit, hot_groups, spark)
    got = out.groupBy("n", "to").agg(F.count(F.lit(1)).alias("rows"), F.min("id").alias("first")).collect()
    assert {(r["n"], r["to"]): (r["rows"], r["first"]) for r in got} == {
        (count + 2, 2500.0): (count, 0), (count + 4, 4499.5): (1, count), (None, None): (3, count + 1)}
    assert sizes and max(sizes) <= limit


@pytest.mark.parametrize("limit", [7, 40])
def test_reach_is_the_same_on_both_paths(spark, hot_groups, limit):
    rows = [(k, i, None if i % 11 == 0 else float([100 * (i // 3), 500, 1000 * (i % 4), 37 * i][k])) for k in range(4) for i in range(120)]
    df = spark.createDataFrame(rows, "k int, id long, alt double")
    usual = sorted(map(tuple, _reach(df, None, hot_groups, spark).collect()), key=repr)
    cut = sorted(map(tuple, _reach(df, limit, hot_groups, spark).collect()), key=repr)
    assert cut == usual and any(r[2] for r in usual)


def test_groups_of_known_size_are_not_counted_again(spark, hot_groups):
    hot_groups(20)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def looked(x):
        seen.add(1)
        return x

    rows = spark.range(60).select(looked("id").alias("i"), F.when(F.col("id") < 50, 1).otherwise(2).alias("k"))
    sizes = spark.createDataFrame([(1, 10), (2, 10)], "k int, _n long")
    ordered.per_group(rows, ["k"], [F.asc("i")], lambda group: group.number("n").df, sizes)
    assert seen.value == 0
    got = ordered.per_group(rows, ["k"], [F.asc("i")], lambda group: group.number("n").df, sizes.replace(10, 50, ["_n"]))
    assert sorted(map(tuple, got.select("k", "i", "n").collect())) == [(1, i, i + 1) for i in range(50)] + [(2, i, i - 49) for i in range(50, 60)]
