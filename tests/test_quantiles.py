"""Exact quantiles by distributed selection, against plain sorting."""

import math
import random

import pytest
from pyspark.sql import functions as F

from stocktake.operators import quantiles as Q
from stocktake.operators import stats as S


def plain(values, p):
    v = sorted((x for x in values if x is not None), key=lambda x: (math.isnan(x), x))
    if not v:
        return None
    at = p * (len(v) - 1)
    low, high = math.floor(at), math.ceil(at)
    return v[low] if v[low] == v[high] or low == high else (high - at) * v[low] + (at - low) * v[high]


def rows_with(rng, kind, n):
    make = {
        "even": lambda: rng.random() * 1000 - 500,
        "steep": lambda: math.copysign(10.0 ** rng.uniform(-300, 300), rng.random() - 0.5),
        "odd": lambda: rng.choice([1.5, -0.0, 0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, float("inf"), float("-inf"), rng.random()]),
    }[kind]
    return [None if rng.random() < 0.05 else make() for _ in range(n)]


@pytest.mark.parametrize("kind", ["even", "steep", "odd"])
def test_one_group_holds_nearly_all_rows(spark, monkeypatch, kind):
    monkeypatch.setattr(Q.ranked_values, "__defaults__", (256, 20))
    rng = random.Random(kind)
    data = [("hot", v) for v in rows_with(rng, kind, 3000)] + [(None, v) for v in rows_with(rng, kind, 400)] + [("cold", v) for v in rows_with(rng, kind, 20)] + [("nulls", None)] * 200 + [("one", 7.0)] * 300
    df = spark.createDataFrame(data, "k string, v double")
    wanted = {"a": (F.col("v"), 0.1), "b": (F.col("v"), 0.5), "c": (F.col("v"), 0.9), "d": (-F.col("v"), 0.25)}
    got = {r.k: r for r in Q.group_stats(df, ["k"], wanted, [F.count("*").alias("n"), F.max("v").alias("top")], limit=100).collect()}
    assert set(got) == {"hot", "cold", None, "nulls", "one"}
    for k, r in got.items():
        own = [v for x, v in data if x == k]
        assert r.n == len(own)
        for name, p in (("a", 0.1), ("b", 0.5), ("c", 0.9)):
            assert r[name] == plain(own, p), (k, name)
        assert r.d == plain([None if v is None else -v for v in own], 0.25)


def test_whole_table_and_no_rows(spark):
    df = spark.range(1001).selectExpr("cast(id * id as double) as v", "1 as n", "'x' as rank")
    (r,) = Q.group_stats(df, [], {"m": (F.col("v"), 0.5), "q": (F.col("v"), 0.999)}, [F.sum("n").alias("rows_")], limit=10).collect()
    assert (r.m, r.rows_) == (250000.0, 1001) and r.q == plain([float(i * i) for i in range(1001)], 0.999)
    assert Q.group_stats(df.where("v < 0"), ["rank"], {"m": (F.col("v"), 0.5)}, limit=10).collect() == []


def test_no_task_holds_a_group(spark):
    """What is gathered, and how many rows a group sends on, doesn't grow with the group."""
    df = spark.range(0, 100_000, 1, 8).selectExpr("'all' as k", "cast(xxhash64(id) as double) as v")
    ranks = spark.createDataFrame([("all", 50_000), ("all", 7)], "k string, _rank long")
    got = {r._rank: r.v for r in Q.ranked_values(df, ["k"], "v", ranks, 256, 50).collect()}
    want = sorted(r.v for r in df.collect())
    assert got == {50_000: want[50_000], 7: want[7]}


def test_operators_take_the_same_values_either_way(spark, monkeypatch):
    rng = random.Random(3)
    df = spark.createDataFrame([(rng.randrange(2), rng.choice("ab"), float(rng.randrange(100))) for _ in range(2000)], "g int, s string, v double").cache()
    plain_ = sorted(map(tuple, S.subgroup_gap(df, ["g"], "s", ("a", "b"), "v").collect()))
    monkeypatch.setattr(Q.group_stats, "__defaults__", ((), 50))
    assert sorted(map(tuple, S.subgroup_gap(df, ["g"], "s", ("a", "b"), "v").collect())) == plain_
    med = {g: plain([r.v for r in df.collect() if r.g == g], 0.5) for g in (0, 1)}
    assert sorted(r.v for r in S.median_outliers(df, ["g"], "v", limit=50).collect()) == sorted(r.v for r in df.collect() if r.v < 0.5 * med[r.g])
