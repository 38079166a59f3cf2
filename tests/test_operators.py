"""Order, ties, empty groups and guards."""

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stocktake.functions import vectors as V
from stocktake.operators import match as M
from stocktake.operators import reconcile as R
from stocktake.operators import rows, stats


def test_first_of_ties(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 5.0), ("b", 3, None)], "k string, ord int, v double").repartition(3)
    assert sorted(map(tuple, rows.best_of(df, ["k"], F.col("v"), "ord").collect())) == [("a", 1, 5.0), ("b", 3, None)]
    assert rows.first_of(df.limit(0), ["k"], "ord").collect() == []


def test_bound_comes_before_dedupe(spark):
    df = spark.createDataFrame([("x", 90, 1), ("x", None, 2), ("y", 3, 3)], "clip string, chapter int, ord int")
    got = rows.dedupe_in_scope(df, rows.within(F.col("chapter"), 60, undated=True), ["clip"], "ord").collect()
    assert {(r.clip, r.ord) for r in got} == {("x", 2), ("y", 3)}
    assert [r.clip for r in df.where(rows.within(F.col("chapter"), 60, undated=False)).collect()] == ["y"]


def test_stage_of(spark):
    stages = spark.createDataFrame([(0, "s1", [3, 5]), (1, "s2", [5, 9])], "ord int, stage string, chapters array<int>")
    lines = spark.createDataFrame([(i, c) for i, c in enumerate([0, 1, 2, 3, 4, 5, 8, 9, 99, None])], "id int, ch int")
    got = {r.ch: r.stage for r in M.stage_of(lines, stages, "ch").collect()}
    assert got == {0: "prologue", 1: "prologue", 3: "s1", 4: "s1", 5: "s1", 8: "s1", 9: "s2", 99: "s2"}
    claims = rows.first_of(stages.select("ord", "stage", F.explode("chapters").alias("ch")), ["ch"], "ord")
    wide = M.as_of_ranges(lines.where("ch is not null"), claims, "ch", "stage", limit=1)
    assert {r.ch: r.stage for r in wide.collect()} == {0: None, 1: None, 2: None} | {k: v for k, v in got.items() if k > 1}


def test_as_of_without_keys_carries_over_runs(spark):
    left = spark.range(0, 300).select(F.col("id").cast("int").alias("x"))
    right = spark.createDataFrame([(x, f"v{x}") for x in range(7, 290, 9) if not 100 < x < 220], "x int, v string")
    claims = sorted(r.x for r in right.collect())
    want = {x: next((f"v{c}" for c in reversed(claims) if c <= x), None) for x in range(300)}
    assert {r.x: r.v for r in M.as_of(left, right, "x", "v").collect()} == want
    assert {r.v for r in M.as_of(left, right.limit(0), "x", "v").collect()} == {None}


def test_nearest_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([(1, 15.0), (2, None)], "id int, x double")
    got = [(r.id, r.target) for r in M.nearest(df, [("a", 10.0), ("b", 20.0)], F.col("x")).collect()]
    assert got == [(1, "a"), (2, None)]


def test_reconcile(spark):
    rec = spark.createDataFrame([("a",), ("b",)], "id string")
    dem = spark.createDataFrame([("b", True), ("c", True), ("d", False), ("a", False)], "id string, scope boolean")
    assert {tuple(r) for r in R.both_ways(rec, dem, ["id"], F.col("scope")).collect()} == {("c", "missing")}
    old, new = (spark.createDataFrame(x, "id string, t string") for x in ([("a", "1"), ("b", None), ("c", "3")], [("a", "2"), ("b", None), ("d", "4")]))
    assert {(r.id, r.change) for r in R.inventory_diff(old, new, ["id"], "t").collect()} == {("a", "modified"), ("c", "removed"), ("d", "added")}
    with pytest.raises(ValueError):
        R.refuse_duplicates(rec.union(rec), ["id"])
    with pytest.raises(ValueError):
        R.require_complete(rec, dem, rec, ["id"])
    assert R.refuse_duplicates(rec, ["id"]) is rec
    assert [r.origin for r in R.reuse_or_generate(rec, dem, ["id"], True).collect()] == ["reused"] * 2


def test_early_stop_and_retry(spark):
    df = spark.createDataFrame([("a", 1, 0.2), ("a", 2, 0.9), ("a", 3, 0.95), ("b", 1, 0.3), ("b", 2, 0.3)], "k string, n int, s double")
    assert {(r.k, r.n) for r in rows.best_with_early_stop(df, ["k"], "n", "s", 0.8).collect()} == {("a", 2), ("b", 1)}
    assert {(r.k, r.n) for r in rows.first_accepted(df, ["k"], "n", F.col("s") > 0.8).collect()} == {("a", 2), ("b", 2)}


def test_samples(spark):
    df = spark.createDataFrame([(i, f"src{i % 2}", None if i % 2 else i, "x" * (i % 5)) for i in range(40)], "id int, s string, ch int, t string")
    got = rows.stratified_longest(df, ["s"], "ch", "t", "id", 6)
    assert got.groupBy("s").count().where("count = 6").count() == 2
    a, b = (sorted(r.id for r in rows.seeded_sample(d, ["s"], "id", 5).collect()) for d in (df, df.repartition(7)))
    assert a == b and len(a) == 10
    top = rows.top_up(df.where("id < 2").select("id"), df.where("id > 30").select("id"), "id", 4)
    assert [r.id for r in top.collect()] == [0, 1, 31, 32]


def test_round_robin(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, None), (4, None)], "ord int, v string")
    assert {r.ord: r.v for r in rows.round_robin(df, F.col("v").isNull(), "ord", ["x", "y", "z"], None, "v").collect()} == {1: "x", 2: "y", 3: "z", 4: "y"}
    assert {r.ord: r.v for r in rows.round_robin(df, F.col("v").isNull(), "ord", ["x"], None, "v").collect()} == {1: "x", 2: "x", 3: "x", 4: "x"}


def test_groups_of_one(spark):
    df = spark.createDataFrame([("a", 1, [1.0, 0.0]), ("b", 2, [1.0, 0.0]), ("b", 3, [0.0, 1.0])], "k string, id int, v array<double>")
    assert [tuple(r) for r in M.cohesion(df, ["k"], "id", "v").collect()] == [("b", 0.0, 0.0, 1)]
    assert [(r.k, r.pairs) for r in M.mean_cohesion(df, ["k"], "v").collect()] == [("b", 1)]


def test_credibility(spark):
    df = spark.createDataFrame([("a", 0.01), ("a", 0.02)], "k string, s double")
    assert stats.credible(df, ["k"], "s").first().median_share == 0.015
    with pytest.raises(PySparkException):
        stats.credible(df, ["k"], "s", 0.01).collect()


def test_registers(spark):
    reg = spark.createDataFrame([("n", "N"), ("g", "G")], "registre string, consigne string")
    df = spark.createDataFrame([("", "", "x"), ("do", "g", "x"), (None, "zz", "x"), (None, None, "r")], "instruct string, registre string, role string")
    assert sorted(r.consigne for r in M.resolve_instruction(df, reg, {"r": "g"}, None, "n").collect()) == ["G", "N", "N", "do"]
    one = spark.range(1).select(M.prompt(F.lit("pre"), F.lit("reg"), F.lit("narrator")).alias("a"), M.prompt(F.lit("pre"), F.lit("reg"), F.lit("x")).alias("b")).first()
    assert (one.a, one.b) == ("reg", "pre reg")


def test_outlier_rule_is_not_idempotent(spark):
    df = spark.createDataFrame([("r", x) for x in (0.1, 0.1, 0.2, 0.4, 0.9)], "k string, s double")
    assert stats.median_outliers(df, ["k"], "s").count() == 0
    fixed = df.withColumn("s", F.when(F.col("s") == 0.1, 0.9).otherwise(F.col("s")))
    assert stats.median_outliers(fixed, ["k"], "s").count() == 2


def test_missing_and_doubled_defaults(spark):
    """No row is lost for want of a default, and an error says where one is needed and isn't there once."""
    reg = spark.createDataFrame([("n", "N"), ("g", "G")], "registre string, consigne string")
    df = spark.createDataFrame([("do", "g", "x"), (None, "g", "x")], "instruct string, registre string, role string")
    asked = lambda r, rows=df: sorted(x.consigne for x in M.resolve_instruction(rows, r, {}, None, "n").collect())
    assert asked(reg.where("registre = 'g'")) == asked(reg) == ["G", "do"]
    unknown = spark.createDataFrame([(None, "zz", "x")], df.schema)
    for bad in (reg.where("registre = 'g'"), reg.limit(0), reg.union(reg)):
        with pytest.raises(PySparkException):
            asked(bad, unknown)
    targets = spark.createDataFrame([("a", 1.0), ("*", 2.0)], "role string, target double")
    roles = spark.createDataFrame([("a",), ("b",)], "role string")
    assert sorted(r.target for r in M.target_of(roles, targets).collect()) == [1.0, 2.0]
    assert [r.target for r in M.target_of(roles.where("role = 'a'"), targets.where("role = 'a'")).collect()] == [1.0]
    for bad in (targets.where("role = 'a'"), targets.union(targets), targets.limit(0)):
        with pytest.raises(PySparkException):
            M.target_of(roles, bad).collect()
    values = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "k string, v double")
    assert sorted(r.d_v for r in stats.delta_to_baseline(values, F.col("k") == "a", ["v"]).collect()) == [0.0, 2.0]
    for baseline in (F.col("k") == "z", F.col("k") > ""):
        with pytest.raises(PySparkException):
            stats.delta_to_baseline(values, baseline, ["v"]).collect()


def test_repeated_dimension_keys(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    dim = spark.createDataFrame([("a", "x", 1), ("a", "y", 2)], "k string, v string, ord int")
    with pytest.raises(PySparkException):
        M.lookup(df, dim, "k", "v", F.lit("none")).collect()
    assert sorted(r.v for r in M.lookup(df, dim, "k", "v", F.lit("none"), "ord").collect()) == ["none", "y"]
    assert sorted((r.k, r.v) for r in M.role_defaults(df, dim, "k", ["v"], "ord").collect()) == [("a", "y"), ("b", None)]


def test_as_of_with_a_hot_key(spark):
    """One key with nearly all rows, null keys and null places, against a plain loop."""
    import random

    rng = random.Random(2)
    left = [(rng.choice(["h"] * 9 + ["a", None]), rng.choice([None, *range(400)]), i) for i in range(500)]
    right = list({(rng.choice(["h"] * 9 + ["a", None]), rng.randrange(400)): f"v{i}" for i in range(150)}.items())
    want = {i: max(((x, v) for (k2, x), v in right if k2 == k and at is not None and x <= at), default=(0, None))[1] for k, at, i in left}
    l = spark.createDataFrame(left, "k string, x int, i int").repartition(5)
    r = spark.createDataFrame([(k, x, v) for (k, x), v in right], "k string, x int, v string").repartition(3)
    got = {row.i: row.v for row in M.as_of(l, r, "x", "v", ["k"]).collect()}
    assert len(got) == 500 and {i: v for i, v in got.items() if left[i][0] is not None} == {i: v for i, v in want.items() if left[i][0] is not None}


def test_another_lot_is_reused_whole_or_not_at_all(spark):
    from stocktake.operators import reconcile

    wanted = spark.createDataFrame([(1, "a"), (2, "b")], "k int, name string")
    lot = spark.createDataFrame([(1, "x")], "k int, clip string")
    assert sorted(map(tuple, reconcile.reuse_plan(wanted, lot, ["k"]).collect())) == [(1, "a", "x", "reused"), (2, "b", None, "missing")]
    with pytest.raises(Exception, match="expected rows are missing"):
        reconcile.reuse_or_generate(wanted, lot, ["k"], True).collect()
    assert [tuple(r) for r in reconcile.reuse_or_generate(wanted.where("k = 1"), lot, ["k"], True).collect()] == [(1, "a", "x", "reused")]


def test_proximity_of_groups(spark):
    """Groups' sums give the mean cosine of all pairs: also with zero, short, null, empty and unequally long vectors."""
    rng = np.random.default_rng(7)
    vectors = [(["c0", "c1", "r0", "r1", "r2"][i % 5], i % 3, [float(x) for x in rng.normal(size=4) * 10.0 ** rng.integers(-7, 3)]) for i in range(150)]
    vectors += [("c0", 1, [0.0] * 4), ("r0", 1, [0.0] * 4), ("c1", 2, None), ("r1", 2, [1.0, None, 2.0, 3.0]), ("r2", 2, [1.0, 2.0]), ("c0", 2, []), ("r0", 2, []), ("c9", 0, None)]
    df = spark.createDataFrame(vectors, "who string, u int, v array<double>")
    c, r = df.where("who like 'c%'").withColumnRenamed("who", "c"), df.where("who like 'r%'").withColumnRenamed("who", "r")
    got = {(x.c, x.r): x.proximity for x in M.proximity(c, r, "u", "c", "r", "v").collect()}
    pairs = c.join(r.withColumnRenamed("v", "w"), "u").groupBy("c", "r").agg(F.avg(V.cosine(F.col("v"), F.col("w"))).alias("p"))
    want = {(x.c, x.r): x.p for x in pairs.collect()}
    assert got.keys() == want.keys() and all(want[k] is None if got[k] is None else abs(got[k] - want[k]) < 1e-10 for k in got)


def test_proximity_makes_no_pairs(spark, monkeypatch):
    """However many vectors two groups have, no cosine of a pair is asked for."""
    df = spark.range(4000).select((F.col("id") % 2).alias("who"), F.lit(0).alias("u"), F.array(F.lit(1.0), F.col("id").cast("double")).alias("v"))
    c, r = df.where("who = 0").withColumnRenamed("who", "c"), df.where("who = 1").withColumnRenamed("who", "r")
    monkeypatch.setattr(V, "cosine", lambda a, b: pytest.fail("a pair is compared"))
    assert M.proximity(c, r, "u", "c", "r", "v").count() == 1
