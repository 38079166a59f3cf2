"""Stores that outlive a run: whole versions, points computed once, retries that end and resume."""

import os

import pytest
from pyspark.sql import functions as F

from stocktake.operators import store as S


def test_versions_appear_whole(spark, tmp_path):
    root = f"file://{tmp_path}/s"
    s = S.Store(spark, root, "k long, v string")
    assert s.versions() == [] and s.read().collect() == [] and s.read_all().columns == ["k", "v", "version"]
    assert S.upsert(s, spark.sql("select 1L as k, 'a' as v union all select 2, 'b'"), ["k"]) == 1
    with pytest.raises(Exception, match="broken"):
        s.write(spark.sql("select 3L as k, cast(raise_error('broken') as string) as v"))
    assert s.versions() == [1] and s.read().count() == 2
    assert S.upsert(s, spark.sql("select 2L as k, 'c' as v"), ["k"]) == 2
    assert sorted(map(tuple, s.read().collect())) == [(1, "a"), (2, "c")] and sorted(map(tuple, s.read(1).collect())) == [(1, "a"), (2, "b")]
    with pytest.raises(RuntimeError, match="another run"):  # a writer that has seen version 1 only
        s.write(spark.sql("select 9L as k, 'x' as v"), after=1)
    assert s.versions() == [1, 2] and [n for n in os.listdir(tmp_path / "s") if not n.startswith(("version=", "_writing"))] == []
    with pytest.raises(ValueError, match="no version 7"):
        s.read(7)
    assert S.Store(spark, root, "k long, v string").read().count() == 2


def test_points_are_computed_once(spark, tmp_path):
    s = S.Store(spark, f"file://{tmp_path}/p", "k long, v long")
    asked = []

    def square(absent):
        asked.append(sorted(r.k for r in absent.collect()))
        return absent.select("k", (F.col("k") * F.col("k")).alias("v"))

    points = spark.range(6).select(F.col("id").alias("k"))
    S.computed(points.where("k < 3"), ["k"], s, square)
    got = S.computed(points.unionByName(points.where("k = 5")), ["k"], s, square)
    assert asked == [[0, 1, 2], [3, 4, 5]] and sorted((r.k, r.v, r.version) for r in got.collect()) == [(0, 0, 1), (1, 1, 1), (2, 4, 1), (3, 9, 2), (4, 16, 2), (5, 25, 2), (5, 25, 2)]
    S.computed(points, ["k"], s, square)
    assert len(asked) == 2 and s.versions() == [1, 2]


def test_retries_end_and_resume(spark, tmp_path):
    """Key k is accepted at its k-th attempt, 9 never, 8 is never answered; the third pass dies and the next run goes on."""
    work = spark.createDataFrame([(1,), (2,), (4,), (8,), (9,), (9,)], "k long")
    s = S.Store(spark, f"file://{tmp_path}/r", "k long, attempt int, accepted boolean")
    passes = []

    def attempt(todo, dies):
        passes.append(sorted(map(tuple, todo.collect())))
        if len(passes) == dies:
            raise KeyboardInterrupt
        return todo.where("k <> 8").withColumn("accepted", (F.col("k") == F.col("attempt")) & (F.col("k") < 8))

    with pytest.raises(KeyboardInterrupt):
        S.retried(work, ["k"], s, lambda t: attempt(t, 3), limit=5)
    got = S.retried(work, ["k"], s, lambda t: attempt(t, 0), limit=5)
    assert sorted(map(tuple, got.collect())) == [(1, 1, True), (2, 2, True), (4, 4, True), (8, 5, False), (9, 5, False)]
    assert passes[:4] == [[(1, 1), (2, 1), (4, 1), (8, 1), (9, 1)], [(2, 2), (4, 2), (8, 2), (9, 2)], [(4, 3), (8, 3), (9, 3)], [(4, 3), (8, 3), (9, 3)]] and len(passes) == 6
