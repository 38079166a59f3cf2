"""The least cosine of groups against all pairs, and how many pairs that takes."""

import numpy as np
import pytest

from stocktake.operators.cohesion import least_cosine
from stocktake.operators.match import cohesion


def plain(vectors):
    v = np.array(vectors, float)
    n = np.sqrt((v * v).sum(1))
    cos = np.einsum("ik,jk->ij", v, v) / (n[:, None] * n + 1e-10)
    return cos[np.triu_indices(len(v), 1)]


def frame(spark, groups):
    return spark.createDataFrame([(k, i, [float(x) for x in v]) for k, vs in groups.items() for i, v in enumerate(vs)], "g string, i int, v array<double>").repartition(4)


@pytest.mark.parametrize("block, pivots", [(1024, 32), (8, 6), (1, 3)])
def test_groups_of_all_kinds(spark, block, pivots):
    rng = np.random.default_rng(block)
    wide = rng.normal(size=(60, 5))
    groups = {"wide": wide, "zero": [*wide[:5], [0.0] * 5, [0.0] * 5], "copies": [wide[0]] * 30, "two": wide[:2], "one": wide[:1], "opposite": [wide[0], -wide[0]] * 10, "near": 3 + rng.normal(size=(50, 5)) * 0.1, "tiny": wide[:6] * 1e-6}
    df = frame(spark, groups).unionByName(spark.createDataFrame([("wide", 900, None), (None, 1, [1.0, 0.0]), (None, 2, [0.0, -2.0])], "g string, i int, v array<double>"))
    got = {r.g: r.min_cos for r in least_cosine(df, ["g"], "i", "v", block, pivots).collect()}
    want = {k: plain(v).min() for k, v in groups.items() if len(v) > 1} | {None: 0.0}
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want), (got, want)


def test_clusters_skip_nearly_all_pairs(spark):
    """A cap of close vectors and a few opposite ones: blocks of the cap are never compared with one another."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 24))
    vs = np.concatenate([centres[rng.integers(0, 6, 6000)] + rng.normal(size=(6000, 24)) * 0.05, -centres[:1] + rng.normal(size=(20, 24)) * 0.05])
    (r,) = least_cosine(frame(spark, {"a": vs}), ["g"], "i", "v", 64, 32).collect()
    assert abs(r.min_cos - plain(vs).min()) < 1e-9
    assert r.compared < 0.05 * len(vs) ** 2 / 2


def test_cohesion_is_that_of_all_pairs(spark):
    rng = np.random.default_rng(2)
    groups = {"a": rng.normal(size=(40, 8)), "b": rng.normal(size=(2, 8)), "c": rng.normal(size=(1, 8))}
    got = {r.g: r for r in cohesion(frame(spark, groups), ["g"], "i", "v").collect()}
    assert set(got) == {"a", "b"}
    for k in got:
        cos = plain(groups[k])
        assert abs(got[k].mean_cos - cos.mean()) < 1e-8 and abs(got[k].min_cos - cos.min()) < 1e-9 and got[k].pairs == len(cos)
