"""Centroid clustering against plain rounds, and what its bounds save."""

import hashlib
import math

import duckdb
import numpy as np
import pytest

from stocktake.llm import op13_centroid_clustering as op
from stocktake.llm.common import stack

SF = "/root/testdata/sf0.001"


def brute(rows, k, rounds, dims, salt="2:"):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))  # the column holds floats
    kept.sort(key=lambda r: (r[0] is None, hashlib.sha256(f"{salt}{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [list(v) for _, v in kept[:k]]
    for n in range(rounds + 1):
        own = [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in kept]
        for j in range(len(centroids) if n < rounds else 0):
            mine = [v for (_, v), (_, c) in zip(kept, own) if c == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine)]
    total = {j: sum(d for d, c in own if c == j) for j in range(len(centroids))} if kept else {}
    return sorted(((i, c, d, total[c], sum(total.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for (i, _), (d, c) in zip(kept, own)), key=repr) if kept else []


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x", 3) for i, v in rows], "vec_id long, embedding array<float>, own int, low int, v string, cluster int").repartition(3)


def test_table_and_sql(spark):
    got = op.op13_centroid_clustering(spark, SF)
    rows = [tuple(r) for r in stack(spark, SF, "embeddings").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 40, 5, 64)
    c = duckdb.connect()
    c.sql(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    rel = c.sql(op.SQL)
    assert rel.columns == got.columns and sorted(rel.fetchall(), key=repr) == brute(rows, 40, 5, 64)


@pytest.mark.parametrize("seed, scale", [(0, 0.01), (1, 0.02), (2, 1.0), (3, 1000.0)])
def test_ties_copies_and_odd_rows(spark, rows, seed, scale):
    """A coarse grid, so that distances tie; repeated ids and vectors, nulls, lengths that don't fit, NaN and infinities."""
    rng = np.random.default_rng(seed)
    docs = [(int(i), [float(x) for x in np.round(rng.normal(size=4) * 3) * scale]) for i in range(200)]
    docs += [docs[3]] * 40 + [(3, [0.0] * 4), (None, docs[5][1]), (None, [1.0] * 4), (500, None), (501, []), (502, [1.0] * 3), (503, [1.0] * 5)]
    docs += [(504, [1.0, None, 0.0, 0.0]), (505, [1.0, float("nan"), 0.0, 0.0]), (506, [float("inf"), 0.0, 0.0, 0.0]), (507, [-0.0, 1e-9, -1e-9, 0.0])]
    got = op.cluster(frame(spark, docs), clusters=12, rounds=4, dims=4)
    assert rows(got, "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256") == brute(docs, 12, 4, 4)


def test_fewer_vectors_than_clusters_and_none(spark, rows):
    docs = [(i, [float(i)] * 4) for i in range(5)]
    assert rows(op.cluster(frame(spark, docs), dims=4).drop("n_distances"), "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256") == brute(docs, 40, 5, 4)
    assert op.cluster(frame(spark, docs), dims=64).collect() == []
    assert op.cluster(frame(spark, []), dims=4).collect() == []


def test_bounds_save_distances(spark):
    """Vectors around well separated centres: nearly all distances are skipped, and none is wrong."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(8, 16)) * 20
    docs = [(int(i), [float(x) for x in centres[i % 8] + rng.normal(size=16)]) for i in range(800)]
    got = op.cluster(frame(spark, docs), clusters=8, rounds=5, dims=16).collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == brute(docs, 8, 5, 16)
    assert sum(r.n_distances for r in got) < 0.5 * len(docs) * 8 * 6


def test_roots_are_conservative():
    x = np.array([0, 1, 2, 3, 4, 8, 9, 10, 2**52 - 1, 2**52, (2**26 + 1) ** 2 - 1, (2**30 - 1) ** 2, (2**30 - 1) ** 2 + 1, 2**61 + 12345], np.int64)
    assert op.root_down(x).tolist() == [math.isqrt(v) for v in x.tolist()]
    assert op.root_up(x).tolist() == [math.isqrt(v) + (math.isqrt(v) ** 2 < v) for v in x.tolist()]


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="don't fit"):
        op.cluster(frame(spark, [(1, [1e30] * 4)]), dims=4).collect()
