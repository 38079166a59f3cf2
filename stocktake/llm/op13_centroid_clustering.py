"""Centroid clustering by exact integer arithmetic, with Elkan's bounds.

Vectors become integers, centroids are integers, and squared distances are compared as integers: results depend on no
order of summation. A round assigns every vector to its nearest centroid (ties: the smaller number) and replaces each
centroid that has vectors by the floor of their componentwise mean.

Bounds. With each vector goes an upper bound on the distance to its own centroid and a lower bound on that to each of the
k centroids. When centroids move, upper bounds grow and lower bounds shrink by as much as they moved, and no distance is
computed for a vector whose upper bound is under half of the distance from its centroid to the next one. Of the other
vectors only the centroids count whose lower bound, and half of whose distance to the vector's own one, don't exceed
the upper bound. Bounds are whole numbers: upper ones are rounded up, lower ones down, and only what is strictly farther
is passed over, so that ties are seen and settled by the exact squared distances. After the last round each vector's
distance is computed exactly.

Bounds are cached in a table in the shared folder, which each round reads and writes anew (then the former one is
deleted, so the disk never holds more than two); a lost executor costs its tasks of one round. Tasks send k sums, not
vectors; the driver holds k centroids, k * k distances and nothing that grows with the vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, col, drop_staged, list_array, out_batch, stack, staged_at, tidy

CLUSTERS = 40
ROUNDS = 5
DIMS = 64
SCALE = 256
SALT = "2:"
FAR = (1 << 31) - 1


def root_down(squares: np.ndarray) -> np.ndarray:
    """The largest whole numbers whose squares don't exceed these (under 2**62)."""
    r = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    r -= r * r > squares
    return r + ((r + 1) * (r + 1) <= squares)


def root_up(squares: np.ndarray) -> np.ndarray:
    """The smallest whole numbers whose squares reach these."""
    r = root_down(squares)
    return r + (r * r < squares)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows."""
    d = a - b
    return np.einsum("ij,ij->i", d, d)


class Centroids:
    """k centroids, how far they are from one another (rounded down) and how far they came in the last move (rounded up)."""

    def __init__(self, at: np.ndarray, before: np.ndarray | None = None) -> None:
        self.at = at
        self.apart = root_down(np.stack([squared(at, c) for c in at]))
        self.moved = np.zeros(len(at), np.int64) if before is None else root_up(squared(at, before))
        others = self.apart + np.diag(np.full(len(at), 4 * FAR))
        self.next = others.min(1)

    def assign(self, v: np.ndarray, own: np.ndarray, upper: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Mend own, upper and low, the state before the move, for the rows v; how many distances were computed for each row."""
        upper += self.moved[own]
        np.maximum(low - self.moved, 0, out=low)
        looked = np.zeros(len(v), np.int64)
        rows = np.flatnonzero(self.next[own] <= 2 * upper)
        if not len(rows):
            return looked
        x, best, at = v[rows], squared(v[rows], self.at[own[rows]]), own[rows]
        bound, lower = root_up(best), low[rows]
        lower[np.arange(len(rows)), at] = root_down(best)
        tries = np.ones(len(rows), np.int64)
        for c in range(len(self.at)):
            hit = np.flatnonzero((at != c) & (lower[:, c] <= bound) & (self.apart[at, c] <= 2 * bound))
            d = squared(x[hit], self.at[c])
            lower[hit, c] = root_down(d)
            tries[hit] += 1
            better = (d < best[hit]) | ((d == best[hit]) & (c < at[hit]))
            win = hit[better]
            best[win], at[win], bound[win] = d[better], c, root_up(d[better])
        own[rows], upper[rows], low[rows], looked[rows] = at, bound, lower, tries
        return looked


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """(id, v): the vectors with dims finite components, each floor(scale * x)."""
    x = F.col("v")
    kept = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(F.when(F.size(x) == dims, finite_of(x)).otherwise(False))

    def floor(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        if not batch.num_rows:
            return None
        v = np.floor(scale * col(batch, "v").flatten().to_numpy())
        if 4 * dims * np.abs(v).max(initial=0) ** 2 >= 2.0**62:
            raise ValueError("components are so large that squared distances don't fit into a long")
        return out_batch(id=col(batch, "id"), v=list_array(pa.array(v.astype(np.int32)), np.full(batch.num_rows, dims)))

    return arrow_map(kept, floor, T.StructType([kept.schema["id"], T.StructField("v", T.ArrayType(T.IntegerType()))]))


def finite_of(x: F.Column) -> F.Column:
    """Whether no element is null, NaN or infinite."""
    return F.forall(x, lambda y: F.coalesce(~F.isnan(y) & (F.abs(y) < float("inf")), F.lit(False)))


def matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A list column whose lists are equally long, as a matrix of longs."""
    return col(batch, name).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, -1)


def assigned(state: DataFrame, now: Centroids) -> DataFrame:
    """state, (id, v) at first, with own, upper, low and looked after a round's assignment."""
    k, fresh = len(now.at), "own" not in state.columns

    def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        n = batch.num_rows
        if not n:
            return None
        v = matrix(batch, "v")
        if fresh:
            own, upper, low, looked = np.zeros(n, np.int64), np.full(n, 2 * FAR), np.zeros((n, k), np.int64), np.zeros(n, np.int64)
        else:
            own, upper, looked = (col(batch, c).to_numpy().astype(np.int64) for c in ("own", "upper", "looked"))
            low = matrix(batch, "low")
        looked += now.assign(v, own, upper, low)
        low = list_array(pa.array(np.minimum(low, FAR).ravel().astype(np.int32)), np.full(n, k))
        return out_batch(id=col(batch, "id"), v=col(batch, "v"), own=pa.array(own.astype(np.int32)), upper=upper, low=low, looked=looked)

    schema = T.StructType([state.schema["id"], state.schema["v"], *T._parse_datatype_string("own int, upper long, low array<int>, looked long").fields])
    return arrow_map(state, step, schema)


def moved(spark: SparkSession, state: DataFrame, now: Centroids) -> Centroids:
    """The centroids after a round: the floor of the mean of each one's vectors; those without vectors stay."""
    k = len(now.at)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, now.at.shape[1]), object), np.zeros(k, np.int64)
        for batch in batches:
            if batch.num_rows:
                v, own = matrix(batch, "v"), col(batch, "own").to_numpy()
                order = np.argsort(own, kind="stable")
                found, first = np.unique(own[order], return_index=True)
                total[found] += np.add.reduceat(v[order], first, axis=0)
                count[found] += np.diff(np.append(first, len(own)))
        full = np.flatnonzero(count)
        if len(full):
            dims = total.shape[1]
            each = np.hstack([total[full], count[full, None].astype(object)])
            yield out_batch(own=np.repeat(full, dims + 1), j=np.tile(np.arange(dims + 1), len(full)), s=pa.array([str(x) for x in each.ravel()]))

    parts = state.select("own", "v").mapInArrow(tidy(sums), "own long, j long, s string")
    at = now.at.copy()
    found: dict[int, dict[int, int]] = {}
    for own, j, s in parts.groupBy("own", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():  # k * (dims + 1) rows
        found.setdefault(own, {})[j] = int(s)
    for own, by in found.items():
        at[own] = [by[j] // by[at.shape[1]] for j in range(at.shape[1])]
    return Centroids(at, now.at)


def cluster(
    df: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, salt: str = SALT, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row per kept vector: id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256, n_distances.

    Kept are vectors with dims components, none null, NaN or infinite; n_distances says how many distances were computed
    for one, of clusters * (rounds + 1). Repeated rows count as often as they come. Centroids start as the vectors whose
    sha256 of salt and id are smallest; rows with equal ids go by their components, rows without an id come last. Where fewer vectors are kept than clusters,
    each starts a centroid; an empty table gives an empty result. Components of 2**27 steps and more (64 of them) are an
    error, as their distances aren't longs. Other columns are ignored.
    """
    spark = df.sparkSession
    state, path = staged_at(whole_vectors(df, id_col, vector_col, dims, scale), "vectors")
    first = state.orderBy(F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256).asc_nulls_last(), "v").limit(clusters).select("v").collect()
    names = ["cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "n_distances"]
    if not first:
        return state.select(F.col("id").alias(id_col), *(F.lit(None).cast(t).alias(n) for n, t in zip(names, ("int", "long", "long", "long", "string", "long"), strict=True)))
    now = Centroids(np.array([r.v for r in first], np.int64))
    for _ in range(rounds):
        state, new = staged_at(assigned(state, now), "bounds")
        drop_staged(spark, path)
        path, now = new, moved(spark, state, now)

    def last(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = col(batch, "own").to_numpy()
        return out_batch(id=col(batch, "id"), cluster=col(batch, "own"), distance=squared(matrix(batch, "v"), now.at[own]), n_distances=col(batch, "looked"))

    schema = T.StructType([state.schema["id"], *T._parse_datatype_string("cluster int, distance long, n_distances long").fields])
    done, _ = staged_at(arrow_map(assigned(state, now), last, schema), "clusters")
    drop_staged(spark, path)
    held = {c: int(s) for c, s in done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}  # k rows
    shas = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in now.at]
    about = spark.createDataFrame([(c, s, sum(held.values()), shas[c]) for c, s in held.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return done.join(F.broadcast(about), "cluster").select(F.col("id").alias(id_col), *names)


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(stack(spark, sf_dir, "embeddings")).drop("n_distances")


def _sql() -> str:
    """The rounds as common tables, one after another."""
    near = "n{0} as materialized (select vec_id, v, cluster, distance from (select *, row_number() over (partition by rid order by distance, cluster) as place from (select x.rid, x.vec_id, x.v, c.cluster, list_sum(list_transform(list_zip(x.v, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as distance from kept x, c{0} c)) where place = 1)"
    mean = "c{1} as materialized (select c.cluster, coalesce(m.c, c.c) as c from c{0} c left join (select cluster, list((s - ((s % n) + n) % n) // n order by j) as c from (select cluster, j, sum(x)::hugeint as s, count(*)::hugeint as n from (select cluster, unnest(v) as x, generate_subscripts(v, 1) as j from n{0}) group by cluster, j) group by cluster) m on c.cluster = m.cluster)"
    steps = [
        "kept as materialized (select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::hugeint) as v from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64)",
        "c0 as materialized (select (row_number() over (order by sha256('2:' || vec_id)) - 1)::int as cluster, v as c from kept order by sha256('2:' || vec_id) limit 40)",
    ]
    for i in range(ROUNDS):
        steps += [near.format(i), mean.format(i, i + 1)]
    steps.append(near.format(ROUNDS))
    return "with " + ",\n".join(steps) + f"""
select n.vec_id, n.cluster, n.distance::bigint as distance, (sum(n.distance) over (partition by n.cluster))::bigint as cluster_inertia,
  (sum(n.distance) over ())::bigint as inertia, sha256(array_to_string(c.c, ',')) as centroid_sha256
from n{ROUNDS} n join c{ROUNDS} c on n.cluster = c.cluster"""


SQL = _sql()
