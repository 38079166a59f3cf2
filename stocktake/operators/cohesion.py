"""The least cosine of the pairs of each group, without looking at all pairs.

Angles obey the triangle inequality: two vectors are at most as far apart as one's angle to a pivot and the other's
together. Some vectors of each group are its pivots. Vectors are dealt out to blocks by their nearest pivot; a block
knows the range of its vectors' angles to each pivot. What is surely found already, the least cosine between a pivot and any
vector, then rules out every pair of blocks whose angles to some pivot add up to less. Only the other pairs of blocks are compared.

A group's vectors come as streams, cut into as many as it has DEALT rows; a task holds BLOCK vectors for each pivot. In
groups of clusters nearly all pairs are skipped. Vectors in all directions of many dimensions are all about as far from
one another, and no bound separates them: there the pairs of blocks that are left grow with the square of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written

BLOCK = 1024
DEALT = 1 << 16
PIVOTS = 32
GUARD = 1e-10


def _unit(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, zero ones staying, and norms."""
    norm = np.sqrt(np.einsum("ij,ij->i", v, v))
    return v / np.where(norm > 0, norm, 1)[:, None], norm


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of all rows of a and b, with the guard in the denominator that makes those of zero vectors 0."""
    (ua, na), (ub, nb) = _unit(a), _unit(b)
    n = na[:, None] * nb
    return np.einsum("ik,jk->ij", ua, ub) * (n / (n + GUARD))


def _angles(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(np.einsum("ik,jk->ij", _unit(v)[0], _unit(pivots)[0]), -1, 1))


def blocks_of(df: DataFrame, keys: list[str], id_col: str, vector: str, block: int = BLOCK, pivots: int = PIVOTS) -> DataFrame:
    """keys, _n, _v (packed vectors), _low, _high (their angles to each pivot, at least and most), _norm (the least), _least (cosine with another pivot), _block; written.

    A group has one pivot for each `block` rows, 1 to `pivots`: those whose ids have the smallest hashes.
    """
    rows = df.where(F.col(vector).isNotNull()).select(*keys, F.col(id_col).alias("_id"), F.col(vector).cast("array<double>").alias("_v"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], F.lit(True))
    sizes = written(rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("_rows")), "group-sizes")
    few = F.row_number().over(W.partitionBy(*keys).orderBy(F.xxhash64("_id"), "_id"))
    first = rows.withColumn("_place", few).where(F.col("_place") <= pivots).join(sizes, same).where(F.col("_place") <= F.greatest(F.lit(1), F.floor(F.col("_rows") / block)))
    parts = F.greatest(F.lit(1), F.ceil(F.col("_rows") / DEALT)).cast("int")
    heads = first.select(*keys, F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part"), F.lit(0).alias("_side"), "_id", "_v")
    each = rows.join(sizes, same).select(*keys, F.pmod(F.xxhash64("_id", F.lit(1)), parts).cast("int").alias("_part"), F.lit(1).alias("_side"), "_id", "_v")
    dealt = heads.unionByName(each).repartition(*keys, "_part").sortWithinPartitions(*keys, "_part", "_side")
    kinds = [df.schema[k] for k in keys]
    schema = T.StructType([*kinds, *T._parse_datatype_string("_n long, _v binary, _low array<double>, _high array<double>, _norm double, _least double").fields])
    names = schema.names

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, heads, held, units = None, [], {}, None
        out: list[tuple] = []

        def flush(which: list[int]) -> None:
            for p in which:
                v = np.array(held.pop(p)[1])
                angles, cos = _angles(v, np.array(heads)), _cosines(v, np.array(heads))
                apart = (v[:, None, :] != np.array(heads)[None]).any(2)  # not the pivot itself: a copy of one has the cosine of the two, near 1
                out.append((*group[:-1], len(v), v.tobytes(), angles.min(0).tolist(), angles.max(0).tolist(), float(_unit(v)[1].min()), float(np.where(apart, cos, 2.0).min())))

        kinds = None
        for batch in batches:
            kinds = kinds or [batch.schema.field(k).type for k in names[: len(names) - 6]]
            columns = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
            for i, key in enumerate(zip(*(columns[k] for k in names[: len(names) - 6]), columns["_part"], strict=True)):
                if key != group:
                    flush(list(held))
                    group, heads, units = key, [], None
                v = columns["_v"][i]
                if columns["_side"][i] == 0:
                    heads.append(v)
                    continue
                units = _unit(np.array(heads))[0] if units is None else units
                p = int((units * np.array(v)).sum(1).argmax())
                held.setdefault(p, (p, []))[1].append(v)
                if len(held[p][1]) >= block:
                    flush([p])
            if out:
                yield _batch(out, names, kinds)
                out.clear()
        if held:
            flush(list(held))
            yield _batch(out, names, kinds)

    made = dealt.select(*keys, "_part", "_side", "_v").mapInArrow(pack, schema)
    return written(made.withColumn("_block", F.monotonically_increasing_id()), "vector-blocks")


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    types = [*kinds, pa.int64(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def least_cosine(df: DataFrame, keys: list[str], id_col: str, vector: str, block: int = BLOCK, pivots: int = PIVOTS) -> DataFrame:
    """keys, min_cos, compared: the least cosine of two rows of each group, and how many pairs blocks were compared for.

    Rows without a vector are left out; a group of one row has no pairs and no row. Vectors of a group are equally long.
    """
    blocks = blocks_of(df, keys, id_col, vector, block, pivots)
    sure = blocks.groupBy(*keys).agg(F.min("_least").alias("_sure"))
    side = lambda s: blocks.select(*[F.col(k).alias(f"{s}{i}") for i, k in enumerate(keys)], *[F.col(c).alias(f"{s}{c}") for c in ("_block", "_high", "_norm")])
    same = lambda a, b: reduce(lambda x, y: x & y, [F.col(p).eqNullSafe(F.col(q)) for p, q in zip(a, b, strict=True)], F.lit(True))
    ks, ls, rs = ([f"{s}{i}" for i in range(len(keys))] for s in ("k", "l", "r"))
    pairs = side("l").join(side("r"), same(ls, rs) & (F.col("l_block") <= F.col("r_block")))
    pairs = pairs.join(sure.select(*[F.col(k).alias(n) for k, n in zip(keys, ks, strict=True)], "_sure"), same(ls, ks))
    widest = F.least(F.array_min(F.zip_with("l_high", "r_high", lambda a, b: a + b)), F.lit(np.pi))
    low = F.cos(widest) - 1e-9
    n = F.col("l_norm") * F.col("r_norm")
    bound = F.when(low > 0, low * (n / (n + GUARD))).otherwise(low)
    # a pair with two copies of a pivot may be missing from what is sure, as it is near 1: a bound under 1 keeps it
    left = pairs.where((bound <= F.col("_sure")) | (F.col("_sure") > 1)).select("l_block", "r_block")
    packed = lambda s: blocks.select(F.col("_block").alias(f"{s}_block"), F.col("_v").alias(f"{s}_v"), F.col("_n").alias(f"{s}_n"), *([F.col(k) for k in keys] if s == "l" else []))
    both = left.join(packed("l"), "l_block").join(packed("r"), "r_block").select(*keys, (F.col("l_block") == F.col("r_block")).alias("_same"), "l_v", "l_n", "r_v", "r_n")
    schema = T.StructType([*[df.schema[k] for k in keys], *T._parse_datatype_string("_min double, compared long").fields])
    count = len(keys)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, compared = [], []
            for same_, lv, ln, rv, rn in zip(*(batch.column(count + i).to_pylist() for i in range(5)), strict=True):
                cos = _cosines(np.frombuffer(lv).reshape(ln, -1), np.frombuffer(rv).reshape(rn, -1))
                if same_:
                    cos = cos[np.triu_indices(ln, 1)]
                found.append(float(cos.min()) if cos.size else None)
                compared.append(cos.size)
            yield pa.RecordBatch.from_arrays([*batch.columns[:count], pa.array(found, pa.float64()), pa.array(compared, pa.int64())], names=schema.names)

    seen = both.mapInArrow(compare, schema).groupBy(*keys).agg(F.min("_min").alias("_min"), F.sum("compared").alias("compared"))
    out = sure.alias("s").join(seen.alias("t"), same([f"s.{k}" for k in keys], [f"t.{k}" for k in keys]), "left")
    least = F.least(F.when(F.col("_sure") <= 1, F.col("_sure")), F.col("_min"))
    return out.select(*[F.col(f"s.{k}") for k in keys], least.alias("min_cos"), F.coalesce("compared", F.lit(0)).alias("compared")).where("min_cos is not null")
