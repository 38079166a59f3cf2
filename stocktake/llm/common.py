"""Helpers shared by the training-data operators: staged tables, Arrow loops, hashing, joins and ranks that no key can skew."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

M64 = 0xFFFFFFFFFFFFFFFF
#: A key with over one in HOT_KEYS of all rows is hot. Fewer than HOT_KEYS are, whatever the data: so they can be broadcast.
HOT_KEYS = 20_000
ROWS_PER_RANGE = 1_000_000
SLICE_BYTES = 8 << 20
#: Spark's setting that a query's shuffle files go when it ends, not when the driver's memory next happens to be collected.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The open blocks of passing(): what was staged in each.
_passing: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """This application's folder in the one that all executors share, spark.checkpoint.dir.

    Where that is unset, an own temporary folder serves sessions of a single process (tests); on a cluster it is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: it has to name a folder that the driver and all executors share")
        own = tempfile.mkdtemp(prefix="stocktake-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        path = f"file://{own}"
        spark.conf.set("spark.checkpoint.dir", path)
    return f"{path.rstrip('/')}/stocktake-{spark.sparkContext.applicationId}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage is cut and a lost executor costs no recomputation."""
    return staged_at(df, name)[0]


def staged_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """staged(), and the folder, which drop_staged() takes once nothing reads it any more."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _passing:
        _passing[-1].append(path)
    was = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(SHUFFLES_GO, was)
    return spark.read.schema(df.schema).parquet(path), path


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What is staged() inside is deleted at the end, but for what is lasting()."""
    _passing.append([])
    try:
        yield
    finally:
        for path in _passing.pop():
            drop_staged(spark, path)


def lasting(df: DataFrame, name: str) -> DataFrame:
    """staged() for the block around the innermost passing() one: it outlives that."""
    inner = _passing[-1:]
    del _passing[-1:]
    try:
        return staged(df, name)
    finally:
        _passing.extend(inner)


def drop_staged(spark: SparkSession, path: str) -> None:
    """Delete one folder of staged_at()."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def clear_staged(spark: SparkSession) -> None:
    """Delete everything staged() has left of this application; results read from it must not be used afterwards."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(top, True)


def give_back() -> None:
    """Free memory goes back to the system: a Python worker outlives its task, and what it keeps is missing in the next stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(stream: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that gives memory back when it is done."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from stream(batches)
        give_back()

    return run


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about SLICE_BYTES, so that what is made of a run at once stays small; a longer row is a run."""
    step = max(1, batch.num_rows * SLICE_BYTES // max(batch.nbytes, 1))
    for lo in range(0, batch.num_rows, step):
        yield batch.slice(lo, step)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | T.StructType) -> DataFrame:
    """mapInArrow with one output batch for each run of input rows; empty input batches are skipped."""

    def loop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                if (out := fn(part)) is not None:
                    yield out

    return df.mapInArrow(tidy(loop), schema)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """Whole texts as UTF-8 bytes; a null text is empty."""
    col = batch.column(batch.schema.get_field_index(column))
    return [x or b"" for x in col.cast(pa.large_binary()).to_pylist()]


def col(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def out_batch(**arrays: pa.Array | list | np.ndarray) -> pa.RecordBatch:
    made = [a if isinstance(a, pa.Array) else pa.array(a) for a in arrays.values()]
    return pa.RecordBatch.from_arrays(made, names=list(arrays))


def list_array(values: pa.Array, sizes: np.ndarray | list[int]) -> pa.Array:
    """A list<...> array from flat values and the size of each list."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of uint64 arrays."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Remembered(dict):
    """What make() gives for a key, remembered; the memory is bounded: long keys are passed by, and all is forgotten when there are too many."""

    LIMIT = 1 << 17
    LONGEST = 64

    def make(self, key):
        raise NotImplementedError

    def __missing__(self, key):
        made = self.make(key)
        if len(key) <= self.LONGEST:
            if len(self) >= self.LIMIT:
                self.clear()
            self[key] = made
        return made


class WordHash(Remembered):
    """word (bytes) -> 64-bit hash."""

    def make(self, word: bytes) -> int:
        import xxhash

        return xxhash.xxh3_64_intdigest(word)


def stack(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread_join(left: DataFrame, right: DataFrame, on: list[str], hot: Column) -> DataFrame:
    """left.join(right, on), for a right side with each key once, some of which may be in a third of left's rows.

    hot says which rows of right have a key with over one in HOT_KEYS of left's rows. These are broadcast, being fewer
    than HOT_KEYS; the rest meets by a shuffle that no key can skew. Both sides are read twice and should be staged.
    """
    big = right.where(hot)
    rest = left.join(F.broadcast(big.select(*on)), on, "left_anti").join(right.where(~hot), on)
    return left.join(F.broadcast(big), on).unionByName(rest)


def spread_on(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """left.join(right, key) by spread_join(); how many of left's rows have each key is counted."""
    held = left.groupBy(key).agg(F.count(F.lit(1)).alias("_held"))
    return spread_join(left, staged(right.join(held, key), "spread"), [key], F.col("_held") > left.count() // HOT_KEYS).drop("_held")


def two_level_rank(df: DataFrame, group: list[str], bucket: str, order: list, rank: str) -> DataFrame:
    """0-based rank of each row in its group by (bucket, order), without a group ever meeting in one task.

    bucket is an integer column that rises with the wanted order. Rows are counted by (group, bucket), the counts
    are summed up to offsets, and rows are numbered inside their bucket only. df should be staged, because it is read twice.
    """
    from pyspark.sql import Window as W

    counts = df.groupBy(*group, bucket).agg(F.count(F.lit(1)).alias("_n"))
    upto = W.partitionBy(*group).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.sum("_n").over(upto))
    starts = starts.select(*group, bucket, F.coalesce("_start", F.lit(0)).alias("_start"))
    inside = F.row_number().over(W.partitionBy(*group, bucket).orderBy(*order))
    return df.join(starts, [*group, bucket]).withColumn(rank, F.col("_start") + inside - 1).drop("_start")


def placed_by(df: DataFrame, order: list[str], rows: int, place: str, name: str) -> DataFrame:
    """df, staged, with the 0-based place of each row in the order of all rows.

    Rows are dealt out by ranges of the whole order, whose bounds Spark samples, and sorted there; a range's rows are
    numbered as they are written, and the ranges' counts are summed up. Columns that tell equal rows apart keep a range
    from growing with one value. The ranges are few, about one in ROWS_PER_RANGE rows, so their counts meet in one task
    and are broadcast. The order alone decides the places, not where the bounds fall.
    """
    from pyspark.sql import Window as W

    dealt = df.repartitionByRange(max(1, rows // ROWS_PER_RANGE), *order).sortWithinPartitions(*order)
    numbered = staged(dealt.withColumn("_at", F.monotonically_increasing_id()), name)
    split = numbered.withColumn("_range", F.shiftright("_at", 33)).withColumn("_in", F.col("_at").bitwiseAND((1 << 33) - 1))
    before = W.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = split.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return split.join(F.broadcast(starts), "_range").withColumn(place, F.col("_start") + F.col("_in")).drop("_range", "_in", "_at", "_start")
