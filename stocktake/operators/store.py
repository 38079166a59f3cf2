"""Tables that outlive a run: versions that appear whole, points that are computed once, work that is retried up to a limit.

A store is a folder in the file system that the session's executors share. What a run adds is written to a folder beside
it and then renamed to the next number. A rename either happens or doesn't, and fails if that number is taken: readers
see whole versions only, a run that dies leaves the former ones as they were, and of two writers at once one is told so.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Store:
    """Numbered versions of a table below root, each a folder of Parquet files."""

    def __init__(self, spark: SparkSession, root: str, schema: str | T.StructType):
        self.spark, self.root = spark, root.rstrip("/")
        self.schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema

    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _system(self):
        return self._path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _folder(self, version: int) -> str:
        return f"{self.root}/version={version:09d}"

    def versions(self) -> list[int]:
        """The versions there are, oldest first."""
        system, root = self._system(), self._path(self.root)
        if not system.exists(root):
            return []
        names = [s.getPath().getName() for s in system.listStatus(root)]
        return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))

    def read(self, version: int | None = None) -> DataFrame:
        """One version, the newest if none is named; without any, an empty table."""
        there = self.versions()
        if version is None and not there:
            return self.spark.createDataFrame([], self.schema)
        if version is not None and version not in there:
            raise ValueError(f"no version {version}")
        return self.spark.read.schema(self.schema).parquet(self._folder(there[-1] if version is None else version))

    def read_all(self) -> DataFrame:
        """The rows of all versions, with the number of their own as version."""
        there = self.versions()
        if not there:
            return self.spark.createDataFrame([], self.schema).withColumn("version", F.lit(0))
        wide = T.StructType([*self.schema.fields, T.StructField("version", T.IntegerType())])
        return self.spark.read.schema(wide).option("basePath", self.root).parquet(*map(self._folder, there))

    def write(self, df: DataFrame, after: int | None = None) -> int:
        """df as the next version, whose number is returned; an error if versions other than up to `after` are there by then."""
        number = (after if after is not None else (self.versions() or [0])[-1]) + 1
        beside = f"{self.root}/_writing-{uuid.uuid4().hex}"
        df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]).write.parquet(beside)
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.root).toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            context.rename(self._path(beside), self._path(self._folder(number)), gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
        except Exception as e:
            self._system().delete(self._path(beside), True)
            raise RuntimeError(f"version {number} was written by another run meanwhile") from e
        return number


def upsert(store: Store, rows: DataFrame, keys: list[str]) -> int:
    """A new version: the newest one's rows whose keys aren't among the rows', and the rows. Former versions stay readable."""
    there = store.versions()
    kept = store.read().join(rows.select(*keys).distinct(), keys, "left_anti")
    return store.write(kept.unionByName(rows.select(*store.schema.names)), there[-1] if there else 0)


def computed(points: DataFrame, keys: list[str], store: Store, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The points' values: those the store has, and for the others what compute() makes of them, which the store then has too.

    compute takes the absent keys, each once, and returns the store's columns; what it gives for other keys is kept as
    well. Where nothing is absent it isn't called and no version is written. Of a point that two runs have computed the
    first one's values count.
    """
    absent = points.select(*keys).distinct().join(store.read_all().select(*keys), keys, "left_anti")
    if absent.limit(1).count():
        store.write(compute(absent))
    known = store.read_all()
    values = [f.name for f in store.schema.fields if f.name not in keys]
    first = known.groupBy(*keys).agg(*[F.min_by(v, "version").alias(v) for v in values], F.min("version").alias("version"))
    return points.join(first, keys)


def retried(work: DataFrame, keys: list[str], store: Store, attempt: Callable[[DataFrame], DataFrame], limit: int = 40) -> DataFrame:
    """Tries what isn't accepted yet, again and again, until all is or has been tried `limit` times; one row for each of work's keys.

    attempt takes the keys and the number of the attempt, from 1, and returns the store's columns, among them keys,
    attempt and accepted; a key that it leaves out counts as tried in vain. Each pass is a version of the store, so a run that
    was interrupted goes on with the counts of the former ones. The result: keys, attempts, accepted.
    """
    keyed = work.select(*keys).distinct()
    while True:
        tried = store.read_all().groupBy(*keys).agg(F.max("attempt").alias("_made"), F.bool_or("accepted").alias("_done"))
        state = keyed.join(tried, keys, "left").select(*keys, F.coalesce("_made", F.lit(0)).alias("_made"), F.coalesce("_done", F.lit(False)).alias("_done"))
        todo = state.where(~F.col("_done") & (F.col("_made") < limit)).select(*keys, (F.col("_made") + 1).alias("attempt"))
        if not todo.limit(1).count():
            return state.select(*keys, F.col("_made").cast("int").alias("attempts"), F.col("_done").alias("accepted"))
        made = attempt(todo)
        own = todo.join(made.drop("attempt"), keys, "left").withColumn("accepted", F.coalesce("accepted", F.lit(False)))
        store.write(own)
