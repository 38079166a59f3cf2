"""Resumable batches as streams: new files are read once, a clip is asked for once, a run ends when it has caught up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import timelines


def timeline_stream(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """Utterances of timelines as they appear; a file is read whole."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.dtl").option("recursiveFileLookup", str(recursive).lower()).load(path)
    stem = F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)
    whole = files.select("path", "modificationTime", stem.alias("timeline"), F.decode("content", "UTF-8").alias("content"))
    return timelines.utterances(timelines.split_lines(whole))


def new_clips(utterances: DataFrame, time: str | None = None, delay: str = "7 days") -> DataFrame:
    """Each clip id once over all runs, for which the state keeps every id there was.

    With a time column (timeline_stream() has modificationTime) an id comes once within delay of its first time, and the
    state keeps the ids of that span only; batch_work_list() against the sink takes out what comes again later.
    """
    named = utterances.where(F.col("id").isNotNull())
    return named.withWatermark(time, delay).dropDuplicatesWithinWatermark(["id"]) if time else named.dropDuplicates(["id"])


def catch_up(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Writes all that is new to out and ends; the checkpoint makes each file count once."""
    query = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def batch_work_list(expected: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """The same without state: what the sink doesn't hold yet."""
    return expected.join(done.select(*keys), keys, "left_anti")
