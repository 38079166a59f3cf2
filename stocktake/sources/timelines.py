"""Timelines: UTF-8 files of one utterance or event per line, in order.

Files are read whole and split in the JVM by Python's line boundaries, so line numbers survive any partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X


def read_whole(spark: SparkSession, path: str, recursive: bool = False, pattern: str = "*.dtl") -> DataFrame:
    """(path, timeline, content); a missing path is an error."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(path)
    stem = F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)
    return files.select("path", stem.alias("timeline"), F.decode("content", "UTF-8").alias("content"))


def lines_of(content: Column) -> Column:
    """The lines of a text; an end of file after a break is no line."""
    body = F.regexp_replace(content, f"(?:{X.LINE_BREAK})$", "")
    return F.when(content == "", F.array().cast("array<string>")).otherwise(F.split(body, X.LINE_BREAK))


def can_be_spoken(bare: Column) -> Column:
    """Whether a stripped line can be an utterance: not blank, no comment, event or choice."""
    return (bare != "") & ~(bare.startswith("#") | bare.startswith("[") | bare.startswith("- "))


def split_lines(files: DataFrame, content: str = "content") -> DataFrame:
    """One row per line: number from 1, and the line."""
    kept = [c for c in files.columns if c != content]
    return files.select(*kept, F.posexplode(lines_of(F.col(content))).alias("_i", "line")).select(*kept, (F.col("_i") + 1).alias("ligne"), "line")


def spoken_lines(files: DataFrame, content: str = "content") -> DataFrame:
    """Lines that can be utterances: number of the line, rank among them, and the stripped line. Both are counted inside the row: nothing moves."""
    numbered = F.transform(lines_of(F.col(content)), lambda x, i: F.struct((i + 1).alias("ligne"), X.stripped(x).alias("line")))
    kept = [c for c in files.columns if c != content]
    each = files.select(*kept, F.posexplode(F.filter(numbered, lambda x: can_be_spoken(x["line"]))).alias("_i", "x"))
    return each.select(*kept, "x.ligne", (F.col("_i") + 1).alias("rank"), "x.line")


def spoken(lines: DataFrame, column: str = "line") -> DataFrame:
    """Lines that can be utterances; adds the stripped line."""
    return lines.withColumn("bare", X.stripped(F.col(column))).where(can_be_spoken(F.col("bare")))


def utterances(lines: DataFrame, column: str = "line") -> DataFrame:
    """locuteur, role, texte, id and chemin of each line that is an utterance; the fingerprint covers the raw text."""
    said = spoken(lines, column)
    parsed = said.withColumn("locuteur", F.regexp_extract("bare", X.UTTERANCE, 1)).withColumn("texte", F.regexp_extract("bare", X.UTTERANCE, 2)).where("locuteur <> ''")
    keyed = parsed.withColumn("role", X.role_of_speaker(F.col("locuteur"))).withColumn("_mark", X.fingerprint(F.col("texte")))
    return keyed.withColumn("id", X.clip_id(F.col("role"), F.col("_mark"))).withColumn("chemin", X.clip_path(F.col("role"), F.col("_mark"))).drop("bare", "_mark", column)


def read_timelines(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """All utterances under a folder, side folders included, or of one file."""
    return utterances(split_lines(read_whole(spark, path, recursive)))


def role_lines(spark: SparkSession, path: str, role: str, recursive: bool = False) -> DataFrame:
    """Positional extraction of one exact role: id role_chNN_II by rank in the timeline, text without markup."""
    lines = split_lines(read_whole(spark, path, recursive))
    quoted = r"\Q" + role.replace("\\E", "\\E\\\\E\\Q") + r"\E"
    exact = rf"(?U)^[\s\x1c-\x1f]*{quoted}[\s\x1c-\x1f]*:[\s\x1c-\x1f]*([^\n]+?)[\s\x1c-\x1f]*$"
    found = lines.withColumn("_raw", F.regexp_extract("line", exact, 1)).where("_raw <> ''").withColumn("texte", X.strip_markup(F.col("_raw"))).where("texte <> ''")
    rank = F.row_number().over(W.partitionBy("path").orderBy("ligne"))
    label = X.chapter_label(F.col("timeline"))
    return found.withColumn("rank", rank).select(
        F.concat(F.lit(role + "_"), label, F.format_string("_%02d", F.col("rank"))).alias("id"),
        label.alias("chapitre"),
        "texte",
        F.lit(role).alias("role"),
        F.col("timeline").alias("source"),
        "ligne",
    )
