"""JSON documents, clip inventories, checksums, logs and pack archives as DataFrames."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas


def json_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON array of records, with its order as ord."""
    return spark.read.schema(schema).option("multiLine", True).json(path).withColumn("ord", F.monotonically_increasing_id())


def json_docs(spark: SparkSession, keys: DataFrame, path: str, schema: str, key: str = "path") -> DataFrame:
    """One document per wanted path; a missing or broken one is a row of nulls."""
    texts = spark.read.format("binaryFile").load(path).select(F.col("path").alias("_p"), F.decode("content", "UTF-8").alias("_body"))
    read = texts.withColumn("doc", F.from_json("_body", schema, {"mode": "PERMISSIVE"})).drop("_body")
    return keys.join(read, keys[key] == read["_p"], "left").drop("_p")


def folder_name(path: str, up: int = 1):
    return F.element_at(F.split(F.col(path), "/"), -1 - up)


def voice_manifests(spark: SparkSession, glob: str) -> DataFrame:
    """Manifests of many folders; a manifest without a name takes its folder's, less 'lines_'."""
    found = spark.read.schema(schemas.VOICE_MANIFEST).option("multiLine", True).json(glob).withColumn("path", F.col("_metadata.file_path"))
    named = F.coalesce(F.nullif("personnage", F.lit("")), F.regexp_replace(folder_name("path"), "^lines_", ""))
    return found.withColumn("personnage", named)


def candidates(spark: SparkSession, glob: str, choices: str) -> DataFrame:
    """Candidates of each folder, one row each, with whether the folder's choice, if there is one, is this candidate."""
    table = spark.read.schema(schemas.CANDIDATES).option("multiLine", True).json(glob).withColumn("dir", folder_name("_metadata.file_path"))
    chosen = spark.read.schema(schemas.CHOICE).option("multiLine", True).json(choices).select(folder_name("_metadata.file_path").alias("dir"), F.col("n").alias("_n"), "valide")
    rows = table.select("dir", "slug", F.posexplode("candidats").alias("ord", "c")).select("dir", "slug", "ord", "c.*")
    picked = F.col("n") == F.col("_n")
    return rows.join(chosen, "dir", "left").select(
        *rows.columns, F.coalesce(picked, F.lit(False)).alias("retenu"), F.when(picked, F.col("valide")).alias("retenu_par")
    )


def clips(spark: SparkSession, path: str, recursive: bool = True, pattern: str = "*.ogg", over_bytes: int = 0) -> DataFrame:
    """(path, clip, folder, bytes, modified) of clips larger than over_bytes; contents aren't read.

    Spark's file sources pass over empty files, so an empty clip is never there.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(path)
    stem = F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)
    return files.where(F.col("length") > over_bytes).select("path", stem.alias("clip"), folder_name("path").alias("folder"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


@F.pandas_udf(T.DoubleType())
def ogg_seconds(content: pd.Series) -> pd.Series:
    """Length of an Ogg Vorbis file from its headers: last granule over sample rate; 0 if either is missing."""

    def seconds(data) -> float:
        if data is None:
            return 0.0
        head, page = data.find(b"\x01vorbis"), data.rfind(b"OggS")
        if head < 0 or page < 0 or len(data) < head + 16 or len(data) < page + 14:
            return 0.0
        (rate,) = struct.unpack_from("<I", data, head + 12)
        (granule,) = struct.unpack_from("<q", data, page + 6)
        return granule / rate if rate else 0.0

    return content.map(seconds)


#: An Ogg page is at most 65,307 bytes long: the last one of a sound file begins within this window.
WINDOW = 1 << 16


def ogg_length(file, size: int, window: int = WINDOW) -> tuple[float, int]:
    """Seconds as ogg_seconds() has them, and bytes read, of an open file: its head and its tail are enough.

    Only where a mark is in neither, in files that aren't whole, the windows grow until they meet.
    """

    def look(mark: bytes, more: int, first: bool) -> tuple[int, bytes, int]:
        span, read = window, 0
        while True:
            span = min(span, size)
            start = 0 if first else size - span
            file.seek(start)
            data = file.read(span)
            read += len(data)
            at = data.find(mark) if first else data.rfind(mark)
            if span == size or at >= 0 and (not first or at + more <= span):
                return at, data, read
            span *= 8

    head, data, read = look(b"\x01vorbis", 16, True)
    if head < 0 or len(data) < head + 16:
        return 0.0, read
    (rate,) = struct.unpack_from("<I", data, head + 12)
    page, data, more = look(b"OggS", 14, False)
    if page < 0 or len(data) < page + 14 or not rate:
        return 0.0, read + more
    return struct.unpack_from("<q", data, page + 6)[0] / rate, read + more


def opened(path: str):
    """A file of any store that Arrow knows, by the path that Spark gives it, open for reading anywhere in it."""
    from pyarrow import fs

    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    store, at = fs.FileSystem.from_uri(path)
    return store.open_input_file(at)


def clip_seconds(spark: SparkSession, path: str) -> DataFrame:
    """(path, clip, seconds, bytes_read): lengths of Ogg clips. Tasks read a window at either end of each file, however long it is."""

    def run(batches):
        for pdf in batches:
            found = []
            for name, size in zip(pdf["path"], pdf["length"], strict=True):
                with opened(name) as file:
                    found.append(ogg_length(file, size))
            yield pdf[["path", "clip"]].assign(seconds=[s for s, _ in found], bytes_read=[n for _, n in found])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ogg").option("recursiveFileLookup", "true").load(path)
    named = files.select("path", F.regexp_extract("path", r"([^/]+)\.ogg$", 1).alias("clip"), "length")
    return named.mapInPandas(run, "path string, clip string, seconds double, bytes_read long")


def stage_plan(spark: SparkSession, path: str, character: str = "arthur") -> DataFrame:
    """(ord, stage, label, chapters) of the character's stages that have chapters."""
    plan = spark.read.schema(schemas.STAGE_PLAN).option("multiLine", True).json(path)
    first = F.filter("characters", lambda c: c["id"] == character)
    stages = plan.select(F.posexplode(F.try_element_at(first, F.lit(1))["stages"]).alias("ord", "s"))
    return stages.where(F.size("s.chapters") > 0).select("ord", F.col("s.id").alias("stage"), "s.label", "s.chapters")


def contract_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Shared fingerprint vectors, one row each."""
    return spark.read.schema(schemas.FINGERPRINT_VECTORS).option("multiLine", True).json(path).select(F.explode("vecteurs").alias("v")).select("v.*")


def checksum(spark: SparkSession, path: str) -> DataFrame:
    """(sha256): the first word of a checksum file."""
    return spark.read.option("wholetext", True).text(path).select(F.try_element_at(F.regexp_extract_all("value", F.lit(r"(\S+)"), F.lit(1)), F.lit(1)).alias("sha256"))


def log_status(spark: SparkSession, path: str) -> DataFrame:
    """(path, step, done): the last line that begins with '=====', and the number of finished batch lines."""
    logs = spark.read.option("wholetext", True).text(path).withColumn("path", F.col("_metadata.file_path"))
    lines = logs.select("path", F.posexplode(F.split("value", "\r?\n")).alias("ord", "line"))
    steps = F.when(F.col("line").startswith("====="), F.struct("ord", "line"))
    done = F.col("line").startswith("[batch") & F.contains("line", F.lit("✓"))
    return lines.groupBy("path").agg(F.max(steps).alias("_s"), F.count_if(done).alias("done")).select("path", F.col("_s.line").alias("step"), "done")


def audit_clips(spark: SparkSession, path: str) -> DataFrame:
    return json_table(spark, path, schemas.AUDIT_CLIP)


def archive(spark: SparkSession, path: str, hashes: bool = True, block: int = 1 << 20, rows: int = 1000) -> DataFrame:
    """(archive, ord, member, bytes, sha256, manifest): members of tar.zst packs; manifest has the text of a manifest.json at depth one.

    A task opens an archive by its path and goes through it as a stream, in blocks: neither archive nor member is ever
    held whole, whatever their sizes. Without hashes sha256 is null, and members are passed over unread.
    """

    def members(name: str):
        import hashlib
        import tarfile

        import zstandard

        with opened(name) as file, zstandard.ZstdDecompressor().stream_reader(file) as raw, tarfile.open(fileobj=raw, mode="r|") as tar:
            for i, m in enumerate(tar):
                small = m.isfile() and m.name.count("/") <= 1 and m.name.rsplit("/", 1)[-1] == "manifest.json"
                mark, text = hashlib.sha256(), []
                if m.isfile() and (hashes or small):
                    body = tar.extractfile(m)
                    while data := body.read(block):
                        mark.update(data)
                        if small:
                            text.append(data)
                yield name, i, m.name, m.size, mark.hexdigest() if hashes and m.isfile() else None, b"".join(text).decode() if small else None

    def run(batches):
        from itertools import islice

        for pdf in batches:
            for name in pdf["path"]:
                found = members(name)
                while some := list(islice(found, rows)):
                    yield pd.DataFrame(some, columns=["archive", "ord", "member", "bytes", "sha256", "manifest"])

    files = spark.read.format("binaryFile").load(path).select("path")
    return files.mapInPandas(run, "archive string, ord int, member string, bytes long, sha256 string, manifest string")


def manifest_files(manifests: DataFrame) -> DataFrame:
    """(voix, id, fichier, sha256, moteur, chapitre, texte): the nested manifest, flat."""
    return manifests.select(F.explode("voix").alias("voix", "v")).select("voix", F.posexplode("v.fichiers").alias("ord", "f")).select("voix", "ord", "f.*")


def read_waves(spark: SparkSession, path: str) -> DataFrame:
    """(path, rate, channels): PCM WAV files; channels has a row of floats in -1 to 1 for each sample."""
    import io
    import wave

    import numpy as np

    def run(batches):
        for pdf in batches:
            out = []
            for name, data in zip(pdf["path"], pdf["content"], strict=True):
                with wave.open(io.BytesIO(data)) as w:
                    width, n = w.getsampwidth(), w.getnchannels()
                    raw = np.frombuffer(w.readframes(w.getnframes()), {1: "u1", 2: "<i2", 4: "<i4"}[width]).astype(np.float64)
                    x = (raw - 128) / 128 if width == 1 else raw / 2.0 ** (8 * width - 1)
                    out.append((name, w.getframerate(), x.reshape(-1, n).tolist()))
            yield pd.DataFrame(out, columns=["path", "rate", "channels"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInPandas(run, "path string, rate int, channels array<array<double>>")


def waves(df: DataFrame, channels: str = "channels") -> DataFrame:
    """Adds wave: the mean of the channels of each sample."""
    from ..functions.signal import downmix

    return df.withColumn("wave", downmix(F.col(channels)))


