"""Sinks: manifests, plans of file actions, packs, reports. Tables are written by Spark; files are acted on by the driver, from a plan that can be shown first."""

from __future__ import annotations

import datetime as dt
import hashlib
import io
import json
import os
import shutil
import tarfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas


def write_json(path: str, doc: dict | list) -> None:
    """A small document, indented UTF-8; folders are made; readers never see half of it."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(f"{path}.part", "w", encoding="utf-8") as f:
        json.dump(doc, f, ensure_ascii=False, indent=2)
    os.replace(f"{path}.part", path)


def backup(path: str, now: dt.datetime | None = None) -> str | None:
    """Moves what is there to a name with the time, in UTC; returns it."""
    if not os.path.exists(path):
        return None
    stem, ext = os.path.splitext(path)
    to = f"{stem}.{(now or dt.datetime.now(dt.UTC)):%Y%m%dT%H%M%SZ}{ext}"
    shutil.copy2(path, to)
    return to


def replace_json(path: str, doc: dict | list, now: dt.datetime | None = None) -> str | None:
    old = backup(path, now)
    write_json(path, doc)
    return old


def write_files(df: DataFrame, root: str, path: str = "path", content: str = "content") -> int:
    """Writes each row's content to its path under root, from the tasks that hold the rows; returns how many files.

    root is a URI that all executors reach and pyarrow's file systems open. A file appears whole or not at all, and a task
    that is run again writes the same files. A path that is absolute or climbs out of root is an error.
    """

    def put(batches):
        import posixpath
        import uuid

        import pyarrow as pa
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root)
        n = 0
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name.startswith("/") or ".." in name.split("/"):
                    raise ValueError(f"unsafe path: {name}")
                to = posixpath.join(base, name)
                part = f"{to}.{uuid.uuid4().hex}.part"
                system.create_dir(posixpath.dirname(to), recursive=True)
                with system.open_output_stream(part) as f:
                    f.write(body or b"")
                system.move(part, to)
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return df.select(path, F.col(content).cast("binary")).mapInArrow(put, "n long").agg(F.sum("n")).first()[0] or 0


def voice_entries(files: DataFrame, voices: DataFrame, voice: str = "voix") -> DataFrame:
    """(voix, entry): the nested manifest entry of each voice, files by id."""
    entry = F.array_sort(F.collect_list(F.struct("id", "fichier", "sha256", "moteur", "chapitre", "texte")))
    nested = files.groupBy(voice).agg(entry.alias("fichiers"), F.count(F.lit(1)).cast("int").alias("repliques"))
    named = voices.join(nested, voice)
    fields = ("nom", "repliques", "format", "convention", "moteur_par_defaut", "fichiers")
    return named.select(voice, F.struct(*[(F.col(f) if f in named.columns else F.lit(None).cast("string")).alias(f) for f in fields]).alias("entry"))


def upsert_voices(manifest: DataFrame, entries: DataFrame) -> DataFrame:
    """The manifest (one row) with the entries' voices replaced or added; all other voices and keys stay."""
    new = entries.agg(F.map_from_entries(F.collect_list(F.struct("voix", F.col("entry").cast(schemas.VOICE_ENTRY)))).alias("_new"))
    old = F.coalesce("voix", F.expr(f"cast(map() as map<string,{schemas.VOICE_ENTRY}>)"))
    kept = F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys("_new"), k))
    return manifest.crossJoin(F.broadcast(new)).withColumn("voix", F.map_concat(kept, "_new")).drop("_new")


def overwrite_voices(manifest: DataFrame, entries: DataFrame) -> DataFrame:
    """A full overwrite of the voices; version_pack and medias, as all other keys, are carried over."""
    return upsert_voices(manifest.withColumn("voix", F.lit(None).cast(f"map<string,{schemas.VOICE_ENTRY}>")), entries)


def upsert_partition(df: DataFrame, path: str, by: str = "voix") -> None:
    """Writes df's partitions over those of the table at path; other partitions stay."""
    df.write.option("partitionOverwriteMode", "dynamic").partitionBy(by).mode("overwrite").parquet(path)


def copy_plan(source: DataFrame, target: DataFrame, key: str, changed: Column) -> DataFrame:
    """Source files to copy: not at the target, or changed (an expression over _old, the target's row)."""
    t = target.select(F.col(key).alias("_k"), F.struct(*target.columns).alias("_old"))
    return source.join(t, F.col(key) == F.col("_k"), "left").where(F.col("_old").isNull() | changed).drop("_k", "_old")


def size_changed() -> Column:
    return F.col("bytes") != F.col("_old.bytes")


def newer() -> Column:
    return F.col("modified") > F.col("_old.modified")


def pack_members(files: DataFrame, declared: DataFrame, path: str = "path") -> DataFrame:
    """Files for a pack, sorted: those at the top level or in a declared folder; hidden ones are left out."""
    parts = F.split(path, "/")
    hidden = F.exists(parts, lambda p: p.startswith("."))
    folder = files.where(~hidden).withColumn("_top", F.when(F.size(parts) > 1, parts[0]))
    kept = folder.where("_top is null").unionByName(folder.join(declared.select(F.col("folder").alias("_top")).distinct(), "_top", "left_semi").select(*folder.columns))
    return kept.drop("_top").orderBy(path)


def build_pack(root: str, members: list[str], manifest: dict, notice: str, to: str) -> str:
    """tar.zst of the manifest, the notice and the members in order, and a checksum beside it; returns the checksum."""
    import zstandard

    os.makedirs(os.path.dirname(to) or ".", exist_ok=True)
    with open(to, "wb") as out, zstandard.ZstdCompressor(level=10).stream_writer(out) as z, tarfile.open(fileobj=z, mode="w|") as tar:
        for name, body in (("manifest.json", json.dumps(manifest, ensure_ascii=False, indent=2)), ("NOTICE.md", notice)):
            info = tarfile.TarInfo(name)
            info.size = len(data := body.encode())
            tar.addfile(info, io.BytesIO(data))
        for name in sorted(members):
            tar.add(os.path.join(root, name), name, recursive=False)
    mark = file_sha256(to)
    with open(f"{to}.sha256", "w", encoding="utf-8") as f:
        f.write(f"{mark}  {os.path.basename(to)}\n")
    return mark


def file_sha256(path: str, block: int = 1 << 20) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while x := f.read(block):
            h.update(x)
    return h.hexdigest()


def short_sha256(content: Column) -> Column:
    return F.substring(F.sha2(content, 256), 1, 16)


def verify_pack(members: DataFrame, listed: DataFrame) -> DataFrame:
    """(voix, announced, there, absent, altered, extra): members of an archive against its manifest.

    members: (voix, fichier, sha256). listed: (voix, fichier, sha256: 16 digits or null).
    """
    m = members.select("voix", "fichier", F.col("sha256").alias("_m"), F.lit(True).alias("_there"))
    j = listed.select("voix", "fichier", F.col("sha256").alias("_l"), F.lit(True).alias("_listed")).join(m, ["voix", "fichier"], "full")
    both = F.col("_listed") & F.col("_there")
    count = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    out = j.groupBy("voix").agg(
        count(F.col("_listed")).alias("announced"),
        count(both).alias("there"),
        count(F.col("_listed") & F.col("_there").isNull()).alias("absent"),
        count(both & (F.col("_l") != F.substring("_m", 1, 16))).alias("altered"),
        count(F.col("_listed").isNull()).alias("extra"),
    )
    return out.orderBy(F.desc("announced"), "voix")


def safe_member(name: Column) -> Column:
    """False for absolute paths and those that climb out of the folder."""
    return ~(name.startswith("/") | F.array_contains(F.split(name, "/"), "..") | name.contains("\\"))


def install_plan(members: DataFrame, installed: DataFrame) -> DataFrame:
    """(member, bytes, action): install, keep or refuse (unsafe) each .ogg or .wav member."""
    i = installed.select(F.col("member").alias("_m"), F.col("bytes").alias("_b"))
    sound = members.where(F.col("member").rlike(r"\.(ogg|wav)$"))
    action = F.when(~safe_member(F.col("member")), "refuse").when(F.col("_b").eqNullSafe(F.col("bytes")), "keep").otherwise("install")
    return sound.join(i, F.col("member") == F.col("_m"), "left").select("member", "bytes", action.alias("action")).orderBy("member")


def install(archive: str, plan: DataFrame, target: str, version: str, dry_run: bool = True) -> list[str]:
    """Extracts what the plan installs and notes the version; with dry_run it only says what it would do."""
    import zstandard

    todo = {r.member for r in plan.where("action = 'install'").select("member").collect()}
    if not dry_run:
        with open(archive, "rb") as f, zstandard.ZstdDecompressor().stream_reader(f) as raw, tarfile.open(fileobj=raw, mode="r|") as tar:
            for m in tar:
                if m.name in todo and m.isfile():
                    tar.extract(m, target, filter="data")
        with open(os.path.join(target, "PACK_VERSION"), "w", encoding="utf-8") as f:
            f.write(version + "\n")
    return sorted(todo)


def uninstall(plan: DataFrame, target: str, dry_run: bool = True) -> list[str]:
    names = sorted(r.member for r in plan.where("action <> 'refuse'").select("member").collect())
    if not dry_run:
        for name in [*names, "PACK_VERSION"]:
            if os.path.exists(os.path.join(target, name)):
                os.remove(os.path.join(target, name))
    return names


def apply_renames(plan: DataFrame, folder: str, old: str, new: str, dry_run: bool = True) -> dict[str, int]:
    """Renames and unlinks by a rename plan; returns how many rows have each action."""
    rows = plan.select(old, new, "action").collect()
    if not dry_run:
        for a, b, action in rows:
            if action == "rename":
                os.rename(os.path.join(folder, f"{a}.ogg"), os.path.join(folder, f"{b}.ogg"))
            elif action == "merge":
                os.remove(os.path.join(folder, f"{a}.ogg"))
    counts: dict[str, int] = {}
    for *_, action in rows:
        counts[action] = counts.get(action, 0) + 1
    return counts


def markdown_table(df: DataFrame, columns: list[str]) -> str:
    """The rows in the frame's order; bars in cells are escaped. For reports a person reads."""
    rows = ["| " + " | ".join(columns) + " |", "|" + " --- |" * len(columns)]
    for r in df.select(*columns).collect():
        rows.append("| " + " | ".join("" if x is None else str(x).replace("|", "\\|") for x in r) + " |")
    return "\n".join(rows) + "\n"


def suspect_rows(df: DataFrame) -> DataFrame:
    return df.select("id", "personnage", "texte", F.bround("fin", 3).alias("fin"), F.bround("ratio", 3).alias("ratio"), F.bround("duree", 2).alias("duree"), "motif")


def candidate_index(rows: DataFrame, source: str) -> DataFrame:
    """(source, personnages): the index document of candidates (dir, slug, ord, n, wav, seed, description, retenu, retenu_par)."""
    item = F.struct("ord", "n", F.col("wav").alias("fichier"), "seed", "description", "retenu", "retenu_par")
    per = rows.groupBy("dir", "slug").agg(F.array_sort(F.collect_list(item)).alias("_c"))
    per = per.withColumn("candidats", F.transform("_c", lambda x: x.dropFields("ord")))
    return per.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("dir", F.struct("slug", "candidats").alias("v"))))).alias("personnages")).select(F.lit(source).alias("source"), "personnages")


def job_plan(voices: DataFrame) -> DataFrame:
    """Jobs of each engine, shortest first: (moteur, jobs)."""
    job = F.struct("repliques", "ord", "nom", "lines", "out_dir", "speaker", "reference")
    return voices.groupBy("moteur").agg(F.array_sort(F.collect_list(job)).alias("_j")).select("moteur", F.transform("_j", lambda x: x.dropFields("ord")).alias("jobs"))


def megabytes(bytes_: Column) -> Column:
    return F.sum(bytes_) / 1e6


def console_table(df: DataFrame, widths: dict[str, int]) -> str:
    """Columns of fixed width, in the frame's order, for a person to read."""
    lines = ["".join(c.ljust(w) for c, w in widths.items()).rstrip()]
    lines += ["".join(("" if x is None else str(x)).ljust(w) for x, w in zip(r, widths.values(), strict=True)).rstrip() for r in df.select(*widths).collect()]
    return "\n".join(lines)


def write_report(df: DataFrame, path: str) -> None:
    """Rows of a metric report as JSON lines, by Spark."""
    df.write.mode("overwrite").json(path)
