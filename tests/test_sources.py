"""Timelines, inventories, packs and streams on files of our own."""

import json
import os
import struct

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stocktake.functions import text as X
from stocktake.operators import sinks
from stocktake.sources import files, timelines
from stocktake.streaming import resumable

MAIN = '# comment\n[event arg="x"]\n- choice : no\nnarrator: Il faisait nuit.\n\n  José Álvarez : [portrait] Bonjour {nom}.\r\nnarrator: Un\x0bnarrator: deux narrator: trois\nsans locuteur\nnarrator:\n'


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "t/side").mkdir(parents=True)
    (tmp_path / "t/chapter_07a.dtl").write_bytes(MAIN.encode())
    (tmp_path / "t/side/arc.dtl").write_text("tessia: Oui.\nnarrator: Il faisait  nuit.\n", encoding="utf-8")
    return tmp_path


def test_timelines(spark, folder):
    got = timelines.read_timelines(spark, f"file://{folder}/t").orderBy("timeline", "ligne").collect()
    main = [(r.ligne, r.locuteur, r.texte) for r in got if r.timeline == "chapter_07a"]
    want = []
    for i, line in enumerate(MAIN.splitlines(), 1):
        s = line.strip()
        if s and not s.startswith(("#", "[", "- ")) and ": " in s.replace(" : ", ": "):
            a, b = s.split(":", 1)
            want.append((i, a.strip(), b.strip()))
    assert [(n, a.strip(), b) for n, a, b in main] == want
    assert {r.timeline for r in got} == {"chapter_07a", "arc"}
    same = {r.id for r in got if "faisait" in r.texte}
    assert len(same) == 1 and next(iter(same)).startswith("narrator_")
    assert all(r.chemin.startswith("arthur/") for r in got if r.role == "narrator")


def test_missing_timeline_is_an_error(spark, folder):
    with pytest.raises(PySparkException):
        timelines.read_timelines(spark, f"file://{folder}/none").collect()


def test_role_lines(spark, folder):
    got = timelines.role_lines(spark, f"file://{folder}/t", "José Álvarez").collect()
    assert [(r.id, r.texte, r.chapitre) for r in got] == [("José Álvarez_ch07_01", "Bonjour .", "ch07")]


def ogg(rate, granule):
    return b"OggS" + bytes(24) + b"\x01vorbis" + struct.pack("<IBI", 0, 1, rate) + b"OggS\0\0" + struct.pack("<q", granule) + bytes(8)


def test_clips(spark, tmp_path):
    os.makedirs(tmp_path / "v/arthur")
    for name, data in {"a": ogg(24000, 48000), "b": b"", "c": b"x" * 400, "d": b"\x01vorbis"}.items():
        (tmp_path / f"v/arthur/{name}.ogg").write_bytes(data)
    root = f"file://{tmp_path}/v"
    assert {r.clip for r in files.clips(spark, root).collect()} == {"a", "c", "d"}
    assert {r.clip for r in files.clips(spark, root, over_bytes=300).collect()} == {"c"}
    assert {r.clip: r.seconds for r in files.clip_seconds(spark, root).collect()} == {"a": 2.0, "c": 0.0, "d": 0.0}


def test_json_documents(spark, tmp_path):
    (tmp_path / "good.json").write_text('{"slug": "x", "candidats": [{"n": 1}]}')
    (tmp_path / "bad.json").write_text("{nope")
    keys = spark.createDataFrame([(f"file:{tmp_path}/{n}.json",) for n in ("good", "bad", "none")], "path string")
    got = {r.path.split("/")[-1]: r.doc for r in files.json_docs(spark, keys, f"file://{tmp_path}/*.json", "slug string, candidats array<struct<n:int>>").collect()}
    assert got["good.json"]["slug"] == "x" and got["none.json"] is None and (got["bad.json"] is None or got["bad.json"]["slug"] is None)
    plan = {"characters": [{"id": "x", "stages": []}, {"id": "arthur", "stages": [{"id": "s1", "label": "l", "chapters": [1, 2]}, {"id": "s2", "label": "m", "chapters": []}]}]}
    (tmp_path / "plan.json").write_text(json.dumps(plan))
    assert [(r.ord, r.stage, r.chapters) for r in files.stage_plan(spark, f"file://{tmp_path}/plan.json").collect()] == [(0, "s1", [1, 2])]
    (tmp_path / "run.log").write_text("===== one\n[batch 1] ✓\n[batch 2] ✗\n===== two\n[batch 3] ✓\n")
    assert [(r.step, r.done) for r in files.log_status(spark, f"file://{tmp_path}/run.log").collect()] == [("===== two", 2)]


def test_pack(spark, tmp_path):
    src = tmp_path / "voices"
    os.makedirs(src / "arthur")
    os.makedirs(src / "stray")
    for n in ("arthur/a.ogg", "arthur/b.ogg", "stray/c.ogg", "top.ogg", "arthur/.hidden"):
        (src / n).write_bytes(n.encode())
    listed = spark.createDataFrame([(str(p.relative_to(src)),) for p in src.rglob("*") if p.is_file()], "path string")
    members = [r.path for r in sinks.pack_members(listed, spark.createDataFrame([("arthur",)], "folder string")).collect()]
    assert members == ["arthur/a.ogg", "arthur/b.ogg", "top.ogg"]
    pack = f"{tmp_path}/dist/pack.tar.zst"
    mark = sinks.build_pack(str(src), members, {"voix": {}}, "notice", pack)
    assert files.checksum(spark, f"file://{pack}.sha256").first().sha256 == mark == sinks.file_sha256(pack)
    inside = files.archive(spark, f"file://{pack}")
    assert [r.member for r in inside.orderBy("ord").collect()] == ["manifest.json", "NOTICE.md", *members]
    assert [json.loads(r.manifest) for r in inside.where("manifest is not null").collect()] == [{"voix": {}}]
    there = inside.select(F.lit("arthur").alias("voix"), F.col("member").alias("fichier"), "sha256").where("member like 'arthur/%'")
    want = spark.createDataFrame([("arthur", "arthur/a.ogg", "0" * 16), ("arthur", "arthur/z.ogg", None)], "voix string, fichier string, sha256 string")
    r = sinks.verify_pack(there, want).first()
    assert (r.announced, r.there, r.absent, r.altered, r.extra) == (2, 1, 1, 1, 1)
    bad = inside.select("member", "bytes").union(spark.createDataFrame([("../x.ogg", 1), ("/y.ogg", 1)], "member string, bytes long"))
    plan = sinks.install_plan(bad, spark.createDataFrame([("top.ogg", 7)], "member string, bytes long"))
    assert {r.member: r.action for r in plan.collect()} == {"../x.ogg": "refuse", "/y.ogg": "refuse", "arthur/a.ogg": "install", "arthur/b.ogg": "install", "top.ogg": "keep"}
    game = tmp_path / "game"
    game.mkdir()
    assert sinks.install(pack, plan, str(game), "1.0") == ["arthur/a.ogg", "arthur/b.ogg"] and not list(game.iterdir())
    sinks.install(pack, plan, str(game), "1.0", dry_run=False)
    assert (game / "arthur/b.ogg").read_bytes() == b"arthur/b.ogg" and (game / "PACK_VERSION").read_text() == "1.0\n"
    sinks.uninstall(plan, str(game), dry_run=False)
    assert not (game / "arthur/b.ogg").exists()


def test_manifest_upsert(spark, tmp_path):
    from stocktake import schemas

    old = {"projet": "p", "version_pack": "1", "medias": {"video": ["v"], "animation": []}, "voix": {"a": {"nom": "A", "repliques": 1, "format": "ogg", "fichiers": []}, "b": {"nom": "B", "repliques": 2, "format": "ogg", "fichiers": []}}}
    path = f"{tmp_path}/manifest.json"
    sinks.write_json(path, old)
    manifest = spark.read.schema(schemas.MANIFEST).option("multiLine", True).json(f"file://{path}")
    clips = spark.createDataFrame([("b", "b_2", "b/b_2.ogg", None, None, None, "t"), ("b", "b_1", "b/b_1.ogg", None, None, None, "t")], "voix string, id string, fichier string, sha256 string, moteur string, chapitre string, texte string")
    entries = sinks.voice_entries(clips, spark.createDataFrame([("b", "B2", "ogg")], "voix string, nom string, format string"))
    got = sinks.upsert_voices(manifest, entries).first()
    assert got.voix["a"].nom == "A" and got.voix["b"].nom == "B2" and [f.id for f in got.voix["b"].fichiers] == ["b_1", "b_2"] and got.version_pack == "1"
    assert set(sinks.overwrite_voices(manifest, entries).first().voix) == {"b"}
    assert [(r.voix, r.id) for r in files.manifest_files(sinks.upsert_voices(manifest, entries)).collect()] == [("b", "b_1"), ("b", "b_2")]
    kept = sinks.replace_json(path, {"x": 1})
    assert json.load(open(kept))["projet"] == "p" and json.load(open(path)) == {"x": 1}
    table = f"file://{tmp_path}/table"
    sinks.upsert_partition(clips, table)
    sinks.upsert_partition(clips.limit(1).withColumn("voix", F.lit("c")), table)
    assert {r.voix: r["count"] for r in spark.read.parquet(table).groupBy("voix").count().collect()} == {"b": 2, "c": 1}


@pytest.mark.parametrize("time", [None, "modificationTime"])
def test_stream_catches_up(spark, folder, time):
    stream = lambda: resumable.new_clips(resumable.timeline_stream(spark, f"file://{folder}/t"), time).select("id", "texte")
    out, mark = f"file://{folder}/out", f"file://{folder}/mark"
    resumable.catch_up(stream(), out, mark)
    first = spark.read.parquet(out).count()
    (folder / "t/side/more.dtl").write_text("tessia: Oui.\ntessia: Non.\n", encoding="utf-8")
    resumable.catch_up(stream(), out, mark)
    ids = [r.id for r in spark.read.parquet(out).collect()]
    assert len(ids) == len(set(ids)) == first + 1
    want = timelines.read_timelines(spark, f"file://{folder}/t").where("id is not null").select("id").distinct()
    assert resumable.batch_work_list(want, spark.read.parquet(out), ["id"]).count() == 0


def test_waves(spark, tmp_path):
    import wave

    with wave.open(f"{tmp_path}/a.wav", "wb") as w:
        w.setnchannels(2)
        w.setsampwidth(2)
        w.setframerate(8000)
        w.writeframes(struct.pack("<4h", 16384, 0, -32768, 32767))
    r = files.waves(files.read_waves(spark, f"file://{tmp_path}")).first()
    assert r.rate == 8000 and [round(x, 3) for x in r.wave] == [0.25, 0.0]


def test_reports(spark):
    df = spark.createDataFrame([("a|b", 1), (None, 2)], "x string, y int").orderBy("y")
    assert sinks.markdown_table(df, ["x", "y"]) == "| x | y |\n| --- | --- |\n| a\\|b | 1 |\n|  | 2 |\n"
    assert sinks.console_table(df, {"x": 5, "y": 2}) == "x    y\na|b  1\n     2"
    assert spark.range(1).select(X.markdown_cell(F.lit("a|b"))).first()[0] == "a\\|b"


def test_files_are_written_whole(spark, tmp_path):
    df = spark.createDataFrame([("a/x.txt", "1"), ("b/y.txt", None), ("a/é z.txt", "3")], "path string, content string")
    assert sinks.write_files(df, f"file://{tmp_path}/w") == 3 == sinks.write_files(df, f"file://{tmp_path}/w")
    assert {str(p.relative_to(tmp_path / "w")): p.read_text() for p in (tmp_path / "w").rglob("*") if p.is_file()} == {"a/x.txt": "1", "b/y.txt": "", "a/é z.txt": "3"}
    assert sinks.write_files(df.limit(0), f"file://{tmp_path}/w") == 0
    for bad in ("/etc/x", "a/../../x"):
        with pytest.raises(PySparkException):
            sinks.write_files(spark.createDataFrame([(bad, "x")], df.schema), f"file://{tmp_path}/w")


def test_lengths_by_byte_ranges(spark, tmp_path):
    """Head and tail are read, however long a clip is; a file without the marks gives 0, one with them in odd places its length."""
    rate = b"\x01vorbis" + struct.pack("<IBI", 0, 1, 8000)
    page = b"OggS\0\0" + struct.pack("<q", 16000)
    cases = {"long": ogg(24000, 48000)[:44] + bytes(5_000_000) + ogg(24000, 48000)[44:], "late": bytes(200_000) + rate + page + bytes(300_000), "none": b"x" * 300_000, "cut": b"x" * 65_530 + rate + page, "half": rate[:9], "no rate": rate[:-4] + bytes(4) + page}
    for name, data in cases.items():
        (tmp_path / f"{name}.ogg").write_bytes(data)
    got = {r.clip: r for r in files.clip_seconds(spark, f"file://{tmp_path}").collect()}
    whole = spark.read.format("binaryFile").load(f"file://{tmp_path}/*.ogg").select("path", files.ogg_seconds("content").alias("s")).collect()
    want = {r.path.rsplit("/", 1)[1][:-4]: r.s for r in whole}
    assert {c: r.seconds for c, r in got.items()} == want and want["long"] == 2.0 and want["late"] == want["cut"] == 2.0
    assert got["long"].bytes_read <= 2 * files.WINDOW


def test_large_members_are_streamed(spark, tmp_path):
    """Members of 200 MB, hashed in blocks or passed over."""
    import hashlib
    import io
    import tarfile

    import zstandard

    size = 200 << 20
    with open(tmp_path / "p.tar.zst", "wb") as out, zstandard.ZstdCompressor(level=1).stream_writer(out) as z, tarfile.open(fileobj=z, mode="w|") as tar:
        for name in ("v/manifest.json", "v/deep/manifest.json", "v/zeros.ogg"):
            info = tarfile.TarInfo(name)
            info.size = size if name.endswith("ogg") else 2
            tar.addfile(info, open("/dev/zero", "rb") if name.endswith("ogg") else io.BytesIO(b"{}"))
    got = files.archive(spark, f"file://{tmp_path}/p.tar.zst").orderBy("ord").collect()
    assert [(r.member, r.bytes, r.manifest) for r in got] == [("v/manifest.json", 2, "{}"), ("v/deep/manifest.json", 2, None), ("v/zeros.ogg", size, None)]
    zeros = hashlib.sha256()
    for _ in range(200):
        zeros.update(bytes(1 << 20))
    assert got[2].sha256 == zeros.hexdigest()
    assert [r.sha256 for r in files.archive(spark, f"file://{tmp_path}/p.tar.zst", hashes=False).collect()] == [None] * 3
