"""SQL functions against the column functions of their names, and their plans."""

import pytest
from pyspark.sql import functions as F

from stocktake.functions import registered
from stocktake.functions import text as X
from stocktake.functions import vectors as V
from stocktake.sources import timelines

TEXTS = [
    "Léa O'Neil : Bonjour  [rire] à toi\r\n# note: no\n\n- Choix: a\nJosé Álvarez:x\x85Ωmega ΣΑΣ : {b} fin\n",
    "",
    "\n",
    "a: b c : d\x1c",
    "[event x: y]\n  narrator :  été \\ ' \" ok ",
    " \t　",
    "'_-Ab c: -\r\r\n:x\n9: z",
    None,
]


@pytest.fixture(scope="module")
def said(spark):
    registered.register(spark)
    registered.register(spark)
    spark.createDataFrame(list(enumerate(TEXTS)), "id int, content string").createOrReplaceTempView("said")
    yield spark.table("said")
    spark.catalog.dropTempView("said")


SCALARS = {
    "stripped": X.stripped,
    "squeeze": X.squeeze,
    "strip_markup": X.strip_markup,
    "normalise_text": X.normalise_text,
    "fingerprint": X.fingerprint,
    "role_of_speaker": X.role_of_speaker,
    "lines_of": timelines.lines_of,
}


@pytest.mark.parametrize("name", sorted(SCALARS))
def test_scalars(said, spark, name):
    got = spark.sql(f"select id, {name}(content) as x from said").collect()
    want = said.select("id", SCALARS[name](F.col("content")).alias("x")).collect()
    assert sorted(got) == sorted(want) and any(r.x for r in got)


def test_utterances(said, spark):
    got = spark.sql("""
        select id, ligne, locuteur, role, texte, clip_id(role, mark) as clip, clip_path(role, mark) as chemin
        from (select id, ligne, locuteur, role_of_speaker(locuteur) as role, texte, fingerprint(texte) as mark from (select id, utterances_of(content) as x from said) lateral view inline(x) u)
    """)
    want = timelines.utterances(timelines.split_lines(said)).select("id", "ligne", "locuteur", "role", "texte", F.col("id").alias("clip"), "chemin")
    rows = lambda df: sorted((r.ligne, r.locuteur, r.role, r.texte, r.clip or "", r.chemin or "") for r in df.collect())
    assert rows(got) == rows(want) and len(rows(got)) == 5
    same = spark.sql("select u.* from said, lateral utterances(content) u")
    assert sorted(same.collect()) == sorted(got.select("ligne", "locuteur", "texte").collect())
    assert spark.sql("select * from lines('a\nb')").collect() == [(1, "a"), (2, "b")]


def test_rows_from_arrays_move_nothing(said, spark):
    plan = spark.sql("select id, u.* from (select id, utterances_of(content) as x from said) lateral view inline(x) u")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and not any(word in plan for word in ("Exchange", "Join", "Python", "Pandas"))


def test_mixes(spark):
    registered.register(spark)
    df = spark.createDataFrame([(1, [(2.0, [1.0, 2.0]), (1.0, [4.0, 2.0])]), (2, [(1.0, [0.5])]), (3, None)], "id int, parts array<struct<weight: double, v: array<double>>>")
    df.createOrReplaceTempView("mixes")
    got = {(r.id, r.pos): r.value for r in spark.sql("select id, m.* from (select id, weighted_mix(parts) as x from mixes) lateral view posexplode(x) m as pos, value").collect()}
    assert got == {(1, 0): 2.0, (1, 1): 2.0, (2, 0): 0.5}
    want = {(r.id, r.pos): r.value for r in df.where("id < 3").select("id", F.posexplode(V.weighted_mix(F.col("parts"))).alias("pos", "value")).collect()}
    assert got == want
    table = spark.sql("select id, m.pos, m.value from mixes, lateral mix(parts) m").collect()
    assert {(r.id, r.pos): r.value for r in table} == got
    one = spark.sql("select rms_db(array(0.5D, -0.5D)) as db, cosine(array(1.0D, 0.0D), array(0.0D, 0.0D)) as z, semitone_ratio(12) as r, rms_db(array()) as none").first()
    want = spark.range(1).select(V.rms_db(F.array(F.lit(0.5), F.lit(-0.5))).alias("db")).first()
    assert one.db == want.db and one.z == 0.0 and one.r == 2.0 and one.none == -200.0
