"""Text functions against Python, on awkward and on generated texts."""

import hashlib
import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stocktake.functions import text as X

BLANKS = [*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def values(spark, texts, column):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


def normal(x):
    return re.sub(r"\s+", " ", unicodedata.normalize("NFC", x)).strip()


def role(x):
    out = ""
    for c in unicodedata.normalize("NFD", x):
        if c.isspace() or c in "'-_":
            if out:
                break
        elif c.isalnum() and not unicodedata.combining(c):
            out += c.lower()
    return out


def test_blanks(spark):
    texts = [f"a{chr(c)}{chr(c)}b{chr(c)}" for c in BLANKS] + ["a​b", "a﻿b", "é x", ""]
    assert values(spark, texts, X.normalise_text) == [normal(x) for x in texts]


def test_normal_form_properties(spark):
    @settings(max_examples=1, deadline=None)
    @given(st.lists(st.text(max_size=30).filter(lambda x: "\x00" not in x), min_size=200, max_size=300))
    def check(texts):
        once = values(spark, texts, X.normalise_text)
        assert once == [normal(x) for x in texts]
        assert values(spark, once, X.normalise_text) == once
        nfd = [unicodedata.normalize("NFD", x) for x in texts]
        assert values(spark, nfd, X.fingerprint) == values(spark, texts, X.fingerprint)
        assert values(spark, [f" \t{x}  " for x in texts], X.fingerprint) == values(spark, texts, X.fingerprint)

    check()


def test_golden(spark):
    assert values(spark, ["x", "  ", "X"], X.fingerprint) == ["2d711642b7", "", hashlib.sha256(b"X").hexdigest()[:10]]
    names = ["José Álvarez", "ΑΛΕΞΗΣ ΣΑΣ", "Ο΄ΔΟΣ", "Élénoir", "  ", "Jean-Luc", "'x y", "_a_b", "O'Neil", "ß1 z", "a.b c"]
    assert values(spark, names, X.role_of_speaker) == [role(x) for x in names]
    assert values(spark, ["narrator", "note", "tessia"], X.voice_folder) == ["arthur", "arthur", "tessia"]
    assert values(spark, ["x" * 140, "x"], X.expected_seconds) == [10.0, 0.6]
    made = values(spark, ["narrator_ch00_07", "narrator_9f3a1c4b2e", "narrator"], X.parse_clip_name)
    assert [m["convention"] for m in made] == ["positional", "fingerprint", "unknown"] and made[0]["rank"] == 7 and made[1]["rank"] is None


def test_case_and_accents_differ(spark):
    assert len(set(values(spark, ["Été", "été", "ete", "été!"], X.fingerprint))) == 4


def test_scalars(spark):
    assert values(spark, ["abé", "", "x"], lambda c: X.byte_sum_seed(c, 100)) == [100 + sum("abé".encode()), 100, 220]
    assert values(spark, ["Une Voix très grave, et lente", "!!"], X.slug) == ["une-voix-tres-grave", "voix"]
    assert values(spark, ["a [x] {y} b", "[z]"], X.strip_markup) == ["a b", ""]
    assert values(spark, ["chapter_07a", "side"], X.chapter_label) == ["ch07", "side"]
    assert values(spark, ["ch12", "ch12b", "xch12", "side"], X.chapter_number) == [12, 12, None, None]
    assert values(spark, ['say: ["a", " ", "b", "c"] ok'], lambda c: X.json_list(c, 2)) == [["a", "b"]]
    assert values(spark, ['x\n "y z" \n'], X.last_line) == ["y z"]
    assert values(spark, [0.75], lambda c: X.short_decimal(c.cast("double"))) == ["075"]
    assert values(spark, ["a=1,b=2,bad,a=3=4"], lambda c: X.option_pairs(F.split(c, ","))) == [{"b": "2", "a": "3=4"}]
    assert values(spark, ["...", "é", "汉"], X.pronounceable) == [False, True, False]


def test_mixes(spark):
    mixes = values(spark, ["Aiden", "a:10+B:2", "a:1+a:3", "a++b", ""], X.parse_mix)
    assert mixes == [{"aiden": 1.0}, {"a": 10.0, "b": 2.0}, {"a": 3.0}, {"a": 1.0, "b": 1.0}, {}]
    assert values(spark, ["a:1+b:3", "a+b"], lambda c: X.dominant(X.parse_mix(c))) == ["b", "a"]
    assert values(spark, ["a:1+b:3"], lambda c: X.mix_share(X.parse_mix(c), ["b"])) == [0.75]
    assert values(spark, ["a+b", "a"], lambda c: X.mix_kinds(X.parse_mix(c), {"a": "M", "b": "F"})) == ["F+M", "M"]
    assert values(spark, ["a:0.6+b"], lambda c: X.dose_mix(c, F.lit(0.25), F.lit("c"))) == ["a:0.450+b:0.750+c:0.250"]
    for bad in ("x", ""):
        with pytest.raises(PySparkException):
            values(spark, [bad], lambda c: X.parse_mix(c, ["a"]))
