"""Functions for SQL: the grammar of lines, keys and paths of clips, mixes and levels of vectors.

    register(spark)
    spark.sql("select path, ligne, clip_id(role_of_speaker(locuteur), fingerprint(texte)) from (select path, utterances_of(content) as said from files) lateral view inline(said)")

All are SQL functions of the session, which Spark inlines into a query's plan; only normal forms of texts beyond ASCII
leave the JVM, by Arrow. Registering again changes nothing. Each does what the column function of its name does.

Rows come from a column of arrays by `lateral view inline(...)`, which works inside the row (Spark takes no SQL function in it). The table functions `lines`,
`utterances` and `mix` say the same more briefly, but Spark joins their rows back to the table by their argument: for
single texts, not for large tables.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import text as X


def _quoted(s: str) -> str:
    """s as a SQL literal."""
    return "'" + "".join(c if 32 <= ord(c) < 127 and c not in "'\\" else f"\\u{ord(c):04x}" for c in s) + "'"


def _normal_form(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


def _without_accents(s: pd.Series) -> pd.Series:
    return s.map(X.without_accents, na_action="ignore")


def _unless_ascii(name: str) -> str:
    return f"coalesce({name}(if(rlike(content, {_quoted(r'[^\x00-\x7f]')}), content, null)), content)"


_FOLDERS = " ".join(f"when {_quoted(role)} then {_quoted(folder)}" for role, folder in X.VOICE_FOLDERS.items())
_SQUARES = "aggregate({0}, 0.0D, (acc, x) -> acc + x * x)"
_BREAK = _quoted(X.LINE_BREAK)
_UTTERANCE = _quoted(X.UTTERANCE)
_PARTS = "array<struct<weight: double, v: array<double>>>"

#: Name and parameters, result, and body, each after those that it calls.
FUNCTIONS = (
    ("stripped(content string)", "string", f"btrim(content, {_quoted(X.BLANKS)})"),
    ("squeeze(content string)", "string", f"btrim(regexp_replace(content, {_quoted(X.BLANK + '+')}, ' '), ' ')"),
    ("strip_markup(content string)", "string", f"squeeze(regexp_replace(content, {_quoted(X.MARKUP)}, ' '))"),
    ("normalise_text(content string)", "string", f"squeeze({_unless_ascii('normal_form_of_others')})"),
    ("mark_of(normal string)", "string", f"if(normal = '', '', substring(sha2(normal, 256), 1, {X.FINGERPRINT_LENGTH}))"),
    ("fingerprint(content string)", "string", "mark_of(normalise_text(content))"),
    ("role_of_speaker(content string)", "string", f"lower(regexp_extract(regexp_replace({_unless_ascii('unaccented_of_others')}, {_quoted(X.NOT_IN_NAMES)}, ''), {_quoted(X.FIRST_NAME)}, 1))"),
    ("voice_folder(role string)", "string", f"case role {_FOLDERS} else role end"),
    ("clip_id(role string, mark string)", "string", "if(role <> '' and mark <> '', concat(role, '_', mark), null)"),
    ("clip_path(role string, mark string)", "string", "concat(voice_folder(role), '/', clip_id(role, mark), '.ogg')"),
    ("lines_of(content string)", "array<string>", f"if(content = '', array(), split(regexp_replace(content, concat('(?:', {_BREAK}, ')$'), ''), {_BREAK}))"),
    (
        "utterances_of(content string)",
        "array<struct<ligne: int, locuteur: string, texte: string>>",
        "filter(transform(transform(lines_of(content), (x, i) -> struct(i + 1 as ligne, btrim(x, " + _quoted(X.BLANKS) + ") as bare)), x -> "
        "if(x.bare = '' or startswith(x.bare, '#') or startswith(x.bare, '[') or startswith(x.bare, '- '), null, "
        f"struct(x.ligne as ligne, regexp_extract(x.bare, {_UTTERANCE}, 1) as locuteur, regexp_extract(x.bare, {_UTTERANCE}, 2) as texte))), x -> x.locuteur <> '')",
    ),
    ("lines(content string)", "table (ligne int, line string)", "select pos + 1, line from (select lines_of(content) as x) lateral view posexplode(x) as pos, line"),
    ("utterances(content string)", "table (ligne int, locuteur string, texte string)", "select u.* from (select utterances_of(content) as x) lateral view inline(x) u"),
    ("semitone_ratio(semitones double)", "double", "pow(2.0D, semitones / 12.0D)"),
    ("rms_db(samples array<double>)", "double", f"20 * log10(sqrt({_SQUARES.format('samples')} / greatest(size(samples), 1)) + 1e-10D)"),
    ("cosine(a array<double>, b array<double>)", "double", f"aggregate(zip_with(a, b, (x, y) -> x * y), 0.0D, (acc, x) -> acc + x) / (sqrt({_SQUARES.format('a')}) * sqrt({_SQUARES.format('b')}) + 1e-10D)"),
    ("sum_of_parts(parts " + _PARTS + ")", "array<double>", "aggregate(parts, transform(parts[0].v, x -> 0.0D), (acc, p) -> zip_with(acc, p.v, (x, y) -> x + y * p.weight))"),
    ("weighted_mix(parts " + _PARTS + ")", "array<double>", "transform(sum_of_parts(parts), x -> x / aggregate(parts, 0.0D, (acc, p) -> acc + p.weight))"),
    ("mix(parts " + _PARTS + ")", "table (pos int, value double)", "select pos, value from (select weighted_mix(parts) as x) lateral view posexplode(x) as pos, value"),
)


def register(spark: SparkSession) -> None:
    """The functions above as temporary functions of the session."""
    spark.udf.register("normal_form_of_others", F.pandas_udf(_normal_form, "string"))
    spark.udf.register("unaccented_of_others", F.pandas_udf(_without_accents, "string"))
    for head, result, body in FUNCTIONS:
        spark.sql(f"create or replace temporary function {head} returns {result} return {body}")
