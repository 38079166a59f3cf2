"""Quality rules: counts of each text, and cross-document line frequency on each host.

Base rules look at one text: too few words, or too many words in passages that the text repeats. The method looks
across documents: normalised lines are hashed and, for each host, the distinct documents with a line are counted. A
line in more documents of its host than the limit allows, however large the host, is boilerplate; a document that is
depleted, with less than `min_left` of its words outside such lines, is rejected. clean_good() gives the other
documents without these lines.

Copies of one document are no sign of boilerplate, so documents with the same normalised lines in the same order count
once: a thousand copies of an article count once, while a navigation line under a thousand different documents counts a
thousand times, whatever other lines they share. An article with one line changed is another document.

A line that a third of all documents hold is counted with partial sums, and joined by spread_join().
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import HOT_KEYS, WordHash, arrow_map, col, list_array, mix64, out_batch, spread_join, stack, staged, texts

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
WINDOW = 8

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
LINES = "copy long, lines array<struct<line:long,words:long>>"


def line_hash(line: bytes) -> int:
    """63 bits of the normalised line's MD5, which SQL has as well."""
    return int.from_bytes(hashlib.md5(line.strip().lower()).digest()[:8], "big") >> 1


def line_key(line: F.Column) -> F.Column:
    """line_hash() of a column."""
    plain = F.translate(F.btrim(line, F.lit(SPACE.decode())), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.shiftrightunsigned(F.conv(F.substring(F.md5(plain.cast("binary")), 1, 16), 16, -10).cast("long"), 1)


def repeated_words(h: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows of words that the text has twice or more."""
    n = len(h) - window + 1
    if n < 2:
        return 0
    w = h[:n].copy()
    for j in range(1, window):
        w = mix64(w) + h[j : j + n]
    order = np.argsort(w, kind="stable")
    s = w[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(h) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def host_key(host: F.Column) -> F.Column:
    """A null host is a host of its own."""
    return F.when(host.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), host.cast("string")))


def text_stats(df: DataFrame, host_col: str) -> DataFrame:
    """_row, id, host, the base counts, copy (a hash of all lines with a word, in order) and, for each distinct one of these lines, its hash and its words."""
    known = WordHash()

    def look(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, chars, symbols, dups, repeats, copies, sizes = [], [], [], [], [], [], []
        line_h, line_n = [], []
        for b in texts(batch):
            words = b.split()
            n_words.append(len(words))
            blank = len(b) - len(b.translate(None, SPACE))
            chars.append(len(b.decode()) - blank)
            symbols.append(len(b) - len(b.translate(None, SYMBOLS)))
            lines = [x for x in b.split(b"\n") if x.strip()]
            dups.append(len(lines) - len(set(lines)))
            repeats.append(repeated_words(np.fromiter(map(known.__getitem__, words), np.uint64, len(words))) if len(words) > WINDOW else 0)
            own: dict[int, int] = {}
            hashes = list(map(line_hash, lines))
            for k, x in zip(hashes, lines, strict=True):
                own[k] = own.get(k, 0) + len(x.split())
            copies.append(int.from_bytes(hashlib.md5(np.array(hashes, np.int64).tobytes()).digest()[:8], "big", signed=True))
            line_h += own.keys()
            line_n += own.values()
            sizes.append(len(own))
        lines = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (line_h, line_n)], ["line", "words"])
        longs = {k: pa.array(v, pa.int64()) for k, v in zip(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), (n_words, chars, symbols, dups, repeats), strict=True)}
        return out_batch(_row=col(batch, "_row"), id=col(batch, "id"), host=col(batch, "host"), **longs, copy=pa.array(copies, pa.int64()), lines=list_array(lines, sizes))

    plain = df.withColumn("host", host_key(F.col(host_col)))
    schema = T.StructType([*plain.select("_row", "id", "host").schema.fields, *T._parse_datatype_string(f"{STATS}, {LINES}").fields])
    return arrow_map(plain.select("_row", "id", "host", "text"), look, schema)


def frequent_lines(stats: DataFrame, max_docs: int) -> DataFrame:
    """(host, line, rows): lines in more distinct documents of their host than max_docs, and in how many rows."""
    lines = stats.select("host", "copy", F.explode("lines.line").alias("line"))
    copies = lines.groupBy("host", "copy", "line").agg(F.count(F.lit(1)).alias("rows"))
    counts = copies.groupBy("host", "line").agg(F.count(F.lit(1)).alias("docs"), F.sum("rows").alias("rows"))
    return counts.where(F.col("docs") > max_docs).select("host", "line", "rows")


def judged_rows(df: DataFrame, max_docs: int, min_left: float, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """id, host, the base counts, failed, gone (words in boilerplate lines), kept and boilerplate (hashes of these lines, or null) of each row."""
    rows = df.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(host_col).alias("_host"))
    stats = staged(text_stats(rows, "_host"), "quality-stats")
    held = stats.agg(F.sum(F.size("lines"))).first()[0] or 0
    frequent = staged(frequent_lines(stats, max_docs), "quality-frequent")
    lines = stats.select("_row", "host", F.explode("lines").alias("x")).select("_row", "host", "x.line", "x.words")
    lost = spread_join(lines, frequent, ["host", "line"], F.col("rows") > held // HOT_KEYS)
    lost = lost.groupBy("_row").agg(F.sum("words").alias("_lost"), F.collect_list("line").alias("boilerplate"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    judged = stats.drop("copy", "lines").join(lost, "_row", "left").withColumn("failed", failed).withColumn("gone", F.coalesce("_lost", F.lit(0)).cast("long"))
    return judged.withColumn("kept", ~F.col("failed") & (F.col("n_words") - F.col("gone") >= min_left * F.col("n_words")))


def quality(
    df: DataFrame,
    max_docs: int = 20,
    min_left: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
) -> DataFrame:
    """One row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_boilerplate_words.

    base_failed: fewer than 20 words, or over 30 % of the words in repeated 8-word windows. kept: not base_failed, and
    min_left of the words or more are outside boilerplate lines. A null text is empty and fails; a null host is a
    host of its own; repeated rows are copies of one another and each is judged; an empty table gives an empty result;
    other columns are ignored.
    """
    return judged_rows(df, max_docs, min_left, id_col, text_col, host_col).select(
        F.col("id").alias("doc_id"),
        *(x.split()[0] for x in STATS.split(", ")),
        F.col("failed").alias("base_failed"),
        "kept",
        F.col("gone").alias("n_boilerplate_words"),
    )


def keep_good(df: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of df whose document is kept; all columns. Rows that repeat an id stay if one of them is kept."""
    good = quality(df, id_col=id_col, **options).where("kept").select(F.col("doc_id").alias("_kept_id")).distinct()
    return df.join(good, df[id_col].eqNullSafe(good["_kept_id"]), "left_semi")


def clean_good(
    df: DataFrame,
    max_docs: int = 20,
    min_left: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
) -> DataFrame:
    """The rows of keep_good(), their text without the lines that are boilerplate on their host; all columns.

    Other texts stay as they are. Lines go with their line break, so a text of such lines alone becomes empty.
    """
    judged = staged(judged_rows(df, max_docs, min_left, id_col, text_col, host_col).select("id", "host", "kept", "boilerplate"), "quality-judged")
    good = judged.where("kept").select(F.col("id").alias("_kept_id")).distinct()
    lines = judged.where("boilerplate is not null").select("id", "host", F.explode("boilerplate").alias("line"))
    cut = lines.groupBy(F.col("id").alias("_cut_id")).agg(F.collect_set(F.struct("host", "line")).alias("_cut"))
    known = good.join(cut, F.col("_kept_id").eqNullSafe(F.col("_cut_id")), "left").select("_kept_id", "_cut")
    host, text = host_key(df[host_col]), df[text_col]
    stays = lambda x: ~F.array_contains("_cut", F.struct(host.alias("host"), line_key(x).alias("line")))
    left = F.when(F.col("_cut").isNull(), text).otherwise(F.array_join(F.filter(F.split(text, "\n", -1), stays), "\n"))
    rows = df.join(known, df[id_col].eqNullSafe(known["_kept_id"]))
    return rows.select(*(left.alias(c) if c == text_col else df[c] for c in df.columns))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(stack(spark, sf_dir, "documents"))


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

SQL = rf"""
with docs as (
  select doc_id, source, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), windows as (
  select doc_id, i, count(*) over (partition by doc_id, win) as times
  from (select doc_id, i, array_to_string(w[i:i + 7], ' ') as win from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from docs))
), repeats as (
  select doc_id, count(distinct spot) as n from (select doc_id, unnest(range(i, i + 8)) as spot from windows where times > 1) group by doc_id
), lines as (
  select doc_id, source, pos, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as words
  from (select doc_id, source, unnest(range(len(string_split(text, chr(10))))) as pos, unnest(string_split(text, chr(10))) as line from docs) where regexp_matches(line, '[^\x20\x09-\x0D]')
), dups as (
  select doc_id, count(*) - count(distinct line) as n from lines group by doc_id
), keyed as (
  select doc_id, source, pos, translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as line, words from lines
), own as (
  select doc_id, source, line, sum(words) as words from keyed group by doc_id, source, line
), copies as (
  select doc_id, string_agg(line, chr(10) order by pos) as copy from keyed group by doc_id
), frequent as (
  select source, line from own join copies using (doc_id) group by source, line having count(distinct copy) > 20
), lost as (
  select doc_id, cast(sum(words) as bigint) as n from own join frequent f on own.line = f.line and own.source is not distinct from f.source group by doc_id
), counted as (
  select d.doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
         coalesce(u.n, 0) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words, coalesce(l.n, 0) as n_boilerplate_words
  from docs d left join dups u on d.doc_id = u.doc_id left join repeats r on d.doc_id = r.doc_id left join lost l on d.doc_id = l.doc_id
)
select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
       not (n_words < 20 or 100 * n_repeat_words > 30 * n_words) and n_words - n_boilerplate_words >= 0.3 * n_words as kept
from counted
"""
