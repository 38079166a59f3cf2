"""Content addressing, extraction and scalar functions over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import rows, stats
from ..sources import timelines
from .registry import query

BLANK = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def sql_normal(x: str) -> str:
    return f"trim(regexp_replace(nfc_normalize({x}), '{BLANK}', ' ', 'g'))"


def sql_mark(x: str) -> str:
    return f"case when {sql_normal(x)} = '' then '' else left(sha256({sql_normal(x)}), 10) end"


def sql_role(x: str) -> str:
    return rf"lower(regexp_extract(regexp_replace(strip_accents({x}), '[^\p{{L}}\p{{N}}\s''_-]', '', 'g'), '^[\s''_-]*([\p{{L}}\p{{N}}]*)', 1))"


@query(f"""
with keyed as (
  select conv_id, turn, {sql_role('role')} as role, {sql_mark('text')} as mark from conversations
)
select role || '_' || mark as id, conv_id, turn, role,
       case when role in ('narrator', 'narrateur', 'note') then 'arthur' else role end || '/' || role || '_' || mark || '.ogg' as path
from keyed where role <> '' and mark <> ''
qualify row_number() over (partition by role, mark order by conv_id, turn) = 1
""")
def fingerprint_inventory(t):
    """Flagship: what is to be recorded, one clip per speaker and text, first request first."""
    role, mark = X.role_of_speaker(F.col("role")), X.fingerprint(F.col("text"))
    keyed = t.conversations.select("conv_id", "turn", role.alias("role"), mark.alias("mark"))
    keyed = keyed.select("conv_id", "turn", "role", X.clip_id(F.col("role"), F.col("mark")).alias("id"), X.clip_path(F.col("role"), F.col("mark")).alias("path")).where("id is not null")
    return rows.first_of(keyed, ["id"], ["conv_id", "turn"])


@query(f"select {sql_mark('text')} as mark, min(doc_id) as first_doc, count(*) as n_docs, count(distinct source) as n_sources from documents group by 1")
def fingerprint_dedupe_docs(t):
    keyed = t.documents.select("doc_id", "source", X.fingerprint(F.col("text")).alias("mark"))
    return keyed.groupBy("mark").agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("n_docs"), F.count_distinct("source").alias("n_sources"))


@query(f"select c_custkey as key, {sql_role('c_name')} as role from customer union all select s_suppkey, {sql_role('s_name')} from supplier")
def speaker_role(t):
    names = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")).unionByName(t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")))
    return names.select("key", X.role_of_speaker(F.col("name")).alias("role"))


_LINES = r"string_split_regex(text, '\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]')"


@query(rf"""
with lines as (select doc_id, unnest(range(1, len({_LINES}) + 1)) as ligne, unnest({_LINES}) as line from documents where text <> ''),
bare as (select doc_id, ligne, regexp_replace(regexp_replace(line, '^{BLANK}', ''), '{BLANK}$', '') as bare from lines)
select doc_id, cast(ligne as integer) as ligne, bare as line, cast(row_number() over (partition by doc_id order by ligne) as integer) as rank
from bare where bare <> '' and bare not like '#%' and bare not like '[%' and bare not like '- %'
""")
def line_extraction(t):
    return timelines.spoken_lines(t.documents.where("text <> ''").select("doc_id", F.col("text").alias("content")))


@query(r"""
select page_id, trim(regexp_replace(regexp_replace(html, '\[[^\]]*\]|\{[^}]*\}', ' ', 'g'), '""" + BLANK + r"""', ' ', 'g')) as text from pages
""")
def markup_strip(t):
    return t.pages.select("page_id", X.strip_markup(F.col("html")).alias("text"))


@query("""
select role, count(*) as n, string_agg(distinct cast(conv_id % 7 as varchar), ',' order by cast(conv_id % 7 as varchar)) as members, min(conv_id * 1000 + turn) as first_seen
from conversations group by role having count(*) >= 10 and role <> 'system'
""")
def census_roles(t):
    said = t.conversations.select("role", (F.col("conv_id") % 7).cast("string").alias("m"), (F.col("conv_id") * 1000 + F.col("turn")).alias("ord"))
    found = stats.census_filter(stats.census(said, "role", "m", "ord"), "role", 10, excluded=["system"])
    return found.withColumn("members", F.array_join("members", ","))


@query("select c_custkey, 1000 + cast(list_sum(list_transform(string_split(c_name, ''), lambda x: ascii(x))) as integer) % 10000 as seed from customer")
def byte_sum_seed(t):
    return t.customer.select("c_custkey", X.byte_sum_seed(F.col("c_name"), 1000).alias("seed"))


@query(r"""
with named as (
  select doc_id, case when doc_id % 3 = 0 then lang || '_ch' || (doc_id % 90) || '_' || (doc_id % 7)
                      when doc_id % 3 = 1 then lang || '_' || left(sha256(cast(doc_id as varchar)), 10) else 'x-' || doc_id end as name from documents)
select doc_id, case when regexp_matches(name, '^[a-z0-9]+_[0-9a-f]{10}$') then 'fingerprint' when regexp_matches(name, '^[a-z0-9]+_ch\d+_\d+$') then 'positional' else 'unknown' end as convention,
       nullif(regexp_extract(name, '^([a-z0-9]+)_(ch\d+_\d+|[0-9a-f]{10})$', 1), '') as role,
       try_cast(nullif(regexp_extract(name, '^[a-z0-9]+_ch(\d+)_\d+$', 1), '') as integer) as chapter,
       nullif(regexp_extract(name, '^[a-z0-9]+_([0-9a-f]{10})$', 1), '') as mark
from named
""")
def clip_names(t):
    i = F.col("doc_id")
    old = F.concat("lang", F.lit("_ch"), (i % 90).cast("string"), F.lit("_"), (i % 7).cast("string"))
    new = F.concat("lang", F.lit("_"), F.substring(F.sha2(i.cast("string"), 256), 1, 10))
    name = F.when(i % 3 == 0, old).when(i % 3 == 1, new).otherwise(F.concat(F.lit("x-"), i.cast("string")))
    return t.documents.select("doc_id", X.parse_clip_name(name).alias("p")).select("doc_id", "p.convention", "p.role", "p.chapter", "p.mark")


@query("""
select doc_id, greatest(0.6, length(text) / 14.0::double) as expected, regexp_matches(text, '[0-9A-Za-zÀ-ÿ]') as pronounceable,
       replace(text, '|', chr(92) || '|') as cell, 'chapter_' || lpad(cast(doc_id % 100 as varchar), 2, '0') as file,
       translate('aiden:0.7+' || lang || ':0.3', ':.+', '--_') as spec
from documents
""")
def text_scalars(t):
    text = F.col("text")
    return t.documents.select(
        "doc_id",
        X.expected_seconds(text).alias("expected"),
        X.pronounceable(text).alias("pronounceable"),
        X.markdown_cell(text).alias("cell"),
        X.chapter_file((F.col("doc_id") % 100).cast("int")).alias("file"),
        X.path_safe(F.concat(F.lit("aiden:0.7+"), "lang", F.lit(":0.3"))).alias("spec"),
    )


@query("""
with named as (select p_partkey, p_size, lower(split_part(p_name, ' ', 1)) as a, lower(split_part(p_brand, '#', 1)) as b from part)
select p_partkey, cast(case when a = b then 1 else 2 end as integer) as n_components,
       case when a = b then a when p_size > 10 then a else b end as dominant,
       case when a = b then 1.0::double else round_even(p_size / (p_size + 10.0::double), 2) end as share
from named
""")
def timbre_mix(t):
    a, b = F.lower(F.split("p_name", " ")[0]), F.lower(F.split("p_brand", "#")[0])
    spec = F.concat(b, F.lit(":10+"), F.upper(a), F.lit(":"), F.col("p_size").cast("string"))
    m = t.part.select("p_partkey", "p_size", a.alias("a"), X.parse_mix(spec).alias("m"))
    total = F.aggregate(F.map_values("m"), F.lit(0.0), lambda s, x: s + x)
    return m.select("p_partkey", F.size("m").alias("n_components"), X.dominant(F.col("m")).alias("dominant"), F.bround(F.try_element_at("m", "a") / total, 2).alias("share"))
