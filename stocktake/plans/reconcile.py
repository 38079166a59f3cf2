"""Inventories against each other."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import reconcile as R
from ..operators import rows, sinks
from .content import sql_mark
from .registry import query


@query("select d.source, round(count(l.doc_id) / greatest(count(*), 1)::double, 6) as coverage from documents d left join labels l on d.doc_id = l.doc_id group by 1")
def coverage_missing(t):
    j = t.documents.select("doc_id", "source").join(t.labels.select("doc_id", F.lit(1).alias("l")), "doc_id", "left")
    n, miss = F.count("l"), F.count_if(F.col("l").isNull())
    return j.groupBy("source").agg(F.round(R.coverage(n, miss), 6).alias("coverage"))


@query("""
select doc_id, 'missing' as status from documents where lang = 'en' and doc_id not in (select doc_id from labels)
union all select distinct doc_id, 'stale' from labels where doc_id not in (select doc_id from documents)
""")
def stale_and_missing(t):
    return R.both_ways(t.labels, t.documents, ["doc_id"], F.col("lang") == "en")


@query("select o_orderkey, o_orderstatus from orders where o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R')")
def present_semi(t):
    demanded = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return R.still_demanded(t.orders.select("o_orderkey", "o_orderstatus"), demanded, ["o_orderkey"])


@query("select c_custkey, c_mktsegment from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'P')")
def work_list(t):
    return R.missing(t.customer.select("c_custkey", "c_mktsegment"), t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("""
with a as (select distinct o_orderpriority as voice, o_orderkey as clip from orders where o_orderstatus <> 'P'),
p as (select distinct o_orderpriority as voice, o_orderkey as clip from orders join lineitem on o_orderkey = l_orderkey where l_returnflag = 'N')
select coalesce(a.voice, p.voice) as voice, count(a.clip) as announced, count(*) filter (where a.clip is not null and p.clip is not null) as there,
       count(*) filter (where p.clip is null) as absent, count(*) filter (where a.clip is null) as extra
from a full join p on a.voice = p.voice and a.clip = p.clip group by 1
""")
def announced_vs_present(t):
    o = t.orders.select(F.col("o_orderpriority").alias("voice"), F.col("o_orderkey").alias("clip"), "o_orderstatus")
    kept = t.lineitem.where("l_returnflag = 'N'").select(F.col("l_orderkey").alias("clip"))
    return R.announced(o.where("o_orderstatus <> 'P'"), R.still_demanded(o, kept, ["clip"]), "voice", "clip")


@query("""
with o as (select o_orderkey, o_orderstatus as v from orders where o_orderdate < timestamp '1997-01-01'),
n as (select o_orderkey, case when o_orderkey % 5 = 0 then 'X' else o_orderstatus end as v from orders where o_orderdate >= timestamp '1994-01-01')
select coalesce(o.o_orderkey, n.o_orderkey) as o_orderkey, o.v as old, n.v as new,
       case when o.o_orderkey is null then 'added' when n.o_orderkey is null then 'removed' else 'modified' end as change
from o full join n on o.o_orderkey = n.o_orderkey where o.v is distinct from n.v
""")
def inventory_diff(t):
    o = t.orders.where("o_orderdate < timestamp '1997-01-01'").select("o_orderkey", F.col("o_orderstatus").alias("v"))
    n = t.orders.where("o_orderdate >= timestamp '1994-01-01'").select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus")).alias("v"))
    return R.inventory_diff(o, n, ["o_orderkey"], "v")


@query("""
with r as (select conv_id, role, turn, text, row_number() over (partition by conv_id, role order by turn) as rank from conversations)
select l.conv_id, l.role, cast(l.rank as integer) as rank, r.turn, abs(length(r.text) - l.chars) / l.chars::double > 0.30 as off
from (select distinct conv_id, role, unnest(range(1, 4)) as rank, 200 as chars from conversations) l
left join r on l.conv_id = r.conv_id and l.role = r.role and l.rank = r.rank
""")
def rank_join_reconcile(t):
    wanted = t.conversations.select("conv_id", "role").distinct().withColumn("rank", F.explode(F.array(*map(F.lit, (1, 2, 3)))))
    j = R.by_rank(wanted, t.conversations, ["conv_id", "role"], "turn")
    return j.select("conv_id", "role", "rank", "turn", R.off_by(F.length("text"), F.lit(200.0)).alias("off"))


@query("""
select coalesce(a.conv_id, b.conv_id) as conv_id, n_left, n_right, n_left is not distinct from n_right as agrees
from (select conv_id, count(*) as n_left from conversations where role = 'user' group by 1) a
full join (select conv_id, count(*) as n_right from conversations where role = 'assistant' group by 1) b on a.conv_id = b.conv_id
""")
def counts_agree(t):
    c = t.conversations
    return R.counts_agree(c.where("role = 'user'"), c.where("role = 'assistant'"), ["conv_id"])


@query(f"""
select {sql_mark('text')} as mark, doc_id, source from documents where cast(substr(source, 4) as integer) <= 9
qualify row_number() over (partition by {sql_mark('text')} order by source, doc_id) = 1
""")
def bounded_dedupe_order(t):
    d = t.documents.select(X.fingerprint(F.col("text")).alias("mark"), "doc_id", "source")
    return rows.dedupe_in_scope(d, F.substring("source", 4, 9).cast("int") <= 9, ["mark"], ["source", "doc_id"])


_LABEL = "case when doc_id % 7 = 0 then 'side_' || doc_id when doc_id % 7 = 1 then 'ch' || (doc_id % 90) || 'b' else 'ch' || (doc_id % 90) end"
_NUMBER = r"try_cast(nullif(regexp_extract({0}, '^ch(\d+)[a-z]*$', 1), '') as integer)".format(_LABEL)


def _labelled(t):
    i = F.col("doc_id")
    n = (i % 90).cast("string")
    label = F.when(i % 7 == 0, F.concat(F.lit("side_"), i.cast("string"))).when(i % 7 == 1, F.concat(F.lit("ch"), n, F.lit("b"))).otherwise(F.concat(F.lit("ch"), n))
    return t.documents.select("doc_id", X.chapter_number(label).alias("chapter"), X.first_number(label).alias("loose"))


_LOOSE = rf"try_cast(nullif(regexp_extract({_LABEL}, '(\d+)', 1), '') as integer)"


@query(f"select doc_id, {_NUMBER} as chapter, {_LOOSE} as loose from documents where {_NUMBER} <= 40")
def bound_null_excluded(t):
    return _labelled(t).where(rows.within(F.col("chapter"), 40, undated=False))


@query(f"select doc_id, {_NUMBER} as chapter, {_LOOSE} as loose from documents where {_NUMBER} is null or {_NUMBER} <= 40")
def bound_null_kept(t):
    return _labelled(t).where(rows.within(F.col("chapter"), 40, undated=True))


@query("""
with r as (select p_partkey, 'p' || p_partkey as old, 'n' || (p_partkey // 2) as new from part),
disk as (select 'p' || p_partkey as c from part where p_partkey % 3 > 0 union select 'n' || (p_partkey // 2) from part where p_partkey % 10 = 0),
j as (select r.*, o.c is not null as has_old, n.c is not null as has_new, row_number() over (partition by new, o.c is not null order by old) as k
      from r left join disk o on r.old = o.c left join disk n on r.new = n.c)
select case when not has_old and not has_new then 'absent' when not has_old then 'keep' when has_new or k > 1 then 'merge' else 'rename' end as action, count(*) as count from j group by 1
""")
def rename_actions(t):
    i = F.col("p_partkey")
    old, new = F.concat(F.lit("p"), i.cast("string")), F.concat(F.lit("n"), F.expr("string(p_partkey div 2)"))
    disk = t.part.where(i % 3 > 0).select(old.alias("clip")).union(t.part.where(i % 10 == 0).select(new.alias("clip"))).distinct()
    return R.action_counts(R.rename_plan(t.part.select(old.alias("old"), new.alias("new")), disk, "old", "new"))


@query("""
select s.doc_id, s.bytes from (select doc_id, strlen(text) as bytes from documents) s
left join (select doc_id, strlen(text) + case when doc_id % 4 = 0 then 1 else 0 end as bytes from documents where doc_id % 3 > 0) t on s.doc_id = t.doc_id
where t.doc_id is null or t.bytes <> s.bytes
""")
def copy_if_changed(t):
    source = t.documents.select("doc_id", F.octet_length("text").cast("long").alias("bytes"))
    target = source.where("doc_id % 3 > 0").withColumn("bytes", F.col("bytes") + F.when(F.col("doc_id") % 4 == 0, 1).otherwise(0))
    return sinks.copy_plan(source, target, "doc_id", sinks.size_changed())


@query("""
with m as (select lang as voix, 'f' || doc_id as fichier, sha256(text) as s from documents where doc_id % 5 > 0),
l as (select lang as voix, 'f' || doc_id as fichier, case when doc_id % 6 = 0 then '0' else left(sha256(text), 16) end as s from documents where doc_id % 7 > 0)
select coalesce(l.voix, m.voix) as voix, count(l.fichier) as announced, count(*) filter (where l.fichier is not null and m.fichier is not null) as there,
       count(*) filter (where m.fichier is null) as absent, count(*) filter (where l.s <> left(m.s, 16)) as altered, count(*) filter (where l.fichier is null) as extra
from l full join m on l.voix = m.voix and l.fichier = m.fichier group by 1
""")
def verify_archive(t):
    i, sha = F.col("doc_id"), F.sha2("text", 256)
    d = t.documents.select("doc_id", F.col("lang").alias("voix"), F.concat(F.lit("f"), i.cast("string")).alias("fichier"), sha.alias("sha256"))
    listed = d.where(i % 7 > 0).withColumn("sha256", F.when(i % 6 == 0, "0").otherwise(F.substring("sha256", 1, 16)))
    return sinks.verify_pack(d.where(i % 5 > 0), listed)


@query("""
select url as path from pages where not contains('/' || split_part(url, '://', 2), '/.') and split_part(split_part(url, '://', 2), '/', 1) in (select split_part(split_part(url, '://', 2), '/', 1) from pages where page_id % 2 = 0)
""")
def pack_members(t):
    p = t.pages.select("page_id", F.col("url"), F.split("url", "://")[1].alias("path"))
    declared = p.where("page_id % 2 = 0").select(F.split("path", "/")[0].alias("folder"))
    return sinks.pack_members(p, declared).select(F.col("url").alias("path"))


@query("""
select n.n_nationkey, n.n_name, case when r.r_regionkey is not null then r.r_name end as region, coalesce(s.n, 0) as files
from nation n left join region r on n.n_regionkey = r.r_regionkey and r.r_regionkey < 3
left join (select s_nationkey, count(*) as n from supplier group by 1) s on n.n_nationkey = s.s_nationkey
""")
def status_board(t):
    slugs = t.nation.select(F.col("n_nationkey").alias("slug"), "n_name")
    doc = t.nation.join(t.region.where("r_regionkey < 3"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("slug"), "r_name")
    board = R.status_board(slugs, {"choice": doc}, t.supplier.select(F.col("s_nationkey").alias("slug")))
    return board.select(F.col("slug").alias("n_nationkey"), "n_name", F.col("choice.r_name").alias("region"), "files")


@query("select distinct lang || '-' || source as label from documents where doc_id % 3 = 0 intersect select distinct lang || '-' || source from documents where doc_id % 3 = 1")
def shared_labels(t):
    label = F.concat_ws("-", "lang", "source").alias("label")
    d = t.documents
    return d.where("doc_id % 3 = 0").select(label).intersect(d.where("doc_id % 3 = 1").select(label)).orderBy("label")
