"""Sampling, assignment, as-of and nearest lookups, priorities, orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import match as M
from ..operators import rows
from .registry import query


@query("""
with r as (select user_id, ts, min(event_id) as claim from events where event_type = 'purchase' group by all)
select e.event_id, e.user_id, r.claim from events e asof left join r on e.user_id = r.user_id and e.ts >= r.ts
""")
def asof_claim(t):
    e = t.events.select("event_id", "user_id", "ts", "event_type")
    claims = rows.first_of(e.where("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("claim")), ["user_id", "ts"], "claim")
    return M.as_of(e.select("event_id", "user_id", "ts"), claims, "ts", "claim", ["user_id"]).select("event_id", "user_id", "claim")


_STAGES = [(0, "s01", [2, 3, 4]), (1, "s02", [8, 9, 15]), (2, "s03", [15, 20, 40])]


@query("""
with claims(ch, stage) as (values (2, 's01'), (3, 's01'), (4, 's01'), (8, 's02'), (9, 's02'), (15, 's02'), (20, 's03'), (40, 's03')),
d as (select doc_id, cast(doc_id % 60 as integer) as chapter from documents where doc_id % 11 > 0)
select d.doc_id, d.chapter, case when d.chapter <= 1 then 'prologue' else c.stage end as stage from d asof left join claims c on d.chapter >= c.ch where d.chapter <= 1 or c.stage is not null
""")
def asof_stage(t):
    stages = t.spark.createDataFrame(_STAGES, "ord int, stage string, chapters array<int>")
    d = t.documents.select("doc_id", F.when(F.col("doc_id") % 11 > 0, F.col("doc_id") % 60).cast("int").alias("chapter"))
    return M.stage_of(d, stages, "chapter").select("doc_id", "chapter", "stage")


_TARGETS = [("low", 950.0), ("mid", 1200.0), ("same", 1200.0), ("high", 1700.0)]


@query("""
with targets(i, target, v) as (values (0, 'low', 950.0::double), (1, 'mid', 1200.0::double), (2, 'same', 1200.0::double), (3, 'high', 1700.0::double))
select p_partkey, target, abs(p_retailprice - v) as distance from part cross join targets qualify row_number() over (partition by p_partkey order by abs(p_retailprice - v), i) = 1
""")
def nearest_target(t):
    return M.nearest(t.part.select("p_partkey", "p_retailprice"), _TARGETS, F.col("p_retailprice")).select("p_partkey", "target", "distance")


@query("""
with d as (select doc_id, source, text, case when source <> 'src3' and doc_id % 13 > 0 then cast(doc_id % 50 as integer) end as chapter from documents),
k as (select *, ntile(5) over (partition by source order by coalesce(chapter, 0), doc_id) as bucket from (select *, bool_or(chapter is not null) over (partition by source) as dated from d) where chapter is not null or not dated)
select source, cast(bucket as integer) as bucket, doc_id from k qualify row_number() over (partition by source, bucket order by length(text) desc, coalesce(chapter, 0), doc_id) = 1
""")
def stratified_longest(t):
    i = F.col("doc_id")
    d = t.documents.select("doc_id", "source", "text", F.when((F.col("source") != "src3") & (i % 13 > 0), i % 50).cast("int").alias("chapter"))
    return rows.stratified_longest(d, ["source"], "chapter", "text", "doc_id", 5).select("source", "bucket", "doc_id")


@query("""
with o as (select n_nationkey, n_name, case when n_regionkey = 0 then 'aiden' end as timbre from nation),
free(i, v) as (values (0, 'ryan'), (1, 'serena'), (2, 'vivian'))
select n_nationkey, n_name, timbre from o where timbre is not null
union all select n_nationkey, n_name, v from (select *, row_number() over (order by n_name) - 1 as turn from o where timbre is null) join free on i = turn % 3
""")
def round_robin_assign(t):
    n = t.nation.select("n_nationkey", "n_name", F.when(F.col("n_regionkey") == 0, "aiden").alias("timbre"))
    return rows.round_robin(n, F.col("timbre").isNull(), "n_name", ["aiden", "ryan", "serena", "vivian"], None, "timbre")


@query("""
with reg(k, v) as (values ('neutral', 'Speak evenly.'), ('grave', 'Low and slow.'), ('light', 'Bright.')),
c as (select conv_id, turn, role, case when turn % 5 = 0 then 'As written.' when turn % 5 = 1 then '' end as instruct, case when turn % 3 = 0 then 'grave' when turn % 3 = 1 then '' else 'unknown' end as registre from conversations)
select conv_id, turn, coalesce(nullif(instruct, ''), r.v, 'Speak evenly.') as consigne
from c left join reg r on r.k = coalesce(nullif(registre, ''), case role when 'user' then 'light' end, 'neutral')
""")
def priority_register(t):
    reg = t.spark.createDataFrame([("neutral", "Speak evenly."), ("grave", "Low and slow."), ("light", "Bright.")], "registre string, consigne string")
    k = F.col("turn")
    c = t.conversations.select("conv_id", "turn", "role", F.when(k % 5 == 0, "As written.").when(k % 5 == 1, "").alias("instruct"), F.when(k % 3 == 0, "grave").when(k % 3 == 1, "").otherwise("unknown").alias("registre"))
    return M.resolve_instruction(c, reg, {"user": "light"}, None, "neutral").select("conv_id", "turn", "consigne")


@query("""
select c_custkey, coalesce(n_name, 'nowhere') as n_name, case when c_mktsegment = 'BUILDING' then case when n_name is not null then 'qwen3' else 'chatterbox' end else c_mktsegment end as engine
from customer left join (select * from nation where n_nationkey < 20) on c_nationkey = n_nationkey
""")
def lookup_and_route(t):
    dim = t.nation.where("n_nationkey < 20").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    out = M.lookup(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"), dim, "c_nationkey", "n_name", F.lit("nowhere"))
    wanted = F.when(F.col("c_mktsegment") == "BUILDING", "hybride").otherwise(F.col("c_mktsegment"))
    return out.select("c_custkey", "n_name", M.engine_of(wanted, F.col("n_name") != "nowhere").alias("engine"))


@query("""
select *, (select greatest(count(*) - 60, 0) from orders) as others from (
select o_orderkey, case when o_orderkey % 3 > 0 then o_custkey end as chapter, o_orderpriority from orders order by chapter asc nulls last, o_orderpriority, o_orderkey limit 60)
""")
def null_last_sort_topk(t):
    o = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_custkey")).alias("chapter"), "o_orderpriority")
    return rows.limit_with_rest(o, [F.col("chapter").asc_nulls_last(), "o_orderpriority", "o_orderkey"], 60)


@query("""
select conv_id, turn, role, last_value(case when role = 'user' then turn end ignore nulls) over (partition by conv_id order by turn rows between unbounded preceding and current row) as last_user from conversations
""")
def last_event_so_far(t):
    return rows.last_so_far(t.conversations.select("conv_id", "turn", "role"), ["conv_id"], "turn", F.when(F.col("role") == "user", F.col("turn")), "last_user")


@query("select conv_id, turn, role from conversations qualify row_number() over (partition by role order by conv_id, turn) <= 8")
def head_per_role(t):
    return rows.head_of(t.conversations.select("conv_id", "turn", "role"), ["role"], ["conv_id", "turn"], 8)


@query("select conv_id, turn, role from conversations order by role = 'user', conv_id, turn limit 25")
def priority_sample(t):
    return rows.priority_sample(t.conversations.select("conv_id", "turn", "role"), F.col("role") == "user", ["conv_id", "turn"], 25)


@query("select doc_id, source from documents qualify row_number() over (partition by source order by md5('11:' || doc_id), doc_id) <= 40")
def seeded_sample(t):
    return rows.seeded_sample(t.documents.select("doc_id", "source"), ["source"], "doc_id", 40)


@query("""
select p_partkey, 'A' as origin from part where p_size > 48 union all select p_partkey, 'B' from part where p_brand = 'Brand#13' and p_partkey not in (select p_partkey from part where p_size > 48)
""")
def union_priority(t):
    a = t.part.where("p_size > 48").select("p_partkey", F.lit("A").alias("origin"))
    return rows.union_with_priority(a, t.part.where("p_brand = 'Brand#13'").select("p_partkey", F.lit("B").alias("origin")), ["p_partkey"])
