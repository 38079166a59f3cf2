"""Further operators over the driver tables: defaults, prompts, jobs, reports, plans of file actions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import match as M
from ..operators import reconcile as R
from ..operators import rows, sinks, store
from ..operators import stats as S
from ..session import scratch_dir
from .registry import query


@query("""
with d(role, register, exaggeration) as (values ('user', 'light', 0.3::double), ('assistant', 'grave', 0.7::double))
select conv_id, turn, coalesce(case when turn % 4 = 0 then 'own' end, d.register) as register, d.exaggeration from conversations c left join d on c.role = d.role
""")
def role_defaults(t):
    defaults = t.spark.createDataFrame([("user", "light", 0.3), ("assistant", "grave", 0.7)], "role string, register string, exaggeration double")
    c = t.conversations.select("conv_id", "turn", "role", F.when(F.col("turn") % 4 == 0, "own").alias("register"))
    return M.role_defaults(c, defaults, "role", ["register", "exaggeration"]).select("conv_id", "turn", "register", "exaggeration")


@query("""
with g(role, target) as (values ('user', 132.0::double), ('*', 217.0::double))
select conv_id, turn, coalesce(g.target, 217.0) as target, trim(concat_ws(' ', case when c.role <> 'narrator' then nullif(case when turn % 2 = 0 then 'A man of forty.' else '' end, '') end, 'Speak evenly.')) as prompt
from conversations c left join g on c.role = g.role and g.role <> '*'
""")
def target_and_prompt(t):
    targets = t.spark.createDataFrame([("user", 132.0), ("*", 217.0)], "role string, target double")
    c = M.target_of(t.conversations.select("conv_id", "turn", "role"), targets)
    prefix = F.when(F.col("turn") % 2 == 0, "A man of forty.").otherwise("")
    return c.select("conv_id", "turn", "target", M.prompt(prefix, F.lit("Speak evenly."), F.col("role")).alias("prompt"))


@query("select s_suppkey from (select s_suppkey, 0 as src from supplier where s_nationkey < 3 union all select s_suppkey, 1 from supplier where s_nationkey >= 20) order by src, s_suppkey limit 9")
def top_up(t):
    s = t.supplier
    return rows.top_up(s.where("s_nationkey < 3").select("s_suppkey"), s.where("s_nationkey >= 20").select("s_suppkey"), "s_suppkey", 9)


@query("""
select p_partkey, case when p_size <= 10 then 'aiden:0.6+ryan' else
  'aiden:' || format('{:.3f}', 0.6 * (1 - p_size / 100.0::double)) || '+ryan:' || format('{:.3f}', 1.0 * (1 - p_size / 100.0::double)) || '+serena:' || format('{:.3f}', p_size / 100.0::double) end as spec from part
""")
def dose_mix(t):
    dose = F.when(F.col("p_size") <= 10, 0.0).otherwise(F.col("p_size") / 100.0)
    return t.part.select("p_partkey", X.dose_mix(F.lit("aiden:0.6+ryan"), dose, F.lit("serena")).alias("spec"))


@query(r"""
select doc_id, coalesce(nullif(array_to_string(regexp_extract_all(lower(regexp_replace(strip_accents(text), '[^\x00-\x7f]', '', 'g')), '[a-z0-9]+')[1:4], '-'), ''), 'voix') as slug from documents
""")
def slugs(t):
    return t.documents.select("doc_id", X.slug(F.col("text")).alias("slug"))


@query("""
select n_regionkey % 2 = 0 as even_, string_agg(n_name, ',' order by n_nationkey % 4, n_nationkey) as jobs from nation group by 1
""")
def job_plan(t):
    even = F.col("n_regionkey") % 2 == 0
    voices = t.nation.select(even.cast("string").alias("moteur"), (F.col("n_nationkey") % 4).cast("int").alias("repliques"), F.col("n_nationkey").alias("ord"), F.col("n_name").alias("nom"), *[F.lit("").alias(c) for c in ("lines", "out_dir", "speaker", "reference")])
    return sinks.job_plan(voices).select((F.col("moteur") == "true").alias("even_"), F.array_join(F.transform("jobs", lambda j: j["nom"]), ",").alias("jobs"))


@query("""
select l_returnflag, string_agg(l_linestatus || '=' || n, ',' order by l_linestatus) as items from (select l_returnflag, l_linestatus, count(*) as n from lineitem group by all) group by 1
""")
def nested_report(t):
    cells = t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    nested = S.nested_report(cells, "l_returnflag", "l_linestatus", ["n"])
    return nested.select("l_returnflag", F.array_join(F.transform(F.array_sort(F.map_entries("items")), lambda e: F.concat_ws("=", e["key"], e["value"]["n"].cast("string"))), ",").alias("items"))


@query("""
with m as (select case when page_id % 9 = 0 then '../' when page_id % 9 = 1 then '/' else '' end || 'p' || page_id || case when page_id % 4 = 0 then '.txt' else '.ogg' end as member, page_id % 100 as bytes from pages)
select member, bytes, case when member like '/%' or member like '../%' then 'refuse' when bytes < 50 then 'keep' else 'install' end as action from m where member like '%.ogg'
""")
def install_plan(t):
    i = F.col("page_id")
    lead = F.when(i % 9 == 0, "../").when(i % 9 == 1, "/").otherwise("")
    m = t.pages.select(F.concat(lead, F.lit("p"), i.cast("string"), F.when(i % 4 == 0, ".txt").otherwise(".ogg")).alias("member"), (i % 100).alias("bytes"))
    return sinks.install_plan(m, m.where("bytes < 50"))


@query("""
select s.doc_id from (select doc_id, doc_id % 10 as m from documents) s left join (select doc_id, doc_id % 7 as m from documents where doc_id % 5 > 0) t on s.doc_id = t.doc_id where t.doc_id is null or s.m > t.m
""")
def convert_if_newer(t):
    source = t.documents.select("doc_id", (F.col("doc_id") % 10).alias("modified"))
    target = t.documents.where("doc_id % 5 > 0").select("doc_id", (F.col("doc_id") % 7).alias("modified"))
    return sinks.copy_plan(source, target, "doc_id", sinks.newer()).select("doc_id")


@query("""
select n_nationkey, coalesce(case when n_regionkey = 0 then 'manual' end, case when n_nationkey % 3 = 0 then 'auto' end, 'first') as choice, 'p' || n_nationkey as slug,
       case when n_name = 'narrator' then 132.0::double else coalesce(case when n_regionkey < 3 then 100.0 + n_regionkey end, 200.0)::double end as target from nation
""")
def choices(t):
    i, r = F.col("n_nationkey"), F.col("n_regionkey")
    choice = M.chosen(F.when(r == 0, "manual"), F.when(i % 3 == 0, "auto"), F.lit("first"))
    target = M.stage_target(F.col("n_name"), F.when(r < 3, 100.0 + r), 132.0, 200.0)
    return t.nation.select("n_nationkey", choice.alias("choice"), F.concat(F.lit("p"), i.cast("string")).alias("slug"), target.alias("target"))


@query("""
select conv_id, turn, list_filter([trim(replace(text, chr(34), ' ')), '', role], lambda x: x <> '')[1:2] as found from (select conv_id, turn, role, regexp_replace(regexp_replace(coalesce(text, ''), '[^a-zA-Z ]', '', 'g'), ' +', ' ', 'g') as text from conversations)
""")
def free_text_lists(t):
    """Lists of a turn's own words and its role, told in free text, and read back."""
    plain = F.regexp_replace(F.regexp_replace(F.coalesce("text", F.lit("")), "[^a-zA-Z ]", ""), " +", " ")
    said = F.concat(F.lit("Sure, here they are: "), F.to_json(F.array(plain, F.lit(" "), "role")), F.lit("\nDone"))
    return t.conversations.select("conv_id", "turn", X.json_list(said, 2).alias("found"))


_LOT = "with o as (select l_partkey as p_partkey, 'clip' || min(l_orderkey) as clip from lineitem where l_quantity >= 49 group by 1)"


def _lot(t):
    made = t.lineitem.where("l_quantity >= 49").groupBy(F.col("l_partkey").alias("p_partkey"))
    return made.agg(F.concat(F.lit("clip"), F.min("l_orderkey").cast("string")).alias("clip"))


@query(_LOT + " select p_partkey, p_name, clip, 'reused' as origin from part join o using (p_partkey)")
def reuse_lot(t):
    """The clips of another lot for the parts that it covers: it has to have one for each of them, or all would be refused."""
    covered = t.part.select("p_partkey", "p_name").join(t.lineitem.where("l_quantity >= 49").select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "left_semi")
    return R.reuse_or_generate(covered, _lot(t), ["p_partkey"], True)


@query(_LOT + " select p_partkey, p_name, clip, case when clip is null then 'missing' else 'reused' end as origin from part left join o using (p_partkey)")
def reuse_plan(t):
    """What another lot has for all parts, and what is missing in it."""
    return R.reuse_plan(t.part.select("p_partkey", "p_name"), _lot(t), ["p_partkey"])


@query("""
with w as (select event_id, row_number() over (order by ts, event_id) as done, count(*) over () as total from events)
select event_id, done * 2.0 / greatest(done, 1) * (total - done) as left_s from w
""")
def progress(t):
    """Seconds left after each event of a run's log; the order over all rows is that of the log."""
    e = rows.position_in(t.events.select("event_id", "ts", F.lit(1).alias("run"), F.to_date("ts").alias("day"), F.struct("ts", "event_id").alias("o")), ["run"], "day", "o", "pos", "total")
    done = e.withColumn("done", F.col("pos") + 1).withColumn("elapsed", F.col("done") * 2.0)
    return rows.progress(done, "done", "total", "elapsed").select("event_id", "left_s")


# what outlives a run


@query("""
select l_suppkey, l_linenumber, round(sum(l_quantity * (1 - l_discount)), 4) as total, case when l_suppkey % 2 = 0 then 1 else 2 end as run, 2 as runs
from lineitem group by l_suppkey, l_linenumber
""")
def sweep_points(t):
    """A sweep in three runs over a store: one of the even suppliers, one of all, which computes the odd ones, and one that computes nothing."""
    lines = t.lineitem.select("l_suppkey", "l_linenumber", (F.col("l_quantity") * (1 - F.col("l_discount"))).alias("x"))
    points = lines.select("l_suppkey", "l_linenumber").distinct()
    keys = ["l_suppkey", "l_linenumber"]
    kept = store.Store(t.spark, scratch_dir(t.spark, "sweep"), "l_suppkey long, l_linenumber int, total double")
    compute = lambda absent: lines.join(absent, keys).groupBy(*keys).agg(F.round(F.sum("x"), 4).alias("total"))
    store.computed(points.where("l_suppkey % 2 = 0"), keys, kept, compute)
    store.computed(points, keys, kept, compute)
    found = store.computed(points, keys, kept, compute)
    return found.select(*[F.col(k) for k in keys], "total", F.col("version").alias("run"), F.lit(len(kept.versions())).alias("runs"))


@query("""
with e as (select user_id, value, row_number() over (partition by user_id order by ts, event_id) as n from events),
f as (select user_id, min(n) filter (where value >= 90 and n <= 4) as hit from e group by 1)
select user_id, cast(coalesce(hit, 4) as integer) as attempts, hit is not null as accepted from f
""")
def bounded_retries(t):
    """A user's events in order are attempts, of which four are allowed: until one reaches 90."""
    e = rows.rank_in(t.events.select("user_id", "event_id", "ts", "value"), ["user_id"], ["ts", "event_id"], "attempt")
    e = e.select("user_id", F.col("attempt").cast("int").alias("attempt"), (F.col("value") >= 90).alias("accepted"))
    log = store.Store(t.spark, scratch_dir(t.spark, "retries"), "user_id long, attempt int, accepted boolean")
    return store.retried(e, ["user_id"], log, lambda todo: todo.join(e, ["user_id", "attempt"]), limit=4)


@query("""
select n_nationkey, case when n_nationkey % 3 = 0 then upper(n_name) || '!' else n_name end as name, n_name as former, 2 as versions from nation
""")
def versioned_upsert(t):
    """A table of which every third row is replaced: the new version and, still there, the former one."""
    kept = store.Store(t.spark, scratch_dir(t.spark, "versions"), "n_nationkey int, name string")
    own = t.nation.select("n_nationkey", F.col("n_name").alias("name"))
    store.upsert(kept, own, ["n_nationkey"])
    store.upsert(kept, own.where("n_nationkey % 3 = 0").withColumn("name", F.concat(F.upper("name"), F.lit("!"))), ["n_nationkey"])
    former = kept.read(1).withColumnRenamed("name", "former")
    return kept.read().join(former, "n_nationkey").select("n_nationkey", "name", "former", F.lit(len(kept.versions())).alias("versions"))
