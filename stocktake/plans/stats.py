"""Group statistics, outliers, verdicts, deltas."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rows
from ..operators import stats as S
from ..operators.quantiles import group_stats
from .registry import query


@query("""
with m as (select l_suppkey, median(l_extendedprice) as group_median from lineitem group by 1)
select l_orderkey, l_linenumber, l.l_suppkey, l_extendedprice, group_median from lineitem l join m on l.l_suppkey = m.l_suppkey where l_extendedprice < 0.5 * group_median
""")
def median_outliers(t):
    return S.median_outliers(t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice"), ["l_suppkey"], "l_extendedprice")


@query("""
select l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice, 0.9) - quantile_cont(l_extendedprice, 0.1), 6) as interdecile, round(max(l_extendedprice) - min(l_extendedprice), 6) as range_
from lineitem group by all
""")
def ranges(t):
    x = F.col("l_extendedprice")
    both = S.interdecile_range(t.lineitem, ["l_returnflag", "l_linestatus"], x, "interdecile", [F.round(S.value_range(x), 6).alias("range_")])
    return both.withColumn("interdecile", F.round("interdecile", 6))


@query("select event_type, median(value) as median_value, round(1.96 * 1.253 * stddev_pop(value) / sqrt(count(value)), 6) as ci95, count(*) as n from events group by 1")
def median_ci95(t):
    x = F.col("value")
    return group_stats(t.events, ["event_type"], {"median_value": (x, 0.5)}, [F.round(S.median_ci95(x), 6).alias("ci95"), F.count(F.lit(1)).alias("n")])


@query("""
select l_returnflag, median(l_quantity) filter (where l_linestatus = 'O') as median_a, median(l_quantity) filter (where l_linestatus = 'F') as median_b,
       abs(median(l_quantity) filter (where l_linestatus = 'O') - median(l_quantity) filter (where l_linestatus = 'F')) as gap from lineitem group by 1
""")
def subgroup_gap(t):
    return S.subgroup_gap(t.lineitem, ["l_returnflag"], "l_linestatus", ("O", "F"), "l_quantity")


@query("""
select l_returnflag, max(l_quantity) filter (where l_linestatus = 'O') - min(l_quantity) filter (where l_linestatus = 'O') as "O",
       max(l_quantity) filter (where l_linestatus = 'F') - min(l_quantity) filter (where l_linestatus = 'F') as "F" from lineitem group by 1
""")
def range_matrix(t):
    return S.matrix(t.lineitem, "l_returnflag", "l_linestatus", ["O", "F"], S.value_range(F.col("l_quantity")))


@query("select l_returnflag, round(sum(l_discount) / greatest(sum(l_tax), 1e-9), 6) as rtf, round(sum(l_quantity) / 1e6, 6) as mb from lineitem group by 1")
def ratio_of_sums(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.round(S.ratio_of_sums(F.col("l_discount"), F.col("l_tax")), 6).alias("rtf"), F.round(F.sum("l_quantity") / 1e6, 6).alias("mb"))


@query("""
with c as (select doc_id, source, text, length(text) / (10 + doc_id % 9)::double as seconds, (doc_id % 100) / 100.0::double as tail from documents),
p as (select source, median(case when length(text) >= 30 then seconds / length(text) end) as pace from c group by 1),
j as (select c.*, seconds / greatest(pace * length(text), 1e-9) as ratio from c join p on c.source = p.source)
select doc_id, round(ratio, 6) as ratio, case when seconds < 0.25 or ratio < 0.6 then 'trop court' else 'fin coupée' end as motif from j where seconds < 0.25 or ratio < 0.6 or tail > 0.8
""")
def duration_ratio_suspects(t):
    seconds = F.length("text") / (10 + F.col("doc_id") % 9).cast("double")
    clips = t.documents.select("doc_id", "source", "text", seconds.alias("seconds"), (F.col("doc_id") % 100 / 100.0).alias("tail"))
    return S.suspects(clips, "source", "text", "seconds", "tail").select("doc_id", F.round("ratio", 6).alias("ratio"), "motif")


@query("""
select l_suppkey, case when g <= 40 and r <= 48 then 'à écouter' when g <= 40 then 'change d''âge selon le texte' when r <= 48 then 'dispersé d''une réplique à l''autre' else 'écarté' end as verdict,
       case when r <= 48 and m between 24 and 26 then 'RETENU' when r <= 48 then 'trop grave' when m between 24 and 26 then 'change d''âge' else 'écarté' end as cast_
from (select l_suppkey, quantile_cont(l_quantity, 0.9) - quantile_cont(l_quantity, 0.1) as g, max(l_quantity) - min(l_quantity) as r, median(l_quantity) as m from lineitem group by 1)
""")
def two_gate_verdict(t):
    q = F.col("l_quantity")
    both = S.interdecile_range(t.lineitem, ["l_suppkey"], q, "g", [S.value_range(q).alias("r")], {"m": (q, 0.5)})
    return both.select("l_suppkey", S.two_gates(F.col("g") <= 40, F.col("r") <= 48).alias("verdict"), S.two_gates(F.col("r") <= 48, S.in_range(F.col("m"), 24, 26), S.CAST_VERDICTS).alias("cast_"))


@query("""
select l_suppkey, round(score, 9) as score, cast(row_number() over (order by score, l_suppkey) as integer) as place from (
  select l_suppkey, (quantile_cont(l_quantity, 0.9) - quantile_cont(l_quantity, 0.1)) / 40.0::double + (max(l_quantity) - min(l_quantity)) / 48.0::double as score from lineitem group by 1)
qualify place <= 60
""")
def ratio_order(t):
    """A report's order: by the sum of two ratios, the first 60."""
    q = F.col("l_quantity")
    both = S.interdecile_range(t.lineitem, ["l_suppkey"], q, "g", [S.value_range(q).alias("r")])
    scored = both.withColumn("score", S.sum_of_ratios([("g", 40.0), ("r", 48.0)]))
    return rows.top_numbered(scored, ["score", "l_suppkey"], 60).select("l_suppkey", F.round("score", 9).alias("score"), "place")


@query("""
select l_suppkey, sum(l_quantity) as total_seconds, coalesce(median(case when l_discount > 0 then l_discount end), 0) as median_pitch, round(avg(l_tax), 9) as mean_spread,
       median(l_extendedprice) as median_voiced, count(*) as clips from lineitem group by 1
""")
def group_report(t):
    return S.group_report(t.lineitem, ["l_suppkey"], "l_quantity", "l_discount", "l_tax", "l_extendedprice").withColumn("mean_spread", F.round("mean_spread", 9))


@query("select user_id, median(value / 700) as median_share, median(value / 700) <= 0.05 as credible from events group by 1")
def credible_share(t):
    """Which users' measurements can be believed, at the share that is refused."""
    return S.credibility(t.events.select("user_id", (F.col("value") / 700).alias("share")), ["user_id"], "share")


@query("""
select doc_id, case when d > 3 * greatest(0.6, length(text) / 14.0) + 5 then 'duration' when db < -38 then 'level' when active < 0.10 then 'breath' else '' end as reason
from (select doc_id, text, (doc_id % 400)::double as d, -(doc_id % 50)::double as db, (doc_id % 30) / 100.0 as active from documents)
""")
def degeneracy(t):
    from ..functions.text import expected_seconds

    i = F.col("doc_id")
    return t.documents.select("doc_id", S.degenerate((i % 400).cast("double"), expected_seconds(F.col("text")), -(i % 50).cast("double"), i % 30 / 100.0).alias("reason"))


@query("""
with a as (select l_returnflag, round(avg(l_quantity), 6) as m, round(avg(l_discount), 6) as d from lineitem group by 1), b as (select m, d from a where l_returnflag = 'N')
select l_returnflag, a.m, a.d, round(a.m - b.m, 6) as d_m, round(a.d - b.d, 6) as d_d from a cross join b
""")
def baseline_delta(t):
    a = t.lineitem.groupBy("l_returnflag").agg(F.round(F.avg("l_quantity"), 6).alias("m"), F.round(F.avg("l_discount"), 6).alias("d"))
    return S.delta_to_baseline(a, F.col("l_returnflag") == "N", ["m", "d"]).withColumn("d_m", F.round("d_m", 6)).withColumn("d_d", F.round("d_d", 6))


@query("""
select a.l_suppkey, a.m as treated, b.m as control, a.m - b.m as effect
from (select l_suppkey, median(l_quantity) as m from lineitem where l_returnflag = 'R' group by 1) a join (select l_suppkey, median(l_quantity) as m from lineitem where l_returnflag = 'A' group by 1) b on a.l_suppkey = b.l_suppkey
""")
def control_difference(t):
    med = lambda f: group_stats(t.lineitem.where(F.col("l_returnflag") == f), ["l_suppkey"], {"m": (F.col("l_quantity"), 0.5)})
    return S.control_difference(med("R"), med("A"), ["l_suppkey"], "m")


@query("""
with e as (select user_id, event_id, value, row_number() over (partition by user_id order by ts, event_id) as attempt from events),
s as (select user_id, min(attempt) filter (where value >= 90) as stop from e group by 1)
select e.user_id, cast(attempt as integer) as attempt, value from e join s on e.user_id = s.user_id where stop is null or attempt <= stop
qualify row_number() over (partition by e.user_id order by value desc, attempt) = 1
""")
def best_of_n_early_stop(t):
    e = rows.rank_in(t.events.select("user_id", "event_id", "ts", "value"), ["user_id"], ["ts", "event_id"], "attempt").select("user_id", "attempt", "value")
    return rows.best_with_early_stop(e, ["user_id"], "attempt", "value", 90)


@query("""
with e as (select user_id, event_id, value, row_number() over (partition by user_id order by ts, event_id) as attempt from events)
select user_id, cast(attempt as integer) as attempt, value from e
qualify row_number() over (partition by user_id order by value < 20 desc, case when value < 20 then attempt else -attempt end) = 1
""")
def retry_until_accepted(t):
    e = rows.rank_in(t.events.select("user_id", "event_id", "ts", "value"), ["user_id"], ["ts", "event_id"], "attempt").select("user_id", "attempt", "value")
    return rows.first_accepted(e, ["user_id"], "attempt", F.col("value") < 20)
