"""Vectors and waveforms: embeddings as vectors and as signals of 64 samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import registered
from ..functions import signal as G
from ..functions import vectors as V
from ..operators import match as M
from ..operators import stats as S
from ..operators import waves
from .registry import query

RATE = 4000


@query("""
select a.label, round(avg(c), 6) as mean_cos, round(min(c), 6) as min_cos, count(*) as pairs from (
  select a.label, list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v)) + 1e-10) as c
  from (select vec_id, label, embedding::double[] as v from embeddings) a join (select vec_id, label, embedding::double[] as v from embeddings) b on a.label = b.label and a.vec_id < b.vec_id) a
group by 1
""")
def cohesion_pairs(t):
    c = M.cohesion(t.embeddings, ["label"], "vec_id", "embedding")
    return c.select("label", F.round("mean_cos", 6).alias("mean_cos"), F.round("min_cos", 6).alias("min_cos"), "pairs")


@query("""
select a.label, round(avg(c), 6) as mean_cos, count(*) as pairs from (
  select a.label, list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) as c
  from (select vec_id, label, embedding::double[] as v from embeddings) a join (select vec_id, label, embedding::double[] as v from embeddings) b on a.label = b.label and a.vec_id < b.vec_id) a
group by 1
""")
def mean_cohesion(t):
    c = M.mean_cohesion(t.embeddings, ["label"], "embedding")
    return c.select("label", F.round("mean_cos", 6).alias("mean_cos"), "pairs")


@query("""
with e as (select vec_id, label, vec_id % 50 as u, embedding::double[] as v from embeddings),
p as (select a.label as candidate, b.label as reference, avg(list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v)) + 1e-10)) as x
      from e a join e b on a.u = b.u where a.label < 5 and b.label >= 5 group by all)
select candidate, round(max(x), 6) as worst_proximity from p group by 1
""")
def worst_proximity(t):
    e = t.embeddings.select("label", (F.col("vec_id") % 50).alias("u"), "embedding")
    c, r = e.where("label < 5").withColumnRenamed("label", "candidate"), e.where("label >= 5").withColumnRenamed("label", "reference")
    w = M.worst_proximity(M.proximity(c, r, "u", "candidate", "reference", "embedding"), "candidate", "reference")
    return w.select("candidate", F.round("worst_proximity", 6).alias("worst_proximity"))


@query("""
with e as (select label, unnest(range(64)) as pos, unnest(embedding::double[]) as x, vec_id from embeddings),
f as (select label, pos, x from e where vec_id in (select min(vec_id) from embeddings group by label))
select cast(pos as integer) as pos, round(sum(x * case label when 0 then 0.5 when 1 then 0.3 else 0.2 end), 6) as value from f where label < 3 group by 1
""")
def weighted_mix(t):
    from ..operators.rows import first_of

    first = first_of(t.embeddings.where("label < 3").select("label", "vec_id", "embedding"), ["label"], "vec_id")
    weight = F.when(F.col("label") == 0, 5.0).when(F.col("label") == 1, 3.0).otherwise(2.0)
    parts = first.agg(F.collect_list(F.struct(weight.alias("weight"), F.col("embedding").alias("v"))).alias("parts"))
    return parts.select(F.posexplode(V.weighted_mix(F.col("parts"))).alias("pos", "value")).select("pos", F.round("value", 6).alias("value"))


@query("""
with e as (select label, vec_id // 8 as batch, 1.0::double + vec_id % 8 as weight, unnest(range(64)) as pos, unnest(embedding::double[]) as x from embeddings),
m as (select label, batch, pos, sum(x * weight) / sum(weight) as v from e group by all)
select label, batch, round(20 * log10(sqrt(avg(v * v)) + 1e-10), 6) as rms_db, round(max(v) filter (where pos = 63), 6) as last from m group by 1, 2
""")
def mixes_in_sql(t):
    """Each label's vectors, mixed eight numbers at a time, asked in SQL with the registered functions."""
    registered.register(t.spark)
    return t.spark.sql(
        """
        with parts as (select label, vec_id div 8 as batch, collect_list(named_struct('weight', 1.0D + vec_id % 8, 'v', cast(embedding as array<double>))) as parts from {vectors} group by 1, 2),
        mixes as (select label, batch, weighted_mix(parts) as v from parts)
        select label, batch, round(rms_db(v), 6) as rms_db, round(v[63], 6) as last from mixes
        """,
        vectors=t.embeddings,
    )


@query("""
with s as (select vec_id, embedding::double[] as v from embeddings)
select vec_id, round(20 * log10(sqrt(list_dot_product(v, v) / 64) + 1e-10), 6) as rms_db,
       len(list_filter(list_transform(range(4), lambda i: sqrt(list_dot_product(v[i*16+1:i*16+16], v[i*16+1:i*16+16]) / 16)), lambda r: r > 0.1)) / 4.0::double as active from s
""")
def signal_level(t):
    return t.embeddings.select("vec_id", F.round(V.rms_db(F.col("embedding")), 6).alias("rms_db"), V.active_share(F.col("embedding"), 16, 0.1).alias("active"))


_DFT = f"""
with s as (select vec_id, label, unnest(range(64)) as i, unnest(embedding::double[]) as x from embeddings),
w as (select vec_id, label, i, x * (0.5 - 0.5 * cos(2 * pi() * i / 63)) as x from s),
k as (select unnest(range(33)) as k),
p as (select vec_id, label, k, k * {RATE} / 64.0::double as f, power(sum(x * cos(2 * pi() * i * k / 64)), 2) + power(sum(x * sin(2 * pi() * i * k / 64)), 2) as p from w cross join k group by all)
"""


@query(_DFT + "select vec_id, cast(k as integer) as bin, round(p, 5) as power from p")
def power_spectrum(t):
    return t.embeddings.select("vec_id", F.posexplode(G.power(F.col("embedding"))).alias("bin", "power")).select("vec_id", "bin", F.round("power", 5).alias("power"))


def _share(low: str, high: str, op: str = ">=") -> str:
    return f"sum(p) filter (where f {op} {low} and f < {high}) / sum(p) filter (where f > 60 and f < 2000)"


def _centre(high: int) -> str:
    return f"sum(p * f) filter (where f > 60 and f < {high}) / sum(p) filter (where f > 60 and f < {high})"


@query(_DFT + f"""
select vec_id, round({_share('60', '150', '>')}, 5) as low_share, round({_share('240.0', '560.0')}, 5) as band, round({_centre(800)}, 3) as narrow, round({_centre(2000)}, 3) as voice, round({_centre(4000)}, 3) as wide
from p group by 1
""")
def spectral_features(t):
    s = t.embeddings.select("vec_id", G.spectrum_features(F.col("embedding"), RATE, (400.0,)).alias("s"))
    return s.select("vec_id", F.round("s.low_share", 5).alias("low_share"), F.round(F.col("s.shares")[0], 5).alias("band"), *[F.round(f"s.centroid_{c}", 3).alias(c) for c in ("narrow", "voice", "wide")])


@query(_DFT + f"""
, c as (select c, row_number() over () as pos from (select unnest([{', '.join(map(str, G.SWEEP))}]) as c)),
each as (select label, vec_id, c, pos, sum(p) filter (where f >= 0.6 * c and f < 1.4 * c) / sum(p) filter (where f > 60 and f < 2000) as share from p cross join c group by all),
med as (select label, c, pos, median(coalesce(share, 0)) / (0.8 * c / 1940) as density from each group by label, c, pos)
select label, c::double as centre, round(density, 6) as density from med qualify row_number() over (partition by label order by density desc, pos) = 1
""")
def target_sweep(t):
    s = t.embeddings.select("label", G.spectrum_features(F.col("embedding"), RATE, tuple(map(float, G.SWEEP))).alias("s"))
    return S.sweep_best(s.select("label", "s.shares"), ["label"], list(G.SWEEP), "shares").select("label", "centre", F.round("density", 6).alias("density"))


SLOW = 800  # samples a second: a vector of 64 is then 80 ms, four frames of pitch and six of the cepstrum


def _described(key: str, samples: str) -> str:
    """SQL of the descriptors of the waves in samples: key, i, x."""
    return f"""
with s as ({samples}),
len as (select {key}, count(*) as n from s group by 1),
f as (select {key}, st, j, x * (0.5 - 0.5 * cos(2 * pi() * j / 32)) as w from (select {key}, unnest(range(0, n - 32, 8)) as st from len) cross join (select unnest(range(32)) as j) join s using ({key}) where i = st + j),
loud as (select {key}, st, avg(w) as m from f group by all having sqrt(avg(w * w)) >= 1e-3),
c as (select {key}, st, j, w - m as c from f join loud using ({key}, st)),
whole as (select {key}, st, sum(c * c) as e from c group by all having sum(c * c) > 0),
auto as (select a.{key}, a.st, b.j - a.j as lag, sum(a.c * b.c) as r from c a join c b on a.{key} = b.{key} and a.st = b.st and b.j - a.j between 2 and 12 group by all),
peak as (select * from auto qualify row_number() over (partition by {key}, st order by r desc, lag) = 1),
f0 as (select {key}, {SLOW}.0::double / lag as f0 from peak join whole using ({key}, st) where r / e >= 0.3),
mid as (select {key}, median(f0) as m from f0 group by 1),
pitch as (select {key}, m, stddev_pop(12 * log2(f0 / m)) as spread, count(*) / (n // 8)::double as voiced from f0 join mid using ({key}) join len using ({key}) group by {key}, m, n),
g as (select {key}, st, j, x * (0.5 - 0.5 * cos(2 * pi() * j / 20)) as w from (select {key}, unnest(range(0, n - 20, 8)) as st from len) cross join (select unnest(range(20)) as j) join s using ({key}) where i = st + j),
heard as (select {key}, st from g group by all having sqrt(avg(w * w)) >= 1e-3),
p as (select {key}, st, k, power(sum(w * cos(2 * pi() * j * k / 20)), 2) + power(sum(w * sin(2 * pi() * j * k / 20)), 2) as p from g join heard using ({key}, st) cross join (select unnest(range(11)) as k) group by all),
ends as (select 2595 * log10(1 + 50 / 700.0::double) as a, 2595 * log10(1 + 400 / 700.0::double) as b),
edge as (select n, floor(21 * 700 * (power(10, (a + (b - a) * n / 41) / 2595) - 1) / {SLOW}) as e from ends cross join (select unnest(range(42)) as n)),
bank as (select x.n as band, k, case when k < y.e then (k - x.e) / (y.e - x.e) else (z.e - k) / (z.e - y.e) end as wt
  from edge x join edge y on y.n = x.n + 1 join edge z on z.n = x.n + 2 join (select unnest(range(11)) as k) on k >= x.e and k < z.e where x.e < y.e and y.e < z.e),
energy as (select h.{key}, h.st, b.band, ln(coalesce(sum(p * wt), 0) + 1e-10) as v
  from heard h cross join (select unnest(range(40)) as band) b left join bank on bank.band = b.band left join p on p.{key} = h.{key} and p.st = h.st and p.k = bank.k group by all),
cep as (select {key}, n, avg(v) as c from (select {key}, st, n, sum(v * cos(pi() * n * (band + 0.5) / 40)) * sqrt(2 / 40.0::double) / case when n = 0 then sqrt(2) else 1 end as v
  from energy cross join (select unnest([0, 1, 12]) as n) group by {key}, st, n) group by all),
level as (select {key}, 20 * log10(sqrt(avg(x * x)) + 1e-10) as db from s group by 1)
select l.{key}, round(coalesce(m, 0), 4) as f0_median, round(coalesce(spread, 0), 4) as f0_spread, round(db, 4) as rms_db, round(coalesce(voiced, 0), 4) as voiced,
       round(coalesce(max(c) filter (where n = 0), 0), 4) + 0.0::double as mfcc0, round(coalesce(max(c) filter (where n = 1), 0), 4) + 0.0::double as mfcc1, round(coalesce(max(c) filter (where n = 12), 0), 4) + 0.0::double as mfcc12
from level l left join pitch using ({key}) left join cep using ({key}) group by l.{key}, m, spread, db, voiced
"""


@query(_described("vec_id", "select vec_id, unnest(range(64)) as i, unnest(embedding::double[]) as x from embeddings"))
def voice_descriptors(t):
    """Pitch, level, voiced share and cepstrum of every vector, read as a wave."""
    d = t.embeddings.select("vec_id", G.descriptors(F.col("embedding"), SLOW).alias("d"))
    mfcc = lambda i: F.round(F.col("d.mfcc")[i], 4).alias(f"mfcc{i}")
    return d.select("vec_id", F.round("d.f0_median", 4).alias("f0_median"), F.round("d.f0_spread_st", 4).alias("f0_spread"), F.round("d.rms_db", 4).alias("rms_db"), F.round("d.voiced", 4).alias("voiced"), mfcc(0), mfcc(1), mfcc(12))


#: The vectors of a label in the order of their numbers, laid end to end.
_END_TO_END = "select label, (row_number() over (partition by label order by vec_id, i)) - 1 as i, x from (select label, vec_id, unnest(range(len(embedding))) as i, unnest(embedding::double[]) as x from embeddings)"


def _end_to_end(t):
    each = t.embeddings.select("label", F.floor(F.col("vec_id") / 1000).alias("thousand"), "vec_id", F.col("embedding").cast("array<double>").alias("samples"))
    return waves.placed(each, ["label"], "thousand", "vec_id")


@query(_described("label", _END_TO_END))
def long_voice_descriptors(t):
    """Pitch, level, voiced share and cepstrum of one long wave a label, in runs of 64 frames."""
    d = waves.descriptors(_end_to_end(t), ["label"], SLOW, frames=64)
    mfcc = lambda i: F.round(F.col("mfcc")[i], 4).alias(f"mfcc{i}")
    return d.select("label", F.round("f0_median", 4).alias("f0_median"), F.round("f0_spread_st", 4).alias("f0_spread"), F.round("rms_db", 4).alias("rms_db"), F.round("voiced", 4).alias("voiced"), mfcc(0), mfcc(1), mfcc(12))


@query(f"""
with s as ({_END_TO_END}),
len as (select label, count(*) as n from s group by 1),
w as (select label, i, n, x * (0.5 + 0.5 * cos(pi() * (1 - n + 2 * i) / (n - 1))) as x from s join len using (label)),
p as (select label, n, k, k * (1.0::double / (n * (1.0::double / {RATE}))) as f, power(sum(x * cos(2 * pi() * ((i * k) % n) / n)), 2) + power(sum(x * sin(2 * pi() * ((i * k) % n) / n)), 2) as p
  from w join (select label, unnest(range(n // 2 + 1)) as k from len) using (label) group by all)
select label, round({_share('60', '150', '>')}, 6) as low_share, round({_share('240.0', '560.0')}, 6) as band, round({_centre(800)}, 4) as narrow, round({_centre(2000)}, 4) as voice, round({_centre(4000)}, 4) as wide
from p group by 1
""")
def long_spectral_features(t):
    """Bands and centroids of the whole spectrum of one long wave a label, transformed in strips of 4096 numbers."""
    s = waves.spectrum_features(_end_to_end(t), ["label"], RATE, (400.0,), cells=4096)
    return s.select("label", F.round("low_share", 6).alias("low_share"), F.round(F.col("shares")[0], 6).alias("band"), *[F.round(f"centroid_{c}", 4).alias(c) for c in ("narrow", "voice", "wide")])


@query("""
select label, 100.0::double + 10.0 * label as hertz, 4000 as samples, 4757 as slow_samples, true as own_pitch, true as lowered_pitch from (select distinct label from embeddings)
""")
def lowered_tones(t):
    """Two harmonics of 100 Hz and up by label, half a second at 8 kHz, three semitones down at their own length and slowed down.

    Pitches are held to 3 %: tapered frames pull low ones up by some two.
    """
    hertz = 100.0 + 10.0 * F.col("label")
    at = lambda i, k: F.sin(2 * 3.141592653589793 * k * hertz * i / 8000.0)
    wave = F.transform(F.sequence(F.lit(0), F.lit(3999)), lambda i: 0.5 * at(i, 1) + 0.2 * at(i, 2))
    d = t.embeddings.select("label").distinct().select("label", hertz.alias("hertz"), wave.alias("wave"))
    d = d.select("label", "hertz", "wave", G.lowered(F.col("wave"), 3.0, 8000).alias("w"), G.lowered(F.col("wave"), 3.0, 8000, keep_length=False).alias("slow"))
    pitch = lambda c: G.descriptors(F.col(c), 8000)["f0_median"]
    near = lambda c, want: F.abs(pitch(c) / want - 1) < 0.03
    down = F.col("hertz") / V.semitone_ratio(F.lit(3.0))
    return d.select("label", "hertz", F.size("w").alias("samples"), F.size("slow").alias("slow_samples"), near("wave", F.col("hertz")).alias("own_pitch"), (near("w", down) & near("slow", down)).alias("lowered_pitch"))
