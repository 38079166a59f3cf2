"""Exact medians and quantiles of groups of any size: no group's values ever meet in one task.

Groups of at most `limit` rows take Spark's own aggregate, which holds a group's distinct values in one task. In the
others, ranks are selected: a group's values between two bounds are counted in CELLS cells, sums of which say in which
cell a wanted rank lies; that cell's least and greatest value are the next bounds. Counting combines before the shuffle,
and a group is never more than CELLS rows behind it. A round that leaves few values between the bounds ends by sorting those.
Cells rise with the values, whatever the rounding, and the least and the greatest value have cells of their own, so
ranks are exact and every round takes at least these two away. Cells are equally wide; where that left too many values
together, the next round's are by octaves. So a handful of rounds are enough for any doubles, two for a billion evenly spread ones.

Groups over the limit number at most GROUPS, so that they can be broadcast: the limit rises with the table if need be.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import written

LIMIT = 100_000
GROUPS = 200_000
CELLS = 4096
GATHERED = 4096


def _same(keys: list[str]) -> Column:
    """Rows of two tables, l and r, have the same keys; null is a key like any other."""
    return reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys], F.lit(True))


def _octaves(x: Column) -> Column:
    """A double's place on a scale of octaves on both sides of zero. It never falls where x rises: so much is promised of logarithms."""
    size = F.least(F.coalesce(F.log2(F.abs(x)), F.lit(-1075.0)), F.lit(1025.0)) + 1076
    return F.when(x < 0, -size).when(x > 0, size).otherwise(0.0)


def _cell(x: Column, low: Column, high: Column, by_octave: Column, cells: int) -> Column:
    """Which cell of [low, high] a double is in. Infinities and NaN, the greatest of all, are bounds at first, and have cells of their own."""
    even = F.try_divide(x / 2 - low / 2, high / 2 - low / 2)
    part = F.when(by_octave, F.try_divide(_octaves(x) - _octaves(low), _octaves(high) - _octaves(low))).otherwise(even)
    inside = F.when(part.isNull() | F.isnan(part), F.lit(1)).otherwise(F.least(F.greatest(F.floor(part * cells), F.lit(1)), F.lit(cells - 2)))
    return F.when(x == low, 0).when(x == high, cells - 1).otherwise(inside).cast("int")


def ranked_values(df: DataFrame, keys: list[str], value: str, ranks: DataFrame, cells: int = CELLS, gathered: int = GATHERED) -> DataFrame:
    """keys, _rank, value: the values at 0-based ranks in the order of their groups' values.

    df: keys and a double, without nulls; it is read once a round. ranks: keys, _rank; few enough to be broadcast, and each
    below its group's number of rows.
    """
    on = [*keys, "_low", "_high", "_below"]
    own = lambda side, names: [F.col(f"{side}.{n}") for n in names]
    ends = df.groupBy(*keys).agg(F.min(value).alias("_low"), F.max(value).alias("_high"), F.count(F.lit(1)).alias("_n"))
    start = ranks.alias("l").join(ends.alias("r"), _same(keys))
    state = written(start.select(*own("l", [*keys, "_rank"]), "_low", "_high", "_n", F.lit(0).cast("long").alias("_below"), F.lit(False).alias("_wide")), "ranks")
    found = state.where("_low = _high").select(*keys, "_rank", F.col("_low").alias(value))
    while True:
        state = state.where("_low <> _high")
        if not state.limit(1).count():
            return found
        spans = state.select(*on, "_n", "_wide").distinct()
        between = (F.col(f"l.{value}") >= F.col("r._low")) & (F.col(f"l.{value}") <= F.col("r._high"))
        inside = df.alias("l").join(F.broadcast(spans.alias("r")), _same(keys) & between).select(*own("r", [*on, "_n", "_wide"]), F.col(f"l.{value}").alias(value))
        few = inside.where(F.col("_n") <= gathered).groupBy(*on).agg(F.sort_array(F.collect_list(value)).alias("_values"))
        sorted_out = state.where(F.col("_n") <= gathered).alias("l").join(few.alias("r"), _same(on))
        counted = inside.where(F.col("_n") > gathered).withColumn("_cell", _cell(F.col(value), F.col("_low"), F.col("_high"), F.col("_wide"), cells))
        counted = counted.groupBy(*on, "_cell").agg(F.count(F.lit(1)).alias("_m"), F.min(value).alias("_least"), F.max(value).alias("_most"))
        upto = W.partitionBy(*on).orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
        counted = counted.withColumn("_from", F.col("_below") + F.coalesce(F.sum("_m").over(upto), F.lit(0)))
        hit = (F.col("l._rank") >= F.col("r._from")) & (F.col("l._rank") < F.col("r._from") + F.col("r._m"))
        narrowed = counted.alias("r").join(F.broadcast(state.where(F.col("_n") > gathered).alias("l")), _same(on) & hit)
        ended = sorted_out.select(*own("l", [*keys, "_rank"]), F.expr("_values[int(l._rank - l._below)]").alias("_low"), F.expr("_values[int(l._rank - l._below)]").alias("_high"), F.lit(1).cast("long").alias("_n"), F.col("l._rank").alias("_below"), F.lit(False).alias("_wide"))
        closer = narrowed.select(*own("l", [*keys, "_rank"]), F.col("_least").alias("_low"), F.col("_most").alias("_high"), F.col("_m").alias("_n"), F.col("_from").alias("_below"), (~F.col("l._wide") & (F.col("_m") > F.col("_n") / 8)).alias("_wide"))
        state = written(ended.unionByName(closer), "ranks")
        found = found.unionByName(state.where("_low = _high").select(*keys, "_rank", F.col("_low").alias(value)))


def large_groups(df: DataFrame, keys: list[str], limit: int = LIMIT) -> DataFrame | None:
    """The keys of the groups of over limit rows, with n; None if there are none. At most GROUPS: one in GROUPS of all rows is a limit too."""
    sizes = written(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    hot = sizes.where(F.col("n") > max(limit, total // GROUPS))
    return hot if hot.limit(1).count() else None


def group_stats(df: DataFrame, keys: list[str], wanted: dict[str, tuple[Column, float]], aggregates: list[Column] = (), limit: int = LIMIT) -> DataFrame:
    """One row for each group: keys, the aggregates, and the quantiles wanted, by name: (value, fraction).

    A quantile interpolates between the two values around its place, nulls left out, as Spark's percentile() does; it is
    null in a group without values. NaN is greater than any other value. Without keys all rows are one group. The
    aggregates must be such as combine before a shuffle (sums, counts, extremes): those of a large group are.
    """
    plain = lambda x: x.groupBy(*keys).agg(*aggregates, *[F.percentile(v, p).alias(n) for n, (v, p) in wanted.items()])
    hot = large_groups(df, keys, limit)
    if hot is None:
        return plain(df)
    own = hot.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    is_hot = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], F.lit(True))
    warm = df.join(F.broadcast(own), is_hot, "left_semi")
    cold = df.join(F.broadcast(own), is_hot, "left_anti")
    names = list(wanted)
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("_w"), v.cast("double").alias("_v")) for i, (v, _) in enumerate(wanted.values())]))
    values = warm.select(*keys, cells.alias("_x")).select(*keys, "_x._w", "_x._v").where("_v is not null")
    at = [*keys, "_w"]
    places = written(values.groupBy(*at).agg(F.count(F.lit(1)).alias("_n")), "places").withColumn("_place", F.element_at(F.array(*[F.lit(float(p)) for _, p in wanted.values()]), F.col("_w") + 1) * (F.col("_n") - 1))
    ranks = places.select(*at, F.explode(F.array_distinct(F.array(F.floor("_place"), F.ceil("_place")))).alias("_rank"))
    ranked = ranked_values(values, at, "_v", ranks)
    around = places.alias("l").join(ranked.alias("r"), _same(at)).select(*[F.col(f"l.{k}") for k in at], "_place", "_rank", "_v")
    share = F.when(F.col("_rank") < F.col("_place"), F.ceil("_place") - F.col("_place")).otherwise(F.when(F.col("_rank") > F.col("_place"), F.col("_place") - F.floor("_place")).otherwise(1.0))
    each = around.groupBy(*at).agg(F.when(F.min("_v") == F.max("_v"), F.min("_v")).otherwise(F.sum(share * F.col("_v"))).alias("_q"))
    pivoted = each.groupBy(*keys).agg(*[F.max(F.when(F.col("_w") == i, F.col("_q"))).alias(n) for i, n in enumerate(names)])
    bare = warm.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *aggregates)
    both = bare.alias("l").join(pivoted.alias("r"), _same(keys), "left").select("l.*", *[F.col(f"r.{n}") for n in names]).drop("_rows")
    return plain(cold).unionByName(both) if keys else both
