"""Order-dependent row operators: first of equals, ranks, samples, top-ups, running choices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _by(order: str | Column | list) -> list:
    return list(order) if isinstance(order, (list, tuple)) else [order]


def first_of(df: DataFrame, keys: list[str], order: str | Column | list) -> DataFrame:
    """The first row of each key. Aggregates before the shuffle, so equal keys cost one row per task."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*_by(order))).alias("_r"))
    return best.select(*keys, "_r.*").select(*df.columns)


def best_of(df: DataFrame, keys: list[str], score: Column, order: str | list) -> DataFrame:
    """The row with the highest score of each key; of equal scores, the first."""
    return first_of(df.withColumn("_score", -score), keys, ["_score", *_by(order)]).drop("_score")


def dedupe_in_scope(df: DataFrame, scope: Column, keys: list[str], order: str | list) -> DataFrame:
    """First of each key among the rows in scope: the bound comes before the dedupe, or rows are lost."""
    return first_of(df.where(scope), keys, order)


def within(number: Column, most: int, undated: bool) -> Column:
    """number <= most; rows without a number are in (undated=True) or out."""
    return number.isNull() | (number <= most) if undated else number <= most


def rank_in(df: DataFrame, keys: list[str], order: str | list, name: str = "rank", start: int = 1) -> DataFrame:
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*_by(order))) - 1 + start)


def head_of(df: DataFrame, keys: list[str], order: str | list, n: int) -> DataFrame:
    """The first n rows of each key."""
    return rank_in(df, keys, order, "_rank").where(F.col("_rank") <= n).drop("_rank")


def priority_sample(df: DataFrame, later: Column, order: str | list, n: int) -> DataFrame:
    """n rows; those for which `later` holds only fill up."""
    return df.orderBy(later.cast("int"), *_by(order)).limit(n)


def seeded_sample(df: DataFrame, keys: list[str], id_col: str, n: int, seed: int = 11) -> DataFrame:
    """n rows of each key at random, the same ones each time. Not the draw of another language's generator."""
    drawn = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))
    return head_of(df, keys, [drawn, F.col(id_col)], n)


def with_group(df: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """df with the columns of its group's one row; null keys are a group too."""
    other = groups.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], *[c for c in groups.columns if c not in keys])
    on = [df[k].eqNullSafe(other[f"_g{i}"]) for i, k in enumerate(keys)]
    return df.join(other, on).drop(*[f"_g{i}" for i in range(len(keys))])


def position_in(df: DataFrame, keys: list[str], coarse: str, fine: str, position: str, size: str) -> DataFrame:
    """0-based position of each row in its key by (coarse, fine), and the key's size.

    Rows are numbered inside (key, coarse) only and counts do the rest, so no key's rows meet in one task.
    """
    counts = df.groupBy(*keys, coarse).agg(F.count(F.lit(1)).alias("_n"))
    w = W.partitionBy(*keys)
    before = F.coalesce(F.sum("_n").over(w.orderBy(coarse).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(*keys, coarse, before.alias("_start"), F.sum("_n").over(w).alias(size))
    inside = F.row_number().over(W.partitionBy(*keys, coarse).orderBy(fine))
    return with_group(df, starts, [*keys, coarse]).withColumn(position, F.col("_start") + inside - 1).drop("_start")


def stratified_longest(df: DataFrame, keys: list[str], number: str, text: str, order: str, k: int) -> DataFrame:
    """The longest text in each of k equal runs of the rows sorted by number; of equals the first.

    Rows without a number only count for keys where no row has one. Runs differ by one row at most, the longer first.
    """
    dated = df.groupBy(*keys).agg(F.max(F.col(number).isNotNull()).alias("_dated"))
    used = with_group(df, dated, keys).where(F.col(number).isNotNull() | ~F.col("_dated")).drop("_dated")
    placed = position_in(used.withColumn("_coarse", F.coalesce(number, F.lit(0))), keys, "_coarse", order, "_pos", "_of")
    longer = F.expr(f"(_of % {k}) * (_of div {k} + 1)")
    bucket = F.when(F.col("_pos") < longer, F.expr(f"_pos div (_of div {k} + 1)")).otherwise(F.col("_of") % k + F.expr(f"(_pos - (_of % {k}) * (_of div {k} + 1)) div greatest(_of div {k}, 1)")) + 1
    cut = placed.withColumn("bucket", bucket.cast("int"))
    return best_of(cut, [*keys, "bucket"], F.length(text), ["_coarse", order]).drop("_coarse", "_pos", "_of")


def round_robin(df: DataFrame, open_rows: Column, order: str | list, pool: list[str], taken: DataFrame | None, column: str, reserve: list[str] | None = None) -> DataFrame:
    """Gives rows for which `open_rows` holds the free values of the pool in turn, in order; others keep theirs.

    Values that rows hold already aren't free; if none is left, the whole reserve (or pool) is. The order is over all
    rows, as the assignment is; it is meant for dimension tables.
    """
    used = df.where(~open_rows).select(F.col(column).alias("_v"))
    used = used if taken is None else used.unionByName(taken.toDF("_v"))
    spare = df.sparkSession.createDataFrame([(i, v) for i, v in enumerate(pool)], "_i int, _v string").join(used.distinct(), "_v", "left_anti")
    free = spare.agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_v"))), lambda x: x["_v"]).alias("_free"))
    turn = F.row_number().over(W.partitionBy(F.lit(1)).orderBy(*_by(order))) - 1
    pick = F.when(F.size("_free") > 0, F.col("_free")).otherwise(F.array(*map(F.lit, reserve or pool)))
    given = df.where(open_rows).withColumn("_turn", turn).crossJoin(F.broadcast(free)).withColumn(column, F.element_at(pick, (F.col("_turn") % F.size(pick) + 1).cast("int")))
    return df.where(~open_rows).unionByName(given.select(*df.columns))


def top_up(primary: DataFrame, defaults: DataFrame, order: str, n: int) -> DataFrame:
    """The primary rows, then the defaults, up to n."""
    both = primary.withColumn("_src", F.lit(0)).unionByName(defaults.withColumn("_src", F.lit(1)))
    return both.orderBy("_src", order).limit(n).drop("_src")


def union_with_priority(explicit: DataFrame, rest: DataFrame, keys: list[str]) -> DataFrame:
    """All explicit rows, and of the rest those whose key isn't among them."""
    return explicit.unionByName(rest.join(explicit.select(*keys), keys, "left_anti"))


def fallback_source(primary: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """For each key the primary's rows if it has any, else the other's."""
    return union_with_priority(primary, other, keys)


def best_with_early_stop(df: DataFrame, keys: list[str], attempt: str, score: str, enough: float) -> DataFrame:
    """Best score of each key among the attempts up to the first that is enough; kept even if none is. Of equals the first.

    Attempts aren't computed lazily as in a loop, but the result is the loop's.
    """
    first_enough = F.min(F.when(F.col(score) >= enough, F.col(attempt))).over(W.partitionBy(*keys))
    tried = df.withColumn("_stop", first_enough).where(F.col("_stop").isNull() | (F.col(attempt) <= F.col("_stop"))).drop("_stop")
    return best_of(tried, keys, F.col(score), attempt)


def first_accepted(df: DataFrame, keys: list[str], attempt: str, accepted: Column) -> DataFrame:
    """The first accepted attempt of each key, else the last."""
    rest = [c for c in df.columns if c not in keys]
    order = F.struct((~accepted).cast("int"), F.when(accepted, F.col(attempt)).otherwise(-F.col(attempt)))
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*").select(*df.columns)


def last_so_far(df: DataFrame, keys: list[str], order: str, event: Column, name: str) -> DataFrame:
    """The last event up to each row."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(name, F.last(event, ignorenulls=True).over(w))


def limit_with_rest(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first n rows, each with `others`: how many more there are."""
    total = df.agg(F.greatest(F.count(F.lit(1)) - n, F.lit(0)).alias("others"))
    return df.orderBy(*order).limit(n).crossJoin(F.broadcast(total))


def top_numbered(df: DataFrame, order: list, n: int, name: str = "place") -> DataFrame:
    """The first n rows, numbered from 1: a report of bounded length. Only these n rows meet in one task."""
    return df.orderBy(*order).limit(n).withColumn(name, F.row_number().over(W.partitionBy(F.lit(1)).orderBy(*order)))


def progress(df: DataFrame, done: str, total: str, elapsed: str) -> DataFrame:
    """Adds seconds left at the pace so far."""
    return df.withColumn("left_s", F.col(elapsed) / F.greatest(F.col(done), F.lit(1)) * (F.col(total) - F.col(done)))
