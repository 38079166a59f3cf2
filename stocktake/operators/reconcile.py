"""Reconciliation of inventories: what is asked for, what was produced, what is there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .rows import rank_in


def missing(expected: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Rows expected but not present: a work list. Run again, it leaves out what was done meanwhile."""
    return expected.join(present.select(*keys), keys, "left_anti")


def orphans(present: DataFrame, demanded: DataFrame, keys: list[str]) -> DataFrame:
    """Rows present that nothing demands. `demanded` must be all demand, not that of one chapter."""
    return present.join(demanded.select(*keys), keys, "left_anti")


def still_demanded(present: DataFrame, demanded: DataFrame, keys: list[str]) -> DataFrame:
    return present.join(demanded.select(*keys), keys, "left_semi")


def both_ways(recorded: DataFrame, demanded: DataFrame, keys: list[str], in_scope: Column) -> DataFrame:
    """Keys with status stale (recorded, not demanded at all) or missing (demanded in scope, not recorded)."""
    r = recorded.select(*keys).distinct().withColumn("_r", F.lit(True))
    d = demanded.select(*keys, in_scope.alias("_s")).groupBy(*keys).agg(F.max("_s").alias("_s"))
    j = r.join(d, keys, "full")
    status = F.when(F.col("_s").isNull() & F.col("_r"), "stale").when(F.col("_r").isNull() & F.col("_s"), "missing")
    return j.select(*keys, status.alias("status")).where("status is not null")


def announced(listed: DataFrame, present: DataFrame, group: str, key: str) -> DataFrame:
    """Per group: announced, there, absent and extra (there, not announced); most announced first."""
    a, p = listed.select(group, key).distinct().withColumn("_a", F.lit(1)), present.select(group, key).distinct().withColumn("_p", F.lit(1))
    j = a.join(p, [group, key], "full")
    has, there = F.col("_a").isNotNull(), F.col("_p").isNotNull()
    return (
        j.groupBy(group)
        .agg(F.count_if(has).alias("announced"), F.count_if(has & there).alias("there"), F.count_if(has & ~there).alias("absent"), F.count_if(~has).alias("extra"))
        .orderBy(F.desc("announced"), group)
    )


def inventory_diff(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys added, removed or modified between two states bounded alike, with both values."""
    o, n = (d.select(*keys, F.struct(F.col(value).alias("v")).alias(s)) for d, s in ((old, "_o"), (new, "_n")))
    change = F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").when(~F.col("_o.v").eqNullSafe(F.col("_n.v")), "modified")
    j = o.join(n, keys, "full")
    return j.select(*keys, F.col("_o.v").alias("old"), F.col("_n.v").alias("new"), change.alias("change")).where("change is not null")


def by_rank(left: DataFrame, right: DataFrame, keys: list[str], order: str, rank: str = "rank") -> DataFrame:
    """Left rows, which know their rank, with the right row of that rank in the same key."""
    return left.join(rank_in(right, keys, order, rank), [*keys, rank], "left")


def counts_agree(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: both counts, and whether numbering can be trusted, as a block."""
    a, b = (d.groupBy(*keys).agg(F.count(F.lit(1)).alias(c)) for d, c in ((left, "n_left"), (right, "n_right")))
    return a.join(b, keys, "full").withColumn("agrees", F.col("n_left").eqNullSafe(F.col("n_right")))


def off_by(measured: Column, expected: Column, tolerance: float = 0.30) -> Column:
    return F.abs(measured - expected) / expected > tolerance


def rename_plan(recorded: DataFrame, disk: DataFrame, old: str, new: str, path: str = "clip") -> DataFrame:
    """(old, new, action): rename, merge (the new name is there already or another row takes it: drop the old), absent, or keep."""
    there = disk.select(F.col(path).alias("_c")).distinct()
    has_old = recorded.join(there.withColumn("_old", F.lit(True)), F.col(old) == F.col("_c"), "left").drop("_c")
    both = has_old.join(there.withColumn("_new", F.lit(True)), F.col(new) == F.col("_c"), "left").drop("_c")
    first = F.row_number().over(W.partitionBy(new, F.col("_old").isNotNull()).orderBy(old))
    action = (
        F.when(F.col("_old").isNull() & F.col("_new").isNull(), "absent")
        .when(F.col("_old").isNull() | (F.col(old) == F.col(new)), "keep")
        .when(F.col("_new").isNotNull() | (first > 1), "merge")
        .otherwise("rename")
    )
    return both.withColumn("action", action).drop("_old", "_new")


def action_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy("action").count()


def coverage(done: Column, missing_: Column) -> Column:
    return done / F.greatest(done + missing_, F.lit(1))


def refuse_if_any(df: DataFrame, bad: DataFrame, message: str) -> DataFrame:
    """df, or an error if bad has a row: nothing is written then. Checked before df is handed on."""
    if bad.limit(1).count():
        raise ValueError(f"{message}: {[tuple(r) for r in bad.limit(5).collect()]}")
    return df


def refuse_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return refuse_if_any(df, df.groupBy(*keys).count().where("count > 1"), "duplicate keys")


def require_complete(df: DataFrame, expected: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    return refuse_if_any(df, missing(expected, present, keys), "expected rows are missing")


def status_board(slugs: DataFrame, docs: dict[str, DataFrame], files: DataFrame, key: str = "slug") -> DataFrame:
    """One row per slug: each optional document as a struct (null if there is none), and the number of files."""
    out = slugs
    for name, doc in docs.items():
        out = out.join(doc.select(key, F.struct(*[c for c in doc.columns if c != key]).alias(name)), key, "left")
    n = files.groupBy(key).agg(F.count(F.lit(1)).alias("files"))
    return out.join(n, key, "left").withColumn("files", F.coalesce("files", F.lit(0)))


def reuse_plan(wanted: DataFrame, other_lot: DataFrame, keys: list[str]) -> DataFrame:
    """Each wanted row with the other lot's columns and its origin: 'reused', or 'missing' where the lot hasn't got it."""
    there = other_lot.withColumn("_there", F.lit(True))
    return wanted.join(there, keys, "left").withColumn("origin", F.when(F.col("_there"), "reused").otherwise("missing")).drop("_there")


def reuse_or_generate(wanted: DataFrame, other_lot: DataFrame, keys: list[str], reuse: bool) -> DataFrame:
    """With reuse, the other lot's rows for all wanted keys, an error if one isn't there; else the wanted rows to generate."""
    if not reuse:
        return wanted.withColumn("origin", F.lit("generate"))
    return require_complete(wanted, wanted, other_lot, keys).join(other_lot, keys).withColumn("origin", F.lit("reused"))
