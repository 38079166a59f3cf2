"""Exact group statistics, robust outliers, verdicts and deltas. Medians and quantiles interpolate; none is approximate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import LIMIT, group_stats


def census(df: DataFrame, key: str, member: str, order: str) -> DataFrame:
    """Rows and sorted distinct members of each key; most rows first, of equals the key seen first."""
    out = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set(member)).alias("members"), F.min(order).alias("first_seen"))
    return out.orderBy(F.desc("n"), "first_seen")


def census_filter(df: DataFrame, key: str, least: int, excluded: list[str] = (), only: list[str] = ()) -> DataFrame:
    out = df.where(F.col("n") >= least)
    out = out.where(~F.col(key).isin(*excluded)) if excluded else out
    return out.where(F.col(key).isin(*only)) if only else out


def value_range(x: Column) -> Column:
    return F.max(x) - F.min(x)


def interdecile_range(df: DataFrame, keys: list[str], x: Column, name: str, aggregates: list[Column] = (), more: dict[str, tuple[Column, float]] | None = None) -> DataFrame:
    """Of each group the distance from the first to the ninth decile as name, with further aggregates and quantiles."""
    out = group_stats(df, keys, {"_p90": (x, 0.9), "_p10": (x, 0.1)} | (more or {}), aggregates)
    return out.withColumn(name, F.col("_p90") - F.col("_p10")).drop("_p90", "_p10")


def median_ci95(x: Column) -> Column:
    """Half the 95 % interval of the median: 1.96 * 1.253 * population deviation / sqrt(n)."""
    return 1.96 * 1.253 * F.stddev_pop(x) / F.sqrt(F.count(x))


def ratio_of_sums(a: Column, b: Column) -> Column:
    return F.sum(a) / F.greatest(F.sum(b), F.lit(1e-9))


def median_outliers(df: DataFrame, keys: list[str], value: str, fraction: float = 0.5, limit: int = LIMIT) -> DataFrame:
    """Rows under fraction of their group's median, with the median. Not idempotent: repairing rows raises the median."""
    med = group_stats(df, keys, {"group_median": (F.col(value), 0.5)}, limit=limit)
    return df.join(med, keys).where(F.col(value) < fraction * F.col("group_median"))


def subgroup_gap(df: DataFrame, keys: list[str], subgroup: str, pair: tuple, value: str) -> DataFrame:
    """Median of each of two subgroups, and how far they are apart."""
    a, b = pair
    of = lambda s: (F.when(F.col(subgroup) == s, F.col(value)), 0.5)
    out = group_stats(df, keys, {"median_a": of(a), "median_b": of(b)})
    return out.withColumn("gap", F.abs(F.col("median_a") - F.col("median_b")))


def matrix(df: DataFrame, row: str, column: str, labels: list, value: Column) -> DataFrame:
    """row x column, one aggregate in each cell."""
    return df.groupBy(row).pivot(column, labels).agg(value)


#: What the verdicts of two gates are called: both passed, only the first, only the second, none.
SWEEP_VERDICTS = ("à écouter", "change d'âge selon le texte", "dispersé d'une réplique à l'autre", "écarté")
CAST_VERDICTS = ("RETENU", "trop grave", "change d'âge", "écarté")
#: Why a clip is suspect.
MOTIFS = ("trop court", "fin coupée")


def two_gates(first: Column, second: Column, labels: tuple[str, str, str, str] = SWEEP_VERDICTS) -> Column:
    """The verdict of two gates, which are conditions: a limit (range <= 40), or a range (low <= median <= high)."""
    a, b = F.coalesce(first, F.lit(False)), F.coalesce(second, F.lit(False))
    return F.when(a & b, labels[0]).when(a, labels[1]).when(b, labels[2]).otherwise(labels[3])


def in_range(x: Column, low: float, high: float) -> Column:
    return (x >= low) & (x <= high)


def sum_of_ratios(parts: list[tuple[str, float]]) -> Column:
    """Columns over their limits, added up: what verdicts are sorted by."""
    total = F.lit(0.0)
    for c, limit in parts:
        total = total + F.col(c) / F.lit(limit)
    return total


def group_report(df: DataFrame, keys: list[str], seconds: str, pitch: str, spread: str, voiced: str) -> DataFrame:
    """Of each group: total seconds, median pitch of the clips that have one (0 without), mean spread, median voiced share."""
    wanted = {"median_pitch": (F.when(F.col(pitch) > 0, F.col(pitch)), 0.5), "median_voiced": (F.col(voiced), 0.5)}
    sums = [F.sum(seconds).alias("total_seconds"), F.avg(spread).alias("mean_spread"), F.count(F.lit(1)).alias("clips")]
    return group_stats(df, keys, wanted, sums).withColumn("median_pitch", F.coalesce("median_pitch", F.lit(0.0)))


def degenerate(seconds: Column, expected: Column, level_db: Column, active: Column) -> Column:
    """Why a clip is degenerate, the first reason that holds; empty if none does."""
    return F.when(seconds > 3 * expected + 5, "duration").when(level_db < -38, "level").when(active < 0.10, "breath").otherwise("")


def suspect(seconds: Column, floor: Column, ratio: Column, tail: Column, tail_limit: float = 0.8, least_ratio: float = 0.6) -> Column:
    return F.when((seconds < floor) | (ratio < least_ratio), MOTIFS[0]).when(tail > tail_limit, MOTIFS[1]).otherwise("")


def suspects(df: DataFrame, group: str, text: str, seconds: str, tail: str, least_chars: int = 30) -> DataFrame:
    """Clips too short for their text at their group's pace, or cut at the end; worst tail first.

    The pace is the group's median of seconds per character over texts of least_chars or more.
    """
    long = F.length(text) >= least_chars
    pace = group_stats(df, [group], {"pace": (F.when(long, F.col(seconds) / F.length(text)), 0.5)})
    ratio = F.col(seconds) / F.greatest(F.col("pace") * F.length(text), F.lit(1e-9))
    judged = df.join(pace, group).withColumn("ratio", ratio).withColumn("motif", suspect(F.col(seconds), F.lit(0.25), F.col("ratio"), F.col(tail)))
    return judged.where("motif <> ''").orderBy(F.desc(tail))


def delta_to_baseline(df: DataFrame, baseline: Column, values: list[str]) -> DataFrame:
    """Each row's values less those of the one baseline row; an error if there isn't exactly one."""
    base = df.where(baseline).agg(F.count(F.lit(1)).alias("_n"), *[F.first(v).alias(f"_{v}") for v in values])
    out = df.crossJoin(F.broadcast(base))
    for v in values:
        refused = F.raise_error(F.concat(F.lit("baseline rows: "), F.col("_n").cast("string"))).cast(df.schema[v].dataType)
        out = out.withColumn(f"d_{v}", F.col(v) - F.when(F.col("_n") == 1, F.col(f"_{v}")).otherwise(refused))
    return out.drop("_n", *[f"_{v}" for v in values])


def control_difference(treated: DataFrame, control: DataFrame, keys: list[str], value: str) -> DataFrame:
    a, b = treated.select(*keys, F.col(value).alias("treated")), control.select(*keys, F.col(value).alias("control"))
    return a.join(b, keys).withColumn("effect", F.col("treated") - F.col("control"))


def credibility(df: DataFrame, keys: list[str], share: str, limit: float = 0.05) -> DataFrame:
    """Median share of each group, and whether its measurements can be believed: a share over the limit says they can't."""
    out = group_stats(df, keys, {"median_share": (F.col(share), 0.5)})
    return out.withColumn("credible", F.coalesce(F.col("median_share") <= limit, F.lit(True)))


def credible(df: DataFrame, keys: list[str], share: str, limit: float = 0.05) -> DataFrame:
    """Median share of each group; an error for a group over the limit."""
    refused = F.raise_error(F.concat(F.lit("low-band share over the limit: "), F.concat_ws(",", *keys))).cast("double")
    return credibility(df, keys, share, limit).withColumn("median_share", F.when(F.col("credible"), F.col("median_share")).otherwise(refused)).drop("credible")


def sweep_best(df: DataFrame, keys: list[str], centres: list[float], shares: str) -> DataFrame:
    """For each key the centre whose band concentrates most energy: median share of each centre over the band's share of the width."""
    from ..functions.vectors import concentration
    from .rows import best_of

    each = df.select(*keys, F.posexplode(shares).alias("pos", "share"))
    med = group_stats(each, [*keys, "pos"], {"share": (F.col("share"), 0.5)})
    centre = F.element_at(F.array(*[F.lit(float(c)) for c in centres]), F.col("pos") + 1)
    return best_of(med.withColumn("centre", centre).withColumn("density", concentration(F.col("share"), centre)), keys, F.col("density"), "pos")


def nested_report(df: DataFrame, key: str, item: str, fields: list[str]) -> DataFrame:
    """Per key a map item -> struct of fields."""
    return df.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(item), F.struct(*fields).alias("v"))))).alias("items"))
