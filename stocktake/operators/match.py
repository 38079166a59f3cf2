"""Joins beyond equality: as-of, nearest, pairs, positional proximity, dimension lookups with priorities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vectors as V
from .cohesion import least_cosine
from .rows import first_of

SHORT = 1e-3  # norm under which the guard of a cosine counts
TERMS = 3  # of the guard's series


def _cuttable(column: Column, kind: T.DataType) -> Column:
    """A number in the order of the column, for cutting it into runs."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp"))
    return F.unix_date(column) if isinstance(kind, T.DateType) else column.cast("double")


def as_of(left: DataFrame, right: DataFrame, on: str, value: str, by: list[str] = (), name: str | None = None) -> DataFrame:
    """Left rows with the value of the right row at, or else next below, their `on`; null before the first.

    Both sides meet in one sorted pass, without a range join. The pass is cut at quantiles of the right side, so that
    neither all rows nor those of one key are sorted in one task: each run of a key is filled by itself, and what a run
    ends with is carried into the key's next. If several right rows claim a key, pass them through first_of() before.
    """
    name, by = name or value, list(by)
    l = left.withColumn("_row", F.struct(*left.columns)).select(*by, F.col(on).alias("_on"), F.lit(1).alias("_side"), F.col("_row"), F.lit(None).cast(right.schema[value].dataType).alias("_v"))
    r = right.select(*by, F.col(on).alias("_on"), F.lit(0).alias("_side"), F.lit(None).cast(l.schema["_row"].dataType).alias("_row"), F.col(value).alias("_v"))
    runs = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = lambda c: _cuttable(F.col(c), right.schema[on].dataType)
    cuts = right.agg(F.percentile_approx(at(on), [i / runs for i in range(1, runs)], 10_000)).first()[0] if runs > 1 else None
    edges = sorted(set(cuts or ()))
    run = F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e <= at("_on"))) if edges else F.lit(0)
    keys = [*by, "_run"]
    both = l.unionByName(r).withColumn("_run", F.when(F.col("_on").isNull(), -1).otherwise(run))
    w = W.partitionBy(*keys).orderBy("_on", "_side")
    filled = both.withColumn("_v", F.last("_v", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)))
    # a row for each run of each key: what the runs before it end with
    ends = both.groupBy(*keys).agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("_on"))).alias("_end"))
    upto = W.partitionBy(*by or [F.lit(0)]).orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.last("_end", ignorenulls=True).over(upto).alias("_before"))
    joined = filled.join(carried if by else F.broadcast(carried), [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return joined.where("_side = 1").select("_row.*", F.coalesce("_v", "_before").alias(name))


def as_of_ranges(left: DataFrame, small: DataFrame, on: str, value: str, limit: int = 1_000) -> DataFrame:
    """The same for a right side of up to `limit` rows: each left row looks it up in one sorted array, and left isn't shuffled.

    Beyond the limit it is as_of().
    """
    if small.limit(limit + 1).count() > limit:
        return as_of(left, small, on, value)
    table = small.where(F.col(on).isNotNull()).agg(F.array_sort(F.collect_list(F.struct(F.col(on).alias("k"), F.col(value).alias("v")))).alias("_t"))
    found = F.try_element_at(F.filter("_t", lambda x: x["k"] <= F.col(on)), F.lit(-1))
    return left.crossJoin(F.broadcast(table)).withColumn(value, found["v"]).drop("_t")


def stage_of(lines: DataFrame, stages: DataFrame, chapter: str, prologue_to: int = 1) -> DataFrame:
    """Lines with their stage: the prologue's up to a chapter, else the stage that lists the chapter or the nearest one below.

    stages: (ord, stage, chapters). The first stage that claims a chapter keeps it. Lines without a chapter, or before
    the first claimed one, drop out.
    """
    claims = first_of(stages.select("ord", "stage", F.explode("chapters").alias(chapter)), [chapter], "ord")
    found = as_of_ranges(lines.where(F.col(chapter).isNotNull()), claims, chapter, "stage")
    return found.withColumn("stage", F.when(F.col(chapter) <= prologue_to, "prologue").otherwise(F.col("stage"))).where("stage is not null")


def nearest(df: DataFrame, targets: list[tuple[str, float]], value: Column) -> DataFrame:
    """The nearest target of each row, and how far it is; of equals the first listed. Row-local: targets are constants."""
    options = F.array(*[F.struct(F.abs(value - F.lit(float(t))).alias("distance"), F.lit(i).alias("i"), F.lit(n).alias("target")) for i, (n, t) in enumerate(targets)])
    best = F.array_min(F.filter(options, lambda o: o["distance"].isNotNull()))
    return df.withColumn("_b", best).withColumn("target", F.col("_b.target")).withColumn("distance", F.col("_b.distance")).drop("_b")


def pairs_within(df: DataFrame, keys: list[str], id_col: str, cols: list[str]) -> DataFrame:
    """All pairs i < j of each group; meant for small groups, such as the clips of one voice."""
    a = df.select(*keys, F.col(id_col).alias("id_a"), *[F.col(c).alias(f"{c}_a") for c in cols])
    b = df.select(*keys, F.col(id_col).alias("id_b"), *[F.col(c).alias(f"{c}_b") for c in cols])
    return a.join(b, keys).where("id_a < id_b")


def cohesion(df: DataFrame, keys: list[str], id_col: str, vector: str) -> DataFrame:
    """Mean and least cosine of the pairs of each group, and their number. A group of one has no pairs and no row.

    The mean is that of mean_cohesion(), the least that of least_cosine(): neither makes all pairs.
    """
    both = mean_cohesion(df, keys, vector).join(least_cosine(df, keys, id_col, vector), keys)
    return both.select(*keys, "mean_cos", "min_cos", "pairs")


def mean_cohesion(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """Mean cosine of the pairs without making pairs: from the sum of the unit vectors of a group. For groups of any size.

    Equal to cohesion()'s mean up to rounding and to the 1e-10 that guards the denominator.
    """
    unit = df.withColumn("_n", V.norm(F.col(vector))).select(*keys, F.posexplode(vector).alias("i", "x"), "_n")
    unit = unit.withColumn("u", F.when(F.col("_n") > 0, F.col("x") / F.col("_n")).otherwise(0.0))
    dims = unit.groupBy(*keys, "i").agg(F.sum("u").alias("s"), F.sum(F.col("u") * F.col("u")).alias("q"), F.count(F.lit(1)).alias("n"))
    total = dims.groupBy(*keys).agg(F.sum(F.col("s") * F.col("s")).alias("all"), F.sum("q").alias("own"), F.max("n").alias("n"))
    return total.where("n > 1").select(*keys, ((F.col("all") - F.col("own")) / (F.col("n") * (F.col("n") - 1))).alias("mean_cos"), F.expr("n * (n - 1) div 2").alias("pairs"))


def proximity(candidates: DataFrame, references: DataFrame, on: str, candidate: str, reference: str, vector: str) -> DataFrame:
    """(candidate, reference, proximity): mean cosine over the pairs of their utterances that have the same `on`.

    The cosines of all pairs of two groups of vectors add up to the product of the groups' sums of unit vectors. The 1e-10
    that V.cosine() has in the denominator is a series in it, of which three terms leave less than 1e-12 where no vector is
    shorter than SHORT. So groups meet, not pairs; only vectors that are shorter, but not zero, are compared one by one.
    Vectors of other lengths, or with nulls, have no cosine.
    """
    side = lambda df, key: df.select(key, on, F.col(vector).alias("_v"), F.size(vector).alias("_size"), V.norm(F.col(vector)).alias("_n"))
    a, b = side(candidates, candidate), side(references, reference)
    short = (F.col("_n") > 0) & (F.col("_n") < SHORT)
    groups = _unit_sums(a.where(~short), [candidate, on]).join(_unit_sums(b.where(~short), [reference, on]).withColumnsRenamed({f"_s{j}": f"_t{j}" for j in range(TERMS)} | {"_k": "_l"}), [on, "_size"])
    terms = [F.lit((-V.GUARD) ** j) * F.coalesce(V.dot(F.col(f"_s{j}"), F.col(f"_t{j}")), F.lit(0.0)) for j in range(TERMS)]
    sums = groups.select(candidate, reference, reduce(lambda x, y: x + y, terms).alias("_sum"), (F.col("_k") * F.col("_l")).alias("_pairs"))
    one = lambda x, y: x.join(y.withColumnsRenamed({"_v": "_w", "_n": "_m"}), [on, "_size"]).select(candidate, reference, V.cosine(F.col("_v"), F.col("_w")).alias("_sum"), F.lit(1).cast("long").alias("_pairs")).where("_sum is not null")
    some_a, some_b = (x.where(short).limit(1).count() for x in (a, b))
    if some_a:
        sums = sums.unionByName(one(a.where(short), b))
    if some_b:
        sums = sums.unionByName(one(a.where(~short), b.where(short)))
    met = a.select(candidate, on).distinct().join(b.select(reference, on).distinct(), on).select(candidate, reference, F.lit(None).cast("double").alias("_sum"), F.lit(None).cast("long").alias("_pairs")).distinct()
    total = sums.unionByName(met).groupBy(candidate, reference).agg(F.sum("_sum").alias("_sum"), F.sum("_pairs").alias("_pairs"))
    return total.select(candidate, reference, (F.col("_sum") / F.col("_pairs")).alias("proximity"))


def _unit_sums(vectors: DataFrame, keys: list[str]) -> DataFrame:
    """keys, _size, _k, _s0, _s1, ...: how many vectors of a length, and the sums of their unit vectors over powers of their norms."""
    each = vectors.where("_n is not null").select(*keys, "_size", "_n", F.posexplode_outer("_v").alias("_i", "_x"))
    over = [F.when(F.col("_n") > 0, F.col("_x") / F.col("_n") / F.pow("_n", F.lit(float(j)))).otherwise(0.0) for j in range(TERMS)]
    dims = each.groupBy(*keys, "_size", "_i").agg(F.count(F.lit(1)).alias("_k"), *[F.sum(x).alias(f"_s{j}") for j, x in enumerate(over)])
    whole = dims.groupBy(*keys, "_size").agg(F.max("_k").alias("_k"), F.array_sort(F.collect_list(F.struct("_i", *[f"_s{j}" for j in range(TERMS)]))).alias("_all"))
    return whole.select(*keys, "_size", "_k", *[F.col(f"_all._s{j}").alias(f"_s{j}") for j in range(TERMS)])


def worst_proximity(near: DataFrame, candidate: str, reference: str) -> DataFrame:
    """The nearest reference decides: the highest proximity of each candidate; the least first."""
    top = near.groupBy(candidate).agg(F.max("proximity").alias("worst_proximity"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(reference, "proximity")))).alias("proximities"))
    return top.orderBy("worst_proximity", candidate)


def one_value(df: DataFrame, keys: list[str], values: list[str], order: str | None) -> DataFrame:
    """One row for each key: the last in order, as in a dictionary filled in that order; without an order, repeated keys are an error."""
    if order:
        return df.groupBy(*keys).agg(*[F.max_by(v, order).alias(v) for v in values])
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.first(v).alias(v) for v in values])
    refused = F.raise_error(F.concat(F.lit("repeated key: "), F.concat_ws(",", *keys)))
    return found.select(*keys, *[F.when(F.col("_n") > 1, refused.cast(df.schema[v].dataType)).otherwise(F.col(v)).alias(v) for v in values])


def only_row(df: DataFrame, value: str, name: str) -> DataFrame:
    """Always one row: the value of df's one row as name, and how many rows there are as {name}_n."""
    return df.agg(F.first(value).alias(name), F.count(F.lit(1)).alias(f"{name}_n"))


def if_one(name: str, what: str) -> Column:
    """The value of only_row(); an error where it is needed and there is none, or more than one."""
    return F.when(F.col(f"{name}_n") == 1, F.col(name)).otherwise(F.raise_error(F.concat(F.lit(f"{what}: rows found: "), F.col(f"{name}_n").cast("string"))))


def lookup(df: DataFrame, dim: DataFrame, key: str, value: str, default: Column, order: str | None = None) -> DataFrame:
    """df with the dimension's value for the key, or the default. Repeated keys: the last in order, or an error."""
    d = one_value(dim, [key], [value], order).select(F.col(key).alias("_k"), F.col(value).alias("_v"))
    return df.join(d, F.col(key) == F.col("_k"), "left").withColumn(value, F.coalesce("_v", default)).drop("_k", "_v")


def resolve_instruction(df: DataFrame, registers: DataFrame, by_role: dict[str, str], job: str | None, default: str) -> DataFrame:
    """instruct if a row has one, else the text of: its own register, its role's, the job's, the default.

    Empty strings count as missing; an unknown register takes the default's text. registers: (registre, consigne), each
    register once. A default that isn't among them is an error for rows that need it; no row is lost.
    """
    some = lambda c: F.nullif(c, F.lit(""))
    role = F.try_element_at(F.create_map(*[F.lit(x) for kv in by_role.items() for x in kv]), F.col("role")) if by_role else F.lit(None)
    named = F.coalesce(some(F.col("registre")), some(role.cast("string")), some(F.lit(job).cast("string")), F.lit(default))
    dim = one_value(registers, ["registre"], ["consigne"], None).select(F.col("registre").alias("_k"), F.col("consigne").alias("_text"))
    fallback = only_row(registers.where(F.col("registre") == default), "consigne", "_default")
    out = df.withColumn("_name", named).join(dim, F.col("_name") == F.col("_k"), "left").crossJoin(F.broadcast(fallback))
    return out.withColumn("consigne", F.coalesce(some(F.col("instruct")), "_text", if_one("_default", "default register"))).drop("_name", "_k", "_text", "_default", "_default_n")


def role_defaults(df: DataFrame, defaults: DataFrame, role: str, fields: list[str], order: str | None = None) -> DataFrame:
    """Fields that a row lacks are its role's. Repeated roles: the last in order, or an error."""
    d = one_value(defaults, [role], fields, order).select(F.col(role).alias("_k"), *[F.col(f).alias(f"_{f}") for f in fields])
    out = df.join(d, F.col(role) == F.col("_k"), "left")
    for f in fields:
        out = out.withColumn(f, F.coalesce(f, f"_{f}") if f in df.columns else F.col(f"_{f}"))
    return out.drop("_k", *[f"_{f}" for f in fields])


def engine_of(wanted: Column, has_timbre: Column) -> Column:
    return F.when(wanted == "hybride", F.when(has_timbre, "qwen3").otherwise("chatterbox")).otherwise(wanted)


def chosen(manual: Column, automatic: Column, first: Column) -> Column:
    """A manual choice is never overwritten by an automatic one; else the candidate picked, else the first."""
    return F.coalesce(manual, automatic, first)


def target_of(df: DataFrame, targets: DataFrame, role: str = "role") -> DataFrame:
    """The target of the row's role, or that of role '*', which is an error if it is needed and not there once."""
    t = one_value(targets.where("role <> '*'"), ["role"], ["target"], None).select(F.col("role").alias("_k"), F.col("target").alias("_t"))
    star = only_row(targets.where("role = '*'"), "target", "_any")
    out = df.join(t, F.col(role) == F.col("_k"), "left").crossJoin(F.broadcast(star))
    return out.withColumn("target", F.coalesce("_t", if_one("_any", "target of role *"))).drop("_k", "_t", "_any", "_any_n")


def stage_target(role: Column, stage_value: Column, narrator: float, default: float) -> Column:
    return F.when(role == "narrator", F.lit(narrator)).otherwise(F.coalesce(stage_value, F.lit(default)))


def prompt(prefix: Column, register: Column, role: Column | None = None) -> Column:
    """Prefix and register, trimmed; the narrator never takes the prefix."""
    lead = prefix if role is None else F.when(role != "narrator", prefix)
    return F.trim(F.concat_ws(" ", F.nullif(lead, F.lit("")), F.nullif(register, F.lit(""))))
