"""Sharding by proportional stratified interleaving, with DataFrame operations only.

Rows of each source are put in a seeded random order and numbered; a row's rank and a part of one more, over its
source's size, is a fraction between 0 and 1 that says how far through the source it stands. Sorting all rows by that
fraction interleaves the sources in proportion, and cutting the sorted rows into equal runs gives shards whose counts
differ by one at most. Of a source's ranks each shard takes those between two fractions: its share, but for less than one
row at either cut. The part is the source's own, by its place among the sources, in steps of the golden section: so any
number of sources with one row each spreads evenly over all shards, where the half would put them all into the middle.

Both orders are total and found by placed_by(), which deals rows out by ranges of the whole order: neither a source
with a third of all rows, nor any number of sources with equal fractions, nor rows without an id meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import HOT_KEYS, placed_by, spread_join, stack, staged

KEY_BITS = 60
#: The golden section of 2 ** 32: multiples of it, modulo 2 ** 32, spread evenly however many there are.
STEP = 2654435769


def interleave(df: DataFrame, n_shards: int = 8, seed: str = "shards", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is `rows`: counts of shards differ by one at most. A null text has size 1 and the checksum of no bytes; a
    null source is a stratum of its own; rows without an id are shuffled by their number in the input, so which of
    them goes where can differ from run to run; rows that are equal in everything take neighbouring places; an empty table
    gives an empty result; with fewer rows than shards some shards stay empty. Further columns are ignored, whatever
    their names. The stratum is the unit of the mixture; equal texts are not held together, as a group of copies may
    be larger than a shard.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    named = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("row "), F.col("_row").cast("string")))
    key = F.substring(F.md5(F.concat_ws(":", F.lit(seed), named)), 1, KEY_BITS // 4)
    rows = staged(
        df.withColumn("_row", F.monotonically_increasing_id()).select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.when(F.col(source_col).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source_col).cast("string"))).alias("_stratum"),
            F.conv(key, 16, 10).cast("long").alias("_key"),
            "_row",
        ),
        "shard-rows",
    )
    total = rows.count()
    own = ["_stratum", "_key", "doc_id", "text_crc32", "size", "_row"]
    shuffled = staged(placed_by(rows, own, total, "_rank", "shard-order"), "shard-ranks")
    strata = staged(shuffled.groupBy("_stratum").agg(F.count(F.lit(1)).alias("_of"), F.min("_rank").alias("_first")), "shard-strata")
    strata = staged(placed_by(strata, ["_of", "_stratum"], strata.count(), "_place", "shard-strata-order"), "shard-strata")
    ranked = spread_join(shuffled, strata, ["_stratum"], F.col("_of") > total // HOT_KEYS)
    part = ((F.col("_place") % (1 << 31)) * STEP % (1 << 32)).cast("double") / float(1 << 32)
    fraction = ((F.col("_rank") - F.col("_first")).cast("double") + part) / F.col("_of").cast("double")
    placed = staged(ranked.withColumn("_fraction", fraction).drop("_rank", "_first", "_of", "_place"), "shard-fractions")
    cut = placed_by(placed, ["_fraction", *own], total, "_pos", "shard-mixture")
    shard = F.expr(f"(({n_shards} * (_pos + 1) - 1) div {max(total, 1)})")
    return cut.withColumn("shard", shard.cast("int")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("_pos") - F.expr(f"(cast(shard as bigint) * {total}) div {n_shards}")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleave(stack(spark, sf_dir, "documents"))


#: DuckDB has no crc32: the 256 remainders are made by rule and folded over the bytes.
SQL = """
with rows as (
  select doc_id, coalesce(text, '') as text, case when source is null then 'n' else 's' || source end as stratum,
         ('0x' || left(md5('shards:' || doc_id), 15))::bigint as k
  from documents
), remainders as (
  select list(list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t
  from range(256) r(i)
), checked as (
  select doc_id, strlen(text) + 1 as size, stratum, k,
         xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::bigint)),
                         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as text_crc32
  from rows cross join remainders
), strata as (
  select stratum, n, (row_number() over (order by n, stratum) - 1) * 2654435769 % 4294967296 / 4294967296.0::double as part from (select stratum, count(*) as n from rows group by 1)
), ranked as (
  select *, ((row_number() over (partition by stratum order by k, doc_id, text_crc32, size) - 1)::double + part) / n::double as frac
  from checked join strata using (stratum)
), placed as (
  select *, row_number() over (order by frac, stratum, k, doc_id, text_crc32, size) - 1 as pos, count(*) over () as total from ranked
)
select doc_id, size, text_crc32, 'rows' as law, cast((8 * (pos + 1) - 1) // total as integer) as shard,
       pos - ((8 * (pos + 1) - 1) // total * total) // 8 as slot, cast(null as integer) as grown_shard
from placed
"""
