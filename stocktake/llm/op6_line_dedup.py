"""Line dedup: explode normalised lines, hash, count distinct documents per hash, drop, reassemble by position.

A line's key is the line without white space ([ \\t-\\r]) at its ends and with A-Z lower-cased. Keys of at least
`min_chars` code points that at least `min_docs` documents hold lose all their lines, except in the largest
document id that holds them. Only 16-byte hashes of keys are exploded and counted, once per document; the text
moves once, to meet the keys that its document loses. A key that a third of all documents hold is counted with
partial sums, and joined by spread_join().
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import HOT_KEYS, arrow_map, col, out_batch, spread_join, stack, staged, texts


def key_of(line: bytes) -> bytes:
    return line.strip().lower()  # of bytes: ASCII white space and A-Z only


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)


def line_keys(df: DataFrame, min_chars: int, id_col: str, text_col: str) -> DataFrame:
    """(id, key): each key of each row once."""

    def keys(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, sizes = [], []
        for b in texts(batch):
            own = {k for line in b.split(b"\n") if long_enough(k := key_of(line), min_chars)}
            found += map(digest, own)
            sizes.append(len(own))
        take = pa.array([i for i, n in enumerate(sizes) for _ in range(n)], pa.int64())
        return out_batch(id=col(batch, "id").take(take), key=pa.array(found, pa.binary()))

    kind = df.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("key", T.BinaryType())])
    return arrow_map(df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null"), keys, schema)


def dedup_lines(df: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of df, the text without its dropped lines, and n_lines and n_dropped (long).

    A null or empty text is one empty line and comes back empty. Rows without an id are in no document: they count
    for no key and keep all lines. Rows that repeat an id are one document for the count, and each is returned. Of
    equal lines in the document that keeps them all stay. An empty table gives an empty result. Columns of df named
    n_lines or n_dropped are replaced.
    """
    pairs = staged(line_keys(df, min_chars, id_col, text_col), "line-keys")
    once = pairs.groupBy("id", "key").agg(F.count(F.lit(1)).alias("_rows"))
    counts = once.groupBy("key").agg(F.count(F.lit(1)).alias("_docs"), F.max("id").alias("_keeper"), F.sum("_rows").alias("_rows"))
    frequent = staged(counts.where(F.col("_docs") >= min_docs).drop("_docs"), "line-frequent")
    lost = spread_join(pairs, frequent, ["key"], F.col("_rows") > pairs.count() // HOT_KEYS).where(F.col("id") < F.col("_keeper"))
    lost = lost.groupBy(F.col("id").alias("_id")).agg(F.collect_set("key").alias("_lost"))
    kept = [c for c in df.columns if c not in ("n_lines", "n_dropped")]
    inner = ["text" if c == text_col else f"_{i}" for i, c in enumerate(kept)]
    own = df.select(*kept).toDF(*inner).withColumn("text", F.col("text").cast("string"))
    joined = own.join(lost, F.col(inner[kept.index(id_col)]) == F.col("_id"), "left").drop("_id")

    def rebuild(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, lines, dropped = [], [], []
        for b, gone in zip(texts(batch), col(batch, "_lost").to_pylist(), strict=True):
            own = b.split(b"\n")
            lines.append(len(own))
            if gone:
                gone = set(gone)
                stay = [x for x in own if not (long_enough(k := key_of(x), min_chars) and digest(k) in gone)]
                dropped.append(len(own) - len(stay))
                b = b"\n".join(stay)
            else:
                dropped.append(0)
            kept.append(b)
        arrays = {f: col(batch, f) for f in batch.schema.names if f != "_lost"}
        arrays["text"] = pa.array(kept, pa.binary()).cast(pa.string())
        return out_batch(**arrays, n_lines=pa.array(lines, pa.int64()), n_dropped=pa.array(dropped, pa.int64()))

    schema = T.StructType([*joined.drop("_lost").schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return arrow_map(joined, rebuild, schema).toDF(*kept, "n_lines", "n_dropped")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = stack(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
with lines as (
  select doc_id, unnest(p) as pos, unnest(l) as line
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l, range(len(string_split(coalesce(text, ''), chr(10)))) as p from documents)
), keyed as (
  select doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from lines
), frequent as (
  select k, max(doc_id) as keeper from keyed where length(k) >= 20 group by k having count(distinct doc_id) >= 3
), marked as (
  select d.doc_id, d.pos, d.line, f.k is not null and d.doc_id <> f.keeper as gone from keyed d left join frequent f on d.k = f.k
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""
