"""Benchmark decontamination: a broadcast set of normalised test n-grams, scanned for in every document.

Words are the runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII. The windows of an item are
its n-grams of `n` words, or the item itself if it is shorter. Windows are broadcast as arrays of word numbers with
hashes; a document's words are numbered by the windows' vocabulary, runs of known words are hashed n words at a time,
and every hit of the hash is verified word by word. The scan moves no document.

The broadcast is bounded: items are cut into runs of at most RUN windows, so none is too long to be dealt out, and a
benchmark of more than `block_windows` windows goes in blocks of about as many, of whole runs. Each block is scanned for by itself, and the
hits of a document are put together afterwards; the result is the same. A window takes some 30 bytes and a distinct word
some 150, on the driver and in every Python worker.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, col, out_batch, stack, staged, texts

_WORD = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
#: Lower-cases A-Z and makes every byte that is in no word a blank.
FOLD = bytes((c + 32 if 0x41 <= c <= 0x5A else c if c in _WORD else 0x20) for c in range(256))
WORD_BYTES = bytes(1 if (c in _WORD or 0x41 <= c <= 0x5A) else 0 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Windows:
    """The distinct windows of some runs of items, (item, its words joined by blanks), by length, ready to be looked up."""

    def __init__(self, runs: list[tuple[str, str]], n: int):
        self.vocab: dict[bytes, int] = {}
        self.names = sorted({name for name, _ in runs})
        number = {x: i for i, x in enumerate(self.names)}
        parts, starts, owners = [], {}, {}
        at = 0
        for name, text in runs:
            words = text.encode().split(b" ")
            length = min(n, len(words))
            parts.append(np.fromiter((self.vocab.setdefault(w, len(self.vocab)) for w in words), np.int32, len(words)))
            first = np.arange(at, at + len(words) - length + 1)
            starts.setdefault(length, []).append(first)
            owners.setdefault(length, []).append(np.full(len(first), number[name], np.int32))
            at += len(words)
        self.words = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        self.by_length = {k: self.table(k, np.concatenate(starts[k]), np.concatenate(owners[k])) for k in sorted(starts)}

    def table(self, length: int, start: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of the windows at start: hash factors, sorted hashes, the place of each distinct window, and where its items begin; the items."""
        seed = 1
        while True:  # another seed in the unlikely case that two windows share a hash
            odd = np.random.default_rng(seed).integers(0, 2**63, length, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            h = np.zeros(len(start), np.uint64)
            for j in range(length):
                h += self.words[start + j].astype(np.uint64) * odd[j]
            order = np.lexsort((owner, h))
            s = h[order]
            fresh = np.concatenate([[True], s[1:] != s[:-1]])
            head = np.maximum.accumulate(np.where(fresh, np.arange(len(s)), 0))
            if all((self.words[start[order] + j] == self.words[start[order][head] + j]).all() for j in range(length)):
                break
            seed += 1
        own = owner[order]
        once = fresh | np.concatenate([[True], own[1:] != own[:-1]])
        window = np.cumsum(fresh) - 1
        begins = np.concatenate([[0], np.cumsum(np.bincount(window[once], minlength=int(fresh.sum())))])
        return odd, s[fresh], start[order][fresh].astype(np.int32), begins, own[once]

    def hits(self, docs: list[bytes]) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Number of words of each document; document, first word, length and item of each occurrence of a window."""
        get, counts, parts = self.vocab.get, [], []
        for b in docs:
            w = words_of(b)
            counts.append(len(w))
            parts.append(np.fromiter(map(get, w, repeat(-1)), np.int64, len(w)))
            parts.append(np.array([-1]))
        ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        begin = np.zeros(len(docs) + 1, np.int64)
        np.cumsum(np.array(counts, np.int64) + 1, out=begin[1:])
        at = np.arange(len(ids))
        run = at - np.maximum.accumulate(np.where(ids < 0, at, -1)) if len(ids) else at
        got = []
        for length, (odd, hashes, place, starts, owners) in self.by_length.items():
            s = np.flatnonzero(run >= length) - length + 1
            for lo in range(0, len(s), 1 << 20):
                part = s[lo : lo + (1 << 20)]
                h = np.zeros(len(part), np.uint64)
                for j in range(length):
                    h += ids[part + j].astype(np.uint64) * odd[j]
                k = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                same = hashes[k] == h
                part, k = part[same], k[same]
                if len(part):
                    true = (ids[part[:, None] + np.arange(length)] == self.words[place[k][:, None] + np.arange(length)]).all(1)
                    part, k = part[true], k[true]
                    n = starts[k + 1] - starts[k]
                    item = owners[np.repeat(starts[k] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())] if len(k) else np.zeros(0, np.int64)
                    got.append((np.repeat(part, n), np.full(n.sum(), length), item))
        start, length, item = (np.concatenate(x).astype(np.int64) if got else np.zeros(0, np.int64) for x in (zip(*got, strict=True) if got else ((), (), ())))
        doc = np.searchsorted(begin, start, "right") - 1
        return counts, doc, start - begin[doc], length, item


def _merged(start: np.ndarray, length: np.ndarray) -> list[tuple[int, int]]:
    """Spans covered, from first word to the word after the last."""
    spans: list[list[int]] = []
    for s, e in sorted(zip(start.tolist(), (start + length).tolist(), strict=True)):
        if spans and s <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], e)
        else:
            spans.append([s, e])
    return [(s, e) for s, e in spans]


HITS = "n_words long, spans array<struct<s:long,e:long>>, items array<string>"


RUN = 50_000


def runs_of(benchmark: DataFrame, n: int, run: int, item_col: str, text_col: str) -> DataFrame:
    """(item, part, windows, words): each item's words in runs of at most `run` windows; runs overlap by n - 1 words. An item without an id is named by the empty string."""

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        item, part, windows, words = [], [], [], []
        for name, text in zip(col(batch, "item").to_pylist(), texts(batch), strict=True):
            w = words_of(text)
            for k, lo in enumerate(range(0, max(1, len(w) - n + 1), run) if w else ()):
                own = w[lo : lo + run + n - 1]
                item.append(name or "")
                part.append(k)
                windows.append(max(1, len(own) - n + 1))
                words.append(b" ".join(own))
        return out_batch(item=pa.array(item, pa.string()), part=pa.array(part, pa.int64()), windows=pa.array(windows, pa.int64()), words=pa.array(words, pa.binary()).cast(pa.string()))

    plain = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    return arrow_map(plain, cut, "item string, part long, windows long, words string")


def scan(df: DataFrame, benchmark: DataFrame, n: int = 10, block_windows: int = 1_000_000, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """df with n_words, the spans of hit words (word numbers, end exclusive) and the items with a window there, sorted."""
    spark = df.sparkSession
    bench = staged(runs_of(benchmark, n, min(RUN, block_windows), item_col, text_col).withColumn("_run", F.monotonically_increasing_id()), "decontamination-windows")
    total = bench.agg(F.sum("windows")).first()[0] or 0
    blocks = -(-total // block_windows)
    names = df.schema.names
    schema = T.StructType([*df.schema.fields, *T._parse_datatype_string(HITS).fields])

    def one(rows: DataFrame, items: list[tuple], hit_only: bool) -> DataFrame:
        shared = spark.sparkContext.broadcast(Windows(items, n))  # about block_windows windows at most

        def look(batch: pa.RecordBatch) -> pa.RecordBatch:
            w = shared.value
            counts, doc, start, length, item = w.hits(texts(batch))
            spans, items = [[] for _ in counts], [[] for _ in counts]
            order = np.argsort(doc, kind="stable")
            cuts = np.searchsorted(doc[order], np.arange(len(counts) + 1))
            for i in np.unique(doc).tolist():
                own = order[cuts[i] : cuts[i + 1]]
                spans[i] = [{"s": s, "e": e} for s, e in _merged(start[own], length[own])]
                items[i] = sorted({w.names[k] for k in item[own].tolist()})
            made = out_batch(
                **{c: col(batch, c) for c in names},
                n_words=pa.array(counts, pa.int64()),
                spans=pa.array(spans, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))),
                items=pa.array(items, pa.list_(pa.string())),
            )
            return made.filter(pa.array([bool(x) for x in items])) if hit_only else made

        return arrow_map(rows, look, schema)

    if blocks <= 1:
        return one(df, [tuple(r) for r in bench.select("item", "words").collect()], False)
    keyed = staged(df.withColumn("_row", F.monotonically_increasing_id()), "decontamination-rows")
    names = [*names, "_row"]
    schema = T.StructType([*keyed.schema.fields, *T._parse_datatype_string(HITS).fields])
    numbered = staged(bench.withColumn("_block", F.pmod(F.xxhash64("_run"), F.lit(blocks))), "decontamination-items")
    hits = None
    for b in range(blocks):
        items = [tuple(r) for r in numbered.where(F.col("_block") == b).select("item", "words").collect()]
        part = staged(one(keyed, items, True).select("_row", "spans", "items"), "decontamination-hits")
        hits = part if hits is None else hits.unionByName(part)
    merged = hits.groupBy("_row").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    fold = """aggregate(spans, cast(array() as array<struct<s:bigint,e:bigint>>), (a, x) -> case
        when size(a) > 0 and x.s <= element_at(a, -1).e
        then concat(slice(a, 1, size(a) - 1), array(named_struct('s', element_at(a, -1).s, 'e', greatest(element_at(a, -1).e, x.e))))
        else concat(a, array(x)) end)"""
    merged = merged.withColumn("spans", F.expr(fold))
    none = one(keyed, [], False).drop("spans", "items")
    joined = none.join(merged, "_row", "left").drop("_row")
    return joined.withColumn("spans", F.coalesce("spans", F.expr("cast(array() as array<struct<s:bigint,e:bigint>>)"))).withColumn("items", F.coalesce("items", F.expr("cast(array() as array<string>)")))


def contamination(df: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans, items.

    A null or empty text has no words and no hits. A null, empty or wordless item has no windows. Items that repeat
    an id count once; items without an id are one item, named by the empty string. Repeated rows are each returned. An empty benchmark hits nothing. Other columns are ignored.
    """
    found = scan(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), benchmark, n, **options)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
        "spans",
        "items",
    )


def decontaminate(df: DataFrame, benchmark: DataFrame, n: int = 10, remove: str = "documents", text_col: str = "text", **options) -> DataFrame:
    """df without contaminated rows (remove="documents"), or with the hit words cut out of their texts (remove="spans").

    All columns of df stay, whatever their names; nulls, empty texts and repeated rows as in contamination().
    """
    names = df.columns
    inner = ["text" if c == text_col else f"_{i}" for i, c in enumerate(names)]
    plain = df.toDF(*inner)
    found = scan(plain.withColumn("text", F.col("text").cast("string")), benchmark, n, **options)
    if remove == "documents":
        kept = found.where(F.size("items") == 0).drop("n_words", "spans", "items")
    else:

        def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for b, spans in zip(texts(batch), col(batch, "spans").to_pylist(), strict=True):
                if spans:
                    inside = np.frombuffer(b.translate(WORD_BYTES), np.uint8)
                    edge = np.diff(np.concatenate([[0], inside, [0]]).astype(np.int8))
                    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                    at, left = 0, []
                    for x in spans:
                        left.append(b[at : begins[x["s"]]])
                        at = ends[x["e"] - 1]
                    b = b"".join([*left, b[at:]])
                out.append(b)
            arrays = {c: col(batch, c) for c in batch.schema.names if c not in ("n_words", "spans", "items")}
            return out_batch(**arrays | {"text": pa.array(out, pa.binary()).cast(pa.string())})

        kept = arrow_map(found, cut, found.drop("n_words", "spans", "items").schema)
    return kept.select(*inner).toDF(*names)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(stack(spark, sf_dir, "documents"), stack(spark, sf_dir, "benchmark")).drop("spans", "items")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = f"""
with items as (
  select cast(item_id as varchar) as item, {_WORDS} as w from benchmark
), windows as (
  select distinct item, least(len(w), 10) as n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as win
  from (select item, w, unnest(range(1, greatest(len(w) - 8, 2))) as i from items where len(w) > 0)
), docs as (
  select doc_id, {_WORDS} as w from documents
), hits as (
  select distinct doc_id, i, n, item
  from (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as win
        from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from docs cross join (select distinct n from windows)))
  join windows using (n, win)
), words as (
  select doc_id, count(distinct spot) as n_hit from (select doc_id, unnest(range(i, i + n)) as spot from hits) group by doc_id
), found as (
  select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as listed from hits group by doc_id
)
select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(listed, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs d left join words h on d.doc_id = h.doc_id left join found f on d.doc_id = f.doc_id
"""
