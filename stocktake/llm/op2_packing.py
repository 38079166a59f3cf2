"""Packing by cutting-stock column generation.

Documents are tokenised once; a document longer than a sequence is cut into full sequences and a rest. The rests are
counted in a histogram of their lengths: at most `capacity` numbers, whatever the size of the corpus. On it the driver
solves the linear program of cutting stock by column generation: a pattern says how many rests of each length share a
sequence. The first columns are those of a fractional largest-first packing, each of which uses up one length, so they
are a triangular basis, whose inverse follows by substitution. Dynamic programming over the knapsack then finds the
patterns that the prices undervalue most, and they enter. Prices are smoothed towards those of the best bound so far, at first
a rest's share of a sequence, as they would swing without that: so many programs are as good as the bound by volume. It ends at the optimum, or when no
whole sequence is to be gained any more. Then patterns are used as often as the solution rounded down says, and the
rests that remain, a few for each pattern, are placed largest first.

`effort` bounds the knapsacks, and the columns that enter, times the lengths there are. Every solution on the
way holds all rests, so beyond it the plan is only less tight, not less whole; planned() says what happened: how many
columns entered, the bound, and whether plain largest-first packing needed fewer sequences and was taken instead.
The driver holds the histogram and one number for each pair of lengths. It calls no linear algebra library: threads of such a
library don't survive in every process that has started a Spark session.

Every rest then finds its place by arithmetic: it is ranked within its length (two_level_rank: no length, however
common, meets in one task) and a table, with some rows for each pattern, says which ranks of a length belong to which sequences.
"""

from __future__ import annotations

import logging
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, col, list_array, out_batch, stack, staged, tidy, two_level_rank
from .tokenizing import chunk_ids, public_path

CAPACITY = 4096
#: The end id that closes each document, as little-endian bytes.
END = (2).to_bytes(4, "little")


def pieces(df: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): full sequences and a rest for each row of (doc_id, text)."""

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = chunk_ids(path)
        at, start, length, crc, total, ids = [], [], [], [], [], []
        for i, text in enumerate(col(batch, "text").to_pylist()):
            b = known.of(text or "") + END
            for lo in range(0, len(b), 4 * capacity):
                x = b[lo : lo + 4 * capacity]
                at.append(i)
                start.append(lo // 4)
                length.append(len(x) // 4)
                crc.append(zlib.crc32(x))
                total.append(len(b) // 4)
                if keep_ids:
                    ids.append(x)
        longs = {k: pa.array(v, pa.int64()) for k, v in {"start": start, "length": length, "ids_crc32": crc, "doc_tokens": total}.items()}
        more = {"ids": list_array(pa.array(np.frombuffer(b"".join(ids), "<i4")), length)} if keep_ids else {}
        return out_batch(doc_id=col(batch, "doc_id").take(pa.array(at, pa.int64())), **longs, **more)

    fields = "start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * keep_ids
    schema = T.StructType([df.schema["doc_id"], *T._parse_datatype_string(fields).fields])
    return arrow_map(df.select("doc_id", "text"), cut, schema)


def best_pattern(prices: np.ndarray, sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """By dynamic programming over the knapsack: the highest value within each room up to this one, and the last rest (or -1) of a pattern that has it."""
    best, took = np.zeros(room + 1), np.full(room + 1, -1)
    fits = np.searchsorted(sizes, np.arange(room + 1), "right").tolist()
    for c in range(int(sizes[0]), room + 1):
        v = best[c - sizes[: fits[c]]] + prices[: fits[c]]
        k = int(v.argmax())
        if v[k] > best[c - 1]:
            best[c], took[c] = v[k], k
        else:
            best[c] = best[c - 1]
    return best, took


def pattern_of(took: np.ndarray, sizes: np.ndarray, room: int) -> Counter:
    """The pattern that best_pattern() found for a room."""
    use: Counter = Counter()
    while room > 0:
        if took[room] < 0:
            room -= 1
        else:
            use[int(took[room])] += 1
            room -= int(sizes[took[room]])
    return use


def fill(active: list[int], left: dict[int, float], room: int) -> Counter:
    """The largest of the active sizes (rising) that fit, as many as are left."""
    use, free, hi = Counter(), room, len(active)
    while hi := bisect_right(active, free, 0, hi):
        s = active[hi - 1]
        use[s] = min(max(1, int(left[s])), free // s)
        free -= use[s] * s
        hi -= 1
    return use


def greedy(left: dict[int, int], room: int) -> list[tuple[Counter, int]]:
    """Sequences for all of left, largest rests first: a pattern is filled with the largest that fit and used while they last."""
    left = {s: n for s, n in left.items() if n > 0}
    active = sorted(left)
    made = []
    while active:
        use = fill(active, left, room)
        times = min(left[s] // n for s, n in use.items())
        made.append((use, times))
        for s, n in use.items():
            left[s] -= n * times
        active = [s for s in active if left[s]]
    return made


def first_basis(sizes: np.ndarray, demand: np.ndarray, room: int) -> tuple[list[Counter], np.ndarray, np.ndarray]:
    """Patterns (of indexes of sizes), how often each is used, and the basis' inverse: largest first, a pattern being used until one size, its own, is gone."""
    left = {int(s): float(n) for s, n in zip(sizes, demand, strict=True)}
    index = {int(s): i for i, s in enumerate(sizes)}
    active = [int(s) for s in sizes]
    patterns: list[Counter] = [Counter()] * len(sizes)
    x, inverse = np.zeros(len(sizes)), np.eye(len(sizes))
    while active:
        use = fill(active, left, room)
        own = min(use, key=lambda s: left[s] / use[s])
        times = left[own] / use[own]
        for s, n in use.items():
            left[s] = max(0.0, left[s] - n * times)
        active.remove(own)
        at = index[own]
        patterns[at], x[at] = Counter({index[s]: n for s, n in use.items()}), times
        inverse[at] /= use[own]
        for s, n in use.items():  # a pattern's other sizes are used up later: their rows aren't final yet
            if s != own:
                inverse[index[s]] -= n * inverse[at]
    return patterns, x, inverse


ROWS = 256  # of the inverse that are changed at once
BATCH = 8  # patterns that one knapsack gives at most
SMOOTH = 0.5


@dataclass
class Plan:
    """made: patterns (size: how many) and how many sequences follow each. origin: 'columns', where column generation got
    to the optimum or no whole sequence was to be gained; 'effort', where it ended at that bound; 'largest first', where
    that needed fewer sequences than the rounded solution. entered: columns that entered the first basis; bound: fewer
    sequences than that are impossible."""

    made: list[tuple[Counter, int]]
    origin: str
    entered: int = 0
    bound: float = 0.0


def solve(sizes: np.ndarray, demand: np.ndarray, room: int, rounds: int) -> tuple[list[tuple[Counter, float]], bool, int, float]:
    """Of the linear program min sum(x), pattern counts @ x = demand: patterns (of indexes of sizes) and how often each is used, whether that is done, columns entered, bound.

    Revised simplex: of the patterns that a knapsack finds, those enter that prices make worth over 1. Any prices give
    the bound demand @ prices / value of the best pattern.
    """
    patterns, x, inverse = first_basis(sizes, demand, room)
    prices = inverse.sum(0)
    centre, bound = sizes / room, float((demand * sizes).sum()) / room
    smooth, entered, done = SMOOTH, 0, False
    for at in range(rounds + 1):
        asked = smooth * centre + (1 - smooth) * prices
        best, took = best_pattern(asked, sizes, room)
        if (low := float((demand * asked).sum()) / best[room]) > bound:
            centre, bound = asked / best[room], low
        done = bool(smooth == 0 and best[room] <= 1 + 1e-9 or at and ceil(x.sum() - 1e-6) <= ceil(bound - 1e-6))
        if done or at == rounds or entered >= rounds:
            break
        before = entered
        for k in np.argsort(-(asked + best[room - sizes]), kind="stable")[:BATCH]:
            use = pattern_of(took, sizes, room - int(sizes[k]))
            use[int(k)] += 1
            which, n = np.array(list(use)), np.array(list(use.values()), float)
            gain = float((prices[which] * n).sum()) - 1
            d = (inverse[:, which] * n).sum(1)
            ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
            out = int(ratio.argmin())
            if gain <= 1e-9 or not np.isfinite(ratio[out]) or entered >= rounds:
                continue
            x = np.maximum(x - ratio[out] * d, 0)
            x[out] = ratio[out]
            row = inverse[out] / d[out]
            prices = prices - gain * row
            changed = np.flatnonzero(d)
            for lo in range(0, len(changed), ROWS):
                part = changed[lo : lo + ROWS]
                inverse[part] -= d[part, None] * row
            inverse[out] = row
            patterns[out] = use
            entered += 1
        smooth = SMOOTH if entered > before else 0 if smooth < 0.3 else smooth / 2
    return [(p, float(v)) for p, v in zip(patterns, x, strict=True) if v > 0], done, entered, bound


def planned(histogram: dict[int, int], room: int, effort: int = 600_000) -> Plan:
    """Patterns that hold the histogram exactly, and where they are from."""
    left = {int(s): int(n) for s, n in histogram.items() if n > 0}
    if not left:
        return Plan([], "columns")
    sizes = np.array(sorted(left), np.int64)
    first = greedy(left, room)
    made: list[tuple[Counter, int]] = []
    solution, done, entered, bound = solve(sizes, np.array([left[int(s)] for s in sizes], float), room, effort // len(sizes))
    for use, x in sorted(solution, key=lambda y: -y[1]):
        p = Counter({int(sizes[i]): n for i, n in use.items()})
        times = min([int(x + 1e-6), *(left[s] // n for s, n in p.items())])
        if times > 0:
            made.append((p, times))
            for s, n in p.items():
                left[s] -= n * times
    made += greedy(left, room)  # what rounding left over: at most a few rests for each pattern
    total = lambda x: sum(t for _, t in x)
    if total(first) < total(made):
        return Plan(first, "largest first", entered, bound)
    return Plan(made, "columns" if done else "effort", entered, bound)


def plan(histogram: dict[int, int], room: int, effort: int = 600_000) -> tuple[list[tuple[Counter, int]], str]:
    """made and origin of planned()."""
    p = planned(histogram, room, effort)
    return p.made, p.origin


def place(cut: DataFrame, capacity: int = CAPACITY, effort: int = 600_000) -> DataFrame:
    """cut (staged pieces) with sequence_id and offset."""
    histogram = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}  # at most `capacity` rows
    rows, sequence = [], 0
    reached: Counter = Counter()
    p = planned(histogram, capacity, effort)
    for use, times in p.made:
        slot = 0
        for s, n in sorted(use.items(), reverse=True):
            rows.append((s, reached[s], n, sequence, slot))
            reached[s] += n * times
            slot += n
        sequence += times
    logging.getLogger(__name__).info("%d sequences by %s, %d columns entered, bound %.1f", sequence, p.origin, p.entered, p.bound)
    size, start, each, first, slots = np.array(sorted(rows), np.int64).reshape(-1, 5).T
    # some rows for each pattern, of which there are about as many as lengths
    table = cut.sparkSession.sparkContext.broadcast(((size << 44) + start, start, each, first, slots))
    buckets = max(16, min(1 << 16, sum(histogram.values()) // 4096))
    keyed = cut.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "doc_tokens"), F.lit(buckets)).cast("int"))
    ranked = two_level_rank(keyed, ["length"], "_bucket", ["doc_id", "start", "ids_crc32", "doc_tokens"], "_rank").drop("_bucket")

    names = cut.columns

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, start, each, first, slots = table.value
        for batch in batches:
            if batch.num_rows:
                rank = col(batch, "_rank").to_numpy()
                k = np.searchsorted(key, (col(batch, "length").to_numpy() << 44) + rank, "right") - 1
                by = rank - start[k]
                arrays = {c: col(batch, c) for c in names}
                yield out_batch(**arrays, sequence_id=pa.array(first[k] + by // each[k]), _slot=pa.array(slots[k] + by % each[k]))

    schema = T.StructType([*ranked.select(*names).schema.fields, *T._parse_datatype_string("sequence_id long, _slot long").fields])
    found = ranked.mapInArrow(tidy(look), schema)
    before = W.partitionBy("sequence_id").orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    return found.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).select(*names, "sequence_id", "offset")


def pack(df: DataFrame, path: str | None = None, capacity: int = CAPACITY, effort: int = 600_000, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, if asked for).

    A null or empty text is the end id alone. Repeated rows are packed as often as they come. An empty table gives an
    empty result. Sequences are to be padded to capacity; sequence ids run from 0 without gaps. effort is
    that of planned(). Other columns of df are ignored.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return place(staged(pieces(rows, path or public_path("word_bpe_49k.json"), capacity, keep_ids), "pieces"), capacity, effort)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(stack(spark, sf_dir, "documents"))


#: SQL has no tokenizer; tests check the exact round trip of every document.
SQL = None
