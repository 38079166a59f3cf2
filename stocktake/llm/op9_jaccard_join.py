"""N-gram Jaccard join with set-relation skipping: block-skipped index lists, and answers derived from similar sets.

A document's set is its distinct shingles, hashed: runs of 3 words in the query. Sets link when their Jaccard similarity
is 0.9 or more in the query. Both are parameters, the similarity in per cent; all bounds below follow from them.

Index. Sets are put into classes by size so that linked sets are in the same or neighbouring classes. In a class the
universe of shingles is cut, by hash, into one position more than two linked sets of the class can have differing
shingles; so linked sets agree in all of at least one position. An index list holds the sets with the same content at
the same position of the same class. Unlike lists of single shingles, no list grows long because of a passage, line
or phrase that many documents share: a list needs a whole slice of the set, all shingles of a position, to agree.
Positions without shingles are in no list. A set with too few others to be sure of a partner cuts the universe anew, by
another hash, and is listed there too, until a cut fills enough: of two linked sets, the one that stops first is sure to
meet the other. So unrelated sets share no list.

Index-level skipping. A set reaches only the lists of its class and the next, position by position. Where the sets of a
list are to be compared they are cut into blocks, by component and by size; a block's bounds are its sizes and the bits
that all or any of its sets' parity bitmaps have, whose distance never exceeds the sets' difference. A pair of blocks
whose bounds allow no link is passed over, and its sets are never sent.

Answer-level skipping. Of each list only (first set, other set) is verified at first. Sets that link to the first one
share its answer: their component. Lists whose sets then all have one component are skipped; in the others no two
blocks of one component are compared. So no link between different sets is lost, and a group of n similar sets costs
about n verifications, not n squared.

Long lists of unlike sets, such as those of one phrase of a passage that many documents share, are cut anew: their sets
are listed by the positions of a further, independent cut, in which linked sets meet as well, and the lists that gives
take the long one's place. That repeats as long as it leaves a quarter of the pairs or fewer.

Equal sets are one set from the start. Lists are sorted streams over ranges of (list, set): no list is held in memory,
and a long one is in many tasks, whose first sets are joined up. Joins split hot keys.

Disk. The two large shuffles, of the lists' entries and of the blocks' sets, go in passes by the hash of a list or of a pair of
blocks; shuffle files go with the query they are of, and tables on the way when the last query that reads them is done.

What stays quadratic is the number
of pairs of blocks of a list whose sets agree in most slices and yet don't link, a block being BLOCK sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import HOT_KEYS, WordHash, arrow_map, col, lasting, list_array, mix64, out_batch, passing, spread_join, spread_on, stack, staged, texts, tidy

SHINGLE = 3
SIMILARITY = 90  # per cent
BITMAP_WORDS = 16
CUTS = 16  # of the universe, for a set whose shingles lie in few positions
BLOCK = 1024
LONG = 16 * BLOCK  # sets of other components that a set of a list has on average, from which on the list is cut anew
MEMBERS = 256  # sets verified against one copy of a leader's text
BROADCAST_IDS = 300_000
PASSES = 4  # that a large shuffle is cut into: its files on disk at once are a fourth
PASS_ROWS = 250_000  # fewer rows than that are no pass of their own


def shingles(words: list[bytes], known: WordHash, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    k = min(size, n)
    out = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        out = mix64(out + h[j : j + n - k + 1])
    return np.unique(out)


def set_name(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


class Positions:
    """For each class: how many positions its universe is cut into."""

    def __init__(self, similarity: int = SIMILARITY) -> None:
        self.similarity = similarity
        self.step = log(100.08 / similarity)  # over 100 / similarity: linked sets are at most one class apart
        self.cache: dict[int, tuple[int, int]] = {}

    def differ(self, n: int) -> int:
        """In how many shingles two sets that link, with n shingles together, differ at most."""
        return n * (100 - self.similarity) // (100 + self.similarity)

    def of(self, c: int) -> tuple[int, int]:
        if c not in self.cache:
            largest = int(np.exp((c + 1) * self.step)) + 1
            m = self.differ(2 * largest) + 1
            self.cache[c] = m + int(4 * m * exp(-(100 + self.similarity) / (2 * (100 - self.similarity)))), largest  # more than are empty
        return self.cache[c]

    def signatures(self, s: np.ndarray) -> np.ndarray:
        n = len(s)
        own = int(log(n) / self.step + 1e-9)
        out = []
        for c in (own, own + 1):
            m, largest = self.of(c)
            apart = self.differ(n + min(largest, n * 100 // self.similarity))  # positions at most in which a linked set is another
            for k in range(CUTS):
                x = s if not k else mix64(s + np.uint64(k * 0x9E3779B97F4A7C15 % 2**64))
                t = mix64(x)
                low, high = (t & np.uint64(0xFFFFFFFF)).astype(float), (t >> np.uint64(32)).astype(float)
                at = (((x >> np.uint64(20)) & np.uint64(0xFFFFFFFF)) % np.uint64(m)).astype(np.int64)
                part = np.bincount(at, low, m).astype(np.uint64) + (np.bincount(at, high, m).astype(np.uint64) << np.uint64(32))
                filled = np.bincount(at, minlength=m) > 0
                lists = mix64(part ^ mix64(np.arange(m, dtype=np.uint64) + np.uint64((c << 32) + (k << 24))))
                sure = filled.sum() > apart
                out.append(lists[filled] if sure or k < CUTS - 1 else lists)
                if sure:
                    break
        return np.concatenate(out)


def bitmap(s: np.ndarray) -> np.ndarray:
    """Parities of the counts of shingles in 64 * BITMAP_WORDS cells."""
    cells = np.bincount((s & np.uint64(64 * BITMAP_WORDS - 1)).astype(np.int64), minlength=64 * BITMAP_WORDS) & 1
    return np.packbits(cells.astype(np.uint8)).view(np.int64)


def sets_of(df: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """(id, n, set, bits, lists) of each row of (id, text); lists is empty where there is no id or the task saw the set before."""
    known, positions, seen = WordHash(), Positions(similarity), set()

    def look(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, name, bits, lists, sizes = [], [], [], [], []
        for b, named in zip(texts(batch), col(batch, "id").is_valid().to_pylist(), strict=True):
            s = shingles(b.lower().split(), known, shingle)
            n.append(len(s))
            if not len(s):
                name.append(None)
                bits.append(np.zeros(BITMAP_WORDS, np.int64))
                sizes.append(0)
                continue
            k = set_name(s)
            name.append(k)
            bits.append(bitmap(s))
            if k in seen or not named:
                sizes.append(0)
            else:
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(k)
                lists.append(positions.signatures(s))
                sizes.append(len(lists[-1]))
        flat = np.concatenate(lists).view(np.int64) if lists else np.zeros(0, np.int64)
        return out_batch(
            id=col(batch, "id"),
            n=pa.array(n, pa.int64()),
            set=pa.array(name, pa.int64()),
            bits=list_array(pa.array(np.concatenate(bits)), [BITMAP_WORDS] * len(bits)),
            lists=list_array(pa.array(flat), sizes),
        )

    schema = T.StructType([df.schema["id"], *T._parse_datatype_string("n long, set long, bits array<long>, lists array<long>").fields])
    return arrow_map(df.select("id", "text"), look, schema)


def passes_of(rows: int | None) -> int:
    """How many passes a shuffle of so many rows goes in."""
    return min(PASSES, 1 + (rows or 0) // PASS_ROWS)


def first_pairs(sets: DataFrame, passes: int = 1) -> DataFrame:
    """(list, first, other): each set of an index list of two sets or more, with a first set of the list.

    A list that lies in several ranges has a first set in each, and pairs of the first of all with these. Each pass has its share of the lists.
    """

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = last_list = first = last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ls, st = (col(batch, c).to_numpy() for c in ("list", "set"))
            start = np.empty(len(ls), bool)
            start[1:] = ls[1:] != ls[:-1]
            start[0] = last_list is None or ls[0] != last_list
            fresh = np.empty(len(ls), bool)
            fresh[1:] = st[1:] != st[:-1]
            fresh[0] = last is None or st[0] != last
            at = np.maximum.accumulate(np.where(start, np.arange(len(ls)), -1))
            leads = np.where(at >= 0, st[at], first if first is not None else 0)
            keep = ~start & fresh
            if head is None:
                head = ls[0]
                yield ends(ls[0], st[0])
            last_list, last, first = ls[-1], st[-1], leads[-1]
            if keep.any():
                yield out_batch(list=ls[keep], first=leads[keep], other=st[keep])
        if last_list != head:
            yield ends(last_list, first)

    def ends(name: int, first: int) -> pa.RecordBatch:
        """A range's first and last list can go on in others: its first set, without another."""
        return out_batch(list=pa.array([name], pa.int64()), first=pa.array([first], pa.int64()), other=pa.array([None], pa.int64()))

    entries = sets.select(F.explode("lists").alias("list"), "set")
    found = None
    for i in range(passes):
        spread = entries.where(F.pmod("list", F.lit(passes)) == i).repartitionByRange("list", "set").sortWithinPartitions("list", "set")
        part = lasting(spread.mapInArrow(tidy(stream), "list long, first long, other long"), "list-pairs")
        found = part if found is None else found.unionByName(part)
    open_ = found.where("other is null").select("list", F.col("first").alias("other")).distinct()  # two for each range
    firsts = open_.groupBy("list").agg(F.min("other").alias("first"))
    return found.where("other is not null").unionByName(lasting(open_.join(firsts, "list").where("first <> other").select("list", "first", "other"), "list-ends"))


def may_link(a: str, b: str, similarity: int = SIMILARITY) -> F.Column:
    """Sizes and bitmaps of two sets (columns n and bits of a and b) allow a link."""
    n1, n2 = F.col(f"{a}.n"), F.col(f"{b}.n")
    apart = F.expr(f"aggregate(zip_with({a}.bits, {b}.bits, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)")
    return (100 * F.least(n1, n2) >= similarity * F.greatest(n1, n2)) & ((100 + similarity) * apart <= (100 - similarity) * (n1 + n2))


def linked(pairs: DataFrame, docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """The pairs (a, b: document ids) of pairs (a, sa, b, sb), with the names of their sets, whose sets link.

    A text meets only the pairs it is in; many pairs of one a are split. Of several texts with one id the one with the set is taken.
    """
    keyed = spread_on(pairs, pairs.groupBy("a").agg(F.count(F.lit(1)).alias("_n")), "a")
    keyed = keyed.select("a", "sa", "b", "sb", F.pmod(F.xxhash64("b"), F.floor(F.col("_n") / MEMBERS) + 1).alias("part"))
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    needed = docs.join(F.broadcast(ids), "id", "left_semi") if few else staged(docs.join(ids, "id", "left_semi"), "needed")
    none = F.lit(None).cast("long")
    heads = keyed.select("a", "sa", "part").distinct().join(needed, F.col("a") == F.col("id")).select("a", "sa", "part", none.alias("b"), none.alias("sb"), "text")
    tails = keyed.join(needed, F.col("b") == F.col("id")).select("a", "sa", "part", "b", "sb", "text")
    rows = heads.unionByName(tails).repartition("a", "sa", "part").sortWithinPartitions("a", "sa", "part", F.col("b").asc_nulls_first())
    known = WordHash()

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = key = done = None
        for batch in batches:
            found_a, found_b = [], []
            for a, sa, b, sb, text in zip(*(col(batch, c).to_pylist() for c in ("a", "sa", "b", "sb")), texts(batch), strict=True):
                if b is not None and (a, sa, b, sb) == done:
                    continue
                s = shingles(text.lower().split(), known, shingle)
                if set_name(s) != (sa if b is None else sb):
                    continue
                if b is None:
                    head, key = s, (a, sa)
                    continue
                done = a, sa, b, sb
                if key != (a, sa):
                    raise ValueError("a pair without its first text")
                both = len(np.intersect1d(head, s, assume_unique=True))
                if 100 * both >= similarity * (len(head) + len(s) - both):
                    found_a.append(a)
                    found_b.append(b)
            if found_a:
                yield out_batch(a=pa.array(found_a, pa.int64()), b=pa.array(found_b, pa.int64()))

    return rows.mapInArrow(tidy(stream), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each id of the links reaches. Labels sink along links and through labels."""
    edges = staged(links.select("a", "b").union(links.select("b", "a")).toDF("a", "b"), "links")
    labels = staged(edges.groupBy("a").agg(F.min("b").alias("l")).select(F.col("a").alias("id"), F.least("a", "l").alias("component")), "labels")
    few = labels.count() <= BROADCAST_IDS
    meet = (lambda left, right, key: left.join(F.broadcast(right), key)) if few else spread_on
    while True:
        seen = meet(edges, labels.select(F.col("id").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("l"))
        sunk = labels.join(seen, F.col("id") == F.col("a")).select("id", F.least("component", "l").alias("near"), F.col("component").alias("was"))
        sunk = sunk if few else staged(sunk, "labels-near")
        far = labels.select(F.col("id").alias("near"), F.col("component").alias("_far"))
        new = staged(meet(sunk, far, "near").select("id", F.least("near", "_far").alias("component"), "was"), "labels")
        if not new.where("component < was").limit(1).count():
            return new.select("id", "component")
        labels = new.select("id", "component")


def block_pairs(members: DataFrame, similarity: int) -> DataFrame:
    """(list, lo, hi, held): pairs of blocks of a list, or a block and itself, that may hold a link between components, and how many sets to send.

    members: (list, block, component, n, bits). Bounds of a block: its sizes, the bits that all and that any of its sets have.
    """
    word = lambda i: F.col("bits")[i]
    bounds = members.groupBy("list", "block").agg(
        F.count(F.lit(1)).alias("k"),
        F.min("n").alias("least"),
        F.max("n").alias("most"),
        F.min("component").alias("from"),
        F.max("component").alias("to"),
        F.array(*[F.bit_and(word(i)) for i in range(BITMAP_WORDS)]).alias("all_have"),
        F.array(*[F.bit_or(word(i)) for i in range(BITMAP_WORDS)]).alias("any_has"),
    )
    bounds = staged(bounds, "block-bounds")
    p, q = bounds.alias("p"), bounds.alias("q")
    apart = F.expr(
        """aggregate(zip_with(zip_with(p.all_have, q.any_has, (x, y) -> x & ~y), zip_with(q.all_have, p.any_has, (x, y) -> x & ~y), (x, y) -> bit_count(x | y)), 0, (s, x) -> s + x)"""
    )
    fits = (100 * F.col("p.most") >= similarity * F.col("q.least")) & (100 * F.col("q.most") >= similarity * F.col("p.least"))
    near = (100 + similarity) * apart <= (100 - similarity) * (F.col("p.most") + F.col("q.most"))
    several = F.least("p.from", "q.from") < F.greatest("p.to", "q.to")
    both = p.join(q, (F.col("p.list") == F.col("q.list")) & (F.col("p.block") <= F.col("q.block"))).where(several & fits & near)
    held = F.when(F.col("p.block") == F.col("q.block"), F.col("p.k")).otherwise(F.col("p.k") + F.col("q.k"))
    return both.select(F.col("p.list").alias("list"), F.col("p.block").alias("lo"), F.col("q.block").alias("hi"), held.alias("held"))


def further_cut(sets: DataFrame, docs: DataFrame, level: int, shingle: int, similarity: int) -> DataFrame:
    """(set, subs): the lists of each of the sets (id, set) in a cut of the universe that no other level has."""
    few = sets.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    known, positions = WordHash(), Positions(similarity)
    salt = np.uint64(level * 0xD1B54A32D192ED03 % 2**64)

    def look(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, lists = [], []
        for name, text in zip(col(batch, "set").to_pylist(), texts(batch), strict=True):
            s = shingles(text.lower().split(), known, shingle)
            if set_name(s) == name:
                names.append(name)
                lists.append(positions.signatures(mix64(s + salt)))
        flat = np.concatenate([np.zeros(0, np.uint64), *lists]).view(np.int64)
        return out_batch(set=pa.array(names, pa.int64()), subs=list_array(pa.array(flat), [len(x) for x in lists]))

    rows = docs.join(F.broadcast(sets) if few else sets, "id").select("set", "text")
    return arrow_map(rows, look, "set long, subs array<long>").dropDuplicates(["set"])


def unlike(groups: DataFrame) -> DataFrame:
    """(list, held, cross): the sets of each list, and its pairs of sets of different components, counted both ways. groups: (list, component, k)."""
    k = F.col("k").cast("double")
    return groups.groupBy("list").agg(F.sum("k").alias("held"), (F.sum(k) * F.sum(k) - F.sum(k * k)).alias("cross"))


def recut(placed: DataFrame, docs: DataFrame, shingle: int, similarity: int) -> DataFrame:
    """placed with its long lists cut anew, as often as that pays: the sets of a list that link share a list of the result.

    placed: (list, set, n, bits, id, component), staged. Lists whose sets differ in too little for a cut to part them stay.
    """
    done, level = None, 0
    both = lambda x, y: y if x is None else x.unionByName(y)
    while True:
        level += 1
        lists = staged(unlike(placed.groupBy("list", "component").agg(F.count(F.lit(1)).alias("k"))), "list-sizes")
        long_ = F.col("cross") > LONG * F.col("held")
        if not lists.where(long_).limit(1).count():
            return both(done, placed)
        each = staged(spread_join(placed, lists, ["list"], F.col("held") > placed.count() // HOT_KEYS), "list-members")
        members = each.where(long_)
        sets = staged(members.select("id", "set").distinct(), "long-sets")
        cut = staged(further_cut(sets, docs, level, shingle, similarity), "further-cut")
        entries = members.select("list", "set", "component").join(cut, "set").select("list", "set", "component", F.explode("subs").alias("sub"))
        entries = staged(entries.withColumn("new", F.xxhash64("list", "sub")).drop("sub"), "further-lists")
        groups = entries.groupBy("list", "new", "component").agg(F.count(F.lit(1)).alias("k"))
        of = groups.groupBy("new").agg(F.first("list").alias("of"))
        sizes = staged(unlike(groups.drop("list").withColumnRenamed("new", "list")).withColumnRenamed("list", "new").where("cross > 0").join(of, "new"), "further-sizes")
        after = sizes.groupBy(F.col("of").alias("list")).agg(F.sum("cross").alias("after"))
        judged = lists.where(long_).join(after, "list", "left").select("list", "held", (4 * F.coalesce("after", F.lit(0.0)) <= F.col("cross")).alias("pays"))
        judged = staged(judged, "lists-judged")
        stay = spread_join(members.drop("held", "cross"), judged.where("not pays"), ["list"], F.col("held") > members.count() // HOT_KEYS)
        done = both(done, staged(each.where(~long_).select(placed.columns).unionByName(stay.select(placed.columns)), "lists-done"))
        better = sizes.join(judged.where("pays").select(F.col("list").alias("of")), "of", "left_semi").select("new", F.col("held").alias("in_new"))
        known = members.select("set", "n", "bits", "id", "component").dropDuplicates(["set"])
        parts = spread_join(entries.select("new", "set"), better, ["new"], F.col("in_new") > entries.count() // HOT_KEYS)
        placed = staged(parts.join(known, "set").withColumnRenamed("new", "list").select(placed.columns), "lists-cut")


def unresolved_pairs(pairs: DataFrame, info: DataFrame, docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """(a, sa, b, sb): pairs of sets of different components in one index list that size and bitmap let through.

    info: (set, n, bits, id, component). Long lists are cut anew. Blocks hold about BLOCK sets, of one component if it has as many in the list,
    else of about one size; a pair of blocks that block_pairs() lets through is a unit of work.
    """
    comp = info.select("set", "component")
    with_first = spread_on(pairs, comp.toDF("first", "c1"), "first")
    open_lists = staged(with_first.join(comp.toDF("other", "c2"), "other").where("c1 <> c2").select("list").distinct(), "open-lists")
    inside = staged(spread_on(pairs, open_lists, "list"), "open-pairs")
    members = inside.select("list", F.col("other").alias("set")).union(inside.select("list", "first")).distinct()
    placed = recut(staged(members.join(info, "set"), "open-members"), docs, shingle, similarity)
    groups = placed.groupBy("list", "component").agg(F.count(F.lit(1)).alias("_of"))
    small = groups.where(F.col("_of") < BLOCK).groupBy("list").agg(F.sum("_of").alias("_small"))
    groups = staged(groups.join(small, "list", "left").na.fill(0, ["_small"]), "open-groups")
    each = spread_join(placed, groups, ["list", "component"], F.col("_of") > placed.count() // HOT_KEYS)
    sizes = F.floor(F.log("n") * (4 / log(100 / similarity)))
    own = F.xxhash64("component", F.pmod(F.xxhash64("set"), F.ceil(F.col("_of") / BLOCK)))
    pool = F.xxhash64(F.lit("pool"), sizes, F.pmod(F.xxhash64("set"), F.ceil(F.col("_small") / BLOCK)))
    blocked = each.withColumn("block", F.when(F.col("_of") >= BLOCK, own).otherwise(pool))
    blocked = staged(blocked.select("list", "block", "set", "n", "bits", "id", "component"), "open-blocks")
    every = staged(block_pairs(blocked, similarity), "block-pairs")

    def compare(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
        rows.sort(key=lambda r: r["n"])
        bits = np.array([r["bits"] for r in rows], np.int64).view(np.uint64)
        n, ids, names, comp, own = (np.array([r[c] for r in rows]) for c in ("n", "id", "set", "component", "block"))
        crossed = rows[0]["lo"] != rows[0]["hi"]
        found = [np.zeros((4, 0), np.int64)]
        for i in range(len(rows) - 1):
            end = np.searchsorted(n, n[i] * 100 // similarity, "right")  # sets beyond are too large to link
            j = np.arange(i + 1, end)
            j = j[(comp[j] != comp[i]) & ((own[j] != own[i]) | (not crossed))]
            if len(j):
                apart = np.bitwise_count(bits[j] ^ bits[i]).sum(1)
                j = j[(100 + similarity) * apart.astype(np.int64) <= (100 - similarity) * (n[j] + n[i])]
                less = ids[i] < ids[j]
                a, b = np.where(less, i, j), np.where(less, j, i)
                found.append(np.stack([ids[a], names[a], ids[b], names[b]]))
        return np.concatenate(found, 1)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            made = []
            for r in batch.to_pylist():
                k = r["list"], r["lo"], r["hi"]
                if k != key and held:
                    made.append(compare(held))
                    held = []
                key = k
                held.append(r)
            if made:
                yield out_batch(**dict(zip(("a", "sa", "b", "sb"), np.concatenate(made, 1), strict=True)))
        if held:
            yield out_batch(**dict(zip(("a", "sa", "b", "sb"), compare(held), strict=True)))

    found, passes = None, passes_of(every.agg(F.sum("held")).first()[0])
    for i in range(passes):
        units = every.where(F.pmod(F.xxhash64("list", "lo", "hi"), F.lit(passes)) == i)
        sides = units.select("list", F.col("lo").alias("block"), "lo", "hi").union(units.where("lo <> hi").select("list", F.col("hi").alias("block"), "lo", "hi"))
        rows = blocked.join(sides, ["list", "block"]).repartition("list", "lo", "hi").sortWithinPartitions("list", "lo", "hi")
        part = staged(rows.mapInArrow(tidy(stream), "a long, sa long, b long, sb long").where("a < b").distinct(), "late-pairs")
        found = part if found is None else found.unionByName(part)
    return found.distinct()


def similar_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (the smallest doc_id reachable by links).

    shingle: words in a shingle; similarity: the least Jaccard similarity of a link, in per cent, 1 to 99. A text without
    words, or null, has an empty set and links with nothing. A row without an id links with nothing and has no
    component. Rows that repeat an id each have the component of the smallest id that has their set; equal rows have equal results. An
    empty table gives an empty result. Other columns are ignored. Ids are integers.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    spark = df.sparkSession
    with passing(spark):
        with passing(spark):
            listed = staged(sets_of(docs, shingle, similarity), "set-lists")
            sets = lasting(listed.select("id", "n", "set", "bits"), "sets")
            whole = sets.where("set is not null and id is not null")
            pairs = first_pairs(listed.where("set is not null and id is not null"), passes_of(whole.agg(F.sum("n")).first()[0]))
        own = lasting(with_components(whole, pairs, docs, shingle, similarity), "components")
        bare = lasting(sets.where("set is null or id is null").select("id", "n", F.col("id").alias("component")), "unlinked")
    found = own.unionByName(bare)
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def with_components(whole: DataFrame, pairs: DataFrame, docs: DataFrame, shingle: int, similarity: int) -> DataFrame:
    """(id, n, component) of each row of whole (id, n, set, bits), which has a set and an id; pairs: first_pairs() of them."""
    info = staged(whole.groupBy("set").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("bits").alias("bits")), "distinct-sets")
    once = staged(pairs.select("first", "other").distinct(), "first-pairs")
    named = lambda x, key: info.select(F.col("set").alias(key), F.col("id").alias(f"{x}_id"), F.struct("n", "bits").alias(x))
    some = spread_on(once, named("p", "first"), "first").join(named("q", "other"), "other").where(may_link("p", "q", similarity))
    less = F.col("p_id") < F.col("q_id")
    ends = [F.when(less, x).otherwise(y).alias(c) for c, x, y in (("a", F.col("p_id"), F.col("q_id")), ("sa", F.col("first"), F.col("other")), ("b", F.col("q_id"), F.col("p_id")), ("sb", F.col("other"), F.col("first")))]
    some = staged(some.select(*ends).where("a < b").distinct(), "candidates")
    links = staged(linked(some, docs, shingle, similarity), "verified")
    groups = components(links)
    known = info.join(groups, "id", "left").withColumn("component", F.coalesce("component", "id"))
    more = staged(unresolved_pairs(pairs, known, docs, shingle, similarity).join(some, ["a", "sa", "b", "sb"], "left_anti"), "late-candidates")
    if more.limit(1).count():
        late = staged(linked(more, docs, shingle, similarity), "late-verified")
        groups = components(links.unionByName(late))
        known = info.join(groups, "id", "left").withColumn("component", F.coalesce("component", "id"))
    return spread_on(whole.select("id", "n", "set"), known.select("set", "component"), "set").select("id", "n", "component")


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """df with one document of each group of linked documents: the one with the smallest id. Rows without an id stay."""
    with passing(df.sparkSession):
        groups = similar_groups(df, id_col, text_col, shingle, similarity)
        gone = lasting(groups.where("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct(), "copies")
    few = gone.count() <= BROADCAST_IDS
    return df.join(F.broadcast(gone) if few else gone, df[id_col].cast("long") == gone["_gone"], "left_anti")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(stack(spark, sf_dir, "documents"))


SQL = r"""
with recursive docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), shingles as (
  select distinct doc_id, s from (
    select doc_id, array_to_string(w[i:i + 2], ' ') as s from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) as i from docs where len(w) > 0))
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), links as (
  select a.doc_id as a, b.doc_id as b
  from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= 90 * (x.n + y.n - count(*))
), reach(a, b) as (
  select doc_id, doc_id from docs union select r.a, l.b from reach r join links l on r.b = l.a
)
select d.doc_id, coalesce(n, 0) as n_shingles, c.component_id
from docs d left join sizes s on d.doc_id = s.doc_id join (select a, min(b) as component_id from reach group by a) c on d.doc_id = c.a
"""
