"""SimHash near-dedup by a Gray-order hierarchical index.

A text's fingerprint has a bit where over half of its shingles' hashes have it. Fingerprints link that differ in at most
`reach` bits; equal ones are one entry from the start.

Order. Entries are sorted by Gray rank, the place of a fingerprint in the Gray code: neighbours differ in few bits, and
what is consecutive shares a prefix and mostly more. They are dealt out by ranges and cut into blocks.

Hierarchy. Over a block's entries stand nodes of FAN neighbours each, over these nodes of FAN nodes, up to the block. A node
has the mask of the bits that all below it share, and their pattern. Masks grow on the way down, so two nodes' differences
in bits that both share add up along it: once they exceed the reach, no entry below one can link to any below the other, and
both groups are passed over as wholes. All blocks' masks and patterns, the uppermost nodes, are broadcast: at most BLOCKS
of them. A block is sent only where its node may link, and of its entries only those that may link to the other node.

Half the reach. Fingerprints within reach differ in at most half as many bits in the first or in the second half. So there
are two indexes, the second over fingerprints with their halves swapped, and each only follows pairs with at most half the
reach in the first 32 bits. A fingerprint then meets some d * d / 2 of 2**d nodes at depth d, not d ** 4 / 24.

Groups of near copies would make links with the square of their size. Neighbours in Gray order are compared first; of nodes all of
whose entries are in one component already, no pair is looked at, and a link is told only if it joins two components of
the task. Blocks meet in groups of (block, run of SENDERS others), streamed: a task holds two blocks at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ROWS_PER_RANGE, arrow_map, col, out_batch, spread_on, stack, staged, texts, tidy
from .op9_jaccard_join import components

SHINGLE = 4
REACH = 4  # bits
SEED = 42
FAN = 4
BLOCK = 1 << 15  # entries of a block at least, where there are so many
BLOCKS = 1 << 16  # blocks at most, but for one more for each range
SENDERS = 16
PAIRS = 1 << 12  # pairs of nodes that are opened at once
ROUND = 1 << 16  # shingles of a text that are counted at once


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text, as an unsigned number; zero without words."""
    words = text.lower().split()  # of bytes: A-Z and the six ASCII blanks
    n = len(words)
    if not n:
        return 0
    k = min(shingle, n)
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: n - k + 1].tolist()
    ends = ends[k - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for lo in range(0, len(starts), ROUND):
        part = zip(starts[lo : lo + ROUND], ends[lo : lo + ROUND], strict=True)
        h = np.array([digest(whole[a:b], SEED) for a, b in part], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n - k + 1, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(id, fp) of each row of (id, text); fp is the fingerprint's bits as a signed long."""

    def look(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, shingle) for t in texts(batch)], np.uint64)
        return out_batch(id=col(batch, "id"), fp=fps.view(np.int64))

    return arrow_map(df, look, "id long, fp long")


def gray_rank(key: Column) -> Column:
    """The rank of a 64-bit code in Gray order, moved so that signed longs sort like unsigned ones."""
    for s in (1, 2, 4, 8, 16, 32):
        key = key.bitwiseXOR(F.shiftrightunsigned(key, s))
    return key.bitwiseXOR(F.lit(-(1 << 63)))


def may_link(p: np.ndarray, q: np.ndarray, mask: np.ndarray, reach: int) -> np.ndarray:
    """Whether patterns differ, in the bits of mask, by at most reach, and by at most half of it in the first half."""
    x = (p ^ q) & mask
    return (np.bitwise_count(x) <= reach) & (np.bitwise_count(x >> np.uint64(32)) <= reach // 2)


class Tree:
    """The nodes over a block's entries, which are sorted by Gray rank. levels[0] are the entries, the last level is one node."""

    def __init__(self, keys: np.ndarray, height: int) -> None:
        self.keys = keys
        self.levels = [(keys, np.full(len(keys), ~np.uint64(0)))]
        every, some = keys, keys
        for _ in range(height):
            at = np.arange(0, len(every), FAN)
            every, some = np.bitwise_and.reduceat(every, at), np.bitwise_or.reduceat(some, at)
            self.levels.append((every, ~(every ^ some)))

    def one_label(self, labels: np.ndarray) -> list[np.ndarray]:
        """For each level, each node's label, or -1 where it has several."""
        low, high = labels, labels
        out = [labels]
        for _ in self.levels[1:]:
            at = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            out.append(np.where(low == high, low, -1))
        return out


def height(n: int) -> int:
    """Levels of nodes over n entries up to a single one."""
    h = 0
    while n > 1:
        n, h = -(-n // FAN), h + 1
    return h


def join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give all that the pairs connect one label, in place; labels[i] <= i and labels[labels] == labels hold before and after."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return
        np.minimum.at(labels, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (deeper := labels[labels]).tobytes() != labels.tobytes():
            labels[:] = deeper


def expanded(level: int, tree: Tree, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The children of each node, FAN columns, and which there are."""
    kids = at[:, None] * FAN + np.arange(FAN)
    return kids, kids < len(tree.levels[level - 1][0])


def links_between(left: Tree, right: Tree | None, reach: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Links (indexes into left and right; right None: within left) that connect all that link, and how many pairs of entries were compared.

    Depth first over pairs of nodes, some at a time, so that memory is bounded. Links within either tree are taken as known
    but for those of left where right is None.
    """
    same = right is None
    other = left if same else right
    n = len(left.keys)
    labels = np.arange(n if same else n + len(other.keys))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for tree, start in ((left, 0),) if same else ((left, 0), (other, n)):
        near = np.flatnonzero(np.bitwise_count(tree.keys[1:] ^ tree.keys[:-1]) <= reach)
        join_labels(labels, start + near, start + near + 1)
        if same:
            found.append((near, near + 1))
    marks = lambda: (left.one_label(labels[:n]), left.one_label(labels) if same else other.one_label(labels[n:]))
    (of_left, of_other), stale, compared = marks(), 0, 0
    top = len(left.levels) - 1
    zero = np.zeros(1, np.int64)
    todo = [(top, zero, zero)]
    while todo:
        level, a, b = todo.pop()
        if len(a) > PAIRS:
            todo.append((level, a[PAIRS:], b[PAIRS:]))
            a, b = a[:PAIRS], b[:PAIRS]
        la, lb = of_left[level][a], of_other[level][b]
        open_ = (la != lb) | (la < 0)
        a, b = a[open_], b[open_]
        if level:
            (ka, ina), (kb, inb) = expanded(level, left, a), expanded(level, other, b)
            there = ina[:, :, None] & inb[:, None, :]
            if same:
                there &= ka[:, :, None] <= kb[:, None, :]
            i, j, k = np.nonzero(there)
            a, b = ka[i, j], kb[i, k]
            level -= 1
            if not level:
                compared += len(a)
            (pa_, ma), (pb, mb) = left.levels[level], other.levels[level]
            near = may_link(pa_[a], pb[b], ma[a] & mb[b], reach)
            a, b = a[near], b[near]
            if level:
                if len(a):
                    todo.append((level, a, b))
                continue
        x, y = labels[a], labels[(b if same else b + n)]
        new = x != y
        if new.any():
            _, first = np.unique(np.stack([np.minimum(x, y)[new], np.maximum(x, y)[new]]), axis=1, return_index=True)
            a, b = a[new][first], b[new][first]
            found.append((a, b))
            join_labels(labels, a, b if same else b + n)
            stale += len(a)
            if stale * 8 >= len(labels) or stale >= 256:
                (of_left, of_other), stale = marks(), 0
    a, b = (np.concatenate([f[s] for f in found]) if found else np.zeros(0, np.int64) for s in (0, 1))
    return a, b, compared


def blocks_of(entries: DataFrame, swapped: bool, total: int, size: int | None, name: str) -> DataFrame:
    """(block, keys, ids, every, some): entries (fp, id) in Gray order, packed; staged, so that block numbers stay."""
    spark = entries.sparkSession
    key = F.col("fp")
    if swapped:
        key = F.shiftleft(key, 32).bitwiseOR(F.shiftrightunsigned(key, 32))
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // ROWS_PER_RANGE)
    dealt = entries.select(key.alias("key"), "id").repartitionByRange(ranges, gray_rank(F.col("key"))).sortWithinPartitions(gray_rank(F.col("key")))
    size = size or max(BLOCK, -(-total // BLOCKS))

    def packed(keys: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        every, some = np.bitwise_and.reduce(keys), np.bitwise_or.reduce(keys)
        return out_batch(keys=pa.array([keys.tobytes()], pa.binary()), ids=pa.array([ids.tobytes()], pa.binary()), every=[every.view(np.int64).item()], some=[some.view(np.int64).item()])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            keys, ids = np.concatenate([keys, col(batch, "key").to_numpy()]), np.concatenate([ids, col(batch, "id").to_numpy()])
            while len(keys) >= size:
                yield packed(keys[:size], ids[:size])
                keys, ids = keys[size:], ids[size:]
        if len(keys):
            yield packed(keys, ids)

    made = dealt.mapInArrow(tidy(pack), "keys binary, ids binary, every long, some long")
    return staged(made.withColumn("block", F.monotonically_increasing_id()), name)


def links(entries: DataFrame, reach: int = REACH, size: int | None = None) -> DataFrame:
    """(a, b): ids of distinct fingerprints (fp, id; staged) that link, enough of them to connect all that do. size: entries of a block."""
    total = entries.count()
    found = [linked_blocks(blocks_of(entries, swapped, total, size, f"blocks-{int(swapped)}"), reach) for swapped in (False, True)]
    return found[0].unionByName(found[1])


def linked_blocks(blocks: DataFrame, reach: int) -> DataFrame:
    """links() of one index."""
    nodes = sorted(blocks.select("block", "every", "some").collect())  # the uppermost nodes: at most BLOCKS, and one for each range
    at = np.array([r.block for r in nodes], np.int64)
    every, some = (np.array([r[c] for r in nodes], np.int64).view(np.uint64) for c in ("every", "some"))
    upper = blocks.sparkSession.sparkContext.broadcast((at, every, ~(every ^ some)))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each block to itself, to the groups in which others come to it, and, thinned out, to later blocks that it may link to."""
        at, pattern, mask = upper.value
        for batch in batches:
            for block, keys, ids in zip(*(col(batch, c).to_pylist() for c in ("block", "keys", "ids")), strict=True):
                i = int(np.searchsorted(at, block))
                near = np.flatnonzero(may_link(pattern, pattern[i], mask & mask[i], reach))
                groups = np.unique(near[near < i] // SENDERS).tolist()
                for g in [-1, *groups]:
                    yield out_batch(target=[i], run=[g], sender=[-1], keys=pa.array([keys], pa.binary()), ids=pa.array([ids], pa.binary()))
                k, v = np.frombuffer(keys, np.uint64), np.frombuffer(ids, np.int64)
                for j in near[near > i].tolist():
                    some = may_link(k, pattern[j], mask[j], reach)
                    if some.any():
                        yield out_batch(target=[j], run=[i // SENDERS], sender=[i], keys=pa.array([k[some].tobytes()], pa.binary()), ids=pa.array([v[some].tobytes()], pa.binary()))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A group's rows come in order: the target block, then its senders. Only the target and one sender are held."""
        tree, own, group = None, None, None
        for batch in batches:
            for target, run, sender, keys, ids in zip(*(col(batch, c).to_pylist() for c in ("target", "run", "sender", "keys", "ids")), strict=True):
                k, v = np.frombuffer(keys, np.uint64), np.frombuffer(ids, np.int64)
                if sender < 0:
                    group, own, tree = (target, run), v, Tree(k, height(len(k)))
                    if run >= 0:
                        continue
                    a, b, _ = links_between(tree, None, reach)
                    pair = own[a], own[b]
                else:
                    assert group == (target, run)
                    high = max(height(len(k)), len(tree.levels) - 1)
                    tree = tree if len(tree.levels) - 1 == high else Tree(tree.keys, high)
                    a, b, _ = links_between(tree, Tree(k, high), reach)
                    pair = own[a], v[b]
                if len(a):
                    yield out_batch(a=pair[0], b=pair[1])

    sent = blocks.select("block", "keys", "ids").mapInArrow(tidy(send), "target long, run long, sender long, keys binary, ids binary")
    met = sent.repartition("target", "run").sortWithinPartitions("target", "run", "sender")
    return met.mapInArrow(tidy(meet), "a long, b long")


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, reach: int = REACH, size: int | None = None) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hexadecimal digits), component_id (the smallest doc_id reachable by links).

    A text of fewer words than a shingle has the whole sequence as its shingle; one without words, or null, has the
    fingerprint zero and links like any other. A row without an id has a fingerprint, links with nothing and has no
    component. Rows that repeat an id each have the component of their own fingerprint. An empty table gives an empty
    result. Other columns are ignored. Ids are integers. reach: 0 to 63 bits; size: entries of a block, for tests.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    prints = staged(fingerprints(docs, shingle), "fingerprints")
    named = prints.where("id is not null")
    entries = staged(named.groupBy("fp").agg(F.min("id").alias("id")), "distinct-fingerprints")
    found = staged(links(entries, reach, size).distinct(), "near-links")
    known = entries.join(components(found), "id", "left").select("fp", F.coalesce("component", "id").alias("component_id"))
    own = spread_on(named, known, "fp").unionByName(prints.where("id is null").withColumn("component_id", F.lit(None).cast("long")))
    return own.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(stack(spark, sf_dir, "documents"))


#: DuckDB has no XXH64; tests hold the query against brute force.
SQL = None
