"""SimHash near-dedup against brute force, and the hierarchical index against all pairs."""

import numpy as np
import pytest
import xxhash

from stocktake.llm import op11_simhash as op
from stocktake.llm.common import staged

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text, size=4):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    n = len(words)
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, n - size + 1))] if n else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def connected(keys, reach=4):
    """For each key the smallest index that it reaches, over all pairs."""
    label = list(range(len(keys)))
    for i in range(len(keys)):
        near = np.flatnonzero(np.bitwise_count(keys ^ keys[i]) <= reach).tolist()
        low = min(label[j] for j in near)
        gone = {label[j] for j in near}
        label = [low if x in gone else x for x in label]
    return label


def brute(docs, size=4, reach=4):
    prints = [(d, plain_fingerprint(t, size)) for d, t in docs]
    ids = sorted({d for d, _ in prints if d is not None})
    distinct = sorted({f for d, f in prints if d is not None}, key=lambda f: min(d for d, g in prints if g == f and d is not None))
    label = connected(np.array(distinct, np.uint64), reach) if ids else []
    first = {f: min(d for d, g in prints if g == f and d is not None) for f in distinct}
    return sorted(((d, f"{f:016x}", first[distinct[label[distinct.index(f)]]] if d is not None else None) for d, f in prints), key=repr)


def test_whole_documents(frame, rows, small_docs, nasty_docs):
    docs = small_docs + nasty_docs + [(None, "one two", "a"), (None, None, "b")]
    got = op.near_groups(frame(docs))
    assert rows(got, "doc_id", "fingerprint", "component_id") == brute([(d, t) for d, t, _ in docs])


def test_query(spark, rows):
    from stocktake.llm.common import stack

    docs = [tuple(r) for r in stack(spark, SF, "documents").select("doc_id", "text").collect()]
    got = op.op11_simhash(spark, SF)
    assert rows(got, "doc_id", "fingerprint", "component_id") == brute(docs)
    assert any(r.component_id != r.doc_id for r in got.collect())


def test_empty_table(frame):
    assert op.near_groups(frame([])).collect() == []


def test_spark_has_the_same_hash(spark):
    (r,) = spark.sql("select xxhash64('one two three four') as h").collect()
    assert r.h % 2**64 == xxhash.xxh64_intdigest(b"one two three four", 42)


def test_long_texts_are_counted_in_rounds(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(5000))
    whole = op.fingerprint(text.encode())
    monkeypatch.setattr(op, "ROUND", 64)
    assert op.fingerprint(text.encode()) == whole == plain_fingerprint(text)


def some_keys(rng, alone, groups, members, flips):
    """Random keys, and groups a few bits around a centre."""
    base = rng.integers(0, 2**63, alone, dtype=np.uint64)
    near = np.repeat(rng.integers(0, 2**63, groups, dtype=np.uint64), members)
    for _ in range(flips):
        near ^= np.uint64(1) << rng.integers(0, 64, len(near), dtype=np.uint64)
    return np.unique(np.concatenate([base, near, np.array([0, 1, 2**64 - 1, 2**64 - 16], np.uint64)]))


@pytest.mark.parametrize("size", [None, 40, 7])
@pytest.mark.parametrize("reach", [0, 3, 4])
def test_index_finds_what_all_pairs_find(spark, size, reach):
    """Over one block or many, and whatever the reach."""
    keys = some_keys(np.random.default_rng(reach), 200, 25, 25, 3)
    entries = staged(spark.createDataFrame([(int(k.view(np.int64)), i) for i, k in enumerate(keys)], "fp long, id long"), "test-entries")
    found = [tuple(r) for r in op.links(entries, reach, size).collect()]
    assert all(int(keys[a] ^ keys[b]).bit_count() <= reach for a, b in found)
    label = np.arange(len(keys))
    if found:
        op.join_labels(label, *(np.array(x) for x in zip(*found)))
    assert label.tolist() == connected(keys, reach)


def rank(keys):
    keys = keys.copy()
    for s in (1, 2, 4, 8, 16, 32):
        keys ^= keys >> np.uint64(s)
    return keys


def test_groups_are_passed_over():
    """Of random fingerprints, a small part of all pairs is compared; of a dense group, as many links are told as connect it."""
    rng = np.random.default_rng(9)
    keys = np.unique(rng.integers(0, 2**63, 20_000, dtype=np.uint64))
    keys = keys[np.argsort(rank(keys))]
    _, _, compared = op.links_between(op.Tree(keys, op.height(len(keys))), None, 4)
    assert compared < 0.03 * len(keys) ** 2
    dense = np.full(3000, np.uint64(2**40 + 77))
    for _ in range(2):
        dense ^= np.uint64(1) << rng.integers(0, 64, 3000, dtype=np.uint64)
    dense = np.unique(dense)
    dense = dense[np.argsort(rank(dense))]
    a, _, compared = op.links_between(op.Tree(dense, op.height(len(dense))), None, 4)
    assert len(a) < 2 * len(dense) and compared < 0.5 * len(dense) ** 2


def test_gray_rank(spark):
    codes = [i ^ (i >> 1) for i in range(300)] + [(2**63 + i) ^ ((2**63 + i) >> 1) for i in range(5)]
    df = spark.createDataFrame([(int(np.uint64(c).view(np.int64)), i) for i, c in enumerate(codes)], "k long, i int")
    assert [r.i for r in df.orderBy(op.gray_rank(df.k)).collect()] == list(range(len(codes)))
