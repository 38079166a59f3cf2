"""The Jaccard join with other shingles and similarities than the query's, against brute force."""

from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stocktake.llm import common, op9_jaccard_join
from stocktake.llm.common import stack, staged

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("size, similarity", [(5, 80), (1, 60)])
def test_parameters(frame, rows, small_docs, nasty_docs, size, similarity):
    docs = small_docs + nasty_docs
    got = op9_jaccard_join.similar_groups(frame(docs), shingle=size, similarity=similarity)
    assert rows(got, "doc_id", "n_shingles", "component_id") == sorted(brute.groups([(d, t) for d, t, _ in docs], size, similarity), key=repr)


def test_stage_of_the_pipeline(spark):
    """The stage alone, over whole documents: five words and 0.8."""
    docs = stack(spark, SF, "documents")
    want = brute.groups([tuple(r) for r in docs.select("doc_id", "text").collect()], 5, 80)
    assert {r.doc_id for r in corpus_pipeline.jaccard_join(spark, docs, SF).collect()} == {d for d, _, c in want if c == d}


@pytest.mark.parametrize("size, similarity", [(10, 90), (18, 90), (10, 80), (300, 90), (40, 60)])
def test_unrelated_sets_share_no_list(size, similarity):
    """The index lists of random sets stay short, however many sets there are."""
    rng = np.random.default_rng(1)
    places = op9_jaccard_join.Positions(similarity)
    n = 20_000 if size < 100 else 2_000
    lists = np.concatenate([np.unique(places.signatures(np.unique(rng.integers(0, 2**63, size, dtype=np.uint64)))) for _ in range(n)])
    assert np.unique(lists, return_counts=True)[1].max() <= 2


@pytest.mark.parametrize("similarity", [60, 80, 90])
def test_linked_sets_share_a_list(similarity):
    """Whatever their sizes, sets that link meet in a list."""
    rng = np.random.default_rng(2)
    places = op9_jaccard_join.Positions(similarity)
    met = 0
    for _ in range(3000):
        n = int(rng.choice([1, 2, 3, 4, 5, 7, 9, 10, 12, 20, 33, 80, 200]))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        out, new = int(rng.integers(0, max(1, n * (100 - similarity) // 100) + 1)), int(rng.integers(0, max(1, n * (100 - similarity) // 100) + 1))
        b = np.unique(np.concatenate([rng.permutation(a)[out:], rng.integers(0, 2**63, new, dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= similarity * (len(a) + len(b) - both):
            met += 1
            assert len(np.intersect1d(places.signatures(a), places.signatures(b)))
    assert met > 500


def test_ids_that_are_null_or_repeated(frame, rows):
    """A row without an id hides no other's lists; each text with an id is compared, whichever is read first."""
    rng = np.random.default_rng(3)
    base = [f"b{x}" for x in rng.integers(0, 10_000, 200)]
    near = lambda *at: " ".join(f"n{i}" if i in at else w for i, w in enumerate(base))
    docs = [(None, near(), "a"), (1, near(), "a"), (2, near(5), "a"), (3, "other words stand here " * 9, "a"), (3, near(190), "a"), (None, near(5), "a"), (4, "all on its own", "a")]
    got = rows(op9_jaccard_join.similar_groups(frame(docs).coalesce(1)), "doc_id", "component_id")
    assert got == [(1, 1), (2, 1), (3, 1), (3, 1), (4, 4), (None, None), (None, None)]


def unlike_texts(n, passage, seed=4):
    """Texts of their own words around one passage; every tenth is a near copy of the one before."""
    rng = np.random.default_rng(seed)
    shared = [f"p{i}" for i in range(passage)]
    out = []
    for i in range(n):
        own = [f"w{x}" for x in rng.integers(0, 10**6, 60)]
        if i % 10 == 9:
            own = [*out[-1].split()[passage:-1], f"end{i}"]
        out.append(" ".join(shared + own))
    return out


def test_long_lists_are_cut_anew(spark, frame, monkeypatch):
    """Lists that a common passage makes long fall apart; sets that link stay together in a list, and none gains sets."""
    texts = unlike_texts(300, 12)
    docs = frame([(i, t, "a") for i, t in enumerate(texts)]).select(F.col("doc_id").alias("id"), "text")
    sets = op9_jaccard_join.sets_of(docs, 3, 90)
    one = sets.select(F.lit(7).cast("long").alias("list"), "set", "n", "bits", "id", F.col("id").alias("component"))
    monkeypatch.setattr(op9_jaccard_join, "LONG", 20)
    got = [r.asDict() for r in op9_jaccard_join.recut(staged(one, "test-members"), docs, 3, 90).collect()]
    lists = defaultdict(set)
    for r in got:
        lists[r["list"]].add(r["id"])
    assert sum(len(x) ** 2 for x in lists.values()) * 4 <= 300**2
    assert all(any({i - 1, i} <= x for x in lists.values()) for i in range(9, 300, 10))
    same = staged(one.withColumn("component", F.lit(1).cast("long")), "test-members")
    assert op9_jaccard_join.recut(same, docs, 3, 90).count() == 300


def test_lists_that_no_cut_parts_stay(spark, frame, monkeypatch):
    """Sets that agree in most positions and don't link aren't listed over and over."""
    texts = [" ".join(f"x{i}" if j in (40, 80, 120, 160) else f"s{j}" for j in range(200)) for i in range(40)]
    docs = frame([(i, t, "a") for i, t in enumerate(texts)]).select(F.col("doc_id").alias("id"), "text")
    one = op9_jaccard_join.sets_of(docs, 3, 90).select(F.lit(7).cast("long").alias("list"), "set", "n", "bits", "id", F.col("id").alias("component"))
    monkeypatch.setattr(op9_jaccard_join, "LONG", 5)
    got = op9_jaccard_join.recut(staged(one, "test-members"), docs, 3, 90).collect()
    assert len(got) == 40 and {r.list for r in got} == {7}


def test_groups_with_every_list_cut_anew(frame, rows, small_docs, nasty_docs, monkeypatch):
    """The result doesn't hang on which lists are cut anew."""
    size, similarity = 5, 80
    monkeypatch.setattr(op9_jaccard_join, "LONG", 0)
    docs = small_docs + nasty_docs + [(10_000 + i, t, "a") for i, t in enumerate(unlike_texts(120, 30))]
    got = op9_jaccard_join.similar_groups(frame(docs), shingle=size, similarity=similarity)
    assert rows(got, "doc_id", "n_shingles", "component_id") == sorted(brute.groups([(d, t) for d, t, _ in docs], size, similarity), key=repr)


def test_lists_in_several_ranges(spark, rows):
    """A list that is dealt out over many ranges joins up: its pairs reach all of its sets."""
    df = spark.createDataFrame([(i, [7, 100 + i]) for i in range(500)], "set long, lists array<long>").repartition(4)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pairs = rows(op9_jaccard_join.first_pairs(df), "list", "first", "other")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    root = {i: i for i in range(500)}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for name, a, b in pairs:
        assert name == 7
        root[find(a)] = find(b)
    assert len({find(x) for x in root}) == 1 and len(pairs) < 520 and len({a for _, a, _ in pairs}) > 1


def test_passes_find_the_same(frame, rows, small_docs, nasty_docs, monkeypatch):
    """However many passes the shuffles go in, the groups are the same."""
    docs = small_docs + nasty_docs + [(10_000 + i, t, "a") for i, t in enumerate(unlike_texts(120, 30))]
    monkeypatch.setattr(op9_jaccard_join, "PASS_ROWS", 1)
    got = op9_jaccard_join.similar_groups(frame(docs), shingle=5, similarity=80)
    assert rows(got, "doc_id", "n_shingles", "component_id") == sorted(brute.groups([(d, t) for d, t, _ in docs], 5, 80), key=repr)


def test_disk_is_given_back(spark, frame, small_docs, nasty_docs):
    """Of the stage's tables on the way only what its result reads is left, and of what staged() writes no shuffle files."""
    shared = Path(common.shared_dir(spark).removeprefix("file://"))
    held = lambda: {p.name for p in shared.glob("*")}
    shuffles = lambda: spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()
    docs = frame(small_docs + nasty_docs)
    before = held()
    kept = op9_jaccard_join.keep_first(docs, shingle=5, similarity=80)
    assert [n.rsplit("-", 1)[0] for n in held() - before] == ["copies"]
    assert kept.count() < docs.count()
    alive = shuffles()
    common.staged(docs.repartition(7, "doc_id").groupBy("source").count(), "test-shuffle")
    assert shuffles() <= alive
