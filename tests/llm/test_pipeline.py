"""The pipeline's stages against brute force, each on what its predecessor kept."""

import re

import duckdb
import pytest

import corpus_pipeline
from stocktake.llm.common import stack

from . import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = stack(spark, SF, "documents")
    columns = docs.columns
    bench = [tuple(r) for r in stack(spark, SF, "benchmark").select("item_id", "text").collect()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, SF)
        assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        after = {r.doc_id: r for r in docs.collect()}
        rows = [(d, r.text) for d, r in before.items()]
        if name == "quality rules":
            want = brute.quality([(d, r.text, r.source) for d, r in before.items()], 20, 0.3)
            assert {d: r.text or "" for d, r in after.items()} == {d: x[2] for d, x in want.items() if x[0]} and len(after) > 0.5 * len(before)
            assert all(r.n_chars == len(r.text) for r in after.values())
        elif name == "line dedup":
            assert {d: r.text for d, r in after.items()} == {d: t for d, _, _, t in brute.line_dedup(rows)}
            assert all(r.n_chars == len(r.text) for r in after.values())
        elif name == "n-gram Jaccard join":
            assert set(after) == {d for d, _, c in brute.groups(rows, 5, 80) if c == d}
        else:
            assert set(after) == {d for d, *_, bad in brute.contamination(rows, bench) if not bad}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == set(after)
    run = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, run.select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect())) == sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in packed)


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (1, None, "en", None, 3), (2, "", None, "a", None), (None, "Some words without an id.", "en", "a", 5), (2, "", None, "a", None)]])
def test_stages_on_no_rows_and_on_nulls(spark, tmp_path, rows):
    """No stage fails, rows keep their columns, and what is packed is what was left."""
    docs = spark.createDataFrame(rows, stack(spark, SF, "documents").schema)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        assert i == len(corpus_pipeline.STAGES) - 1 or out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{i}")
        left, docs = docs, spark.read.parquet(f"{tmp_path}/{i}")
    assert docs.select("doc_id").distinct().count() == left.select("doc_id").distinct().count() and docs.count() == left.count()


def test_registered():
    import __spark_entry__ as e

    names = [n for n in e.queries() if re.match(r"op\d+_|pipeline$", n)]
    assert len(names) == 14 and {int(n[2:].split("_")[0]) for n in names if n != "pipeline"} == set(range(1, 14))


def test_line_dedup_sql():
    from stocktake.llm import op6_line_dedup

    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    rows = c.sql("select doc_id, text from documents").fetchall()
    want = {d: (n, k, brute.sha(t)) for d, n, k, t in brute.line_dedup(rows)}
    assert {d: tuple(x) for d, *x in c.sql(op6_line_dedup.SQL).fetchall()} == want
