"""Boilerplate lines where documents share other lines too."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stocktake.llm import op5_quality_rules

from . import brute


def test_different_documents_count_whatever_they_share(frame):
    """Ten menu lines and one own line each: every menu line is in 100 documents; exact copies of one count once."""
    menu = [f"menu {i} leads to page {i}" for i in range(10)]
    docs = [(i, "\n".join([*menu, f"own{i} line{i}"]), "h") for i in range(100)]
    docs += [(200 + i, "\n".join(f"article line {j} with its words" for j in range(8)), "h") for i in range(100)]
    got = {r.doc_id: r for r in op5_quality_rules.quality(frame(docs), max_docs=99).collect()}
    assert all(got[i].n_boilerplate_words == 60 and not got[i].kept for i in range(100))
    assert all(got[200 + i].n_boilerplate_words == 0 and got[200 + i].kept for i in range(100))


@pytest.mark.parametrize("shared", [2, 6])
def test_pages_of_boilerplate_are_rejected_on_every_host(frame, shared):
    """Pages of a few shared lines and one own line: whatever the lines are, every page goes."""
    docs = []
    for h in range(8):
        lines = [" ".join(f"host{h} part{j} word{k}" for k in range(8)) for j in range(shared)]
        docs += [(1000 * h + i, "\n".join([lines[0], f"own line {h} {i}", *lines[1:]]), f"h{h}") for i in range(60)]
    want = brute.quality(docs, 20, 0.3)
    got = {r.doc_id: (r.kept, r.n_boilerplate_words) for r in op5_quality_rules.quality(frame(docs)).collect()}
    assert got == {d: x[:2] for d, x in want.items()} and not any(k for k, _ in got.values())


def test_further_rows_make_no_line_good(frame):
    """21 different documents with a footer are depleted on a host of 21 rows and on one of 12,000."""
    footer = " ".join(f"footer{i}" for i in range(30))
    docs = [(i, f"{footer}\nown{i}", "h") for i in range(21)]
    more = [(100 + i, f"text {i}", "h") for i in range(12_000)]
    for rows in (docs, docs + more):
        got = {r.doc_id: r.kept for r in op5_quality_rules.quality(frame(rows)).collect()}
        assert not any(got[i] for i in range(21))


def test_boilerplate_lines_are_cut_out(spark, frame):
    """A short menu line goes from kept documents of its host only, and n_chars follows; other lines and columns stay."""
    own = lambda i: "\n".join(" ".join(f"w{i}x{j}x{k}" for k in range(12)) for j in range(3))
    docs = [(i, f"Menu \n\n{own(i)}\nmenu", "h") for i in range(30)] + [(100, f"menu\n{own(100)}", None), (101, None, "h")]
    got = op5_quality_rules.clean_good(frame(docs))
    assert got.columns == frame(docs).columns
    assert {r.doc_id: r.text for r in got.collect()} == {i: f"\n{own(i)}" for i in range(30)} | {100: f"menu\n{own(100)}"}
    table = spark.createDataFrame([(d, t, "en", h, len(t or "")) for d, t, h in docs], "doc_id long, text string, lang string, source string, n_chars long")
    staged = corpus_pipeline.quality_rules(spark, table, "")
    assert staged.columns == table.columns and {r.doc_id: r.n_chars for r in staged.collect()} == {i: len(own(i)) + 1 for i in range(30)} | {100: len(own(100)) + 5}


def test_line_hash_is_the_same_in_spark(spark, nasty_docs):
    lines = sorted({x for _, t, _ in nasty_docs for x in (t or "").split("\n")})
    df = spark.createDataFrame([(x,) for x in lines], "x string").select("x", op5_quality_rules.line_key(F.col("x")).alias("k"))
    assert {r.x: r.k for r in df.collect()} == {x: op5_quality_rules.line_hash(x.encode()) for x in lines}


def test_sql_counts_documents(spark, tmp_path):
    """The SQL on 300 pages of header, own line and footer, copies among them, against brute force."""
    docs = [(i, "\n".join(["Header " + "a b c d e f g h i j", f"own {i % 250} line", "footer " + "k l m n o p q r s t"]), ("x", None)[i % 2]) for i in range(300)]
    docs += [(1000 + i, "\n".join(f"article {j} " + "u v w x y z" for j in range(6)), "x") for i in range(50)]
    df = spark.createDataFrame([(d, t, "en", s, len(t)) for d, t, s in docs], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    rel = c.sql(op5_quality_rules.SQL)
    at = [rel.columns.index(x) for x in ("doc_id", "kept", "n_boilerplate_words")]
    want = {d: x[:2] for d, x in brute.quality(docs, 20, 0.3).items()}
    assert {r[at[0]]: (r[at[1]], r[at[2]]) for r in rel.fetchall()} == want
    got = op5_quality_rules.op5_quality_rules(spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.kept, r.n_boilerplate_words) for r in got} == want
