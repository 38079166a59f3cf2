import random

import pyarrow.parquet as pq
import pytest

SF = "/root/testdata/sf0.001"

NASTY = [
    None,
    "",
    " ",
    "\n\n",
    "one",
    "one two",
    "A line that is long enough to count.\nA line that is long enough to count.",
    "  a LINE that is long enough to count. \t\nother words stand here instead",
    "x" * 30_000,
    "word " * 5_000,
    "mail a.b@c.d.org, or x@y, @@ a@b@c.com 1.2.3.4 300.1.1.1 1.2.3.4.5.6.7.8 +1 (656) 555-6510 4207 0512 7910 8084 4111-1111-1111-1111",
    "é ñ ü ß 漢字       \x1c \x85 İ ΑΣ́ é don't 12½",
    "<|endoftext|> A<|startoftext|>B \x00\x1f\x7f",
]


@pytest.fixture(scope="session")
def small_docs():
    """The smallest table's documents, whole."""
    t = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    return [(r["doc_id"], r["text"], r["source"]) for r in t]


@pytest.fixture(scope="session")
def nasty_docs():
    """Nulls, empty and very long texts, ties, near copies and repeated rows."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(120)]
    docs = [(1000 + i, t, ("a", None, "b")[i % 3]) for i, t in enumerate(NASTY)]
    for i in range(60):  # near copies, with a shared passage
        w = list(base)
        for _ in range(i % 5):
            w[rng.randrange(len(w))] = rng.choice(words)
        docs.append((2000 + i, " ".join(w[:40]) + "\n" + " ".join(w[40:]), "a"))
    for i in range(40):  # different documents around one line and one passage
        own = [rng.choice(words) for _ in range(60)]
        docs.append((3000 + i, "The same line of navigation everywhere.\n" + " ".join(own) + "\n" + " ".join(base[10:45]), "b"))
    docs += [docs[20], docs[20], docs[-1]]
    return docs


@pytest.fixture(scope="session")
def frame(spark):
    """A DataFrame of (id, text, host) with further columns whose names the operators use themselves."""

    def make(docs):
        rows = [(d, t, s, 1, 2, "z", None, 5, 6) for d, t, s in docs]
        return spark.createDataFrame(rows, "doc_id long, text string, source string, id int, n int, key string, component int, spans int, _id int").repartition(3)

    return make


def rows_of(df, *columns):
    """All rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="session")
def rows():
    return rows_of
