"""License scans against their SQL, and on awkward rows."""

import duckdb
import pytest

from stocktake.llm import op10_license_scans as L

SF = "/root/testdata/sf0.001"


def test_against_sql(spark):
    df = L.op10_license_scans(spark, SF)
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    rel = c.sql(L.SQL)
    at = [rel.columns.index(x) for x in df.columns]
    want = sorted((repr(tuple(r[i] for i in at)) for r in rel.fetchall()))
    assert sorted(repr(tuple(r)) for r in df.collect()) == want


ROWS = [
    (1, "Licensed under the Apache License, Version 2.0.\ncode", "a/LICENSE"),
    (2, "no statement", "a/b/c/x"),
    (3, "Released under the MIT License.\n", "a/b/LICENSE"),
    (4, None, "a/b/c/d/y"),
    (5, "", "z/q"),
    (6, "text\nAll rights reserved.", "a/b/c/w"),
    (7, "plain", None),
    (8, "Licensed under CC BY-NC 4.0.", "y/top"),
    (8, "Licensed under CC BY-NC 4.0.", "y/top"),
    (9, "A licence is mentioned in this long sentence about the license of somebody to drive a car on all roads", "z/r"),
    (10, "x " * 60_000 + "license", "z/s"),
]


def test_inheritance(spark):
    df = spark.createDataFrame([(*r, 1, "k") for r in ROWS], "doc_id long, text string, path string, score int, dir string").repartition(4)
    got = {r.doc_id: r for r in L.scan_licenses(df).collect()}
    assert len(got) == 10 and L.scan_licenses(df).count() == 11
    assert (got[1].license, got[1].how) == ("Apache-2.0", "stated") and got[3].license == "MIT"
    assert (got[2].license, got[2].how, got[2].licensed_by) == ("MIT", "inherited", "a/b") and got[4].license == "MIT"
    assert (got[6].license, got[6].how, got[6].line) == ("proprietary", "stated", 1)
    assert got[5].how == got[7].how == got[9].how == got[10].how == "none" and got[8].license == "CC-BY-NC-4.0"


GPL = """# frob - frobs things
# Copyright (C) 2019-2021  J. Doe <doe@example.org>
#
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.

import frob
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
"""
FILES = [
    ("CC-BY-4.0", "pictures/notes.txt", "Some pictures of the sea.\nCC BY 4.0\nMore on them."),
    ("BSD-3-Clause", "bsd/LICENSE", "Copyright (c) 2010, The Frob Project\nAll rights reserved.\n\n" + BSD),
    ("BSD-3-Clause", "bare/LICENSE", BSD),
    ("MIT", "mit/frob.js", "/*\n * Copyright (c) 2020 J. Doe\n *\n * Permission is hereby granted, free of charge, to any person obtaining a copy\n * of this software\n */\nfrob();"),
    ("GPL-3.0", "gpl/frob.py", GPL),
    ("BSD-3-Clause", "go/a.go", "// Copyright 2009 The Frob Authors. All rights reserved.\n// Use of this source code is governed by a BSD-style\n// license that can be found in the LICENSE file.\n\npackage frob"),
    ("GPL-2.0", "old/a.c", "/* " + L.TEMPLATES[[x[0] for x in L.TEMPLATES].index("GPL-2.0") + 2][1] + " */"),
    ("Apache-2.0", "ap/COPYING", "\n".join(L.TEMPLATES[i][1] for i in (1, 3))),
    ("proprietary", "own/a.txt", "Copyright (c) 1999 Frob Inc. All rights reserved."),
]


def test_headers_and_licence_files(spark):
    """Usual headers and licence files among a table's documents, and what stands below the licence files."""
    docs = [(r.doc_id, r.text, f"docs/{r.doc_id}") for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    files = [(10_000 + i, text, path) for i, (_, path, text) in enumerate(FILES)] + [(20_000, "frob", "bsd/src/x/y.c"), (20_001, None, "ap/z")]
    df = spark.createDataFrame(docs + files, "doc_id long, text string, path string").repartition(3)
    got = {r.doc_id: r for r in L.scan_licenses(df).collect()}
    assert {p: got[10_000 + i].license for i, (_, p, _) in enumerate(FILES)} == {p: k for k, p, _ in FILES}
    assert (got[20_000].license, got[20_000].licensed_by, got[20_001].license) == ("BSD-3-Clause", "bsd", "Apache-2.0")


def test_the_bound_loses_nothing(spark):
    """Lines made of templates' words and others: what has no key term is below the score."""
    import random

    rng = random.Random(3)
    texts = []
    for _ in range(300):
        words = rng.choice(L.TEMPLATES)[1].split()
        own = [w for w in words if rng.random() < 0.7] + [f"x{rng.randrange(50)}" for _ in range(rng.randrange(6))]
        rng.shuffle(own)
        texts.append(" ".join(own))
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, path string")
    kept = {r.doc_id: (r.license, r.score) for r in L.scan_licenses(df).collect()}
    keys, reach = L.key_terms, L.may_reach
    try:
        L.key_terms = lambda sides, _: sorted({r.term for r in sides.collect()})
        L.may_reach = lambda unit, *_: unit.isNotNull()
        assert {r.doc_id: (r.license, r.score) for r in L.scan_licenses(df).collect()} == kept
    finally:
        L.key_terms, L.may_reach = keys, reach
    assert 50 < sum(k is not None for k, _ in kept.values()) < 300


@pytest.mark.parametrize("rows", [[], [(1, None, None)]])
def test_nothing_there(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, path string")
    assert [r.how for r in L.scan_licenses(df).collect()] == ["none"] * len(rows)


def test_blocks(spark):
    """Blocks and their first lines, with blank lines in any number and of any white space, against a plain loop."""
    import random

    from pyspark.sql import functions as F

    rng = random.Random(1)
    texts = ["", "\n", "a", "\n\na\n", " \t\r\nb a\nc\n\r\n\n a"] + ["\n".join(rng.choice(["", " ", "\t\r", "a b", "c", "a", " d  a", "b c"]) for _ in range(rng.randrange(12))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r.i: [tuple(x) for x in r.b] for r in df.select("i", L.blocks_of(F.col("text"), F.array(F.lit("a"), F.lit("d"))).alias("b")).collect()}
    for i, text in enumerate(texts):
        want, own = [], []
        for k, line in enumerate([*text.split("\n"), ""]):
            if line.strip(" \t\r"):
                own.append((k, line))
            elif own:
                if any(w in "ad" for _, x in own for w in x.split()):
                    want.append((own[0][0], "\n".join(x for _, x in own)))
                own = []
        assert got[i] == want, text


def test_very_long_texts(spark):
    """100,000 blocks, all of which mention a licence; one line of 200,000 words; a licence file of 200,000 words."""
    import time

    words = " ".join(f"w{i}" for i in range(200_000))
    rows = [(1, "no license here\n\n" * 100_000 + "Released under the MIT License.", "a/x"), (2, words + " license", "b/x"), (3, words + "\nlicense", "c/LICENSE"), (4, "license " * 200_000, "d/NOTICE")]
    df = spark.createDataFrame(rows, "doc_id long, text string, path string").repartition(4)
    began = time.time()
    got = {r.doc_id: (r.license, r.line) for r in L.scan_licenses(df).collect()}
    assert got[1] == ("MIT", 200_000) and got[2] == got[3] == (None, None) and len(got) == 4
    assert time.time() - began < 120


def test_counts_of_terms(spark):
    from collections import Counter

    from pyspark.sql import functions as F

    rows = [(0, []), (1, ["a"]), (2, ["a", "a", "b"]), (3, ["a", "b", "b", "c", "c", "c"])]
    df = spark.createDataFrame(rows, "i int, terms array<string>")
    for r in df.select("i", "terms", L.runs_of_equals("terms").alias("n")).collect():
        assert dict(map(tuple, r.n)) == Counter(r.terms)


def test_licence_files_of_the_query_are_compared_whole(spark):
    df = L.op10_license_scans(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    named = df.where(df.path.rlike(L.NAMED))
    assert named.count() == docs.where("doc_id % 100 = 0").count() > 0 and df.count() == docs.count()
