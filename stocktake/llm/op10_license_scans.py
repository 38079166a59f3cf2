"""License scans, with DataFrame operations only: sparse TF-IDF cosine to templates, then directory inheritance.

Documents' terms are counted over the whole corpus. Templates are the statements, headers, titles and paragraphs of
well-known licences, as unit vectors of TF-IDF weights. What is held against them are the units of a file: each line,
each header, that is each block of lines up to a blank one, and the whole text of a file that is named as a licence.
Copyright notices are taken out before. A unit takes the licence of the template with the highest cosine, from
`min_score` on; a file takes that of its best unit.

Most units need not be weighed, by a bound that loses no hit. Of each template the terms of the highest weight are taken
until the rest of its vector is shorter than min_score. A unit without any of these terms meets the template in the
rest alone, and its cosine, at most the length of the rest, is below min_score. So only texts, and in them only lines and
blocks, with such a term are looked at. Of these the squared cosine is at most what the templates' terms have in the
unit's squared length. To that length every other term adds its squared weight, which is known for the COMMON most
frequent terms, and for any other term is no less than theirs. Units whose bound is lower go, row by row, and what is
left is weighed with all its terms.

A file without a licence inherits from the licence file of the nearest directory above it, found by joining paths: the
distinct directories, not the files, meet their ancestors, so a directory with a third of all files is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import HOT_KEYS, spread_join, stack, staged

#: Public texts of licences, or the parts that identify them. Several rows may have one licence.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ Terms and conditions for use, reproduction, and distribution"),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at '
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and '
        "limitations under the License.",
    ),
    (
        "Apache-2.0",
        'Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file distributed with this work for additional information '
        'regarding copyright ownership. The ASF licenses this file to You under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    ),
    ("MIT", "Released under the MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, under the terms of the MIT License"),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    (
        "MIT",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR '
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy"),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list "
        "of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of "
        "its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    (
        "BSD-3-Clause",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF '
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
        "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version.",
    ),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    (
        "LGPL-3.0",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
    ),
    ("CC-BY-4.0", "CC BY 4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0"),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved"),
)
COMMON = 200
TERM = "[a-z0-9]+(?:[.-][a-z0-9]+)*"
#: A copyright notice at the begin of a lower-case line: up to the end of the sentence that has its year. No term is cut.
NOTICE = r"^[^a-z0-9]*(?:copyright|\(c\)|©)[^.]*[0-9]{4}[^\n]*?(?:\.[ \t\r]|\.?\z)"
BLANK = r"^[ \t\r]*\z"
BLANK_LINE = r"\n[ \t\r]*(?=\n|\z)"
#: Names that licence files have.
NAMED = r"(?i)(?:^|/)(?:(?:un)?licen[cs]e|copying|copyright|notice)[^/]*$"


def terms(line: Column) -> Column:
    return F.regexp_extract_all(F.regexp_replace(F.lower(line), NOTICE, " "), F.lit(TERM), F.lit(0))


def document_terms(text: Column) -> Column:
    """The distinct terms of a whole text, copyright notices too."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def weight_of_df(df: str, total: int) -> Column:
    """Of a term that is in df of all documents: 1, if it is in all, or more."""
    return F.log((F.lit(total) + 1.0) / (F.coalesce(df, F.lit(0)) + 1.0)) + 1


def weight(tf: str, df: str, total: int) -> Column:
    """Of a term that is tf times in its unit and in df of all documents: repeated words of a long text weigh by the logarithm."""
    return (F.log(F.col(tf)) + 1) * weight_of_df(df, total)


def template_sides(spark: SparkSession, frequency: DataFrame, total: int) -> DataFrame:
    """(template, license, term, t, key): unit vectors; key marks the terms without which a unit stays below the score that is asked for."""
    said = spark.createDataFrame([(i, *x) for i, x in enumerate(TEMPLATES)], "template int, license string, said string")
    counted = said.select("template", "license", F.explode(terms(F.col("said"))).alias("term")).groupBy("template", "license", "term").agg(F.count(F.lit(1)).alias("tf"))
    known = frequency.join(F.broadcast(counted.select("term").distinct()), "term", "left_semi")
    weighed = counted.join(known, "term", "left").select("template", "license", "term", weight("tf", "df", total).alias("w"))
    return weighed.select("template", "license", "term", (F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy("template")))).alias("t"))


def key_terms(sides: DataFrame, min_score: float) -> list[str]:
    """Of each template the heaviest terms, until what is left of its vector is shorter than min_score."""
    upto = W.partitionBy("template").orderBy(F.desc("t"), "term")
    left = 1 - F.coalesce(F.sum(F.col("t") * F.col("t")).over(upto.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    # a hair more, for rounding: a key term too many only means more to weigh
    keys = sides.withColumn("left", left).where(F.col("left") >= (min_score - 1e-4) ** 2).select("term").distinct()
    return sorted(r.term for r in keys.collect())  # of the templates, whatever the corpus


def runs_of_equals(terms: str) -> Column:
    """array<struct<term, tf>>: how often each is in a sorted array. Takes a column's name: a column that is worked out would be so for each element."""
    here = F.col(terms)
    starts = F.filter(F.sequence(F.lit(1), F.size(here)), lambda i: (i == 1) | (F.get(here, i - 2) != F.get(here, i - 1)))
    # shifted by one, each start stands beside the next; the last beside the end
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))), F.array(F.size(here) + 1))
    counts = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda x: F.struct(F.get(here, x["a"] - 1).alias("term"), (x["b"] - x["a"]).alias("tf")))
    return F.when(F.size(here) > 0, counts).otherwise(F.array().cast("array<struct<term:string,tf:int>>"))


def may_reach(unit: Column, weights: dict[str, float], common: dict[str, float], min_score: float) -> Column:
    """Whether a unit, struct(counts, known, usual), can have a cosine of min_score with a template.

    weights are those of the templates' terms, common those of the most frequent other terms: no other term weighs less.
    """
    table = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv]).cast("map<string,double>")
    square = lambda x: F.pow((F.log(x["tf"]) + 1) * F.try_element_at(table(weights), x["term"]), F.lit(2.0))
    own = F.aggregate(F.filter(unit["counts"], lambda x: F.array_contains(unit["known"], x["term"])), F.lit(0.0), lambda a, x: a + square(x))
    rest = F.size(unit["counts"]) - F.size(unit["known"]) - F.size(unit["usual"])
    others = F.aggregate(unit["usual"], rest * F.lit(max(common.values(), default=1.0) ** 2), lambda a, t: a + F.pow(F.try_element_at(table(common), t), F.lit(2.0)))
    return own >= (min_score - 1e-4) ** 2 * (own + others)


def that_may_reach(units: DataFrame, weights: dict[str, float], common: dict[str, float], min_score: float) -> DataFrame:
    """The units that may reach the score, as rows of their terms, each with tf. units has the column terms; they are sorted and counted once, whatever their number."""
    names = lambda d: F.array(*map(F.lit, d)).cast("array<string>")
    kept = [c for c in units.columns if c != "terms"]
    # generators hand on what was worked out once; expressions would be put in place of their names
    ordered = units.select(*kept, F.explode(F.array(F.array_sort("terms"))).alias("terms"))
    unit = F.struct(runs_of_equals("terms").alias("counts"), F.array_intersect("terms", names(weights)).alias("known"), F.array_intersect("terms", names(common)).alias("usual"))
    reaching = ordered.select(*kept, F.explode(F.array(unit)).alias("u")).where(may_reach(F.col("u"), weights, common, min_score))
    return reaching.select(*kept, F.explode("u.counts").alias("x")).select(*kept, "x.term", F.col("x.tf").cast("long").alias("tf"))


def blocks_of(text: Column, wanted: Column) -> Column:
    """array<struct<line, said>>: the blocks of lines up to a blank one that hold a wanted term, with the number of their first line."""
    # every line with its break before it; each blank line is one separator, so that every block but the first begins after one
    pieces = F.split(F.concat(F.lit("\n"), text), BLANK_LINE)
    blank = F.filter(F.transform(F.split(text, "\n"), lambda x, i: F.when(F.translate(x, " \t\r", "") == "", i + 1)), F.isnotnull)
    each = F.arrays_zip(F.concat(F.array(F.lit(0)), blank).alias("line"), pieces.alias("p"))
    hits = F.filter(each, lambda x: F.arrays_overlap(lines_terms(x["p"]), wanted))
    return F.transform(hits, lambda x: F.struct(x["line"].alias("line"), F.substr(x["p"], F.lit(2)).alias("said")))


def lines_terms(text: Column) -> Column:
    return F.flatten(F.transform(F.split(text, "\n"), terms))


def unit_terms(rows: DataFrame, keys: list[str], weights: dict[str, float], common: dict[str, float], min_score: float) -> DataFrame:
    """(_row, unit, line, term, tf): the terms of the lines, blocks and whole texts that hold a key term and may reach the score. rows: (_row, path, text).

    unit tells units of a text apart; line is where one begins. Units are made inside the row of their text: only the terms of those that may reach the score move.
    """
    wanted = F.array(*map(F.lit, keys)).cast("array<string>")
    blocks = rows.select("_row", F.explode(blocks_of(F.col("text"), wanted)).alias("x")).select("_row", "x.line", "x.said")
    # terms come out of a generator, so that no filter on them is pushed below it and takes them again for each use
    each_line = F.posexplode(F.transform(F.split("said", "\n"), terms)).alias("i", "terms")
    lines = blocks.select("_row", "line", each_line).select("_row", F.lit("line").alias("unit"), (F.col("line") + F.col("i")).alias("line"), "terms")
    several = blocks.where(F.contains("said", F.lit("\n"))).select("_row", F.lit("block").alias("unit"), "line", F.explode(F.array(lines_terms(F.col("said")))).alias("terms"))
    whole = rows.where(F.rlike("path", F.lit(NAMED))).select("_row", F.lit("whole").alias("unit"), F.lit(0).alias("line"), F.explode(F.array(lines_terms(F.col("text")))).alias("terms"))
    units = lines.unionByName(several).unionByName(whole).where(F.arrays_overlap("terms", wanted))
    return that_may_reach(units, weights, common, min_score)


def unit_scores(counted: DataFrame, frequency: DataFrame, sides: DataFrame, total: int, min_score: float) -> DataFrame:
    """(_row, license, score, line): the best unit of each row that has one. 'proprietary' counts where no licence is stated."""
    held = counted.groupBy("term").agg(F.count(F.lit(1)).alias("held"))
    known = staged(frequency.join(held, "term"), "license-known")
    weighed = spread_join(counted, known, ["term"], F.col("held") > counted.count() // HOT_KEYS).withColumn("w", weight("tf", "df", total))
    weighed = staged(weighed.select("_row", "unit", "line", "term", "w"), "license-weights")
    norms = weighed.groupBy("_row", "unit", "line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    # the templates' terms: fixed
    dots = weighed.join(F.broadcast(sides), "term").groupBy("_row", "unit", "line", "template", "license").agg(F.sum(F.col("w") * F.col("t")).alias("dot"))
    scored = dots.join(norms, ["_row", "unit", "line"]).withColumn("score", F.round(F.col("dot") / F.col("norm"), 4)).where(F.col("score") >= min_score)
    best = scored.groupBy("_row").agg(F.min(F.struct((F.col("license") == "proprietary").alias("p"), (-F.col("score")).alias("s"), "line", "license")).alias("x"))
    return best.select("_row", F.col("x.license").alias("license"), (-F.col("x.s")).alias("score"), F.col("x.line").cast("long").alias("line"))


def scan_licenses(df: DataFrame, min_score: float = 0.6, id_col: str = "doc_id", text_col: str = "text", path_col: str = "path") -> DataFrame:
    """One row per input row: doc_id, path, license, how (stated, inherited or none), score, line, licensed_by.

    A licence file is one that is named as such, or whose first line or first block states a licence; of several in one
    directory the one with the smallest id speaks for it. Of units with equal scores the one that begins first counts,
    then the licence first by name; a licence goes before 'proprietary', all rights reserved. licensed_by is the
    directory inherited from. Null and empty texts state nothing; a null path is in no directory; repeated rows are
    each returned; an empty table gives an empty result; other columns are ignored.
    """
    spark = df.sparkSession
    text, path = F.col(text_col).cast("string"), F.col(path_col).cast("string")
    each = df.select(text.alias("text"))
    total = each.count()
    frequency = staged(each.select(F.explode(document_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")), "license-frequency")
    sides = staged(template_sides(spark, frequency, total), "license-sides")
    keys = key_terms(sides, min_score)
    vocabulary = sides.select("term").distinct().join(frequency, "term", "left").select("term", weight_of_df("df", total).alias("w"))
    weights = {r.term: r.w for r in vocabulary.collect()}  # of the templates, whatever the corpus
    others = frequency.join(F.broadcast(sides.select("term").distinct()), "term", "left_anti").orderBy(F.desc("df"), "term").limit(COMMON)
    common = {r.term: r.w for r in others.select("term", weight_of_df("df", total).alias("w")).collect()}
    # row numbers hold for one reading of df only, so all that is needed of it from here on is read and staged at once
    rows = df.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_col).alias("doc_id"),
        path.alias("path"),
        F.regexp_replace(path, "/?[^/]*$", "").alias("dir"),
        F.when(F.arrays_overlap(document_terms(text), F.array(*map(F.lit, keys)).cast("array<string>")), text).alias("text"),
    )
    rows = staged(rows, "license-rows")
    # few bytes with much to do for each: dealt out anew, or they would be read by few tasks
    some = rows.where("text is not null").select("_row", "path", "text").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "_row")
    counted = staged(unit_terms(some, keys, weights, common, min_score), "license-terms")
    stated = staged(unit_scores(counted, frequency, sides, total, min_score), "license-statements")
    files = staged(rows.drop("text").join(stated, "_row", "left"), "license-files")
    named = files.where("license is not null and dir is not null").where((F.col("line") == 0) | F.rlike("path", F.lit(NAMED)))
    named = named.groupBy("dir").agg(F.min(F.struct("doc_id", "license")).alias("x"))
    speaking = named.select(F.col("dir").alias("licensed_by"), F.col("x.license").alias("from_dir"))
    dirs = files.where("license is null and dir is not null").groupBy("dir").agg(F.count(F.lit(1)).alias("_files"))
    depth = F.size(F.split("dir", "/"))
    above = dirs.withColumn("depth", F.explode(F.sequence(F.lit(0), depth))).withColumn("up", F.expr("substring_index(dir, '/', depth)"))
    nearest = above.join(speaking, F.col("up") == F.col("licensed_by")).groupBy("dir").agg(F.max_by(F.struct("licensed_by", "from_dir"), "depth").alias("x"), F.first("_files").alias("_files"))
    nearest = staged(nearest.select("dir", "x.licensed_by", "x.from_dir", "_files"), "license-nearest")
    none = F.lit(None).cast("string")
    own = files.where("license is not null").select("doc_id", "path", "license", F.lit("stated").alias("how"), "score", "line", none.alias("licensed_by"))
    left = files.where("license is null")
    heirs = spread_join(left, nearest, ["dir"], F.col("_files") > total // HOT_KEYS)
    heirs = heirs.select("doc_id", "path", F.col("from_dir").alias("license"), F.lit("inherited").alias("how"), "score", "line", "licensed_by")
    bare = left.join(nearest.select("dir"), "dir", "left_anti").select("doc_id", "path", none.alias("license"), F.lit("none").alias("how"), "score", "line", none.alias("licensed_by"))
    return own.unionByName(heirs).unionByName(bare)


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: source/thousands/hundreds/id. Round hundreds are licence files: a round thousand in its source's directory, any other in its thousand's."""
    i = F.col("doc_id")
    licence = F.concat(F.lit("LICENSE-"), i.cast("string"))
    path = F.when(i % 1000 == 0, F.concat_ws("/", "source", licence)).when(i % 100 == 0, F.concat_ws("/", "source", F.expr("string(doc_id div 1000)"), licence))
    path = path.otherwise(F.concat_ws("/", "source", F.expr("string(doc_id div 1000)"), F.expr("string(doc_id div 100)"), i.cast("string")))
    return scan_licenses(stack(spark, sf_dir, "documents").withColumn("path", path))


def _sql() -> str:
    """Every line, every block and every whole licence file against every template, without the bound."""
    quoted = lambda x: "'" + x.lower().replace("'", "''") + "'"
    values = ", ".join(f"({i}, '{k}', {quoted(v)})" for i, (k, v) in enumerate(TEMPLATES))
    return f"""
with total as (select count(*) as n from documents
), frequency as (
  select term, count(*) as df from (select unnest(list_distinct(regexp_extract_all(lower(text), '{TERM}'))) as term from documents) group by 1
), lines as (
  select doc_id, line, regexp_matches(said, '{BLANK}') as blank, regexp_extract_all(regexp_replace(lower(said), '{NOTICE}', ' '), '{TERM}') as terms
  from (select doc_id, unnest(range(len(string_split(text, chr(10))))) as line, unnest(string_split(text, chr(10))) as said from documents)
), marked as (
  select * from (select *, count(*) filter (where blank) over (partition by doc_id order by line rows unbounded preceding) as block from lines) where not blank
), units as (
  select doc_id, 'l' || line as unit, line, terms from marked
  union all
  select doc_id, 'w', 0, terms from marked where doc_id % 100 = 0
  union all
  select doc_id, 'b' || block, first_line, terms from (select *, min(line) over w as first_line, count(*) over w as n from marked window w as (partition by doc_id, block)) where n > 1
), counted as (
  select doc_id, unit, line, term, count(*) as tf from (select doc_id, unit, line, unnest(terms) as term from units) group by all
), vocabulary as (
  select template, license, term, count(*) as tf
  from (select template, license, unnest(regexp_extract_all(regexp_replace(said, '{NOTICE}', ' '), '{TERM}')) as term from (values {values}) as t(template, license, said)) group by all
), sides as (
  select template, license, term, w / sqrt(sum(w * w) over (partition by template)) as t
  from (select template, license, v.term, (ln(v.tf) + 1) * (ln((n + 1.0) / (coalesce(f.df, 0) + 1.0)) + 1) as w from vocabulary v cross join total left join frequency f on v.term = f.term)
), weights as (
  select doc_id, unit, line, c.term, (ln(c.tf) + 1) * (ln((n + 1.0) / (f.df + 1.0)) + 1) as w from counted c cross join total join frequency f on c.term = f.term
), scored as (
  select d.doc_id, d.line, d.license, round(d.dot / m.norm, 4) as score
  from (select doc_id, unit, line, template, license, sum(w * t) as dot from weights join sides on weights.term = sides.term group by all) d
  join (select doc_id, unit, sqrt(sum(w * w)) as norm from weights group by all) m on d.doc_id = m.doc_id and d.unit = m.unit
), best as (
  select doc_id, license, score, line
  from scored where score >= 0.6 qualify row_number() over (partition by doc_id order by license = 'proprietary', score desc, line, license) = 1
), files as (
  select d.doc_id, b.license, b.score, b.line,
         case when d.doc_id % 1000 = 0 then source
              when d.doc_id % 100 = 0 then source || '/' || (d.doc_id // 1000)
              else source || '/' || (d.doc_id // 1000) || '/' || (d.doc_id // 100) end as dir
  from documents d left join best b on d.doc_id = b.doc_id
), speaking as (
  select dir, arg_min(license, doc_id) as license from files where license is not null and (line = 0 or doc_id % 100 = 0) group by dir
), above as (
  select dir, unnest(range(1, len(string_split(dir, '/')) + 1)) as depth from (select distinct dir from files)
), nearest as (
  select a.dir, s.dir as licensed_by, s.license from above a
  join speaking s on s.dir = array_to_string(string_split(a.dir, '/')[1:a.depth], '/')
  qualify row_number() over (partition by a.dir order by a.depth desc) = 1
)
select f.doc_id, f.dir || '/' || case when f.doc_id % 100 = 0 then 'LICENSE-' else '' end || f.doc_id as path, coalesce(f.license, n.license) as license,
       case when f.license is not null then 'stated' when n.license is not null then 'inherited' else 'none' end as how,
       f.score, f.line, case when f.license is null then n.licensed_by end as licensed_by
from files f left join nearest n on f.dir = n.dir
"""


SQL = _sql()
