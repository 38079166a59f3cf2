"""Token counts by offset-mapped attribution.

A document is encoded once, whole. Its tokens' spans are laid over the spans of its sections, an interval join of two
sorted lists inside the row, and every token goes to one section:

- a token that overlaps one section goes there;
- a token that crosses a boundary goes to the section with most of its bytes, of equals to the earlier one;
- a token that overlaps none, such as a line break, goes to the last section that begins before its end, or to the first.

So the counts of a document's sections add up to the document's count, which encoding sections one by one would not
give. Spans are compared in bytes; a byte-level token can be part of a character, and sections begin and end between
characters.

Sections can come in any order, overlap, or lie outside the text. Bounds are held to the text; the sections are sorted by
where they begin and end, then as listed; where they overlap, the text belongs to the first. A section that nothing is
left of, or that ends before it begins, is empty and overlaps no token; one without a bound has no tokens at all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, col, out_batch, stack
from .tokenizing import public_path, token_lengths


def attribute(token_ends: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of them also lie outside it. Sections are sorted and don't overlap."""
    k = len(begin)
    if not len(token_ends):
        return np.zeros(k, np.int64), np.zeros(k, np.int64)
    token_begins = np.concatenate([[0], token_ends[:-1]])
    first = np.searchsorted(end, token_begins, "right")
    last = np.searchsorted(begin, token_ends, "left") - 1
    own = np.minimum(first, last)
    for t in np.flatnonzero(last > first):
        i, j = first[t], last[t] + 1
        overlap = np.minimum(end[i:j], token_ends[t]) - np.maximum(begin[i:j], token_begins[t])
        own[t] = i + int(overlap.argmax()) if overlap.max() > 0 else last[t]
    own = np.maximum(own, 0)
    crossing = (first <= last) & ((token_begins < begin[own]) | (token_ends > end[own]))
    return np.bincount(own, minlength=k), np.bincount(own[crossing], minlength=k)


def line_spans(text: str) -> tuple[list[int], list[int]]:
    begin, end, at = [], [], 0
    for line in text.split("\n"):
        begin.append(at)
        end.append(at + len(line))
        at += len(line) + 1
    return begin, end


def byte_places(text: str, places: np.ndarray) -> np.ndarray:
    """Bytes before each of the places, which count characters."""
    b = text.encode()
    if len(b) == len(text):
        return places
    starts = np.flatnonzero((np.frombuffer(b, np.uint8) & 0xC0) != 0x80)
    return np.append(starts, len(b))[places]


def in_order(text: str, sections: list[tuple[int | None, int | None] | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which sections have both bounds, in the order of the text, and their bounds: in the text and without overlaps."""
    known = sorted((min(max(x[0], 0), len(text)), min(max(x[1], 0), len(text)), i) for i, x in enumerate(sections) if x and None not in x)
    begin, end, which = (np.array([x[k] for x in known], np.int64) for k in range(3))
    reached = np.concatenate([[0], np.maximum.accumulate(end)[:-1]]) if len(end) else end
    begin = np.maximum(begin, reached)
    return which, begin, np.maximum(begin, end)


def count_tokens(df: DataFrame, path: str | None = None, sections_col: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per section: doc_id, section, char_start, char_end, n_tokens, n_crossing, doc_tokens.

    sections_col is an array of structs (start, end) in characters; without it the sections are the lines, without
    their line breaks. Sections are numbered from 0, as listed, and come back with the bounds given. A document without
    sections has one, its whole text; so has one whose sections all lack a bound, after them. A null or empty text has
    no tokens; its one line has none. Repeated rows are each counted; an empty table gives an empty result; other
    columns are ignored.
    """
    path = path or public_path("byte_bpe_50k.tiktoken")
    picked = [F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    if sections_col:
        picked.append(F.transform(F.col(sections_col), lambda x: F.struct(x["start"].cast("long").alias("s"), x["end"].cast("long").alias("e"))).alias("spans"))
    rows = df.select(*picked)

    def look(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = token_lengths(path)
        own = [x or "" for x in col(batch, "text").to_pylist()]
        spans = col(batch, "spans").to_pylist() if sections_col else None
        at, parts = [], [[] for _ in range(6)]
        for i, text in enumerate(own):
            if spans is None:
                begin, end = line_spans(text)
                given = list(zip(begin, end, strict=True))
                which = np.arange(len(begin))
            else:
                given = [x and (x["s"], x["e"]) for x in spans[i] or ()]
                which, begin, end = in_order(text, given)
                if not len(which):
                    given.append((0, len(text)))
                    which, begin, end = np.array([len(given) - 1]), [0], [len(text)]
            lengths = known.of(text)
            places = byte_places(text, np.array([begin, end], np.int64))
            n, crossing = np.zeros((2, len(given)), np.int64)
            n[which], crossing[which] = attribute(np.cumsum(lengths, dtype=np.int64), places[0], places[1])
            at.append(len(given))
            for p, x in zip(parts, ([x and x[0] for x in given], [x and x[1] for x in given], np.arange(len(given)), n, crossing, np.full(len(given), len(lengths))), strict=True):
                p.append(x)
        ids = col(batch, "doc_id").take(pa.array(np.repeat(np.arange(len(own)), at)))
        bounds = {k: pa.array([y for x in p for y in x], pa.int64()) for k, p in zip(("char_start", "char_end"), parts[:2], strict=True)}
        counts = {k: pa.array(np.concatenate(p)) for k, p in zip(("section", "n_tokens", "n_crossing", "doc_tokens"), parts[2:], strict=True)}
        return out_batch(doc_id=ids, section=counts.pop("section"), **bounds, **counts)

    schema = T.StructType([rows.schema["doc_id"], *T._parse_datatype_string("section long, char_start long, char_end long, n_tokens long, n_crossing long, doc_tokens long").fields])
    return arrow_map(rows, look, schema)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(stack(spark, sf_dir, "documents"))


#: SQL has no tokenizer; tests hold the counts against another library's tokens of the same vocabulary.
SQL = None
