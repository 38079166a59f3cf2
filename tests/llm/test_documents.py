"""Operators on documents against brute force, over a whole small table and over awkward rows."""

import math
import zlib

import numpy as np
import pytest

from stocktake.llm import op1_pii, op2_packing, op3_token_counts, op4_decontamination, op5_quality_rules, op6_line_dedup, op7_sharding, op8_substring_dedup, op9_jaccard_join, tokenizing

from . import brute


@pytest.fixture(params=["small", "nasty", "empty"])
def docs(request, small_docs, nasty_docs):
    return {"small": small_docs, "nasty": nasty_docs, "empty": []}[request.param]


def test_pii_base(docs, frame, rows):
    got = op1_pii.find_pii(frame(docs))
    want = sorted(((d, *brute.pii(t)[:5]) for d, t, _ in docs), key=repr)
    assert rows(got, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == want
    for r in got.collect():
        base = next(brute.pii(t)[5] for d, t, _ in docs if d == r.doc_id)
        assert set(base.split(",")) <= set(r.spans.split(","))


def test_pii_discovers_by_context(frame):
    docs = [(i, f"some text number\nplease call me at +1 (656) 555-{1000 + i} any day of the week", "a") for i in range(30)]
    docs += [(100 + i, f"please call me at 656-555-{2000 + i} any day of the week", "a") for i in range(3)]
    docs += [(200, "the part 656-555-2999 was sold", "a")]
    got = {r.doc_id: r for r in op1_pii.find_pii(frame(docs)).collect()}
    assert all(got[100 + i].spans == "phone:18:30" and got[100 + i].n_found == 1 for i in range(3))
    assert got[200].spans == "" and got[5].n_phone == 1


def test_pii_by_one_cue_and_in_chains(frame):
    """A left cue alone is enough where many seeds have it; what one round finds is a seed of the next, to the end."""
    rng = np.random.default_rng(4)
    word = lambda: f"w{rng.integers(0, 10**9)}"
    docs = [(i, f"{word()} {word()} phone: +1 (656) 555-{1000 + i} {word()} {word()}", "a") for i in range(1500)]
    docs += [(10_000 + i, f"{word()} {word()} phone: 656-555-{2000 + i} {word()} {word()}", "a") for i in range(4)]
    # 'phone' finds numbers that stand at 'desk' too, these make 'desk' sure and find those at 'room', which find the one at 'hall'
    chain = [("phone:", "desk", 200), ("desk", "room", 30), ("room", "hall", 1)]
    docs += [(20_000 + 1000 * step + i, f"{word()} {word()} {a} 656-{700 + step}-{3000 + i} {word()} {word()}", "a") for step, (*cues, n) in enumerate(chain) for i in range(n) for a in cues]
    docs += [(30_000 + i, f"{word()} {word()} part 656-555-{5000 + i} {word()} {word()}", "a") for i in range(30)]
    got = {}
    for r in op1_pii.find_pii(frame(docs)).collect():
        got[r.doc_id] = max(got.get(r.doc_id, 0), r.n_found)
    assert all(got[10_000 + i] == 1 for i in range(4)) and all(got[20_000 + 1000 * k + i] == 1 for k, (*_, n) in enumerate(chain) for i in range(n))
    assert not any(got[30_000 + i] for i in range(30))


@pytest.mark.parametrize("seed", range(4))
def test_pii_graph(spark, seed):
    """Random graphs with hubs, conflicts between kinds, ties, and discoveries in later rounds."""
    rng = np.random.default_rng(seed)
    mentions = []
    for i in range(400):
        kind = int(rng.integers(0, 4))
        seeded = rng.random() < 0.6
        shape = 1 << kind | (int(rng.integers(0, 16)) if rng.random() < 0.5 else 0)
        cues = [f"p{kind}{rng.integers(0, 3)}" if rng.random() < 0.9 else f"p{rng.integers(0, 4)}{rng.integers(0, 6)}" for _ in range(rng.integers(1, 4))]
        for _ in range(rng.integers(1, 3)):
            mentions.append((i, kind if seeded else None, shape, [hash_of(x) for x in {*cues, *(["hub"] if rng.random() < 0.5 else [])}]))
    mentions.append((7, None, 15, [hash_of("p00")]))
    df = spark.createDataFrame(mentions, "instance long, kind int, shape int, patterns array<long>")
    got = {r.instance: r.kind for r in op1_pii.believed(df, 5, 0.6, 0.8, 0.25).collect()}
    assert got == brute.pattern_graph(mentions, 5, 0.6, 0.8, 0.25) and 20 < len(got) < 160


def hash_of(x):
    return zlib.crc32(x.encode())


def test_pii_contexts_are_words():
    far = "call" + " " * 500 + "+1 (656) 555-1000" + "\n" * 300 + "x" * 900
    s = far.index("+")
    assert op1_pii.patterns(far, s, s + 17) == ["call _", f"{op1_pii.EDGE} call _", "call _ " + "x" * 900, "_ " + "x" * 900 + f" {op1_pii.EDGE}", "_ " + "x" * 900]


def test_packing_round_trip(docs, frame):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizing.public_path("word_bpe_49k.json"))
    got = op2_packing.pack(frame(docs), keep_ids=True).collect()
    want = sorted((d, [*whole.encode(t or "", add_special_tokens=False).ids, 2]) for d, t, _ in docs) if docs else []
    by = {}
    for r in got:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for (d, n), pieces in by.items():
        ids = next(i for x, i in want if x == d and len(i) == n)
        copies = sum(x == d for x, _ in want)
        for start in {p.start for p in pieces}:
            same = [p for p in pieces if p.start == start]
            assert len(same) == copies and all(p.ids == ids[start : start + p.length] for p in same)
        assert sum(p.length for p in pieces) == copies * n
    assert {d for d, _ in by} == {d for d, _, _ in docs}
    used = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert used.get(r.sequence_id, 0) == r.offset
        used[r.sequence_id] = r.offset + r.length
    assert all(n <= 4096 for n in used.values()) and set(used) == set(range(len(used)))


def sequences_of(histogram, room, **options):
    """How many sequences a plan needs, checked to hold the histogram exactly; and where it is from."""
    made, origin = op2_packing.plan(histogram, room, **options)
    held = {}
    for p, times in made:
        assert times > 0 and sum(s * n for s, n in p.items()) <= room
        for s, n in p.items():
            held[s] = held.get(s, 0) + n * times
    assert held == histogram
    return sum(t for _, t in made), origin


def test_packing_is_tight():
    rng = np.random.default_rng(3)
    for low, room in ((1, 256), (60, 256), (1, 4096)):
        sizes, counts = np.unique(rng.integers(low, room + 1, 50_000), return_counts=True)
        histogram = dict(zip(sizes.tolist(), counts.tolist()))
        n, _ = sequences_of(histogram, room)
        assert n <= (1.004 if low == 1 else 1.2) * sum(s * n for s, n in histogram.items()) / room + 3


def test_packing_by_columns():
    """Where largest first wastes room, column generation doesn't; with no rounds the plan still holds all."""
    rng = np.random.default_rng(0)
    sizes, counts = np.unique(rng.integers(1300, 1500, 200_000), return_counts=True)
    histogram = dict(zip(sizes.tolist(), counts.tolist()))
    first = sum(t for _, t in op2_packing.greedy(histogram, 4096))
    n, origin = sequences_of(histogram, 4096)
    assert n < 0.95 * first and origin == "columns"
    worse, origin = sequences_of(histogram, 4096, effort=0)
    assert worse > n and origin in ("effort", "largest first")
    assert op2_packing.plan({}, 101) == ([], "columns") and sequences_of({101: 7}, 101) == (7, "columns")


@pytest.mark.parametrize("seed", range(40))
def test_packing_of_few_rests_against_all_ways(seed):
    """The true optimum of tiny cases by search; the bound never exceeds it, and the plan is at most one sequence over it."""
    from functools import cache

    rng = np.random.default_rng(seed)
    room = int(rng.integers(8, 30))
    rests = sorted(rng.integers(max(1, room // 6), room + 1, int(rng.integers(1, 9))).tolist())

    @cache
    def least(left):
        if not left:
            return 0
        head, rest = left[-1], left[:-1]
        return 1 + min(least(tuple(r for i, r in enumerate(rest) if not mask >> i & 1)) for mask in range(1 << len(rest)) if head + sum(r for i, r in enumerate(rest) if mask >> i & 1) <= room)

    p = op2_packing.planned({s: rests.count(s) for s in rests}, room)
    n, _ = sequences_of({s: rests.count(s) for s in rests}, room)
    assert p.bound <= least(tuple(rests)) + 1e-6 and least(tuple(rests)) <= n <= least(tuple(rests)) + 1


def test_program_in_a_session(spark):
    """In a process whose session has run a job: two hundred and two thousand lengths, with columns that enter."""
    assert spark.range(10).selectExpr("sum(id) as s").collect()[0].s == 45
    rng = np.random.default_rng(2)
    for low, high in ((1300, 1500), (100, 2100)):
        sizes, counts = np.unique(rng.integers(low, high, 200_000), return_counts=True)
        p = op2_packing.planned(dict(zip(sizes.tolist(), counts.tolist())), 4096, effort=50_000)
        assert p.entered > 0 and sum(t for _, t in p.made) >= p.bound - 1e-6


def test_columns_enter_for_the_tables(spark, monkeypatch):
    """Of the documents' own lengths: the query's plan is priced, and needs no more sequences than the bound rounded up."""
    plans = []
    monkeypatch.setattr(op2_packing, "planned", lambda *a, plan=op2_packing.planned: plans.append(plan(*a)) or plans[-1])
    got = op2_packing.op2_packing(spark, "/root/testdata/sf0.01").agg({"sequence_id": "max"}).collect()
    (p,) = plans
    assert p.entered > 0 and p.origin == "columns" and got[0][0] + 1 == sum(t for _, t in p.made) <= math.ceil(p.bound)


def test_tokens_merge_back():
    """Every token's own bytes merge back into it by the vocabulary's merges: then both ways of merging agree on all texts."""
    import json

    path = tokenizing.public_path("word_bpe_49k.json")
    byte = tokenizing.byte_characters()

    def raw(token):
        end = token.endswith("</w>")
        return bytes(byte[c] for c in (token[:-4] if end else token)) + b"\xff" * end

    merges = {}
    with open(path, encoding="utf-8") as f:
        for i, x in enumerate(json.load(f)["model"]["merges"]):
            a, b = x.split(" ") if isinstance(x, str) else x
            merges[raw(a), raw(b)] = i
    ranks = tokenizing.suffixed_ranks(path)
    assert all(ranks[a + b] == 512 + i for (a, b), i in merges.items())
    for token in ranks:
        parts = [bytes([c]) for c in token]
        if len(parts) > 1 and parts[-1] == b"\xff":
            parts[-2:] = [parts[-2] + b"\xff"]
        while len(parts) > 1:
            rank, i = min((merges.get((parts[i], parts[i + 1]), 1 << 30), i) for i in range(len(parts) - 1))
            assert rank < 1 << 30, token
            parts[i : i + 2] = [parts[i] + parts[i + 1]]


@pytest.fixture(scope="module")
def token_bytes():
    """The lengths in bytes of a text's tokens, by another library than the operator's, from the same vocabulary."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizing.public_path("byte_bpe_50k.json"))

    def lengths(text):
        for special in ("<|endoftext|>",):  # the operator knows no special tokens
            assert special not in text
        return [len(whole.id_to_token(i)) for i in whole.encode(text, add_special_tokens=False).ids]

    return lengths


def attributed(lengths, sections):
    """Tokens of each section, the plain way; sections are spans of bytes, in order."""
    counts, at = [0] * len(sections), 0
    for n in lengths:
        over = [max(0, min(at + n, y) - max(at, x)) for x, y in sections]
        own = over.index(max(over)) if max(over) else max((k for k, (x, _) in enumerate(sections) if x < at + n), default=0)
        counts[own] += 1
        at += n
    return counts


def test_token_counts(docs, frame, token_bytes):
    docs = [(d, (t or "").replace("<|endoftext|>", "<end>"), s) for d, t, s in docs]
    got = {}
    for r in op3_token_counts.count_tokens(frame(docs)).collect():
        got.setdefault(r.doc_id, {}).setdefault(r.section, []).append(r)
    assert set(got) == {d for d, _, _ in docs}
    for d, text in {(d, t) for d, t, _ in docs}:
        lines, at = [], 0
        for x in text.split("\n"):
            lines.append((at, at + len(x.encode())))
            at += len(x.encode()) + 1
        lengths = token_bytes(text)
        want = attributed(lengths, lines)
        assert sum(lengths) == len(text.encode()) and len(got[d]) == len(lines)
        for k, (x, y) in enumerate(lines):
            for r in got[d][k]:
                assert text[r.char_start : r.char_end].encode() == text.encode()[x:y] and (r.doc_tokens, r.n_tokens) == (len(lengths), want[k])


def test_crossing_tokens_go_by_most_bytes(spark):
    df = spark.createDataFrame([(1, "hello world", [(0, 3), (3, 11)])], "doc_id long, text string, parts array<struct<start:int,end:int>>")
    got = [tuple(r) for r in op3_token_counts.count_tokens(df, sections_col="parts").orderBy("section").collect()]
    assert sum(r[4] for r in got) == got[0][6] == 2 and sum(r[5] for r in got) == 1


def test_any_sections(spark, token_bytes):
    """Sections in any order, overlapping, empty, beyond the text, without a bound, or none at all; texts with wide characters."""
    rng = np.random.default_rng(2)
    texts = ["héllo wörld, 漢字 and\n\n\nthe rest of it " * 3, "plain words only " * 5, "", "é"]
    rows = [(0, None, [(0, 4)]), (1, texts[0], None), (2, texts[0], []), (3, texts[0], [None, (None, 4), (2, None)]), (4, texts[0], [(5, 900), (-7, 3), None, (3, 3), (9, 2)])]
    for i in range(60):
        t = texts[i % 4]
        rows.append((10 + i, t, [tuple(int(x) for x in rng.integers(-5, len(t) + 9, 2)) for _ in range(rng.integers(1, 7))]))
    df = spark.createDataFrame(rows, "doc_id int, text string, parts array<struct<start:int,end:int>>").repartition(3)
    got = {}
    for r in op3_token_counts.count_tokens(df, sections_col="parts").collect():
        got.setdefault(r.doc_id, {})[r.section] = r
    for d, text, parts in rows:
        text = text or ""
        given = list(parts or ())
        known = [(x, i) for i, x in enumerate(given) if x and None not in x]
        if not known:
            given.append((0, len(text)))
            known = [((0, len(text)), len(given) - 1)]
        clamp = lambda x: min(max(x, 0), len(text))
        spans, reached = [], 0
        for s, e, i in sorted((clamp(s), clamp(e), i) for (s, e), i in known):
            s, e, reached = max(s, reached), e, max(reached, e)
            spans.append((len(text[:s].encode()), len(text[: max(s, e)].encode()), i))
        counts = attributed(token_bytes(text), [x[:2] for x in spans])
        want = dict.fromkeys(range(len(given)), 0) | {i: n for (_, _, i), n in zip(spans, counts)}
        assert {k: r.n_tokens for k, r in got[d].items()} == want, (d, text, parts)
        assert [(r.char_start, r.char_end) for _, r in sorted(got[d].items())] == [x or (None, None) for x in given]
        assert {r.doc_tokens for r in got[d].values()} == {len(token_bytes(text))}


ITEMS = [(1, "w1 w2 w3"), (2, None), (3, "..."), (None, "w4 w5"), (None, "w8"), (3, "The same line of navigation everywhere. w5 w6 w7 w8 w9 w10"), (9, "A LINE that is long enough to count other words stand here")]


@pytest.mark.parametrize("blocks", [1_000_000, 40])
def test_decontamination(docs, frame, rows, spark, blocks):
    """In one block and in many, with an item longer than a block, items that repeat an id, and items without one."""
    items = ITEMS + [(100 + d, t[50:400]) for d, t, _ in docs[3:9] if t] + [(7, t[:3000]) for _, t, _ in docs[10:11] if t]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = op4_decontamination.contamination(frame(docs), bench, block_windows=blocks)
    want = sorted(brute.contamination([(d, t) for d, t, _ in docs], items), key=repr)
    assert rows(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want
    whole = op4_decontamination.contamination(frame(docs), bench)
    assert rows(got, "doc_id", "spans", "items") == rows(whole, "doc_id", "spans", "items")
    assert rows(op4_decontamination.decontaminate(frame(docs), bench, block_windows=blocks), "doc_id") == [(d,) for d, *_, bad in want if not bad]


@pytest.mark.parametrize("blocks", [1_000_000, 2])
def test_spans_are_cut_out(docs, frame, rows, spark, blocks):
    df = spark.createDataFrame([(1, "Keep this. One two, THREE four! And this."), (2, "clean"), (3, "one two three four ONE-TWO-THREE-FOUR five"), (4, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "one two three four"), (2, "four five")], "item_id long, text string")
    got = dict(tuple(r) for r in op4_decontamination.decontaminate(df, bench, remove="spans", block_windows=blocks).collect())
    assert {k: v or "" for k, v in got.items()} == {1: "Keep this. ! And this.", 2: "clean", 3: "", 4: ""}
    items = ITEMS + [(100 + d, t[50:400]) for d, t, _ in docs[3:9] if t]
    bench = spark.createDataFrame(items, "item_id long, text string")
    left = rows(op4_decontamination.decontaminate(frame(docs), bench, remove="spans", block_windows=10 * blocks), "doc_id", "text")
    word = lambda t: brute.BENCH_WORD.findall(brute.lower(t or ""))
    counts = {(d, n - hit) for d, n, hit, *_ in brute.contamination([(d, t) for d, t, _ in docs], items)}
    assert {(d, len(word(t))) for d, t in left} == counts and len(left) == len(docs)


def test_quality(docs, frame, rows):
    got = op5_quality_rules.quality(frame(docs), max_docs=5)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert rows(got, "doc_id", *names) == sorted(((d, *brute.quality_base(t)) for d, t, _ in docs), key=repr)
    want = brute.quality(docs, 5, 0.3)
    assert {r.doc_id: (r.kept, r.n_boilerplate_words) for r in got.collect()} == {d: x[:2] for d, x in want.items()}
    assert {r.doc_id for r in op5_quality_rules.keep_good(frame(docs), max_docs=5).collect()} == {d for d, x in want.items() if x[0]}
    assert {r.doc_id: r.text or "" for r in op5_quality_rules.clean_good(frame(docs), max_docs=5).collect()} == {d: x[2] for d, x in want.items() if x[0]}


def test_boilerplate_goes_and_copies_stay(frame):
    rng = np.random.default_rng(1)
    line = lambda n: " ".join(f"v{x}" for x in rng.integers(0, 900, n))
    menu, article = line(30), "\n".join(line(12) for _ in range(8))
    docs = [(i, f"{menu}\n{line(4)}", "h") for i in range(60)] + [(100 + i, article, "h") for i in range(60)] + [(200, f"{menu}\n{line(60)}", "h")]
    kept = {r.doc_id: r.kept for r in op5_quality_rules.quality(frame(docs)).collect()}
    assert not any(kept[i] for i in range(60)) and all(kept[100 + i] for i in range(60)) and kept[200]


def test_line_dedup(docs, frame, rows):
    got = op6_line_dedup.dedup_lines(frame(docs))
    assert rows(got, "doc_id", "n_lines", "n_dropped", "text") == sorted(brute.line_dedup([(d, t) for d, t, _ in docs]), key=repr)
    assert set(got.columns) == set(frame(docs).columns) | {"n_lines", "n_dropped"}


def test_sharding(docs, frame):
    got = op7_sharding.interleave(frame(docs)).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in docs)
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r)
    assert all(sorted(r.slot for r in s) == list(range(len(s))) for s in shards.values())
    if docs:
        sizes = [len(shards.get(i, ())) for i in range(8)]
        assert max(sizes) - min(sizes) <= 1
        host = {d: s for d, _, s in docs}
        for h in set(host.values()):
            own = [sum(host[r.doc_id] == h for r in shards[i]) for i in range(8)]
            assert max(own) - min(own) <= 2
    assert sorted(map(tuple, op7_sharding.interleave(frame(docs[::-1])).collect())) == sorted(map(tuple, got)) if docs else True


def test_sharding_many_sources(frame):
    """Thousands of sources with one row, one with a third of all rows, and rows without an id, in bulk."""
    docs = [(i, f"text {i}", f"site{i}") for i in range(3000)] + [(10_000 + i, "copy", "hot") for i in range(2000)] + [(None, "nameless", None)] * 1000
    got = op7_sharding.interleave(frame(docs)).collect()
    assert len(got) == 6000 and all(sum(r.shard == k for r in got) == 750 for k in range(8))
    assert all(sorted(r.slot for r in got if r.shard == k) == list(range(750)) for k in range(8))
    for kind in (lambda r: r.doc_id is not None and r.doc_id >= 10_000, lambda r: r.doc_id is None):
        own = [sum(map(kind, (r for r in got if r.shard == k))) for k in range(8)]
        assert max(own) - min(own) <= 2


def test_substrings(docs, frame, rows):
    got = op8_substring_dedup.dedup_substrings(frame(docs))
    assert rows(got, "doc_id", "n_words", "n_removed", "text") == sorted(brute.substrings([(d, t) for d, t, _ in docs]), key=repr)


def test_repeats_are_repeats(docs, frame):
    """Words at both places are the same, the other place is earlier, no two repeats run on, and together they are what goes."""
    docs = list({d: (d, t, s) for d, t, s in docs}.values())
    words = {d: brute.WORD.findall(t or "") for d, t, _ in docs}
    for r in op8_substring_dedup.dedup_substrings(frame(docs)).collect():
        gone, ends = set(), set()
        for x in r.repeats:
            assert x.length >= 20 and (x.other, x.other_start) < (r.doc_id, x.start)
            assert words[x.other][x.other_start : x.other_start + x.length] == words[r.doc_id][x.start : x.start + x.length]
            assert (x.other, x.other_start, x.start) not in ends
            ends.add((x.other, x.other_start + x.length - 19, x.start + x.length - 19))
            gone |= set(range(x.start, x.start + x.length))
        assert len(gone) == r.n_removed


def test_groups(docs, frame, rows):
    got = op9_jaccard_join.similar_groups(frame(docs))
    want = brute.groups([(d, t) for d, t, _ in docs])
    assert rows(got, "doc_id", "n_shingles", "component_id") == sorted(want, key=repr)
    assert {r.doc_id for r in op9_jaccard_join.keep_first(frame(docs)).collect()} == {d for d, _, c in want if d == c}


def test_late_links_are_found(frame, rows, monkeypatch):
    """Sets that share index lists with a first set that neither links to still find each other."""
    rng = np.random.default_rng(7)
    base = [f"b{x}" for x in rng.integers(0, 10_000, 300)]
    docs = []
    for i in range(40):
        w = list(base)
        for p in rng.choice(300, 12, replace=False) if i % 2 else rng.choice(60, 5, replace=False) + 200:
            w[p] = f"n{i}x{p}"
        docs.append((i, " ".join(w), "a"))
    monkeypatch.setattr(op9_jaccard_join, "BLOCK", 7)
    monkeypatch.setattr(op9_jaccard_join, "MEMBERS", 3)
    monkeypatch.setattr(op9_jaccard_join, "BROADCAST_IDS", 5)
    got = op9_jaccard_join.similar_groups(frame(docs))
    assert rows(got, "doc_id", "n_shingles", "component_id") == sorted(brute.groups([(d, t) for d, t, _ in docs]), key=repr)


def test_null_ids(frame, rows):
    text = " ".join(f"w{i}" for i in range(60)) + "\nA line that is long enough to count."
    docs = [(None, text, "a"), (1, text, "a"), (None, None, None), (2, text, "b")]
    assert rows(op9_jaccard_join.similar_groups(frame(docs)), "doc_id", "component_id") == [(1, 1), (2, 1), (None, None), (None, None)]
    assert rows(op8_substring_dedup.dedup_substrings(frame(docs)), "doc_id", "n_removed") == [(1, 0), (2, 68), (None, 0), (None, 0)]
    assert [r[1] for r in rows(op6_line_dedup.dedup_lines(frame(docs)), "doc_id", "n_dropped")] == [0, 0, 0, 0]
    for got in (op1_pii.find_pii, op2_packing.pack, op3_token_counts.count_tokens, op5_quality_rules.quality, op7_sharding.interleave):
        assert {r.doc_id for r in got(frame(docs)).collect()} == {None, 1, 2}
