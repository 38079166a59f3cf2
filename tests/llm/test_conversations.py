"""Conversation repair against a search over whole audits, with its lists of repaired rows."""

import hashlib
import random
import zlib
from functools import cache

import pytest

from stocktake.llm import op12_conversation_repair as op
from stocktake.llm.common import stack

SF = "/root/testdata/sf0.001"
BLANKS = " \t\n\x0b\x0c\r"
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damage(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k:
            text = "" if k == 1 else "".join(c for c in text if c not in ".!?") if k == 2 else text
            yield from [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)


def best(rows):
    """Cheapest (cost, audit, repaired) of (role, text, fault), over all ways, the least audit first."""

    @cache
    def rest(i, state, inserted):
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        follow = {"": "su", "s": "u", "u": "a", "a": "u"}[state]

        def add(price, letter, line, at, to, n):
            cost, audit, lines = rest(at, to, n)
            found.append((price + cost, letter + audit, (line, *lines) if line is not None else lines))

        if i < len(rows):
            role, text, fault = rows[i]
            add(2, "D", None, i + 1, state, 0)
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if role[:1] and role[:1] in follow:
                    add(more, "K", f"{role}:{text}", i + 1, role[0], 0)
                for r in ("user", "assistant"):
                    if r[0] in follow:
                        add(1 + more, "R", f"{r}:{text}", i + 1, r[0], 0)
        if inserted < 3:
            for r in ("user", "assistant"):
                if r[0] in follow:
                    add(5, "I", f"{r}:", i, r[0], inserted + 1)
        return min(found) if found else (10**9, "", ())

    return rest(0, "", 0)


def brute(rows, damaged=True):
    out = {}
    by = {c: [] for c, *_ in rows}
    for r in damage(rows) if damaged else [tuple(" " if x is None and i > 1 else x for i, x in enumerate(r)) for r in rows]:
        by[r[0]].append(r)
    for conv, own in by.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()))
        seen, rated = set(), []
        for _, _, role, text in own:
            full = text.strip(BLANKS)
            rated.append((role, text, "blank" if not full else "duplicate" if (role, text) in seen else "truncated" if full[-1] not in ".!?" else ""))
            seen.add((role, text))
        turns = [t for _, t, _, _ in own if t is not None]
        cost, audit, lines = best(tuple(rated))
        count = [sum(f == k for *_, f in rated) for k in ("blank", "duplicate", "truncated")]
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *count, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def result(df):
    return {r[0]: tuple(r)[1:] for r in df.select(*COLUMNS).collect()}


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "conv_id long, turn long, role string, text string, n int, run string, known int").repartition(3)


def made(rng, conversations, longest):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "User", "unknown"]
    texts = ["Yes.", "No?", "cut", "", " \n", None, "a b c.", "é!", "tail. \t", "one\ntwo."]
    rows = []
    for c in range(conversations):
        for t in range(rng.randrange(1, longest)):
            turn = rng.choice([t, t, t, t, t + 3, None, -t])
            text = rng.choice(texts) if rng.random() < 0.4 else f"text {rng.randrange(1000)}" + rng.choice([".", "!", "?", "", " ."])
            rows.append((c if rng.random() < 0.98 else None, turn, roles[t % 2 + 1] if rng.random() < 0.7 else rng.choice(roles), text))
    return rows + rows[:20] + rows[:5]


def test_tables(spark):
    rows = [tuple(r) for r in stack(spark, SF, "conversations").collect()]
    got = op.op12_conversation_repair(spark, SF)
    assert tuple(got.columns) == COLUMNS
    assert result(got) == brute(rows)


@pytest.mark.parametrize("damaged", [True, False])
def test_random_conversations(spark, damaged):
    rows = made(random.Random(4), 150, 12)
    assert result(op.repair(frame(spark, rows), damage=damaged)) == brute(rows, damaged)


@pytest.mark.parametrize("most", [1, 3, 50])
def test_long_conversations_go_in_runs(spark, monkeypatch, most):
    """One conversation has most rows: it is cut into runs of a few rows, which meet as matrices; results don't change."""
    monkeypatch.setattr(op, "RUN_ROWS", most)
    rng = random.Random(most)
    rows = made(rng, 30, 10) + [(77, t, ("user", "assistant")[(t + (t % 37 == 0)) % 2], rng.choice([f"row {t}.", f"row {t}", "often.", ""])) for t in range(300)]
    assert result(op.repair(frame(spark, rows), damage=False)) == brute(rows, False)
    many = frame(spark, rows)
    runs = op.runs_of(op.damaged(many, "conv_id", "turn", "role", "text", True))
    assert max(len(r.turn) for r in runs.collect()) <= most and runs.where("conv = 77").count() >= 300 // most


def test_one_row_repeated_very_often(spark):
    """Copies are counted before anything is shuffled: a single row stands for them."""
    rows = spark.range(20_000).selectExpr("1L as conv_id", "7L as turn", "'user' as role", "'Hm.' as text")
    assert op.damaged(rows, "conv_id", "turn", "role", "text", True).count() == 1
    (r,) = op.repair(rows, damage=False).collect()
    assert (r.duplicate, r.illegal, r.cost, r.gaps, r.n_rows) == (19_999, 19_999, 40_000, 0, 20_000) and r.audit == "D" * 20_000


def test_empty_tables_and_lost_conversations(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert op.repair(spark.createDataFrame([], schema)).collect() == []
    lost = [(c, 0, "user", "Yes.") for c in range(2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert lost and result(op.repair(spark.createDataFrame(lost, schema))) == {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, *_ in lost}


def test_few_vectors():
    """Prices bound the cost vectors: however long a scan, the table stays small."""
    a, rng = op.Automaton(), random.Random(1)
    a.scan(a.number(op.END)[0], [rng.randrange(op.GONE + 1) for _ in range(100_000)], [1] * 100_000)
    assert len(a.vectors) < 60
