"""Conversation structure repair by a lazily determinised weighted automaton.

A conversation is to read as an optional system turn and then pairs of user and assistant turns, or as nothing. Rows may be
kept, given another role or deleted, and empty rows inserted, each edit at its price. Four states say what has been
read so far: nothing, a system row, up to a user's row, up to an assistant's row.

Determinisation. Scanning a conversation from its last row to its first, the vector of the four states' least costs from
there on, less its smallest entry, is a state of the determinised automaton; what was taken off is the transition's weight.
Which vector follows for which kind of row (four initials, truncated or not; or a row that has to go) is computed when it is
first met and cached in a transition table. Prices bound the differences, so there are few vectors, and a scan is a lookup a row.

Trace. Going back over the scan, from the first row on, the arcs that are tight, whose price and cost from there make up the
cost from here, belong to cheapest repairs. Each state has at most one arc for a letter, so always taking the tight arc with
the smallest letter gives the least audit in ASCII order; and an audit says what the roles become.

Long conversations. Rows that are equal, turn included, are counted, then all rows are dealt out by ranges of (conversation,
turn) and cut into runs of at most RUN_ROWS rows. What lies whole within a range is done there. The runs of others are first
told which of their rows an earlier run has; each then is a 4 by 4 matrix of costs from its beginning to its end, the
matrices give the vector at each run's end, that gives the state each run passes on, and these the state in which it
begins: four small numbers a run go through each of these steps, and only a conversation's audit and hash, which are a
single value, take its pieces in order, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, stack, staged, tidy

RUN_ROWS = 4096
RUN_BYTES = 1 << 20
BLANKS = " \t\n\x0b\x0c\r"
FAULTS = 20
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
NEVER = 1 << 50
INITIALS = "sua"
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
#: The state after another row, by its initial; the states are: nothing, system, user, assistant.
ARCS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: Kinds of rows: initial (others are 3) * 2 + truncated, or GONE for one that has to be deleted.
GONE = 8


def closed(v: list[int]) -> tuple[int, ...]:
    """Costs once rows may be inserted first."""
    for _ in range(3):
        v = [min([v[q], *(INSERT + v[to] for c, to in ARCS[q].items() if c in ROLES)]) for q in range(4)]
    return tuple(min(x, NEVER) for x in v)


END = closed([0, NEVER, NEVER, 0])


class Automaton:
    """Normalised cost vectors by number, and the transitions met so far."""

    def __init__(self) -> None:
        self.vectors: list[tuple[int, ...]] = []
        self.numbers: dict[tuple[int, ...], int] = {}
        self.table: list[list[tuple[int, int] | None]] = []
        self.arcs: dict[tuple[int, int, int], tuple[str, tuple[str, ...], int, int]] = {}

    def number(self, v: tuple[int, ...]) -> tuple[int, int]:
        """The vector's number once its least entry is taken off, and that."""
        low = min(v)
        v = tuple(x if x >= NEVER else x - low for x in v)
        if v not in self.numbers:
            self.numbers[v] = len(self.vectors)
            self.vectors.append(v)
            self.table.append([None] * (GONE + 1))
        return self.numbers[v], low

    def options(self, q: int, kind: int) -> Iterator[tuple[str, str | None, int, int]]:
        """What can become of a row in state q, by letter: the letter, a new role's initial, price, next state."""
        yield "D", None, DELETE, q
        if kind != GONE:
            more = TRUNCATED * (kind & 1)
            if (to := ARCS[q].get("sua-"[kind >> 1])) is not None:
                yield "K", None, more, to
            for c in ROLES:
                if c in ARCS[q]:
                    yield "R", c, REROLE + more, ARCS[q][c]

    def before(self, v: tuple[int, ...], kind: int) -> tuple[int, ...]:
        """The costs before a row, from those after it."""
        return closed([min(price + v[to] for _, _, price, to in self.options(q, kind)) for q in range(4)])

    def step(self, number: int, kind: int) -> tuple[int, int]:
        """The transition: the vector before a row of this kind, and the weight."""
        if (known := self.table[number][kind]) is None:
            known = self.table[number][kind] = self.number(self.before(self.vectors[number], kind))
        return known

    def scan(self, number: int, kinds: list[int], copies: list[int]) -> tuple[list[int], int]:
        """The vectors after each row and before the first, and the weights' sum. Copies of a row have to go: they change no vector."""
        out, cost = [number] * (len(kinds) + 1), 0
        for i in range(len(kinds) - 1, -1, -1):
            out[i], add = self.step(out[i + 1], kinds[i])
            cost += add + DELETE * (copies[i] - 1)
        return out, cost

    def arc(self, q: int, kind: int, after: int) -> tuple[str, tuple[str, ...], int, int]:
        """The least tight arcs from state q through a row, when the vector after it is given: letters, initials of new roles, price, next state."""
        key = q, kind, after
        if key not in self.arcs:
            v = self.vectors[after]
            costs = self.before(v, kind)
            letters, roles, price = "", (), 0
            while True:
                there = [x for x in self.options(q, kind) if x[2] + v[x[3]] == costs[q]]
                there += [("I", c, INSERT, to) for c, to in ARCS[q].items() if c in ROLES and INSERT + costs[to] == costs[q]]
                letter, c, cost, to = min(there, key=lambda x: x[0])
                letters, roles, price, q = letters + letter, (*roles, c), price + cost, to
                if letter != "I":
                    break
            self.arcs[key] = letters, roles, price, q
        return self.arcs[key]

    def exits(self, kinds: list[int], copies: list[int], after: int) -> list[int]:
        """For each state at the beginning, that at the end."""
        vectors, _ = self.scan(after, kinds, copies)
        states = list(range(4))
        for i, kind in enumerate(kinds):
            states = [self.arc(q, kind, vectors[i + 1])[3] for q in states]
        return states

    def matrix(self, kinds: list[int], copies: list[int]) -> list[int]:
        """Costs from each state at the beginning to each at the end, by rows; NEVER where there is no way."""
        columns = []
        for k in range(4):
            start, _ = self.number(tuple(0 if q == k else NEVER for q in range(4)))
            vectors, cost = self.scan(start, kinds, copies)
            columns.append([x if x >= NEVER else x + cost for x in self.vectors[vectors[0]]])
        return [columns[k][q] for q in range(4) for k in range(4)]


def through(matrix: list[int], v: list[int] | tuple[int, ...]) -> tuple[int, ...]:
    """The costs before a run, less the least, from those after it."""
    out = [min(matrix[4 * q + k] + v[k] for k in range(4)) for q in range(4)]
    return tuple(min(x - min(out), NEVER) for x in out)


def damaged(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, mend_only: bool = False) -> DataFrame:
    """(conv, turn, role, text, n): rows after damage, n of each; a conversation that has lost all has one row of which there are none."""
    rows = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))))
    if mend_only:
        rows = rows.withColumn("n", F.lit(1).cast("long"))
    else:
        name = F.concat(F.coalesce(F.col("conv").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
        fault = F.col("fault")
        rows = rows.withColumn("fault", F.crc32(name.cast("binary")) % FAULTS).select(
            "conv",
            F.when(fault != 0, F.col("turn")).alias("turn"),
            F.when(fault == 0, "").when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(fault <= 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
            F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).cast("long").alias("n"),
        )
    return rows.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n"))


def runs_of(rows: DataFrame) -> DataFrame:
    """(conv, open, turn, role, text, n, run): the rows in order, as arrays; open says that a neighbouring run may have more of the conversation. Staged."""
    tie = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    dealt = rows.withColumn("tie", tie).repartitionByRange("conv", "turn", "tie").sortWithinPartitions("conv", "turn", "tie")
    names = ("turn", "role", "text", "n")
    schema = T.StructType([rows.schema["conv"], *T._parse_datatype_string("open boolean, turn array<long>, role array<string>, text array<string>, n array<long>").fields])
    arrow = pa.schema([("turn", pa.list_(pa.int64())), ("role", pa.list_(pa.string())), ("text", pa.list_(pa.string())), ("n", pa.list_(pa.int64()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, first, parts, conv = 0, True, 0, None
        done: list[tuple] = []

        def close(more: bool, last: bool) -> None:
            """End a run; more: the same conversation goes on in the next one."""
            nonlocal held, size, parts, first
            done.append((conv, first or more or last or parts > 0, *([r[i] for r in held if r[3] or len(held) == 1] for i in range(4))))
            held, size = [], 0
            parts = parts + 1 if more else 0
            first = first and more

        def batch_of(kind: pa.DataType) -> pa.RecordBatch:
            cols = list(zip(*done, strict=True))
            arrays = [pa.array(cols[0], kind), pa.array(cols[1], pa.bool_()), *(pa.array(c, arrow.field(n).type) for n, c in zip(names, cols[2:], strict=True))]
            done.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["conv", "open", *names])

        kind = None
        for batch in batches:
            kind = col(batch, "conv").type
            for c, *row in zip(*(col(batch, x).to_pylist() for x in ("conv", *names)), strict=True):
                if held and c != conv:
                    close(False, False)
                elif held and (len(held) >= RUN_ROWS or size + len(row[1]) + len(row[2]) > RUN_BYTES):
                    close(True, False)
                conv = c
                held.append(row)
                size += len(row[1]) + len(row[2])
            if done:
                yield batch_of(kind)
        if held:
            close(False, True)
            yield batch_of(kind)

    return staged(dealt.select("conv", *names).mapInArrow(tidy(cut), schema).withColumn("run", F.monotonically_increasing_id()), "conversation-runs")


class Judged:
    """A run's rows, and what is wrong with each."""

    def __init__(self, turn: list, role: list[str], text: list[str], n: list[int], known: list[int] | None) -> None:
        there = [i for i, k in enumerate(n) if k]
        self.turn, self.role, self.text, self.copies = ([x[i] for i in there] for x in (turn, role, text, n))
        earlier, seen = set(known or ()), set()
        self.kinds: list[int] = []
        self.blank = self.duplicate = self.truncated = 0
        for at, r, t, k in zip(there, self.role, self.text, self.copies, strict=True):
            full = t.strip(BLANKS)
            if not full:
                kind, self.blank = GONE, self.blank + k
            elif at in earlier or (r, t) in seen:
                kind, self.duplicate = GONE, self.duplicate + k
            else:
                cut = full[-1] not in ".!?"
                kind = 2 * (INITIALS.find(r[0]) if r and r[0] in INITIALS else 3) + cut
                self.truncated, self.duplicate = self.truncated + cut, self.duplicate + k - 1
            seen.add((r, t))
            self.kinds.append(kind)

    def illegal(self) -> int:
        """Neighbours that don't follow one another; a row and its copy never do."""
        return sum(k - 1 for k in self.copies) + sum(a[:1] + b[:1] not in LEGAL for a, b in zip(self.role, self.role[1:], strict=False))

    def traced(self, a: Automaton, after: int, q: int) -> tuple[str, list[str], int, int]:
        """Audit, repaired rows, cost, and the state at the end, beginning in state q."""
        vectors, _ = a.scan(after, self.kinds, self.copies)
        audit, lines, cost = [], [], 0
        for i, kind in enumerate(self.kinds):
            letters, roles, price, q = a.arc(q, kind, vectors[i + 1])
            for letter, c in zip(letters, roles, strict=True):
                if letter != "D":
                    lines.append(f"{ROLES[c] if c else self.role[i]}:{'' if letter == 'I' else self.text[i]}")
            audit.append(letters + "D" * (self.copies[i] - 1))
            cost += price + DELETE * (self.copies[i] - 1)
        return "".join(audit), lines, cost, q


PIECE = "last boolean, rows long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, lines array<string>, turns long, turn_lo long, turn_hi long, role_lo string, role_hi string"


def pieces(runs: DataFrame) -> DataFrame:
    """A run's part of the result, from (conv, run, turn, role, text, n, known, after, entry, last)."""
    schema = T.StructType([runs.schema["conv"], *T._parse_datatype_string("run long, " + PIECE).fields])
    names = schema.names

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = Automaton()
        types = None
        for batch in batches:
            kind, out = col(batch, "conv").type, []
            types = types or [kind, pa.int64(), pa.bool_(), *repeat(pa.int64(), 6), pa.string(), pa.list_(pa.string()), *repeat(pa.int64(), 3), pa.string(), pa.string()]
            for conv, run, turn, role, text, n, known, after, entry, last in zip(*(col(batch, c).to_pylist() for c in ("conv", "run", "turn", "role", "text", "n", "known", "after", "entry", "last")), strict=True):
                j = Judged(turn, role, text, n, known)
                audit, lines, cost, q = j.traced(a, a.number(tuple(after))[0], entry)
                while last and END[q]:  # the rest can only be inserted
                    c, q = next((c, to) for c, to in ARCS[q].items() if c in ROLES and INSERT + END[to] == END[q])
                    audit, cost = audit + "I", cost + INSERT
                    lines.append(f"{ROLES[c]}:")
                dated = [t for t in j.turn if t is not None]
                ends = (dated[0], dated[-1]) if dated else (None, None)
                roles = (j.role[0][:1], j.role[-1][:1]) if j.role else (None, None)
                out.append((conv, run, last, sum(j.copies), j.blank, j.duplicate, j.truncated, j.illegal(), cost, audit, lines, len(set(dated)), *ends, *roles))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return runs.mapInArrow(tidy(stream), schema)


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, n_rows long"


def joined(parts: DataFrame) -> DataFrame:
    """One row per conversation, from its pieces in order."""
    schema = T.StructType([parts.schema["conv"], *T._parse_datatype_string(RESULT).fields])
    names = parts.columns

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh = lambda: {"sum": [0] * 6, "audit": [], "sha": hashlib.sha256(), "any": False, "turns": 0, "lo": None, "hi": None, "role": None}
        at = fresh()
        for batch in batches:
            out = []
            for row in zip(*(col(batch, c).to_pylist() for c in names), strict=True):
                p = dict(zip(names, row, strict=True))
                at["sum"] = [x + p[c] for x, c in zip(at["sum"], ("blank", "duplicate", "truncated", "illegal", "cost", "rows"), strict=True)]
                if at["role"] is not None and p["role_lo"] is not None:
                    at["sum"][3] += at["role"] + p["role_lo"] not in LEGAL
                at["role"] = at["role"] if p["role_hi"] is None else p["role_hi"]
                if p["turns"]:
                    at["turns"] += p["turns"] - (at["hi"] == p["turn_lo"])
                    at["lo"], at["hi"] = p["turn_lo"] if at["lo"] is None else at["lo"], p["turn_hi"]
                at["audit"].append(p["audit"])
                if p["lines"]:
                    at["sha"].update((("\n" if at["any"] else "") + "\n".join(p["lines"])).encode())
                    at["any"] = True
                if p["last"]:
                    blank, duplicate, truncated, illegal, cost, rows = at["sum"]
                    gaps = at["hi"] - at["lo"] + 1 - at["turns"] if at["turns"] else 0
                    out.append((p["conv"], gaps, blank, duplicate, truncated, illegal, cost, "".join(at["audit"]), at["sha"].hexdigest(), rows))
                    at = fresh()
            if out:
                types = [col(batch, "conv").type, *repeat(pa.int64(), 6), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=schema.names)

    return parts.mapInArrow(tidy(stream), schema)


def seen_before(runs: DataFrame) -> DataFrame:
    """(run, known): which rows of a run have their role and text in an earlier run of the conversation. A run has a key once, so none is in more rows than there are runs."""
    cells = runs.select("conv", "run", F.posexplode(F.arrays_zip("role", "text", "n")).alias("at", "x")).where("x.n > 0")
    key = F.md5(F.concat(F.length("x.role").cast("string"), F.lit(":"), "x.role", "x.text"))
    keys = staged(cells.select("conv", "run", "at", key.alias("key")).groupBy("conv", "run", "key").agg(F.min("at").alias("at")), "row-keys")
    first = keys.groupBy("conv", "key").agg(F.min("run").alias("first")).select(F.col("conv").alias("_conv"), F.col("key").alias("_key"), "first")
    later = keys.join(first, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("key") == F.col("_key"))).where("run > first")
    return later.groupBy("run").agg(F.collect_list("at").alias("known"))  # at most RUN_ROWS


def chained(rows: DataFrame, back: bool) -> DataFrame:
    """Along each conversation's runs, from (conv, run, matrix) back: (run, after, last); from (conv, run, exits) on: (run, entry)."""
    order = [F.col("conv"), F.col("run").desc() if back else F.col("run")]
    what = "matrix" if back else "exits"

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, value, begun = None, None, False
        for batch in batches:
            out = []
            for conv, run, x in zip(*(col(batch, c).to_pylist() for c in ("conv", "run", what)), strict=True):
                fresh = not begun or conv != before
                before, begun = conv, True
                if fresh:
                    value = END if back else 0
                out.append((run, list(value), fresh) if back else (run, value))
                value = through(x, value) if back else x[value]
            if out:
                types = [pa.int64(), pa.list_(pa.int64()), pa.bool_()] if back else [pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["run", "after", "last"] if back else ["run", "entry"])

    sorted_ = rows.select("conv", "run", what).repartition("conv").sortWithinPartitions(*order)
    return sorted_.mapInArrow(tidy(stream), "run long, after array<long>, last boolean" if back else "run long, entry long")


def linked_up(runs: DataFrame) -> DataFrame:
    """Open runs with known, after, entry and last."""
    known = staged(runs.join(seen_before(runs), "run", "left"), "judged-runs")
    schema = T.StructType([known.schema["conv"], *T._parse_datatype_string("run long, kinds binary, copies array<long>, matrix array<long>").fields])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = Automaton()
        for batch in batches:
            if batch.num_rows:
                made = [Judged(*row) for row in zip(*(col(batch, c).to_pylist() for c in ("turn", "role", "text", "n", "known")), strict=True)]
                arrays = [col(batch, "conv"), col(batch, "run"), pa.array([bytes(j.kinds) for j in made], pa.binary()), pa.array([j.copies for j in made], pa.list_(pa.int64())), pa.array([a.matrix(j.kinds, j.copies) for j in made], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    weighed = staged(known.select("conv", "run", "turn", "role", "text", "n", "known").mapInArrow(tidy(weigh), schema), "weighed-runs")
    after = staged(chained(weighed, True), "after-runs")
    exit_schema = T.StructType([known.schema["conv"], *T._parse_datatype_string("run long, exits array<long>").fields])

    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = Automaton()
        for batch in batches:
            if batch.num_rows:
                made = [a.exits(list(kinds), copies, a.number(tuple(v))[0]) for kinds, copies, v in zip(*(col(batch, c).to_pylist() for c in ("kinds", "copies", "after")), strict=True)]
                yield pa.RecordBatch.from_arrays([col(batch, "conv"), col(batch, "run"), pa.array(made, pa.list_(pa.int64()))], names=exit_schema.names)

    exits = weighed.join(after, "run").select("conv", "run", "kinds", "copies", "after").mapInArrow(tidy(leave), exit_schema)
    return known.join(after, "run").join(chained(exits, False), "run")


def repair(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", damage: bool = True, texts: bool = False) -> DataFrame:
    """One row per conversation: its id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, n_rows.

    damage: rows are damaged first, as the contract of the query says. A null role or text is one space, a null turn comes
    first; rows without a conversation's id are one conversation. Rows of one turn come by the hash of their role and text,
    so equal ones are neighbours, and what the table's order was doesn't matter. A role without characters has no initial
    and can't be kept. n_rows counts rows after damage. A conversation without any has zeros, an empty audit and the hash of nothing.
    An empty table gives an empty result. Other columns are ignored. texts: the pieces before they are joined instead,
    with a piece's repaired rows in lines, in the order of run.
    """
    runs = runs_of(damaged(df, conv_col, turn_col, role_col, text_col, not damage))
    bare = runs.where("not open").select("*", F.lit(None).cast("array<int>").alias("known"), F.array(*(F.lit(x).cast("long") for x in END)).alias("after"), F.lit(True).alias("last"), F.lit(0).cast("long").alias("entry"))
    names = ["conv", "run", "turn", "role", "text", "n", "known", "after", "entry", "last"]
    alone = pieces(bare.select(*names))
    linked = pieces(linked_up(runs.where("open")).select(*names))
    if texts:
        return alone.unionByName(linked).withColumnRenamed("conv", conv_col)
    found = joined(alone).unionByName(joined(linked.repartition("conv").sortWithinPartitions("conv", "run")))
    return found.withColumnRenamed("conv", conv_col)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(stack(spark, sf_dir, "conversations")).drop("n_rows")


SQL = None
