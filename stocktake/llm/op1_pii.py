"""Personal data by bootstrapped contextual extraction.

Base patterns find e-mail addresses, IP addresses, card and phone numbers. These are the seeds. Around each seed, and
around each candidate (a token with a digit or an @ that no base pattern takes, with the shape of a kind), lexical
patterns are read off the text: the word before it, the two words before, the word after, the two words after, and the
words on both sides. Patterns and instances form a graph over all documents, which Spark scores in rounds:

- a pattern's confidence for a kind is the number of distinct instances of that kind it surrounds, over the weight of
  all it surrounds and one: an instance of this or another kind weighs 1, a candidate that can't be of the kind 1, an
  undecided one `doubt`. It counts once `min_support` distinct instances back it and the confidence is `min_confidence`;
- a candidate is believed to be of a kind as far as its confident patterns say so together (noisy or), if it has the
  shape of the kind, and is accepted from `min_belief` on.

The one that is added bounds what few instances can prove: a pattern alone convinces with 19 instances, two with five.
Accepted candidates are instances from the next round on, and stay; rounds go on until none is added. What is accepted is
added to the base spans.

Hubs, such as the edge of a text on both sides, are dropped before the rounds where even all undecided candidates could
not make them confident; that loses nothing. The keys that remain can still be in a third of all edges: sums are formed
before the shuffle, and joins split hot keys.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import HOT_KEYS, arrow_map, col, out_batch, spread_join, stack, staged

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A run of digits is taken whole or not at all, so no match begins inside one.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
CANDIDATE = re.compile(r"[0-9@]\S*(?: [0-9()+.-]*[0-9][0-9()+.-]*)*")
WORD = re.compile(r"\S+")
TRIM_LEFT, TRIM_RIGHT = "([{<\"'", ".,;:!?)]}>\"'"
EDGE = "\x02"

SPAN = "struct<start:long,end:long,kind:int>"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > done and text[lo - 1] in LOCAL:
            lo -= 1
        after = at + 1
        if lo < at and (m := DOMAIN.match(text, after)):
            out.append((lo, m.end()))
            done = after = m.end()
        at = text.find("@", after)
    return out


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind), by start, then kind."""
    out = [(s, e, 0) for s, e in emails(text)]
    out += [(*m.span(), 1) for m in IP.finditer(text) if all(map(small, m[0].split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            out.append((*m.span(), 2))
    out += [(*m.span(), 3) for m in PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    return sorted(out, key=lambda x: (x[0], x[2], x[1]))


def shape(value: str) -> int:
    """Bits of the kinds that a candidate may be of."""
    digits = len(digits_of(value))
    plain = not re.search(r"[^\x20().0-9+-]", value)
    return (
        1 * bool(re.fullmatch(r"[^@\s]+@[^@\s]+", value))
        + 2 * (plain and value.count(".") == 3 and 4 <= digits <= 12)
        + 4 * (plain and 13 <= digits <= 19)
        + 8 * (plain and 7 <= digits <= 15)
    )


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, shape) of tokens with a digit or @ outside the spans taken that have the shape of a kind."""
    out, done, spans, k = [], 0, sorted((s, e) for s, e, _ in taken), 0
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        while s > done and not text[s - 1].isspace():
            s -= 1
        done = e
        while s < e and text[s] in TRIM_LEFT:
            s += 1
        while s < e and text[e - 1] in TRIM_RIGHT:
            e -= 1
        while k < len(spans) and spans[k][1] <= s:
            k += 1
        j, free = k, s < e
        while free and j < len(spans) and spans[j][0] < e:
            free = spans[j][1] <= s
            j += 1
        if free and (kinds := shape(text[s:e])):
            out.append((s, e, kinds))
    return out


def words_before(text: str, at: int, n: int) -> list[str]:
    """The last n words before a place, the nearest first, however long they and the blanks between them are."""
    out = []
    while len(out) < n:
        while at > 0 and text[at - 1].isspace():
            at -= 1
        end = at
        while at > 0 and not text[at - 1].isspace():
            at -= 1
        if at == end:
            break
        out.append(text[at:end])
    return out


def patterns(text: str, s: int, e: int) -> list[str]:
    clean = lambda w: w.lower().strip(".,;:!?()[]{}<>\"'")
    left, right = words_before(text, s, 2), [m[0] for m, _ in zip(WORD.finditer(text, e), range(2))]
    l1, l2 = (clean(left[i]) if len(left) > i else EDGE for i in (0, 1))
    r1, r2 = (clean(right[i]) if len(right) > i else EDGE for i in (0, 1))
    return [f"{l1} _", f"{l2} {l1} _", f"{l1} _ {r1}", f"_ {r1} {r2}", f"_ {r1}"]


def join_spans(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


def h64(x: str) -> int:
    return xxhash.xxh3_64_intdigest(x) >> 1


def mentions(df: DataFrame) -> DataFrame:
    """_row, doc_id, base counts, base_sha256, base spans, and all mentions: place, kind (null: a candidate), shape, instance and patterns."""

    def look(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, shas, base, found = [], [], [], []
        for text in col(batch, "text").to_pylist():
            text = text or ""
            spans = base_spans(text)
            counts.append([sum(k == i for _, _, k in spans) for i in range(4)])
            shas.append(hashlib.sha256(join_spans(spans).encode()).hexdigest())
            base.append([{"start": s, "end": e, "kind": k} for s, e, k in spans])
            near = [(s, e, k, 1 << k) for s, e, k in spans] + [(s, e, None, x) for s, e, x in candidates(text, spans)]
            found.append(
                [{"start": s, "end": e, "kind": k, "shape": x, "instance": h64(text[s:e]), "patterns": [h64(p) for p in patterns(text, s, e)]} for s, e, k, x in near]
            )
        n = np.array(counts, np.int64).reshape(-1, 4)
        return out_batch(
            _row=col(batch, "_row"),
            doc_id=col(batch, "doc_id"),
            **{f"n_{k}": pa.array(n[:, i]) for i, k in enumerate(KINDS)},
            base_sha256=pa.array(shas),
            base=pa.array(base, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32())]))),
            found=pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("shape", pa.int32()), ("instance", pa.int64()), ("patterns", pa.list_(pa.int64()))]))),
        )

    fields = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base array<" + SPAN + ">, found array<struct<start:long,end:long,kind:int,shape:int,instance:long,patterns:array<long>>>"
    schema = T.StructType([df.schema["_row"], df.schema["doc_id"], *T._parse_datatype_string(fields).fields])
    return arrow_map(df.select("_row", "doc_id", "text"), look, schema)


def each_kind() -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(len(KINDS) - 1))).alias("kind")


def allowed() -> Column:
    """Whether the shape of a row allows its kind."""
    return F.expr("(shape & shiftleft(1, kind)) > 0")


def graph_of(found: DataFrame) -> DataFrame:
    """(pattern, instance, kinds, shape), once each: kinds are those that base patterns take the instance for anywhere, none for a candidate."""
    pairs = staged(found.select(F.explode("patterns").alias("pattern"), "instance").distinct(), "pattern-pairs")
    wide = pairs.groupBy("instance").agg(F.count(F.lit(1)).alias("n"))
    nodes = found.groupBy("instance").agg(F.array_sort(F.collect_set("kind")).alias("kinds"), F.bit_or(F.when(F.col("kind").isNull(), F.col("shape"))).alias("shape"))
    nodes = staged(nodes.join(wide, "instance"), "pattern-instances")
    return staged(spread_join(pairs, nodes, ["instance"], F.col("n") > pairs.count() // HOT_KEYS).drop("n"), "pattern-graph")


def able_patterns(graph: DataFrame, min_support: int, min_confidence: float) -> DataFrame:
    """(pattern, kind, seeds, every, maybe, never): what a pattern surrounds, for the kinds it could come to be confident of.

    seeds are of the kind, every counts the seeds of all kinds; maybe and never count the candidates that can and can't be
    of the kind. A pattern that would not be confident if it had all of maybe is left out, as it never will be.
    """
    own = graph.select("pattern", F.explode("kinds").alias("kind")).groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("seeds"))
    every = graph.where(F.size("kinds") > 0).groupBy("pattern").agg(F.count(F.lit(1)).alias("every"))
    maybe = graph.where(F.size("kinds") == 0).select("pattern", "shape", each_kind()).groupBy("pattern", "kind").agg(F.count_if(allowed()).alias("maybe"), F.count_if(~allowed()).alias("never"))
    sizes = own.join(maybe, ["pattern", "kind"], "full").join(every, "pattern", "left").na.fill(0, ["seeds", "every", "maybe", "never"])
    most = F.col("seeds") + F.col("maybe")
    return sizes.where((most >= min_support) & (most / (F.col("every") + F.col("never") + F.col("maybe") + 1) >= min_confidence))


def believed(found: DataFrame, min_support: int, min_confidence: float, min_belief: float, doubt: float) -> DataFrame:
    """(instance, kind, belief) of the candidates accepted after the last round, one kind each: the best, of equals the first.

    found: (instance, kind or null, shape, patterns), a row for each mention.
    """
    graph = graph_of(found)
    able = staged(able_patterns(graph, min_support, min_confidence), "patterns-able")
    open_ = graph.where(F.size("kinds") == 0).select("pattern", "instance", "shape")
    reach = able.groupBy("pattern").agg(F.max(F.col("maybe") + F.col("never")).alias("n"))
    edges = staged(spread_join(open_, reach, ["pattern"], F.col("n") > graph.count() // HOT_KEYS).drop("n"), "pattern-edges")
    hot = F.col("n") > edges.count() // HOT_KEYS
    wide = staged(edges.groupBy("instance").agg(F.count(F.lit(1)).alias("n")), "pattern-widths")
    accepted, many = None, 0
    while True:
        none = F.lit(0).cast("long")
        scored = able.select("*", none.alias("taken"), none.alias("gained"))
        if many:
            each = spread_join(edges, accepted.join(wide, "instance"), ["instance"], hot).select("pattern", "shape", F.col("kind").alias("is"), each_kind())
            gained = each.groupBy("pattern", "kind").agg(F.count_if(allowed()).alias("taken"), F.count_if(F.col("is") == F.col("kind")).alias("gained"))
            scored = able.join(gained, ["pattern", "kind"], "left").na.fill(0, ["taken", "gained"])
        backs = F.col("seeds") + F.col("gained")
        weight = F.col("every") + F.col("never") + F.col("taken") + doubt * (F.col("maybe") - F.col("taken")) + 1
        scored = scored.withColumn("confidence", F.round(backs / weight, 9))
        sure = scored.where((backs >= min_support) & (F.col("confidence") >= min_confidence))
        says = staged(sure.groupBy("pattern").agg(F.collect_list(F.struct("kind", "confidence")).alias("says"), F.max(F.col("maybe") + F.col("never")).alias("n")), "patterns-sure")
        said = spread_join(edges, says, ["pattern"], hot).select("instance", "shape", F.explode("says").alias("x")).select("instance", "shape", "x.*").where(allowed())
        belief = F.round(1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6))))), 9)
        voted = said.groupBy("instance", "kind").agg(belief.alias("belief")).where(F.col("belief") >= min_belief)
        best = voted.groupBy("instance").agg(F.max(F.struct("belief", (-F.col("kind")).alias("order"))).alias("top"))
        new = best.select("instance", (-F.col("top.order")).cast("int").alias("kind"), F.col("top.belief").alias("belief"))
        if many:
            new = accepted.unionByName(new.join(accepted.select("instance"), "instance", "left_anti"))
        accepted = staged(new, "believed")
        if many == (many := accepted.count()):
            return accepted


def find_pii(
    df: DataFrame,
    min_support: int = 5,
    min_confidence: float = 0.8,
    min_belief: float = 0.95,
    doubt: float = 0.25,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found.

    The counts and base_sha256 are of the base spans; spans has these and the ones the method found (n_found), as
    kind:start:end in characters, end exclusive, by start, then kind. A null or empty text has none. Repeated rows
    are each returned; their instances are the same and count once. An empty table gives an empty result. Other
    columns are ignored.
    """
    rows = df.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    table = staged(mentions(rows), "mentions")
    found = table.select("_row", F.explode("found").alias("x")).select("_row", "x.*")
    best = believed(found, min_support, min_confidence, min_belief, doubt)
    open_ = found.where("kind is null").drop("kind")
    seen = open_.join(best.select("instance"), "instance", "left_semi").groupBy("instance").agg(F.count(F.lit(1)).alias("n"))
    more = spread_join(open_, best.select("instance", "kind").join(seen, "instance"), ["instance"], F.col("n") > found.count() // HOT_KEYS)
    more = more.groupBy(F.col("_row").alias("_of")).agg(F.collect_list(F.struct("start", "end", "kind")).alias("_more"))
    joined = table.drop("found").join(more, F.col("_row") == F.col("_of"), "left")
    every = F.array_sort(F.transform(F.concat("base", F.coalesce("_more", F.expr(f"cast(array() as array<{SPAN}>)"))), lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))))
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    text = F.array_join(F.transform(every, lambda x: F.concat_ws(":", name(x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")
    return joined.select("doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", text.alias("spans"), F.coalesce(F.size("_more"), F.lit(0)).cast("long").alias("n_found"))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(stack(spark, sf_dir, "documents"))


#: Scores of the pattern graph are not for SQL; tests hold them, and the base spans, against brute force.
SQL = None
