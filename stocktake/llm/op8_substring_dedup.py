"""Substring dedup: seed and extend on winnowed anchors, keeping the first of all repeated windows of words.

Every window of `WINDOW` words selects an anchor: the smallest hash among its grams of GRAM words. Windows with the
same words select the same anchor at the same place, so a window can only repeat where its anchor does.

1. Seeds: documents send their anchors, about one in seven words, to the task that owns the hash; anchors seen twice
   go back to their documents.
2. Extension: around each repeated anchor a document extends to all windows that selected it, both ways, and sends
   these windows' hashes to their owners.
3. Owners find the first start of each window, by (document id, word), and send back the later ones with the place of
   an earlier one.
4. Of these a document makes its maximal repeats: runs of windows whose earlier places run on in one document,
   (start, other document, other start, length), all of WINDOW words or more. It drops the words that they cover.

Windows are joined on hashes, never in pairs: each meets an earlier one, so a thousand copies make a thousand links.
Their words are compared by 96 bits of hash.

What travels is packed: one binary row per batch of documents and owner, about nine bytes an anchor or window, and
the texts twice. A batch sends each hash once and settles its own repeats itself, so an anchor or window that a
third of all documents hold reaches its owner once per batch only. Parts follow the bytes of the texts, which are
counted first; what the owners found is staged, so that a lost executor repeats the last step only.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordHash, list_array, mix64, stack, staged, texts, tidy

WINDOW = 20
GRAM = 8
OWNER_BYTES = 16 << 20

ROWS = "to int, kind int, data binary"
TEXT, SEED, KNOWN_SEED, WIN, LATER = range(5)


def owners(docs: DataFrame) -> int:
    """Into how many parts hashes and documents are dealt: one for each OWNER_BYTES of text."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // OWNER_BYTES + 1)


# packed rows


def _zip(x: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x)


def _unzip(x: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(x)


def pack_at(key: np.ndarray, ids: np.ndarray, count: np.ndarray, at: np.ndarray, *more: np.ndarray) -> bytes:
    """Documents (key, id, number of entries), places of entries (rising in each document) and further 8- and 4-byte columns."""
    step = np.diff(at, prepend=0).astype("<i4")
    head = np.concatenate([key.view(np.uint64), ids.astype(np.int64).view(np.uint64), count.astype(np.uint64)]).tobytes()
    body = _zip(head + step.tobytes())
    return b"".join([np.array([len(key), len(at), len(body)], "<u8").tobytes(), body, *(x.tobytes() for x in more)])


def unpack_at(data: bytes, kinds: tuple = ()) -> tuple:
    docs, n, size = np.frombuffer(data, "<u8", 3).astype(int)
    body = _unzip(data[24 : 24 + size])
    head = np.frombuffer(body, "<u8", 3 * docs)
    at = np.cumsum(np.frombuffer(body, "<i4", n, 24 * docs), dtype=np.int64)
    out, lo = [], 24 + size
    for kind in kinds:
        out.append(np.frombuffer(data, kind, n, lo))
        lo += out[-1].nbytes
    return head[:docs], head[docs : 2 * docs].view(np.int64), head[2 * docs :].astype(np.int64), at, *out


def pack_later(pick: np.ndarray, lead: np.ndarray, doc: np.ndarray, key: np.ndarray, ids: np.ndarray, at: np.ndarray) -> bytes:
    """Later windows (pick, in the order of (document, place)) with the entries (lead) they repeat, as documents and distances."""
    d = doc[pick]
    first = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
    own, count = d[first], np.diff(np.append(first, len(d)))
    other, which = np.unique(doc[lead[pick]], return_inverse=True)
    heads = [key[own].view(np.uint64), ids[own].view(np.uint64), count.astype(np.uint64), key[other].view(np.uint64), ids[other].view(np.uint64)]
    back = at[lead[pick]] - at[pick]
    body = _zip(b"".join(x.tobytes() for x in (*heads, np.diff(at[pick], prepend=0).astype("<i4"), which.astype("<i4"), back.astype("<i4"))))
    return np.array([len(own), len(other), len(pick)], "<u8").tobytes() + body


def unpack_later(data: bytes) -> tuple[np.ndarray, ...]:
    """Keys and numbers of entries of documents; of each entry its place, the key and id of the other document and the place there."""
    docs, others, n = np.frombuffer(data, "<u8", 3).astype(int).tolist()
    body = _unzip(data[24:])
    head = np.frombuffer(body, "<u8", 3 * docs + 2 * others)
    step, which, back = np.frombuffer(body, "<i4", 3 * n, head.nbytes).reshape(3, n)
    at = np.cumsum(step, dtype=np.int64)
    key, ids = head[3 * docs : 3 * docs + others], head[3 * docs + others :].view(np.int64)
    return head[:docs], head[2 * docs : 3 * docs].astype(np.int64), at, key[which], ids[which], at + back


def pack_texts(docs: list[tuple[int, int, bool, bytes]]) -> bytes:
    head = np.array([x for d in docs for x in (d[0], len(d[3]) + (d[2] << 62))], "<u8")
    ids = np.array([d[1] for d in docs], "<i8")
    return np.array([len(docs)], "<u8").tobytes() + _zip(head.tobytes() + ids.tobytes() + b"".join(d[3] for d in docs))


def unpack_texts(data: bytes) -> Iterator[tuple[int, int, bool, bytes]]:
    n = int(np.frombuffer(data, "<u8", 1)[0])
    body = _unzip(data[8:])
    head = np.frombuffer(body, "<u8", 2 * n).reshape(n, 2).tolist()
    ids = np.frombuffer(body, "<i8", n, 16 * n).tolist()
    lo = 24 * n
    for (key, size), i in zip(head, ids, strict=True):
        size, named = size & ((1 << 62) - 1), bool(size >> 62)
        yield key, i, named, body[lo : lo + size]
        lo += size


def rows_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    to, kind, data = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(kind, pa.int32()), pa.array(data, pa.binary())], names=["to", "kind", "data"])


# words and windows of a run of documents


class Words:
    """The hashed words of some documents, one after the other."""

    def __init__(self, docs: list[bytes], known: WordHash):
        each = []
        for b in docs:
            w = b.split()
            each.append(np.fromiter(map(known.__getitem__, w), np.uint64, len(w)))
        self.count = np.array([len(x) for x in each], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.count)])
        self.h = np.concatenate(each) if each else np.zeros(0, np.uint64)

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Document and start of each window, the place of its anchor, and the hashes of all grams."""
        n = len(self.h)
        if n < WINDOW:
            return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
        gram = np.full(n - GRAM + 1, GRAM, np.uint64)
        for j in range(GRAM):
            gram = mix64(gram + self.h[j : j + len(gram)])
        m = n - WINDOW + 1
        best, at = gram[:m].copy(), np.zeros(m, np.int64)
        for j in range(1, WINDOW - GRAM + 1):
            less = gram[j : j + m] < best
            best[less] = gram[j : j + m][less]
            at[less] = j
        doc = np.repeat(np.arange(len(self.count)), self.count)
        inside = np.flatnonzero(doc[:m] == doc[WINDOW - 1 :])
        return doc[inside], inside, inside + at[inside], gram

    def window_hashes(self, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """96 bits of hash of the windows that begin at start."""
        a, c = np.full(len(start), 1, np.uint64), np.zeros(len(start), np.uint64)
        for j in range(WINDOW):
            x = self.h[start + j]
            a = mix64(a + x)
            c = c * np.uint64(0x9E3779B97F4A7C15) + (x ^ (x >> np.uint64(29)))
        return a, (mix64(c) >> np.uint64(32)).astype("<u4")


def dealt(owner: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each owner, the entries that go to it, in their order."""
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(n + 1))
    for p in np.unique(owner).tolist():
        yield p, order[cuts[p] : cuts[p + 1]]


def pack_entries(pick: np.ndarray, doc: np.ndarray, key: np.ndarray, ids: np.ndarray, at: np.ndarray, *more: np.ndarray) -> bytes:
    """pick: entries in the order of (document, place)."""
    d = doc[pick]
    first = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]])) if len(d) else np.zeros(0, np.int64)
    own = d[first]
    return pack_at(key[own], ids[own], np.diff(np.append(first, len(d))), at[pick], *(x[pick] for x in more))


# the four steps


def text_rows(df: DataFrame, n: int) -> DataFrame:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            to = defaultdict(list)
            for key, i, named, b in keyed(batch):
                to[key % n].append((key, i, named, b))
            if to:
                yield rows_batch([(q, TEXT, pack_texts(d)) for q, d in to.items()])

    return df.mapInArrow(tidy(send), ROWS)


def keyed(batch: pa.RecordBatch) -> Iterator[tuple[int, int, bool, bytes]]:
    """A key of (id, text) to find the row again, the id, whether there is one, and the text."""
    for i, b in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
        named = i is not None
        yield xxhash.xxh3_64_intdigest(b, seed=xxhash.xxh3_64_intdigest(str(i))), i or 0, named, b


def seed_rows(df: DataFrame, n: int) -> DataFrame:
    known = WordHash()

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = [d for d in keyed(batch) if d[2]]
            if not docs:
                continue
            key, ids = np.array([d[0] for d in docs], np.uint64), np.array([d[1] for d in docs], np.int64)
            words = Words([d[3] for d in docs], known)
            doc, _, anchor, gram = words.windows()
            place, first = np.unique(anchor, return_index=True)
            if not len(place):
                continue
            doc, h = doc[first], gram[place]
            at = place - words.begin[doc]
            _, lead, back, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
            rows = []
            ships = np.zeros(len(h), bool)
            ships[lead] = True
            pick = np.flatnonzero(ships)
            twice = (count > 1)[back].astype("u1")
            for p, i in dealt((h[pick] % np.uint64(n)).astype(np.int64), n):
                rows.append((p, SEED, pack_entries(pick[i], doc, key, ids, at, h, twice)))
            rest = np.flatnonzero(~ships)
            for q, i in dealt((key[doc[rest]] % np.uint64(n)).astype(np.int64), n):
                rows.append((q, KNOWN_SEED, pack_entries(rest[i], doc, key, ids, at)))
            yield rows_batch(rows)

    return df.mapInArrow(tidy(send), ROWS)


def entries(blobs: list[bytes], kinds: tuple) -> tuple:
    """All entries of some packed rows: index of document, place and further columns; keys and ids by document."""
    got = [unpack_at(x, kinds) for x in blobs]
    key, ids, count = (np.concatenate([g[i] for g in got]) for i in range(3))
    return key, ids, np.repeat(np.arange(len(key)), count), *(np.concatenate([g[i] for g in got]) for i in range(3, 4 + len(kinds)))


def by_partition(work):
    """work(to, {kind: blobs}) -> rows or batches, for what was dealt to each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = defaultdict(lambda: defaultdict(list))
        for batch in batches:
            for to, kind, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                held[to][kind].append(data)
        for to in sorted(held):
            yield from work(to, held.pop(to))

    return run


def repeated_seeds(n: int):
    def work(to: int, rows: dict) -> Iterator[pa.RecordBatch]:
        out = [(to, KNOWN_SEED, x) for x in rows.get(KNOWN_SEED, ())]
        if blobs := rows.pop(SEED, None):
            key, ids, doc, at, h, twice = entries(blobs, ("<u8", "u1"))
            order = np.argsort(h, kind="stable")
            s = h[order]
            same = np.zeros(len(s), bool)
            same[1:] = s[1:] == s[:-1]
            same[:-1] |= same[1:]
            hit = np.zeros(len(s), bool)
            hit[order] = same
            pick = np.flatnonzero(hit | (twice > 0))
            for q, i in dealt((key[doc[pick]] % np.uint64(n)).astype(np.int64), n):
                out.append((q, KNOWN_SEED, pack_entries(pick[i], doc, key, ids, at)))
        if out:
            yield rows_batch(out)

    return work


def extended(n: int):
    known = WordHash()

    def work(to: int, rows: dict) -> Iterator[pa.RecordBatch]:
        key, _, doc, at = entries(rows[KNOWN_SEED], ()) if KNOWN_SEED in rows else (np.zeros(0, np.uint64), None, np.zeros(0, np.int64), np.zeros(0, np.int64))
        seeded = set(key.tolist())
        docs = list({d[0]: d for blob in rows.pop(TEXT, ()) for d in unpack_texts(blob) if d[2] and d[0] in seeded}.values())
        if not docs:
            return
        where = {d[0]: i for i, d in enumerate(docs)}
        words = Words([d[3] for d in docs], known)
        wdoc, start, anchor, gram = words.windows()
        live = np.zeros(len(words.h) + 1, bool)
        live[words.begin[np.array([where[k] for k in key.tolist()], np.int64)[doc]] + at] = True
        pick = np.flatnonzero(live[anchor])
        wdoc, start = wdoc[pick], start[pick]
        h, check = words.window_hashes(start)
        place = start - words.begin[wdoc]
        key, ids = np.array([d[0] for d in docs], np.uint64), np.array([d[1] for d in docs], np.int64)
        lead = earlier_starts(h, check, ids[wdoc], place)
        later = lead >= 0
        out = []
        # of equal windows here the first is sent, with any that tie with it
        stay = np.flatnonzero(~later)
        for p, i in dealt((h[stay] % np.uint64(n)).astype(np.int64), n):
            out.append((p, WIN, pack_entries(stay[i], wdoc, key, ids, place, h, check)))
        gone = np.flatnonzero(later)
        if len(gone):
            out.append((to, LATER, pack_later(gone, lead, wdoc, key, ids, place)))
        if out:
            yield rows_batch(out)

    return work


def earlier_starts(h: np.ndarray, check: np.ndarray, ids: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each window the entry of the same that starts first, by (document id, word); -1 for those that do."""
    lead = np.full(len(h), -1)
    if not len(h):
        return lead
    rank = (np.unique(ids, return_inverse=True)[1].astype(np.int64) << 32) | place
    order = np.lexsort((rank, h))
    s, c = h[order], check[order]
    if ((s[1:] == s[:-1]) & (c[1:] != c[:-1])).any():
        order = np.lexsort((rank, check, h))
        s, c = h[order], check[order]
    begin = np.flatnonzero(np.concatenate([[True], (s[1:] != s[:-1]) | (c[1:] != c[:-1])]))
    first = np.repeat(order[begin], np.diff(np.append(begin, len(s))))
    lead[order] = np.where(rank[order] > rank[first], first, -1)
    return lead


def settled(n: int):
    def work(to: int, rows: dict) -> Iterator[pa.RecordBatch]:
        out = [(to, LATER, x) for x in rows.get(LATER, ())]
        if blobs := rows.pop(WIN, None):
            key, ids, doc, at, h, check = entries(blobs, ("<u8", "<u4"))
            lead = earlier_starts(h, check, ids[doc], at)
            gone = np.flatnonzero(lead >= 0)
            for q, i in dealt((key[doc[gone]] % np.uint64(n)).astype(np.int64), n):
                out.append((q, LATER, pack_later(gone[i], lead, doc, key, ids, at)))
        if out:
            yield rows_batch(out)

    return work


def maximal_repeats(at: np.ndarray, key: np.ndarray, ids: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Rows (start, other id, other start, length) of later windows at `at`, whose words are at `other` in the document (key, id)."""
    order = np.argsort(at, kind="stable")
    at, key, ids, other = at[order], key[order], ids[order], other[order]
    starts = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1] + 1) | (other[1:] != other[:-1] + 1) | (key[1:] != key[:-1])]))
    return np.stack([at[starts], ids[starts], other[starts], np.diff(np.append(starts, len(at))) + WINDOW - 1], 1)


def kept_words():
    def work(to: int, rows: dict) -> Iterator[pa.RecordBatch]:
        cuts = defaultdict(list)
        for blob in rows.pop(LATER, ()):
            key, count, *entries_ = unpack_later(blob)
            ends = np.cumsum(count)
            for k, lo, hi in zip(key.tolist(), (ends - count).tolist(), ends.tolist(), strict=True):
                cuts[k].append([x[lo:hi] for x in entries_])
        found: dict[int, np.ndarray] = {}
        for blob in rows.pop(TEXT, ()):
            ids, named, n, removed, text, repeats = [], [], [], [], [], []
            for k, i, has, b in unpack_texts(blob):
                words = b.split()
                ids.append(i)
                named.append(has)
                n.append(len(words))
                repeats.append(np.zeros((0, 4), np.int64))
                if has and k in cuts:
                    if k not in found:
                        found[k] = maximal_repeats(*(np.concatenate(x) for x in zip(*cuts[k], strict=True)))
                    repeats[-1] = own = found[k]
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, own[:, 0], 1)
                    np.add.at(edge, own[:, 0] + own[:, 3], -1)
                    words = [w for w, s in zip(words, (np.cumsum(edge)[:-1] == 0).tolist(), strict=True) if s]
                removed.append(n[-1] - len(words))
                text.append(b" ".join(words))
            flat = np.concatenate(repeats)
            lists = list_array(pa.StructArray.from_arrays([pa.array(flat[:, j]) for j in range(4)], ["start", "other", "other_start", "length"]), [len(x) for x in repeats])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64(), mask=~np.array(named, bool)), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(text, pa.binary()).cast(pa.string()), lists],
                names=["doc_id", "n_words", "n_removed", "text", "repeats"],
            )

    return work


def dedup_substrings(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, the text of the kept words, joined by one blank, and repeats.

    Each word goes that a window of 20 words covers whose words also start earlier: in a smaller id, or before it in
    the same document. repeats has the maximal runs of such windows: start, other (an id), other_start and length, in
    words; the words there are the same. A null text has no words. Rows without an id are in no document: they keep all
    words. Equal rows are one document and have equal results; rows that share an id but not the text are read as one
    document's versions, none earlier than the other at the same word. An empty table gives an empty result. Ids are
    integers; other columns are ignored.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    n = owners(docs)
    to = lambda *dfs: (dfs[0] if len(dfs) == 1 else dfs[0].unionByName(dfs[1])).repartitionById(n, F.col("to"))
    done = lambda rows, work, schema=ROWS: rows.mapInArrow(tidy(by_partition(work)), schema)
    seeds = done(to(seed_rows(docs, n)), repeated_seeds(n))
    wins = done(to(text_rows(docs, n), seeds), extended(n))
    later = staged(done(to(wins), settled(n)), "later-windows")
    schema = "doc_id long, n_words long, n_removed long, text string, repeats array<struct<start:long,other:long,other_start:long,length:long>>"
    return done(to(text_rows(docs, n), later), kept_words(), schema)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_substrings(stack(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
with docs as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), windows as (
  select doc_id, i, array_to_string(w[i:i + 19], ' ') as win from (select doc_id, w, unnest(range(1, len(w) - 18)) as i from docs)
), later as (
  select doc_id, i from windows qualify row_number() over (partition by win order by doc_id, i) > 1
), gone as (
  select distinct doc_id, unnest(range(i, i + 20)) as spot from later
), words as (
  select doc_id, unnest(range(1, len(w) + 1)) as spot, unnest(w) as word from docs
), kept as (
  select x.doc_id, count(*) as n, string_agg(word, ' ' order by x.spot) as text
  from words x left join gone g on x.doc_id = g.doc_id and x.spot = g.spot where g.spot is null group by x.doc_id
)
select d.doc_id, len(w) as n_words, len(w) - coalesce(k.n, 0) as n_removed, sha256(coalesce(k.text, '')) as kept_sha256
from docs d left join kept k on d.doc_id = k.doc_id
"""
