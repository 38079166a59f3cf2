"""The contracts of the operators, written as plainly as can be, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANKS = " \t\n\x0b\x0c\r"


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def digits(s):
    return re.sub(r"[^0-9]", "", s)


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0


def pii(text):
    t = text or ""
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(t) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 10 <= len(digits(m[0])) <= 15]
    kinds = ("email", "ip", "card", "phone")
    joined = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(out))
    return (*(sum(k == i for _, k, _ in out) for i in range(4)), sha(joined), joined)


def pattern_graph(mentions, min_support=5, min_confidence=0.8, min_belief=0.95, doubt=0.25):
    """mentions: (instance, kind or None, shape, patterns) -> {instance: kind} of the candidates accepted at the end."""
    kinds, shape, around = defaultdict(set), {}, defaultdict(set)
    for i, k, s, ps in mentions:
        if k is None:
            shape[i] = shape.get(i, 0) | s
        else:
            kinds[i].add(k)
        for p in ps:
            around[p].add(i)
    accepted = {}
    while True:
        confidence = {}
        for p, own in around.items():
            for k in range(4):
                backs = sum(k in kinds[i] if i in kinds else accepted.get(i) == k for i in own)
                weight = 1 + sum(1 if i in kinds or i in accepted or not shape[i] >> k & 1 else doubt for i in own)
                if backs >= min_support and round(backs / weight, 9) >= min_confidence:
                    confidence[p, k] = round(backs / weight, 9)
        new = {}
        for i in shape:
            if i in kinds or i in accepted:
                continue
            best = (0, 0)
            for k in range(4):
                left = 1.0
                for p in around:
                    if i in around[p] and (p, k) in confidence and shape[i] >> k & 1:
                        left *= max(1 - confidence[p, k], 1e-6)
                best = max(best, (round(1 - left, 9), -k))
            if best[0] >= min_belief:
                new[i] = -best[1]
        if not new:
            return accepted
        accepted |= new


def contamination(docs, items, n=10):
    windows = defaultdict(set)
    for i, text in items:
        w = BENCH_WORD.findall(lower(text or ""))
        for k in range(max(1, len(w) - n + 1)) if w else ():
            windows[tuple(w[k : k + n])].add("" if i is None else str(i))
    sizes = {len(w) for w in windows}
    out = []
    for d, text in docs:
        w = BENCH_WORD.findall(lower(text or ""))
        hit, found = set(), set()
        for n_ in sizes:
            for k in range(len(w) - n_ + 1):
                if (x := tuple(w[k : k + n_])) in windows:
                    hit |= set(range(k, k + n_))
                    found |= windows[x]
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def quality_base(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    twice = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(twice) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(twice), failed


def quality(docs, max_docs, min_left):
    """docs: (id, text, host) -> {id: (kept, words in boilerplate lines, text without these lines)}."""
    key = lambda x: lower(x.strip(BLANKS))
    holders = defaultdict(set)
    for _, text, host in docs:
        lines = tuple(key(x) for x in (text or "").split("\n") if WORD.search(x))
        for k in lines:
            holders[host, k].add(lines)  # documents with the same lines in the same order are copies
    often = {hk for hk, s in holders.items() if len(s) > max_docs}
    out = {}
    for d, text, host in docs:
        n, *_, failed = quality_base(text)
        lines = (text or "").split("\n")
        gone = sum(len(WORD.findall(x)) for x in lines if (host, key(x)) in often)
        left = "\n".join(x for x in lines if (host, key(x)) not in often)
        out[d] = not failed and n - gone >= min_left * n, gone, left
    return out


def line_dedup(docs):
    key = lambda x: lower(x.strip(BLANKS))
    holders = defaultdict(set)
    for d, text in docs:
        for x in (text or "").split("\n"):
            if d is not None and len(key(x)) >= 20:
                holders[key(x)].add(d)
    out = []
    for d, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if d is None or len(key(x)) < 20 or len(holders[key(x)]) < 3 or max(holders[key(x)]) == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def substrings(docs, n=20):
    first = {}
    words = [(d, WORD.findall(t or "")) for d, t in docs]
    for d, w in words:
        for i in range(len(w) - n + 1):
            k = tuple(w[i : i + n])
            if d is not None and (k not in first or (d, i) < first[k]):
                first[k] = (d, i)
    out = []
    for d, w in words:
        gone = {j for i in range(len(w) - n + 1) if d is not None and (d, i) > first[tuple(w[i : i + n])] for j in range(i, i + n)}
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def shingle_set(text, size=3):
    w = WORD.findall(lower(text or ""))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def groups(docs, size=3, similarity=90):
    """(id, shingles, smallest id reachable by links) of each of (id, text)."""
    sets = [(d, shingle_set(t, size)) for d, t in docs]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    at = defaultdict(list)
    for k, (d, s) in enumerate(sets):
        for x in s:
            at[x].append(k)
    for k, (d, s) in enumerate(sets):
        common = Counter(j for x in s for j in at[x] if j < k)
        for j, c in common.items():
            if 100 * c >= similarity * (len(s) + len(sets[j][1]) - c):
                a, b = sorted((find(d), find(sets[j][0])))
                root[b] = a
    return [(d, len(s), find(d)) for d, s in sets]
